"""Parts that need no cluster, each against a plain version."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmap.llm import fast_tokens, fingerprints, jaccard_join, packing, substring_dedup, topk, toxicity


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17F, exclude_categories=["Cs"]), st.sampled_from(list(" \n\t'<|endoftxs>日é"))), max_size=60))
def test_token_ids_are_the_librarys(text):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        fast = fast_tokens.load(name)
        assert np.frombuffer(fast.encode([text])[0], np.uint32).tolist() == fast.library.encode(text, add_special_tokens=False).ids


def test_best_fit_keeps_every_constraint():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 400)
    for rule in ("norm", "dot"):
        cap = np.array([100.0, 5.0, 6000.0])
        bins, offsets = packing.best_fit(lengths, cap, np.array([1.0, 0.1, 0.1]), rule)
        for b in np.unique(bins):
            own = lengths[bins == b]
            assert own.sum() <= 100 and len(own) <= 5 and (own**2).sum() <= 6000 or len(own) == 1
            order = np.argsort(offsets[bins == b])
            assert offsets[bins == b][order].tolist() == np.concatenate([[0], np.cumsum(own[order])[:-1]]).tolist()
    bins, _ = packing.best_fit(np.array([50, 50, 30, 70]), np.array([100.0, 100.0, 1e4]), np.array([1.0, 1e-3, 1e-3]))
    assert len(set(bins.tolist())) == 2


def test_fm_index_is_a_plain_search():
    rng = np.random.default_rng(2)
    seqs = [rng.integers(1, 4, rng.integers(5, 40)).astype(np.uint64) for _ in range(12)]
    numbers, most = rng.permutation(12), 5
    index = substring_dedup.FMIndex(seqs, numbers, most)
    stream = rng.integers(1, 5, 200).astype(np.uint64)
    ends = np.arange(1, 201)
    length, least = index.matches(index.codes(stream), ends, most)
    for e, n, lo in zip(ends, length, least, strict=True):
        hit = lambda k: [numbers[i] for i, s in enumerate(seqs) if any(s[j : j + k].tolist() == stream[e - k : e].tolist() for j in range(len(s) - k + 1))]  # noqa: B023, E731
        want = max(k for k in range(0, min(most, e) + 1) if k == 0 or hit(k))
        assert n == want
        assert lo == (min(hit(most)) if want == most else np.iinfo(np.int64).max)


def plain_chunks(data):
    """The distinct chunks, byte by byte: digest-free."""
    out, lo, h = {}, 0, 0
    for _ in range(fingerprints.REACH + 2):
        h = (2 * h + int(fingerprints._GEAR[0])) % 2**32  # as if after some zeros
    for p in range(len(data)):
        h = (2 * h + int(fingerprints._GEAR[data[p]])) % 2**32
        size = p + 1 - lo
        cut = size >= fingerprints.NORMAL and h & int(fingerprints.LOOSE) == 0 or size >= fingerprints.LEAST and h & int(fingerprints.STRICT) == 0
        if cut or size == fingerprints.MOST or p + 1 == len(data):
            out[data[lo : p + 1]] = size
            lo = p + 1
    return out


def plain_containment(a, b):
    return sum(n for c, n in a.items() if c in b) / sum(a.values()) if a else float(not b)


def test_chunks_are_the_plain_ones(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ij\né日") for _ in range(n)).encode() for n in (0, 1, 3, 4, 5, 13, 47, 48, 49, 100, 700, 3000, 9000)] + [b"a" * 500, b"", b"ab" * 300]
    texts += [texts[-5][:2000], texts[-5][1000:4000]]

    def check():
        sets, plain = fingerprints.chunk_sets(texts), [plain_chunks(t) for t in texts]
        for s, p in zip(sets, plain, strict=True):
            assert sorted(s[1].tolist()) == sorted(p.values())
            again = fingerprints.decode(fingerprints.encode(s))
            assert again[0].tolist() == s[0].tolist() and again[1].tolist() == s[1].tolist()
        for i in range(len(texts)):
            for j in range(len(texts)):
                assert abs(fingerprints.containment(sets[i], sets[j]) - plain_containment(plain[i], plain[j])) < 1e-12
        return [fingerprints.encode(s) for s in sets]

    whole = check()
    monkeypatch.setattr(fingerprints, "WINDOW", 100)  # in pieces the same
    assert check() == whole


def test_chunks_do_not_know_their_place():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).encode()
    for size, mean, least in ((250, 0.87, 0.75), (600, 0.94, 0.88), (3000, 0.98, 0.97)):
        got = []
        for k in range(60):
            own = prose(600)[:size]
            host = prose(400)[: rng.randrange(2000)] + own + prose(50 + k)
            a, b = fingerprints.chunk_sets([own, host])
            got.append(fingerprints.containment(a, b))
        assert sum(got) / len(got) >= mean and min(got) >= least, (size, sum(got) / len(got), min(got))
    a, b = fingerprints.chunk_sets([prose(400), prose(400)])
    assert fingerprints.containment(a, b) < 0.3


def test_similar_pairs_both_ways_are_plain():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**60, 60).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, 50, replace=False), rng.integers(0, 2**60, rng.integers(0, 5)).astype(np.uint64)])) for _ in range(40)]
    want = [(i, j) for i in range(40) for j in range(i + 1, 40) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    assert jaccard_join.similar_pairs(sets, 0.8) == want
    assert sorted(jaccard_join.similar_pairs(sets, 0.8, 17)) == [p for p in want if p[0] < 17 <= p[1]]


def test_search_is_exact_and_prunes():
    rng = np.random.default_rng(5)
    # four directions matter, so that bounds can tell candidates apart
    directions = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    c = np.floor(rng.normal(size=(3000, 24)) * np.array([300, 200, 100, 50] + [2] * 20) @ directions.T).astype(np.int64) + 40
    q, ids = c[:9], np.arange(3000)
    q = np.concatenate([q, np.zeros((1, 24), np.int64)])
    q_ids = np.append(ids[:9], -1)
    rotation, seen = topk.Rotation(c[:1000]), [0] * 4
    best = np.full((10, 4), topk.NONE)
    for half in (slice(0, 1500), slice(1500, 3000)):  # the second half against the first's best
        seen[:] = [0] * 4
        for i, new, s in topk.search_batch(q_ids, q, ids[half], c[half], 4, best, rotation, seen):
            best[i] = -np.sort(-np.concatenate([best[i], s]))[:4]
    for i in range(10):
        s = c @ q[i]
        assert best[i].tolist() == sorted((s[j] for j in ids if j != q_ids[i]), reverse=True)[:4]
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] and seen[1] < 0.2 * 9 * 1500 + 1500


def test_ftrl_learns_a_word():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(600):
        own = [rng.choice(words) for _ in range(30)]
        labels.append(i % 4 == 0)
        texts.append(" ".join(own + ["awful"] * labels[-1]))
    at, w = toxicity.train(lambda i: toxicity.features(texts[i]), labels)
    d = dict(zip(at.tolist(), w.tolist(), strict=True))
    score = lambda t: d.get(2**toxicity.BITS, 0) + sum(d.get(int(f), 0) for f in set(toxicity.features(t)))
    assert score("w1 w2 awful w3") > 0 > score("w1 w2 w3") and len(at) < 2000


def test_ftrl_is_the_plain_one():
    """Coordinate by coordinate, in dictionaries, against the arrays."""
    import math

    rng = random.Random(9)
    rows = [sorted({rng.randrange(50) for _ in range(8)}) for _ in range(120)]
    labels = [float(sum(r) % 3 == 0) for r in rows]
    alpha, beta, l1, l2, epochs, seed = 0.5, 1.0, 0.6, 0.1, 3, 7
    at, got = toxicity.train(lambda i: np.array(rows[i], np.uint32), labels, epochs, alpha, beta, l1, l2, 1.0, seed)
    z, n, bias = {}, {}, 2**toxicity.BITS

    def weight(f):
        l = 0.0 if f == bias else l1  # noqa: E741
        if abs(z.get(f, 0.0)) <= l:
            return 0.0
        return -(z[f] - math.copysign(l, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)).tolist():
            own = [*rows[i], bias]
            p = 1 / (1 + math.exp(-sum(weight(f) for f in own)))
            steps = []
            for f in own:
                g, w = p - labels[i], weight(f)
                sigma = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / alpha
                steps.append((f, g - sigma * w, g * g))
            for f, dz, dn in steps:
                z[f], n[f] = z.get(f, 0.0) + dz, n.get(f, 0.0) + dn
    want = {f: weight(f) for f in z if weight(f)}
    assert set(at.tolist()) == set(want) and len(want) < 51
    assert all(abs(want[f] - w) < 1e-9 for f, w in zip(at.tolist(), got.tolist(), strict=True))


def test_only_merges_in_order_are_ranks():
    model = {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3}, "merges": ["a b", "ab a"]}
    assert fast_tokens._ranked(model, set())
    assert not fast_tokens._ranked(model | {"merges": ["ab a", "a b"]}, set())
    assert not fast_tokens._ranked(model | {"byte_fallback": True}, set()) and not fast_tokens._ranked(model | {"vocab": model["vocab"] | {"z": 9}}, set())
    assert all(fast_tokens.load(n).split is not None for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_least_of_ranges_is_the_plain_one():
    rng = np.random.default_rng(12)
    for n in (1, 2, 31, 32, 33, 64, 1000):
        numbers = rng.integers(0, 10**12, n)
        least = substring_dedup.RangeLeast(numbers)
        lo = rng.integers(0, n, 300)
        hi = np.array([rng.integers(x + 1, n + 1) for x in lo])
        assert least(lo, hi).tolist() == [numbers[a:b].min() for a, b in zip(lo, hi, strict=True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list(" \t\n\x0b\x0c\r\x1c\x85  abé")), max_size=40)), max_size=6))
def test_words_hash_alike_one_by_one_and_together(texts):
    import pyarrow as pa

    h, places = jaccard_join.hashed_words(pa.array(texts, pa.string()))
    assert len(places) == len(texts) + 1
    for i, t in enumerate(texts):
        assert h[places[i] : places[i + 1]].tolist() == jaccard_join.word_hashes(t or "").tolist()


def test_minimiser_runs_are_those_of_each_text():
    rng, window = np.random.default_rng(5), 6
    for lengths in ([], [0], [3, 40, 0, 6, 5, 90], [5, 0, 2], [7]):
        texts = [rng.integers(0, 2**63, n).astype(np.uint64) for n in lengths]
        places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        got = [x.tolist() for x in substring_dedup.minimiser_runs(np.concatenate([np.zeros(0, np.uint64), *texts]), places, window)]
        want = []
        for i, t in enumerate(texts):
            gram = substring_dedup.GRAM
            for j in range(len(t) - window + 1):
                least = None
                for k in range(j, j + window - gram + 1):
                    g = np.uint64(0)
                    for w in t[k : k + gram]:
                        g = np.multiply(g ^ w, substring_dedup._MIX)
                        g ^= g >> np.uint64(29)
                    least = int(g) if least is None else min(least, int(g))
                least = int(np.uint64(least).view(np.int64))
                if want and want[-1][0] == i and want[-1][3] == least:
                    want[-1][2] += 1
                else:
                    want.append([i, int(places[i]) + j, 1, least])
        assert [list(x) for x in zip(*got, strict=True)] == want
