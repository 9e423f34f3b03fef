"""Documents of one to four pages against a plain version, pair by pair."""

import random
import re
from collections import defaultdict

import pytest

from quillmap.functions import similarity as s
from quillmap.operators import elements as e
from quillmap.plans import pipelines as p
from tests.test_matching import FIELD, WORD

N = 220


def build():
    rng = random.Random(11)
    words, fields = [], []
    for d in range(N):
        code = lambda: "".join(rng.choice("ABCDE0123") for _ in range(6))
        noise = lambda t: t if rng.random() < 0.7 else t[:-1] + rng.choice("XYZ")
        head = [("serie_completa", code() + code(), "single"), ("importe_total", f"{rng.randrange(100, 999)}.{rng.randrange(10, 99)}", "numeric"), ("receptor", f"{code()} {code()}", "multiword"), ("nota", rng.choice([None, ""]), "single"), ("match_score", "1", "single")]
        fields += [(d, "header", -1, o, n, v, k) for o, (n, v, k) in enumerate(head)]
        items = [(("codigo", code(), "single"), ("cantidad", str(rng.randrange(1, 40)), "numeric"), ("descripcion", f"{code()} {code()}", "multiword")) for _ in range(rng.randrange(0, 6))]
        fields += [(d, "items", i, o, n, v, k) for i, item in enumerate(items) for o, (n, v, k) in enumerate(item)]
        pages, idx = rng.randrange(1, 5), 0
        for at, (_, v, _) in enumerate(head[:3]):
            for w in v.split():
                words.append((d, idx, 0, noise(w), 40 + 110 * (idx % 6), 40 + 30 * at, 110 + 110 * (idx % 6), 55 + 30 * at, rng.randrange(50, 100) / 100))
                idx += 1
        for i, item in enumerate(items):
            page = 0 if pages == 1 else 1 + i % (pages - 1)
            y = 300 + 40 * (i // max(1, pages - 1)) if pages > 1 else 300 + 40 * i
            for c, (_, v, _) in enumerate(item):
                for j, w in enumerate(v.split()):
                    words.append((d, idx, page, noise(w), 40 + 200 * c + 80 * j, y + (c % 3), 110 + 200 * c + 80 * j, y + 14, rng.randrange(50, 100) / 100))
                    idx += 1
        if pages > 1 and rng.random() < 0.3:
            words.append((d, idx, pages - 1, head[0][1], 600, 800, 700, 815, 0.9))
    return fields, words


def norm(t):
    return " ".join("".join(c for c in t.lower() if c.isalnum() or c in "_ ").split())


def number(t):
    """The first number of a text with points only: one that three digits do not follow is decimal."""
    m = re.search(r"\d[\d.]*", t)
    if not m:
        return None
    x = m[0].rstrip(".")
    decimal = x.count(".") == 1 and len(x.split(".")[1]) != 3
    return float(x if decimal else x.replace(".", ""))


def best(value, runs):
    """The first best of (text, payload) at 85 or more."""
    top = None
    for text, own in runs:
        score = 100.0 if norm(text) == norm(value) else s.ratio_of(norm(value), norm(text))
        if score >= 85 and (top is None or score > top[0]):
            top = (score, own)
    return top


def plain_fields(fields, words):
    words = sorted(words, key=lambda w: w[1])
    for f in fields:
        d, section, item, o, name, value, kind = f
        if not value or not value.strip():
            continue
        if kind == "numeric":
            near = [(abs(number(w[3]) - float(value)) / max(abs(float(value)), 0.01), w[1], w) for w in words if number(w[3]) is not None]
            near = sorted(x for x in near if x[0] <= 0.01)
            if near:
                yield f, near[0][2][2:3] + near[0][2][4:8], near[0][2][8], near[0][2][3]
            continue
        most = 9 if kind == "multiword" else 1
        runs = [(" ".join(w[3] for w in words[i : i + n]), words[i : i + n]) for i in range(len(words)) for n in range(1, most + 1) if i + n <= len(words)]
        top = best(value, runs)
        if top:
            ws = top[1]
            box = (min(w[4] for w in ws), min(w[5] for w in ws), max(w[6] for w in ws), max(w[7] for w in ws))
            yield f, (ws[0][2], *box), sum(w[8] for w in ws) / len(ws) * top[0] / 100, " ".join(w[3] for w in ws)


def plain_rows(words):
    out = []
    for page in sorted({w[2] for w in words}):
        rows = []
        for w in sorted((w for w in words if w[2] == page), key=lambda w: (w[5], w[4], w[1])):
            if rows and abs(w[5] - rows[-1][0][5]) <= 10:
                rows[-1].append(w)
            else:
                rows.append([w])
        out += [sorted(r, key=lambda w: w[1]) for r in rows if len(r) >= 2]
    return out


def plain_document(fields, words):
    """(section, item, ord, page, box, confidence) of every element."""
    pages = sorted({w[2] for w in words})
    if len(pages) == 1:
        return list(plain_fields(fields, words))
    keys = [f for f in fields if f[1] == "header" and f[4] in ("serie_completa", "importe_total")]
    hits = {q: sum(best(f[5], [(w[3], w) for w in words if w[2] == q]) is not None for f in keys) for q in pages}
    most = max(hits.values())
    head = [q for q in pages if (q == 0 if most == 0 else hits[q] >= most / 2)]
    out = list(plain_fields([f for f in fields if f[1] == "header"], [w for w in words if w[2] in head]))
    rows = plain_rows([w for w in words if w[2] not in head])
    items = defaultdict(list)
    for f in fields:
        if f[1] == "items":
            items[f[2]].append(f)
    for own in items.values():
        chosen = (0, 0, [])
        for r in rows:
            found = [(f, best(f[5], [(w[3], w) for w in r])) for f in own]
            found = [(f, t) for f, t in found if t]
            total = sum(round(t[0] / 100 * 1e9) for _, t in found)
            if (len(found), total) > chosen[:2]:
                chosen = (len(found), total, found)
        out += [(f, (t[1][2], *t[1][4:8]), t[1][8] * t[0] / 100, t[1][3]) for f, t in chosen[2]]
    return out


@pytest.fixture(scope="module")
def made(spark):
    fields, words = build()
    return fields, words, spark.createDataFrame(fields, FIELD).cache(), spark.createDataFrame(words, WORD).cache()


def key(f, place, confidence, text):
    return (*f[:4], *place, round(confidence, 9), text)


def by_document(rows, at=0):
    out = defaultdict(list)
    for r in rows:
        out[r[at]].append(r)
    return out


def test_process_documents(made):
    fields, words, f, w = made
    fd, wd = by_document(fields), by_document(words)
    want = sorted(key(*x) for d in wd for x in plain_document(fd[d], wd[d]))
    got = sorted((r["doc_id"], r["section"], r["item_idx"], r["ord"], r["page"], r["x0"], r["y0"], r["x1"], r["y1"], round(r["confidence"], 9), r["text"]) for r in p.process_documents(f, w).collect())
    assert got == want
    several = [d for d in wd if len({x[2] for x in wd[d]}) > 2]
    assert len(several) > 40 and sum(g[1] == "items" and g[4] > 1 for g in got) > 50  # items on several pages


def test_enriched_and_reprocessed(made):
    fields, words, f, w = made
    fd, wd = by_document(fields), by_document(words)
    found = {x[0][:4]: x for d in wd for x in plain_fields(fd[d], wd[d])}
    for r in p.enrich_fields(f, w).collect():
        x = found.get((r["doc_id"], r["section"], r["item_idx"], r["ord"]))
        sure = None if x is None else x[2]
        if not r["value"]:
            assert r["not_found"] is None and r["bbox"] is None
        elif x is None:
            assert r["not_found"] and r["confidence"] == 0.0
        elif r["not_found"]:
            assert sure < 0.5
        else:  # a pattern can raise it, and several words widen the box
            assert r["confidence"] >= round(sure, 9) - 1e-9 and r["bbox"][0] <= x[1][1] and r["bbox"][2] >= x[1][3]
    rows = p.reprocess(f, w).collect()
    assert rows and not any(r["field_name"] == "match_score" for r in rows)
    boxes = [(r["doc_id"], r["page"], r["x0"], r["y0"], r["x1"], r["y1"]) for r in rows]
    assert len(set(boxes)) == len(boxes) and all(r["confidence"] >= 0.5 for r in rows)
    out, metrics, each = p.reprocess_report(f, w)
    assert out.count() == len(rows) and metrics.agg({"total_elements": "sum"}).first()[0] == len(rows)
    assert each.agg({"removed_metadata_fields": "sum"}).first()[0] == N


def test_batch(spark, made):
    _, words, f, w = made
    done = spark.createDataFrame([(3,), (4,)], "doc_id int")
    rows = {r["doc_id"]: r for r in p.process_batch(f, w.filter("doc_id <> 7"), done).collect()}
    assert rows[3]["status"] == "skipped" and rows[7]["status"] == "failed" and rows[5]["status"] == "processed" and len(rows) == N
    assert rows[5]["header_total"] == 5 and rows[7]["match_rate"] is None


def test_chunks_of_elements_of_any_size(spark):
    """The fold, element by element, over elements of one to forty words."""
    rng, rows = random.Random(4), []
    for d in range(60):
        rows += [(d, i, i, " ".join(["w"] * rng.choice((1, 2, 5, 20, 40, 200)))) for i in range(rng.randrange(1, 40))]
    got = defaultdict(lambda: defaultdict(list))
    for r in e.chunk_elements(spark.createDataFrame(rows, "doc_id int, position int, id int, text string")).collect():
        got[r["doc_id"]][r["chunk_index"]].append((r["pos"], r["id"]))
    for d, own in by_document(rows).items():
        sized = [(i, 2 * len(t.split()) + 4) for _, i, _, t in own]
        chunks, now, size, tail, kept = [], [], 0, [], 0
        for i, t in sized:
            if size + t > 384 and now:
                chunks.append(now)
                now, size, tail, kept = [*tail, (i, t)], kept + t, [], 0
                tail, kept = [(i, t)], t
            else:
                now, size = [*now, (i, t)], size + t
                tail, kept = [*tail, (i, t)], kept + t
            while kept > 128 and len(tail) > 1:
                kept -= tail.pop(0)[1]
        chunks.append(now)
        if sum(t for _, t in sized) <= 384:
            chunks = [sized]
        assert [[i for _, i in sorted(c)] for _, c in sorted(got[d].items())] == [[i for i, _ in c] for c in chunks]
