"""String similarity on a scale to 100, vectorised over distinct pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel in the shorter text's positions."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & places.get(c, 0)
        row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def ratio_of(a: str, b: str) -> float:
    """200 * LCS / (length + length); two empty texts are 100."""
    n = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / n if n else 100.0


def partial_ratio_of(a: str, b: str) -> float:
    """Best ratio of the shorter text and a window of the longer one, as long or cut by an end."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = 0.0
    for i in range(1 - len(a), len(b)):
        best = max(best, ratio_of(a, b[max(0, i) : i + len(a)]))
        if best == 100.0:
            break
    return best


def partial_ratio_from(a: str, b: str, least: float) -> float:
    """partial_ratio_of where that is `least` or more, else 0: no window shares more than the whole texts do."""
    if len(a) > len(b):
        a, b = b, a
    common = lcs_length(a, b)
    if a and 200.0 * common / (len(a) + common) < least:
        return 0.0
    score = 100.0 if a and a in b else partial_ratio_of(a, b)
    return score if score >= least else 0.0


def _each(f, a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict = {}  # texts repeat within a batch
    return pd.Series([None if x is None or y is None else known[x, y] if (x, y) in known else known.setdefault((x, y), f(x, y)) for x, y in zip(a, b, strict=True)], dtype="float64")


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """ratio_of of each pair, all pairs together."""
    if not a:
        return np.zeros(0)
    codes, starts = _flat([*a, *b])
    sizes = np.fromiter(map(len, [*a, *b]), np.int64, 2 * len(a))
    n, m = sizes[: len(a)], sizes[len(a) :]
    common = lcs_lengths(codes, (starts[: len(a)], n), (starts[len(a) :], m))
    return np.where(n + m > 0, 200.0 * common / np.maximum(n + m, 1), 100.0)


@pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out, some = pd.Series(np.nan, a.index, "float64").astype("Float64"), a.notna() & b.notna()
    out[some], out[~some] = ratios(a[some].tolist(), b[some].tolist()), pd.NA
    return out


@pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _each(partial_ratio_of, a, b)


def partial_ratio_at(least: float):
    """partial_ratio as far as it reaches `least`, 0 below."""

    @pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        return _each(lambda x, y: partial_ratio_from(x, y, least), a, b)

    return scored


#: Candidate pairs that are compared at a time, the widest pattern of the bit-parallel comparison, and the words of masks at a time.
PAIRS, PATTERN, MASKS = 200_000, 64, 4_000_000
#: Classes of characters whose counts bound a common subsequence.
CLASSES = 32


def lcs_lengths(texts: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
    """Longest common subsequences of pairs of slices of one array of character codes.

    a, b: (starts, lengths) of each pair. The shorter slices of up to PATTERN characters are
    patterns held in one machine word each, and all pairs advance together; the rest one by one.
    """
    (a0, an), (b0, bn) = a, b
    swap = an > bn
    p0, pn, t0, tn = np.where(swap, b0, a0), np.where(swap, bn, an), np.where(swap, a0, b0), np.where(swap, an, bn)
    out = np.zeros(len(p0), np.int64)
    wide = pn > PATTERN
    for i in np.flatnonzero(wide):
        out[i] = lcs_length("".join(map(chr, texts[p0[i] : p0[i] + pn[i]])), "".join(map(chr, texts[t0[i] : t0[i] + tn[i]])))
    own = np.flatnonzero(~wide & (pn > 0))
    number = np.zeros(int(texts.max(initial=0)) + 1, np.int64)
    number[texts] = 1
    alphabet = np.flatnonzero(number)
    number[alphabet] = np.arange(len(alphabet))
    codes = number[texts]
    step = max(1, MASKS // len(alphabet)) if len(alphabet) else 1
    for at in range(0, len(own), step):
        part = own[at : at + step]
        out[part] = _advanced(codes, len(alphabet), p0[part], pn[part], t0[part], tn[part])
    return out


def _advanced(codes: np.ndarray, letters: int, p0: np.ndarray, pn: np.ndarray, t0: np.ndarray, tn: np.ndarray) -> np.ndarray:
    order = np.argsort(-tn, kind="stable")  # the longest texts first: those still running are a prefix
    p0, pn, t0, tn = p0[order], pn[order], t0[order], tn[order]
    each, pattern = np.unique(p0 * (PATTERN + 1) + pn, return_inverse=True)
    starts, lengths = each // (PATTERN + 1), each % (PATTERN + 1)
    masks = np.zeros((len(starts), letters), np.uint64)
    for k in range(int(lengths.max())):
        on = np.flatnonzero(lengths > k)
        masks[on, codes[starts[on] + k]] |= np.uint64(1) << np.uint64(k)
    full = np.where(lengths == 64, np.uint64(2**64 - 1), (np.uint64(1) << (lengths % 64).astype(np.uint64)) - np.uint64(1))[pattern]
    row = full.copy()
    for k in range(int(tn[0])):
        n = int(np.searchsorted(-tn, -k, side="left"))  # texts of more than k characters
        r = row[:n]
        u = r & masks[pattern[:n], codes[t0[:n] + k]]
        row[:n] = ((r + u) | (r - u)) & full[:n]
    out = np.empty(len(p0), np.int64)
    out[order] = lengths[pattern] - np.bitwise_count(row).astype(np.int64)
    return out


def slices(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to about `most`; a larger one is a range by itself."""
    out, lo, held = [], 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            out.append((lo, i))
            lo, held = i, 0
        held += n
    return [*out, (lo, len(sizes))] if lo < len(sizes) else out


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of the texts joined by spaces, and the start of each text."""
    codes = np.frombuffer(" ".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return codes, np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)


def run_spans(sizes: np.ndarray, starts: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the joined normal forms of n words from `at`; words with an empty form add nothing.

    sizes, starts: of all words' forms that are joined by single spaces, empty ones left out (their start is the next one's).
    """
    last = np.maximum.accumulate(np.where(sizes > 0, np.arange(len(sizes)), -1))  # the last word with a form
    end = last[at + n - 1]
    some = end >= at
    return np.where(some, starts[at], 0), np.where(some, starts[np.maximum(end, 0)] + sizes[np.maximum(end, 0)] - starts[at], 0)


def _bits(bit: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bits of each slice's characters together; 0 for an empty one."""
    out, some = np.zeros(len(starts), np.uint64), sizes > 0
    at = np.stack([starts[some], starts[some] + sizes[some]], axis=1).reshape(-1)
    if len(at):
        out[some] = np.bitwise_or.reduceat(np.append(bit, np.uint64(0)), at)[::2]
    return out


def scored_runs(queries: list[str], most: np.ndarray, words: list[str], groups: np.ndarray, q_row: np.ndarray, w_row: np.ndarray, w_tail: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(query, first word, number of words, score) of all runs of words that reach the threshold.

    Queries and words belong to rows (documents), ascending; a query meets the runs of up to its `most` words of its row.
    A run stays within one group and starts at a word that is no tail. Single words equal to an empty query match it.
    """
    out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]
    if not len(queries) or not len(words):
        return out[0]
    w_size = np.fromiter(map(len, words), np.int64, len(words))
    q_size = np.fromiter(map(len, queries), np.int64, len(queries))
    w_flat = " ".join(w for w in words if w)
    some = w_size > 0
    w_start = np.zeros(len(words), np.int64)
    w_start[some] = np.concatenate([[0], np.cumsum(w_size[some] + 1)[:-1]])
    nxt = len(w_flat)
    filled = np.where(some, w_start, nxt)
    w_start = np.minimum.accumulate(filled[::-1])[::-1]  # an empty word starts where the next one does
    q_codes, q_start = _flat(queries)
    codes = np.concatenate([np.frombuffer(w_flat.encode("utf-32-le"), np.uint32), q_codes])
    q_start = q_start + len(w_flat)
    counts = np.zeros((len(codes) + 1, CLASSES), np.int32)
    counts[np.arange(1, len(codes) + 1), codes % CLASSES] = 1
    np.cumsum(counts, axis=0, out=counts)
    # the classes of characters of each query and word as bits, without the space's: one that the other text lacks is a character not shared
    bit = np.where(codes % 64 == 32, np.uint64(0), np.uint64(1) << (codes % 64).astype(np.uint64))
    q_bits, w_bits = _bits(bit, q_start, q_size), _bits(bit, w_start, w_size)
    edge = np.flatnonzero((w_row[1:] != w_row[:-1]) | (groups[1:] != groups[:-1])) + 1
    until = np.repeat(np.append(edge, len(words)), np.diff(np.concatenate([[0], edge, [len(words)]])))  # where a word's group ends
    lo, hi = np.searchsorted(w_row, q_row, "left"), np.searchsorted(w_row, q_row, "right")
    for n in range(1, int(most.max()) + 1):
        at = np.flatnonzero((np.arange(len(words)) + n <= until) & ~w_tail)
        r_start, r_size = run_spans(w_size, w_start, at, np.full(len(at), n))
        r_bits = w_bits[at]
        for k in range(1, n):
            r_bits = r_bits | w_bits[at + k]
        asked = np.flatnonzero(most >= n)
        first, past = np.searchsorted(at, lo[asked]), np.searchsorted(at, hi[asked])
        size = past - first
        cuts = np.concatenate([[0], np.cumsum(size)])
        i = 0
        while i < len(asked):  # queries with about PAIRS pairs together
            j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + PAIRS, "right")) - 1)
            q = np.repeat(asked[i:j], size[i:j])
            r = np.arange(len(q)) - np.repeat(cuts[i:j] - cuts[i], size[i:j]) + np.repeat(first[i:j], size[i:j])
            i = j
            both = q_size[q] + r_size[r]
            empty = (both == 0) & (n == 1) & (most[q] == 1)
            ok = (np.minimum(q_size[q], r_size[r]) * 200 >= both * threshold) & (q_size[q] > 0) & (r_size[r] > 0)
            if empty.any():
                out.append((q[empty], at[r[empty]], np.full(int(empty.sum()), n), np.full(int(empty.sum()), 100.0)))
            q, r, both = q[ok], r[ok], both[ok]
            most_shared = np.minimum(q_size[q] - np.bitwise_count(q_bits[q] & ~r_bits[r]), r_size[r] - np.bitwise_count(r_bits[r] & ~q_bits[q]))
            ok = most_shared * 200 >= both * threshold
            q, r, both = q[ok], r[ok], both[ok]
            qs, rs = q_start[q], r_start[r]
            common = np.minimum(counts[qs + q_size[q]] - counts[qs], counts[rs + r_size[r]] - counts[rs]).sum(1)
            ok = common * 200 >= both * threshold
            q, r, both, qs, rs = q[ok], r[ok], both[ok], qs[ok], rs[ok]
            if not len(q):
                continue
            score = 200.0 * lcs_lengths(codes, (qs, q_size[q]), (rs, r_size[r])) / both
            ok = score >= threshold
            out.append((q[ok], at[r[ok]], np.full(int(ok.sum()), n), score[ok]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def near_words(queries: list[str], q_row: np.ndarray, q_code: np.ndarray, words: list[str], w_row: np.ndarray, w_code: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(query, word, score) of all pairs of one row that reach the threshold but are not equal, as their codes tell.

    Words of a row go by their length, so a query only meets those of a length that can reach it.
    """
    out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
    if not len(queries) or not len(words):
        return out[0]
    codes, starts = _flat([*queries, *words])
    sizes = np.fromiter(map(len, [*queries, *words]), np.int64, len(queries) + len(words))
    bit = np.where(codes == 32, np.uint64(0), np.uint64(1) << (codes % 64).astype(np.uint64))
    bits, k = _bits(bit, starts, sizes), len(queries)
    q_size, w_size, q_start, w_start, q_bits, w_bits = sizes[:k], sizes[k:], starts[:k], starts[k:], bits[:k], bits[k:]
    order = np.lexsort((w_size, w_row))
    base = int(sizes.max()) + 2
    key = w_row[order] * base + w_size[order]
    least = np.maximum(1, np.ceil(q_size * threshold / (200 - threshold) - 1e-9)).astype(np.int64)
    most = np.minimum(base - 1, np.floor(q_size * (200 - threshold) / threshold + 1e-9)).astype(np.int64)
    # unequal texts of one length differ in a character at least
    same = (q_size - 1) * 200 >= 2 * q_size * threshold
    some, apart = np.flatnonzero(q_size > 0), np.flatnonzero((q_size > 0) & ~same)
    asked = np.concatenate([some, apart])
    lo = np.concatenate([least[some], q_size[apart] + 1])
    hi = np.concatenate([np.where(same, most, q_size - 1)[some], most[apart]])
    lo, hi = np.searchsorted(key, q_row[asked] * base + lo, "left"), np.searchsorted(key, q_row[asked] * base + hi, "right")
    hi = np.maximum(lo, hi)
    cuts, i, held = np.append(0, np.cumsum(hi - lo)), 0, []
    while i < len(asked):
        j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + PAIRS, "right")) - 1)
        n = hi[i:j] - lo[i:j]
        q = np.repeat(asked[i:j], n)
        w = order[np.arange(len(q)) - np.repeat(cuts[i:j] - cuts[i], n) + np.repeat(lo[i:j], n)]
        i = j
        shared = np.minimum(q_size[q] - np.bitwise_count(q_bits[q] & ~w_bits[w]), w_size[w] - np.bitwise_count(w_bits[w] & ~q_bits[q]))
        ok = (shared * 200 >= (q_size[q] + w_size[w]) * threshold) & (q_code[q] != w_code[w])
        held.append((q[ok], w[ok]))
        if i < len(asked) and sum(len(x) for x, _ in held) < PAIRS:
            continue
        q, w = (np.concatenate(c) for c in zip(*held, strict=True))
        held = []
        if len(q):
            score = 200.0 * lcs_lengths(codes, (q_start[q], q_size[q]), (w_start[w], w_size[w])) / (q_size[q] + w_size[w])
            ok = score >= threshold
            out.append((q[ok], w[ok], score[ok]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def partial_ratios(codes: np.ndarray, a: tuple, b: tuple, least: float) -> np.ndarray:
    """partial_ratio_from of pairs of slices of one array of character codes, all windows of some pairs together.

    a, b: (starts, lengths) of each pair, none empty.
    """
    (a0, an), (b0, bn) = a, b
    swap = an > bn
    a0, an, b0, bn = np.where(swap, b0, a0), np.where(swap, bn, an), np.where(swap, a0, b0), np.where(swap, an, bn)
    out = np.zeros(len(a0))
    if not len(a0):
        return out
    common = lcs_lengths(codes, (a0, an), (b0, bn))
    asked = np.flatnonzero(200.0 * common / (an + common) >= least)
    for lo, hi in slices((an + bn)[asked].tolist(), PAIRS):
        own = asked[lo:hi]
        n = (an + bn - 1)[own]
        pair, cuts = np.repeat(own, n), np.cumsum(n) - n
        i = np.arange(len(pair)) - np.repeat(cuts, n) + 1 - an[pair]
        start, end = np.maximum(i, 0), np.minimum(i + an[pair], bn[pair])
        size = end - start
        score = np.zeros(len(pair))
        on = np.flatnonzero(200.0 * np.minimum(size, common[pair]) / (an[pair] + size) >= least)
        score[on] = 200.0 * lcs_lengths(codes, (a0[pair[on]], an[pair[on]]), (b0[pair[on]] + start[on], size[on])) / (an[pair[on]] + size[on])
        out[own] = np.maximum.reduceat(score, cuts)
    return np.where(out >= least, out, 0.0)


def token_sort(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda x: x != "")), " ")


def may_reach(len_a: Column, len_b: Column, threshold: float) -> Column:
    """Whether two lengths allow the ratio: a common subsequence is no longer than the shorter text."""
    return F.least(len_a, len_b) * 200 >= (len_a + len_b) * threshold


def lcs_fold(a: Column, b: Column) -> Column:
    """The same length by higher-order functions only, to cross-check the bit-parallel one."""
    zeros = F.transform(F.split(b, ""), lambda _: F.lit(0))

    def row(before: Column, c: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            last = F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.lit(0))
            up, corner = F.get(before, j), F.coalesce(F.get(before, j - 1), F.lit(0))
            same = F.substr(b, j + 1, F.lit(1)) == c
            return F.concat(acc, F.array(F.when(same, corner + 1).otherwise(F.greatest(last, up))))

        return F.aggregate(F.sequence(F.lit(0), F.size(before) - 1), F.array().cast("array<int>"), cell)

    return F.coalesce(F.element_at(F.aggregate(F.split(a, ""), zeros, row), -1), F.lit(0))


def register(spark) -> None:
    """The functions by name, for SQL."""
    from quillmap.functions.text import normalize_text_sql

    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION normalize_text(t STRING) RETURNS STRING RETURN {normalize_text_sql('t')}")
    spark.udf.register("similarity_ratio", similarity_ratio)
    spark.udf.register("partial_ratio", partial_ratio)
