"""Matching document by document gives what the operators on tables give, and shuffles no words."""

import random

import numpy as np
import pytest

from quillmap import fixtures
from quillmap.functions import similarity as s
from quillmap.functions import text as t
from quillmap.operators import documents as docs
from quillmap.operators import matching as m
from quillmap.plans import catalog
from tests.test_whole_job import few  # noqa: F401

NO_WORDS_SHUFFLED = ["match_exact", "match_fuzzy", "match_fields"]


@pytest.mark.parametrize("name", NO_WORDS_SHUFFLED)
def test_words_are_not_shuffled(spark, few, name):  # noqa: F811
    plan = catalog.queries()[name](spark, few)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and plan.count("RepartitionByExpression") == 1


@pytest.mark.parametrize("name", NO_WORDS_SHUFFLED)
def test_documents_give_what_tables_give(spark, few, name):  # noqa: F811
    f, w = fixtures.fields_inv(spark, few), fixtures.words_inv(spark, few)
    of = {"match_fuzzy": "kind = 'single'"}.get(name, "true")
    got, want = catalog.queries()[name](spark, few), getattr(m, name)(f.filter(of), w)
    assert got.columns == want.columns
    rows = lambda df: sorted(map(repr, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())))
    assert rows(got) == rows(want) and rows(got)


def test_documents_over_batches_are_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fixtures, "_LINES", 4)
    ids = [1] * 3 + [2] * 7 + [3] + [4] * 2
    batches = pa.Table.from_arrays([pa.array(ids), pa.array(range(len(ids)))], ["doc_id", "x"]).to_batches(max_chunksize=2)
    parts = [p["doc_id"].to_pylist() for p in fixtures._several(iter(batches))]
    assert sum(parts, []) == ids and all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))


def test_equal_runs_are_the_best_runs():
    """What is looked up is what scoring all pairs finds with 100, words without a normal form included."""
    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(60):
        words = [rng.choice(["a", "bb", "", "c1"]) for _ in range(rng.randrange(1, 25))]
        row = np.array(sorted(rng.randrange(3) for _ in words))
        queries = [" ".join(rng.choice(["a", "bb", "c1"]) for _ in range(rng.randrange(0, 4))) for _ in range(8)]
        most, q_row = np.array([rng.choice([1, 9]) for _ in queries]), np.array(sorted(rng.randrange(3) for _ in queries))
        q, at, n, *_ = docs._equal(pa.array(queries), most, q_row, pa.array(words), row, row)
        a = s.scored_runs(queries, most, words, row, q_row, row, np.zeros(len(words), bool), 85)
        best = {}
        for x, i, k, score in zip(*(c.tolist() for c in a), strict=True):
            if score == 100:
                best[x] = min(best.get(x, (i, k)), (i, k))
        assert {x: (i, k) for x, i, k in zip(q.tolist(), at.tolist(), n.tolist(), strict=True)} == best


def test_normal_forms_and_numbers_of_arrays(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    texts = ["Ñandú", "S/.", "straße", "a  B\tc", "...", "é", None, "P00_1", " x ", "a b", "İ½²", "1.234,56", "1,234.56", "1.234", "12,5", "1.234.567", "F985-390210", "-7", "5.", "x-1,2,3.", "0.10"]
    rows = spark.createDataFrame([(v,) for v in texts], "v string").select(t.normalize_text(F.col("v")).alias("a"), t.extract_number(F.col("v")).alias("n")).collect()
    assert t.normal_forms(pa.array(texts)).to_pylist() == [r["a"] for r in rows]
    assert [None if np.isnan(x) else x for x in docs._numbers(pa.array(texts)).tolist()] == [r["n"] for r in rows]


@pytest.mark.parametrize("name", ["header_elements", "item_elements", "single_page"])
def test_only_matches_of_elements_are_shuffled(spark, few, name):  # noqa: F811
    plan = catalog.queries()[name](spark, few)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("RepartitionByExpression") == 1


def test_five_strategies_shuffle_lines_only(spark, few):  # noqa: F811
    got = catalog.queries()["match_five_strategy"](spark, few)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and plan.count("RepartitionByExpression") == 1
    want = m.match_five_strategy(fixtures.fields_inv(spark, few), fixtures.words_inv(spark, few))
    assert got.dtypes == want.dtypes
    rows = [sorted(map(repr, df.collect())) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def test_five_strategies_of_odd_texts(spark, monkeypatch):
    """Accents, points, several tokens in a word, wide values, null and empty texts, a field given twice: as on tables."""
    import pyarrow as pa

    from tests.test_matching import FIELD, WORD

    rng = random.Random(4)
    part = lambda n: "".join(rng.choice("abcdeñ.-0É") for _ in range(n))
    cores = [part(rng.choice((1, 3, 5, 8, 10, 11, 14))) for _ in range(40)] + ["x" * 70 + "abc"]

    def text():
        own = list(rng.choice(cores))
        for _ in range(rng.choice((0, 0, 1, 2))):
            own.insert(rng.randrange(len(own) + 1), rng.choice("ab#/  .é"))
        return rng.choice((None, "", " ", "\t", "#")) if rng.random() < 0.05 else rng.choice(("", " ")).join([*own]) if len(own) < 7 and rng.random() < 0.1 else "".join(own) + rng.choice(("", "", " " + rng.choice(cores)))

    words, fields = [], []
    for d in range(60):
        words += [(d, i, 0, text(), 10 * i, 5, 10 * i + 9, 15, rng.choice((None, 0.5, 0.9))) for i in range(rng.randrange(0, 12))]
        fields += [(d, "header", -1, k, f"f{k}", text(), "single") for k in range(rng.randrange(0, 8))]
        fields += [(d, "items", 0, 0, "g", rng.choice(cores), "single")] * (d % 3)
    # more than 95 beside a value that is in another word
    words += [(60, 0, 0, "abcdeabcde" * 2, 0, 5, 9, 15, 0.9), (60, 1, 0, "abcdexabcde", 10, 5, 19, 15, 0.9), (60, 2, 0, "dos uno", 20, 5, 29, 15, 0.9)]
    fields += [(60, "header", -1, 0, "f0", "abcdeabcde", "single"), (60, "header", -1, 1, "f1", "uno dos", "single")]
    want = m.match_five_strategy(spark.createDataFrame(fields, FIELD), spark.createDataFrame(words, WORD))

    ids = list(range(61))

    def rows(schema, data):
        names = [c.split(" ") for c in schema.split(", ")[1:]]
        kinds = {"int": pa.int32(), "string": pa.string(), "double": pa.float64()}
        cols = [pa.array([r[1 + i] for r in data], kinds[kind]) for i, (_, kind) in enumerate(names)]
        return np.bincount([r[0] for r in data], minlength=len(ids)), pa.StructArray.from_arrays(cols, [n for n, _ in names])

    n_f, fs = rows(FIELD, fields)
    n_w, ws = rows(WORD, words)
    plain = lambda r: repr(tuple(r[c] for c in want.columns))
    for pairs in (s.PAIRS, 7):
        monkeypatch.setattr(s, "PAIRS", pairs)
        got = docs.five_strategies(pa.array(ids), n_f, fs, n_w, ws)
        assert sorted(map(plain, got.to_pylist())) == sorted(map(plain, want.collect()))
    assert {r["strategy"] for r in got.to_pylist()} == set(docs.STRATEGIES)
    assert [(r["word_idx"], r["strategy"]) for r in got.to_pylist() if r["doc_id"] == 60] == [(1, "ratio"), (2, "token_sort")]


def test_partial_ratios_of_many_are_those_of_each():
    rng = random.Random(6)
    text = lambda: "".join(rng.choice("abcé ") for _ in range(rng.choice((1, 2, 7, 12, 64, 65, 80))))
    a, b = [text() for _ in range(150)], [text() for _ in range(150)]
    codes, start = s._flat([*a, *b])
    size = np.array([*map(len, [*a, *b])])
    got = s.partial_ratios(codes, (start[:150], size[:150]), (start[150:], size[150:]), 75)
    assert got.tolist() == [s.partial_ratio_from(x, y, 75) for x, y in zip(a, b, strict=True)]
