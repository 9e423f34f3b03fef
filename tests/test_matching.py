"""Literal cases, and the similarity against a plain one."""

import random

from pyspark.sql import functions as F

from quillmap.functions import similarity as s
from quillmap.functions import text as t
from quillmap.operators import matching as m

WORD = "doc_id int, word_idx int, page int, text string, x0 int, y0 int, x1 int, y1 int, confidence double"
FIELD = "doc_id int, section string, item_idx int, ord int, field_name string, value string, kind string"


def words(spark, *texts, confidence=1.0):
    return spark.createDataFrame([(1, i, 0, w, 100 + 60 * i, 50, 150 + 60 * i, 70, confidence) for i, w in enumerate(texts)], WORD)


def field(spark, value, kind="single"):
    return spark.createDataFrame([(1, "header", -1, 0, "f", value, kind)], FIELD)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_lcs_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert s.lcs_length(a, b) == plain_lcs(a, b)
    assert round(s.ratio_of("factura", "factur4"), 3) == 85.714 and round(s.ratio_of("factura", "boleta"), 2) == 30.77


def test_lcs_fold_agrees(spark):
    rows = spark.createDataFrame([("factura", "factur4"), ("abcbdab", "bdcaba"), ("x", "y")], "a string, b string")
    got = rows.select("a", "b", s.lcs_fold(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r["n"] for r in got] == [s.lcs_length(r["a"], r["b"]) for r in got]


def test_exact_first_word_wins(spark):
    w = words(spark, "FACTURA", "20393920069", "20393920069")
    (r,) = m.match_exact(field(spark, "20393920069"), w).collect()
    assert (r["word_idx"], r["match_score"]) == (1, 1.0)


def test_fuzzy_hit_and_miss(spark):
    (r,) = m.match_fuzzy(field(spark, "FACTURA"), words(spark, "FACTUR4", confidence=0.9)).collect()
    assert abs(r["match_score"] - 12 / 14) < 1e-9 and abs(r["confidence"] - 0.9 * 12 / 14) < 1e-9
    assert m.match_fuzzy(field(spark, "FACTURA"), words(spark, "BOLETA")).count() == 0
    assert m.match_fuzzy(field(spark, None), words(spark, "BOLETA")).count() == 0


def test_multiword_box(spark):
    (r,) = m.match_multiword(field(spark, "La Positiva S.A.", "multiword"), words(spark, "La", "Positiva", "S.A.")).collect()
    assert (r["text"], r["x0"], r["x1"], r["word_count"]) == ("La Positiva S.A.", 100, 270, 3)


def test_numeric_modes(spark):
    w, f = words(spark, "15234.50", "17976.71"), field(spark, "17976.71", "numeric")
    (r,) = m.match_numeric(f, w).collect()
    assert r["numeric_value"] == 17976.71
    assert m.match_numeric(f, w, mode="strip_separators").count() == 0


def test_number_rule(spark):
    cases = {"1.234,56": 1234.56, "1,234.56": 1234.56, "1.234": 1234.0, "12,5": 12.5, "1.234.567": 1234567.0, "F985-390210": 985.0, "none": None, "-7": -7.0, "5.": 5.0}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", t.extract_number(F.col("v")).alias("n")).collect()
    assert {r["v"]: r["n"] for r in rows} == cases


def test_normal_form(spark):
    cases = {"Ñandú": "nandu", "S/.": "s", "straße": "straße", "a  B\tc": "a b c", "...": "", "é": "e", None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", t.normalize_text(F.col("v")).alias("n")).collect()
    assert {r["v"]: r["n"] for r in rows} == cases


def test_five_strategies(spark):
    one = lambda value, *texts: m.match_five_strategy(field(spark, value), words(spark, *texts)).collect()
    got = [[(r["strategy"], r["match_score"]) for r in one(*case)] for case in (("FACTURA ELECTRONICA", "FACTURA", "x"), ("FACTURA", "x", "FACTURA"), ("BOLETAS-1", "xBOLETAS-1x"), ("FACTURA", "FACTUR4"), ("uno dos", "dos uno"))]
    # a word inside a long value is contained (95) and its best window equal (100), which is more
    assert got == [[("partial", 1.0)], [("exact", 1.0)], [("substring", 0.95)], [("ratio", 12 / 14)], [("token_sort", 1.0)]]


def test_partial_and_sorted_tokens(spark):
    assert s.partial_ratio_of("abc", "xxabcxx") == 100.0 and s.partial_ratio_of("", "a") == 0.0 and s.partial_ratio_of("", "") == 100.0
    assert round(s.partial_ratio_of("abcd", "xxab"), 6) == round(200 * 2 / 6, 6)  # the window is cut by the end
    (r,) = spark.createDataFrame([("b a  c",)], "v string").select(s.token_sort(F.col("v")).alias("v")).collect()
    assert r["v"] == "a b c"


def test_ratios_of_many_are_those_of_each():
    rng = random.Random(2)
    text = lambda: "".join(rng.choice("abcé ") for _ in range(rng.choice((0, 1, 7, 40, 63, 64, 65, 100))))
    a, b = [text() for _ in range(300)], [text() for _ in range(300)]
    assert s.ratios(a, b).tolist() == [s.ratio_of(x, y) for x, y in zip(a, b, strict=True)]


def test_functions_by_name(spark):
    s.register(spark)
    (r,) = spark.sql("SELECT normalize_text('Ñandú  S.A.') a, similarity_ratio('abc', 'abd') b, partial_ratio('ab', 'xabx') c, similarity_ratio(NULL, 'a') d").collect()
    assert (r["a"], round(r["b"], 3), r["c"], r["d"]) == ("nandu sa", 66.667, 100.0, None)


def test_documented_normal_form(spark):
    (r,) = spark.createDataFrame([("F001-23 (Nº) é.",)], "v string").select(t.normalize_text_keep_points(F.col("v")).alias("v")).collect()
    assert r["v"] == "f001-23 nº é."


def test_blocks_of_one_document(spark, monkeypatch):
    """A document in many blocks gives what it gives in one: runs over a block's end, and the first of equal words."""
    texts = [f"w{i % 13}" for i in range(60)] + ["La", "Positiva", "S.A."] + ["w3"] * 5
    f = spark.createDataFrame([(1, "header", -1, i, f"f{i}", v, k) for i, (v, k) in enumerate([("w3", "single"), ("La Positiva S.A.", "multiword"), ("w11 w12 w0 w1 w2", "multiword"), ("zzz", "single"), ("...", "single")])], FIELD)
    run = lambda: sorted((r["ord"], r["word_idx"], r["word_count"], r["text"]) for r in m.match_fields(f, words(spark, *texts)).collect())
    whole = run()
    assert whole == [(0, 3, 1, "w3"), (1, 60, 3, "La Positiva S.A."), (2, 11, 5, "w11 w12 w0 w1 w2")]
    monkeypatch.setattr(m, "BLOCK_WORDS", 9)
    monkeypatch.setattr(m, "BLOCK_FIELDS", 2)
    assert run() == whole


def test_rows_of_different_pages_are_different(spark):
    w = spark.createDataFrame([(1, 0, 1, "alpha", 10, 50, 60, 62, 1.0), (1, 1, 1, "beta", 70, 50, 120, 62, 1.0), (1, 2, 2, "gamma", 10, 50, 60, 62, 1.0), (1, 3, 2, "222", 70, 50, 120, 62, 1.0)], WORD)
    f = spark.createDataFrame([(1, "items", 0, 0, "codigo", "alpha", "single"), (1, "items", 0, 1, "cantidad", "222", "numeric")], FIELD)
    from quillmap.plans.pipelines import items_via_table

    assert [(r["page"], r["text"]) for r in items_via_table(f, w).collect()] == [(1, "alpha")]
