"""Rows, duplicates, chunks and their invariants on small hand-made pages."""

import random

from pyspark.sql import functions as F

from quillmap.functions import geometry as g
from quillmap.operators import elements as e
from quillmap.operators import layout as y
from quillmap.sources import tables as s
from tests.test_matching import WORD


def page(spark, *boxes):
    return spark.createDataFrame([(1, i, 0, "w", x, top, x + 20, top + 10, 0.9) for i, (x, top) in enumerate(boxes)], WORD)


def test_rows_hang_on_their_first_word(spark):
    rows = y.detect_rows(page(spark, *((10, v) for v in (0, 6, 12, 18, 24, 100)))).orderBy("word_idx").collect()
    assert [r["row_id"] for r in rows] == [0, 0, 1, 1, 2, 3]


def test_regions_without_anything_found(spark):
    (r,) = y.combine_regions(page(spark, (10, 10))).collect()
    assert (r["header_end"], r["items_start"], r["items_end"], r["totals_start"], r["totals_end"]) == (240, 250, 790, 800, 1000)


def test_duplicates(spark):
    rows = [(1, 0, 0, 0, 0, 10, 10, 0.5), (1, 1, 0, 0, 0, 10, 10, 0.9), (1, 2, 1, 0, 0, 10, 10, 0.9), (1, 3, 0, 5, 5, 9, 9, 0.1)]
    el = spark.createDataFrame(rows, "doc_id int, id int, page int, x0 int, y0 int, x1 int, y1 int, confidence double")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(e.dedup_keep_best(el)) == [1, 2, 3]
    assert ids(e.dedup_keep_best(el, ("doc_id",))) == [1, 3]
    assert ids(e.dedup_remove_all(el)) == [2, 3]
    assert {r["id"]: r["x0"] for r in e.dedup_expand(el).collect()} == {0: 0, 1: 2, 2: 0, 3: 5}


def test_boxes(spark):
    c = [F.lit(v) for v in (0, 0, 1000, 1000)]
    (r,) = spark.range(1).select(g.is_valid(*c).alias("a"), g.is_valid(*[F.lit(0)] * 4).alias("z"), g.xywh_to_xyxy(F.array(F.lit(1), F.lit(2))).alias("n"), F.array(*g.expand(F.lit("abc"), *(F.lit(v) for v in (10, 10, 15, 22)))).alias("e")).collect()
    assert (r["a"], r["z"], r["n"], r["e"]) == (True, False, None, [1, 10, 24, 22])


def test_chunks_reassemble(spark):
    rng = random.Random(3)
    rows = [(d, i, i, "w " * rng.randrange(1, 90)) for d in range(4) for i in range(rng.randrange(1, 60))]
    el = spark.createDataFrame(rows, "doc_id int, position int, id int, text string")
    chunks = e.chunk_elements(el)
    back = {(r["doc_id"], r["id"]) for r in e.reassemble_chunks(chunks).collect()}
    assert back == {(d, i) for d, i, _, _ in rows}
    one = e.chunk_elements(spark.createDataFrame([(9, 0, 0, "w " * 400)], "doc_id int, position int, id int, text string")).collect()
    assert len(one) == 1 and one[0]["tokens"] == 804


def test_scans(spark):
    docs = spark.createDataFrame([(f"/in/{i}.pdf",) for i in range(9)], "path string")
    assert [r["path"] for r in s.scan_slice(docs, 2, 5).collect()] == ["/in/2.pdf", "/in/3.pdf", "/in/4.pdf"]
    stems = docs.select(s.stem(F.col("path")).alias("stem"))
    assert s.pending_documents(stems, stems.filter("stem < '7'")).count() == 2


def test_annotations_and_adapter(spark, tmp_path):
    from quillmap.sources.adapters import extract_words

    (tmp_path / "a.json").write_text('{"b": 1, "a": "x y", "items": [1], "n": null}')
    rows = s.read_annotations(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r["stem"], r["key"], r["kind"]) for r in rows] == [("a", "b", "scalar"), ("a", "a", "scalar"), ("a", "items", "nested"), ("a", "n", "null")]
    files = spark.createDataFrame([("/x/1.pdf", bytearray(b"hello world")), ("/x/2.pdf", bytearray(b"!"))], "path string, content binary")

    def engine():
        def run(content):
            if content == b"!":
                raise ValueError("broken")
            return [(0, w.decode(), 1, 2, 3, 4, 1.0, 0) for w in content.split()]

        return run

    got = extract_words(files, engine).orderBy("doc_id", "word_idx").collect()
    assert [r["text"] for r in got] == ["hello", "world", None] and got[2]["error"].startswith("ValueError")


def test_incremental_run_sees_each_file_once(spark, tmp_path):
    from quillmap.streaming.incremental import process_new

    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for k in range(2):
        spark.createDataFrame([(k,)], "v int").write.mode("append").parquet(src)
        process_new(spark, src, spark.read.parquet(src).schema, out, str(tmp_path / "cp"), lambda df: df)
    assert sorted(r["v"] for r in spark.read.parquet(out).collect()) == [0, 1]
