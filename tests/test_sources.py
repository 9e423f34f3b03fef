"""Sinks, adapters and reports on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from quillmap import storage
from quillmap.operators import elements as e
from quillmap.operators import quality as q
from quillmap.sources import adapters as a
from quillmap.sources import tables as s
from tests.test_matching import WORD


def test_documents_there_and_back(spark, tmp_path):
    rows = [(1, i, i, f"é{i}", 0, 0, 10, 10, 0.12345, "answer", "f", 0) for i in (1, 0)]
    el = spark.createDataFrame(rows, "doc_id int, position int, id int, text string, x0 int, y0 int, x1 int, y1 int, confidence double, label string, field_name string, page int").withColumn("words", F.array(F.struct("text", F.array("x0", "y0", "x1", "y1").alias("box"))))
    s.write_documents(e.to_documents(el), str(tmp_path / "out"))
    (r,) = s.read_documents(spark, str(tmp_path / "out")).collect()
    assert [x["text"] for x in r["form"]] == ["é0", "é1"] and r["form"][0]["confidence"] == 0.123 and r["form"][0]["box"] == [0, 0, 10, 10]


def test_first_files_of_a_folder(spark, tmp_path):
    for n in ("b.pdf", "a.pdf", "c.pdf", "d.txt"):
        (tmp_path / n).write_bytes(n.encode())
    got = sorted(r["path"].rsplit("/", 1)[-1] for r in s.scan_files(spark, str(tmp_path), most=2).collect())
    assert got == ["a.pdf", "b.pdf"] and s.scan_files(spark, str(tmp_path)).count() == 3


def test_hybrid_and_forced(spark):
    word = "doc_id string, word_idx int, page int, text string, x0 int, y0 int, x1 int, y1 int, confidence double, extraction_method string, rotation int, error string"
    native = spark.createDataFrame([("a", i, 0, "n", 10, 300, 20, 310, 1.0, "native", 0, None) for i in range(11)] + [("b", 0, 0, "n", 10, 300, 20, 310, 1.0, "native", 0, None)], word)
    seen = spark.createDataFrame([(d, 0, 0, "o", 10, 40, 20, 50, 0.9, "ocr", 90, None) for d in "ab"], word)
    method = lambda df: sorted({(r["doc_id"], r["extraction_method"]) for r in df.collect()})
    assert method(a.hybrid_words(native, seen)) == [("a", "native"), ("b", "ocr")]
    assert method(a.hybrid_words(native, seen, force_method="ocr")) == [("a", "ocr"), ("b", "ocr")]
    with pytest.raises(ValueError):
        a.hybrid_words(native, seen, force_method="other")
    assert {r["region"] for r in a.hybrid_words_v2(native, seen).collect()} == {"header", "items"}
    tags = {r["doc_id"]: (r["method"], r["rotation"]) for r in q.extraction_stats(a.hybrid_words(native, seen)).collect()}
    assert tags == {"a": ("native", 0), "b": ("ocr", 90)}


def test_images_and_pages(spark):
    files = spark.createDataFrame([("x", bytearray(b"abc")), ("y", bytearray(b""))], "path string, content binary")

    def turn():
        def one(b):
            if not b:
                raise ValueError("no image")
            return b[::-1]

        return one

    got = {r["path"]: (bytes(r["content"]), r["error"]) for r in a.map_images(files, turn).collect()}
    assert got == {"x": (b"cba", None), "y": (b"", "ValueError: no image")}
    pages = a.render_pages(files, lambda: lambda b, zoom: [bytes([c]) * round(zoom) for c in b], dpi=144).collect()
    assert [(r["path"], r["page"], bytes(r["content"])) for r in pages] == [("x", 0, b"aa"), ("x", 1, b"bb"), ("x", 2, b"cc")]


def test_words_of_lines(spark):
    lines = spark.createDataFrame([(1, 0, 0, "ab cdef", 0, 10, 700, 30, 0.9)], "doc_id int, page int, word_idx int, text string, x0 int, y0 int, x1 int, y1 int, confidence double")
    got = [(r["text"], r["x0"], r["x1"]) for r in a.split_lines(lines).orderBy("pos").collect()]
    assert got == [("ab", 0, 200), ("cdef", 214, 614)]


def test_files_of_a_document(spark):
    el = spark.createDataFrame([("d", 0, "header"), ("d", 1, "header"), ("d", 1, "items"), ("d", 2, "items"), ("e", 0, "items")], "doc_id string, page int, section string")
    chunks = spark.createDataFrame([("d", "items", 2, k) for k in (0, 1)], "doc_id string, kind string, page int, chunk_index int")
    names = sorted(r["file_name"] for r in s.output_file_plan(el, chunks).collect())
    assert names == ["d_header.json", "d_items_p1.json", "d_items_p2_chunk_0.json", "d_items_p2_chunk_1.json", "e_layout.json"]


def test_empty_reports(spark):
    runs = spark.createDataFrame([], "doc_id int, status string, header_match_rate double, items_match_rate double, seconds double")
    (r,) = q.batch_stats(runs).collect()
    assert (r["total_documents"], r["processed"], r["failed"]) == (0, 0, 0)
    rates = spark.createDataFrame([(1, 2, 1, 4, 2, 1, 6, 3, 0.5, 0.5, 0.5)], "doc_id int, header_total int, header_found int, item_fields_total int, item_fields_found int, items_total int, fields_total int, fields_found int, header_match_rate double, items_match_rate double, match_rate double")
    words = spark.createDataFrame([(1, 0, 0, "a", 0, 0, 9, 9, 1.0)], WORD)
    stats = spark.createDataFrame([(1, 5)], "doc_id int, num_elements int")
    failed = spark.createDataFrame([(2, "unreadable")], "doc_id int, error string")
    good, bad = q.document_metadata(rates, q.extraction_stats(words), stats, failed).orderBy("doc_id").collect()
    assert good["status"] == "processed" and good["warnings"] == ["header_match_rate", "items_match_rate"] and good["errors"] == []
    assert bad["status"] == "failed" and bad["errors"] == ["unreadable"] and bad["num_pages"] is None
    (r,) = q.validate_metadata(spark.createDataFrame([(1, None)], "doc_id int, num_pages int")).collect()
    assert r["missing"] == ["num_pages", "components", "statistics"]


def test_shared_folder(spark):
    out = storage.written(spark.range(5), "five")
    assert out.count() == 5
    path = out.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    storage.removed(spark, out)
    assert not os.path.exists(path)


def test_no_folder_of_one_machine_on_a_cluster(spark):
    from types import SimpleNamespace as Some

    conf = Some(get=lambda *_: None)
    with pytest.raises(ValueError):
        storage.shared_dir(Some(conf=conf, sparkContext=Some(master="yarn", applicationId="a cluster's")))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(storage.atexit, "register", lambda *_, **__: None)
        own = storage.shared_dir(Some(conf=conf, sparkContext=Some(master="local[2]", applicationId="a test's", setCheckpointDir=lambda _: None)))
        assert own.startswith("file://")
        os.rmdir(own.removeprefix("file://"))
