"""Scans of page images and native text through an engine of choice.

An engine turns one file's bytes into words; it is made once for each task, and a file
that it cannot read gives a row with its error instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = "doc_id string, word_idx int, page int, text string, x0 int, y0 int, x1 int, y1 int, confidence double, extraction_method string, rotation int, error string"


def extract_words(files: DataFrame, make_engine: Callable[[], Callable[[bytes], Iterable[tuple]]], method: str = "native") -> DataFrame:
    """files: path, content. An engine yields (page, text, x0, y0, x1, y1, confidence, rotation) in reading order."""

    def run(batches):
        import pandas as pd

        engine = make_engine()
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    rows = [(name, i, w[0], w[1].strip(), *w[2:6], float(w[6]), method, w[7], None) for i, w in enumerate(w for w in engine(content) if w[1] and w[1].strip())]
                except Exception as error:  # noqa: BLE001  the file's fault, reported in its row
                    rows = [(name, None, None, None, None, None, None, None, None, method, None, f"{type(error).__name__}: {error}"[:500])]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in WORDS.split(", ")])

    return files.select("path", "content").mapInPandas(run, WORDS)


def split_lines(lines: DataFrame) -> DataFrame:
    """Words of recognised lines: the line's width dealt by length, gaps of 2 % of it."""
    width, n = F.col("x1") - F.col("x0"), F.length("text")
    parts = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    left = lambda i: F.aggregate(F.slice(parts, 1, i), F.col("x0").cast("double"), lambda a, v: a + F.length(v) / n * width + width * 0.02)
    boxes = F.transform(parts, lambda w, i: F.struct(w.alias("text"), left(i).cast("int").alias("x0"), F.least((left(i) + F.length(w) / n * width).cast("int"), F.col("x1")).alias("x1")))
    return lines.select("doc_id", "page", F.col("word_idx").alias("line"), F.posexplode(boxes).alias("pos", "w"), "y0", "y1", "confidence").select("doc_id", "page", "line", "pos", "w.text", "w.x0", "y0", "w.x1", "y1", "confidence")


def hybrid_words(native: DataFrame, recognised: DataFrame, least: int = 10, force_method: str | None = None) -> DataFrame:
    """A document's native words if its first page has more than `least`, else the recognised ones; force_method takes one for all."""
    if force_method not in (None, "native", "ocr"):
        raise ValueError(f"force_method is native, ocr or None, not {force_method!r}")
    if force_method:
        return native if force_method == "native" else recognised
    first = native.filter("page = 0 AND error IS NULL").groupBy("doc_id").count().filter(F.col("count") > least).select("doc_id")
    return native.join(first, "doc_id", "left_semi").unionByName(recognised.join(first, "doc_id", "left_anti"))


def hybrid_words_v2(native: DataFrame, recognised: DataFrame | None, least: int = 10, force_method: str | None = None) -> DataFrame:
    """The same with each word's region; without a recognising engine the native words of all documents."""
    from quillmap.operators.layout import assign_regions

    words = native if recognised is None else hybrid_words(native, recognised, least, force_method)
    return assign_regions(words.filter("error IS NULL"))


def map_images(images: DataFrame, make_engine: Callable[[], Callable[[bytes], bytes]]) -> DataFrame:
    """path, content, error: each image through an engine, bytes to bytes, such as one that rotates, deskews, crops, denoises,
    binarises or enlarges. An image that the engine cannot work on stays as it is, with the error beside it."""

    def run(batches):
        import pandas as pd

        engine = make_engine()
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows.append((path, engine(content), None))
                except Exception as error:  # noqa: BLE001  the image's fault, reported in its row
                    rows.append((path, content, f"{type(error).__name__}: {error}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "content", "error"])

    return images.select("path", "content").mapInPandas(run, "path string, content binary, error string")


def render_pages(files: DataFrame, make_engine: Callable[[], Callable[[bytes, float], Iterable[bytes]]], dpi: int = 300) -> DataFrame:
    """path, page, content, error: each page as an image, by an engine that takes a file and the zoom dpi / 72."""

    def run(batches):
        import pandas as pd

        engine = make_engine()
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows = [(path, k, image, None) for k, image in enumerate(engine(content, dpi / 72))]
                except Exception as error:  # noqa: BLE001  the file's fault, reported in its row
                    rows = [(path, None, None, f"{type(error).__name__}: {error}"[:500])]
                yield pd.DataFrame(rows, columns=["path", "page", "content", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, content binary, error string")
