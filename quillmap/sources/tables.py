"""Scans and sinks: path listings, slices, pairing, pending documents, JSON annotations and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmap.functions.text import value_kind


def scan_files(spark: SparkSession, directory: str, pattern: str = "*.pdf", most: int | None = None) -> DataFrame:
    """path, modificationTime, length, content of the files of a directory; with `most` the first by path.

    The first are found by their paths alone, before any content is read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return files if most is None else files.join(files.select("path").orderBy("path").limit(most), "path", "left_semi")


def scan_slice(paths: DataFrame, start: int = 0, end: int | None = None, most: int | None = None, column: str = "path") -> DataFrame:
    """Rows from `start` before `end` of the listing in order, at most `most`. The listing is sorted by all tasks; an offset's rows are passed over in one."""
    rows = paths.orderBy(column)
    n = None if end is None else max(0, end - start)
    n = most if n is None else n if most is None else min(n, most)
    rows = rows.offset(start) if start else rows
    return rows if n is None else rows.limit(n)


def stem(path: Column) -> Column:
    """File name without folders and the last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.[^.]*$", "")


def pair_documents(documents: DataFrame, annotations: DataFrame) -> DataFrame:
    """documents and status by their stem: paired, or no_annotation."""
    known = annotations.select("stem").distinct().withColumn("__some", F.lit(True))
    return documents.join(known, "stem", "left").withColumn("status", F.when(F.col("__some"), "paired").otherwise("no_annotation")).drop("__some")


def pending_documents(documents: DataFrame, done: DataFrame) -> DataFrame:
    """documents without a result yet; put before any expensive step."""
    return documents.join(done.select("stem").distinct(), "stem", "left_anti")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """stem, key, value, kind in document order of one JSON object a file; nested values stay JSON."""
    files = spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("stem"), "value")
    keys = files.select("stem", "value", F.posexplode(F.json_object_keys("value")).alias("ord", "key"))
    parsed = keys.withColumn("map", F.from_json("value", "map<string,string>"))
    value = F.element_at("map", F.col("key"))
    kind = F.when(value.isNull(), "null").when(value.rlike(r"^\s*[\[{]"), "nested").otherwise("scalar")
    return parsed.select("stem", "ord", "key", value.alias("value"), kind.alias("kind"))


def split_annotation(annotations: DataFrame, column: str = "annotation") -> DataFrame:
    """Fields of JSON annotations: doc_id, section, item_idx, ord, field_name, value, kind, in the object's order.

    The key items holds a list of objects, whose fields are items' fields; cuotas is left
    out; all other keys are the header's. Null and empty values are dropped, ord counts them.
    """
    pairs = annotations.select("doc_id", F.from_json(column, "map<string,variant>").alias("m"))
    of = lambda m: F.posexplode(F.map_entries(m)).alias("ord", "e")
    kind_of = F.schema_of_variant("v")
    out = ["doc_id", "section", "item_idx", "ord", "field_name", "value"]
    head = pairs.select("doc_id", F.lit("header").alias("section"), F.lit(-1).alias("item_idx"), of(F.map_filter("m", lambda k, v: ~k.isin("items", "cuotas"))))
    items = pairs.select("doc_id", F.posexplode(F.col("m")["items"].cast("array<map<string,variant>>")).alias("item_idx", "m"))
    both = head.unionByName(items.select("doc_id", F.lit("items").alias("section"), "item_idx", of("m")))
    flat = both.select("doc_id", "section", "item_idx", "ord", F.col("e.key").alias("field_name"), F.col("e.value").alias("v")).withColumn("value", F.col("v").cast("string"))
    numeric = kind_of.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    return flat.filter(F.col("value").isNotNull() & (F.col("value") != "")).select(*out, value_kind(F.col("value"), numeric).alias("kind"))


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line; characters as they are."""
    documents.write.mode(mode).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def output_file_plan(elements: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """doc_id, page, kind, file_name: one file for a one-page document, else the header's (page: its first) and one for each page of items.

    elements: doc_id, page and section; without a section page 0 is the header. chunks:
    doc_id, kind, page, chunk_index of those parts that were cut; only their files are numbered.
    """
    section = F.col("section") if "section" in elements.columns else F.when(F.col("page") == 0, "header").otherwise("items")
    pages = elements.select("doc_id", "page", section.alias("section"))
    single = F.min("page").over(Window.partitionBy("doc_id")) == F.max("page").over(Window.partitionBy("doc_id"))
    kind = F.when(F.col("single"), "single").when(F.col("section") == "header", "header").otherwise("items")
    parts = pages.withColumn("single", single).withColumn("kind", kind).groupBy("doc_id", "kind", F.when(kind == "items", F.col("page")).alias("__page")).agg(F.min("page").alias("page"))
    name = F.when(F.col("kind") == "single", F.concat(F.col("doc_id"), F.lit("_layout"))).when(F.col("kind") == "header", F.concat(F.col("doc_id"), F.lit("_header"))).otherwise(F.concat(F.col("doc_id"), F.lit("_items_p"), F.col("page")))
    plan = parts.select("doc_id", "page", "kind", name.alias("stem"))
    if chunks is None:
        return plan.select("doc_id", "page", "kind", F.concat("stem", F.lit(".json")).alias("file_name"))
    numbered = plan.join(chunks.select("doc_id", "kind", "page", "chunk_index").distinct(), ["doc_id", "kind", "page"], "left")
    number = F.when(F.col("chunk_index").isNotNull(), F.concat(F.lit("_chunk_"), F.col("chunk_index"))).otherwise("")
    return numbered.select("doc_id", "page", "kind", F.concat("stem", number, F.lit(".json")).alias("file_name"))


def reorganize(files: DataFrame) -> DataFrame:
    """name, status, target: enriched files by their final name; those without metadata are rejected."""
    ok = F.col("metadata").isNotNull()
    return files.select("name", F.when(ok, "accepted").otherwise("rejected").alias("status"), F.when(ok, F.regexp_replace("name", r"_enriched\.json$", ".json")).alias("target"))


def dataset_summary(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.try_divide(F.count_if(F.col("status") == "accepted") * F.lit(100.0), F.count(F.lit(1))).alias("success_percent"))


def content_files(files: DataFrame) -> DataFrame:
    """Files that are results, not metadata, statistics, reports or checkpoints."""
    return files.filter(~F.lower("name").rlike("metadata|statistic|report|checkpoint"))


def native_page_flag(words: DataFrame, least: int = 10) -> DataFrame:
    """doc_id, page, word_count, native: a page with more than ten words has native text."""
    return words.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("word_count")).withColumn("native", F.col("word_count") > least)


def page_count(words: DataFrame) -> DataFrame:
    return words.groupBy("doc_id").agg(F.count_distinct("page").alias("num_pages"))
