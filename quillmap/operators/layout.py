"""Rows, columns, regions and tables from word coordinates. One document's words meet in one place only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmap.functions.geometry import band

# Words of the totals' region, and names of columns by the words in their heads, in order.
TOTAL_WORDS = ["subtotal", "igv", "total", "importe", "neto", "valor", "descuento", "suma", "monto", "pagar", "cobrar"]
COLUMN_NAMES = [("item", "item"), ("codigo", "codigo"), ("descripcion", "descripcion"), ("cantidad", "cantidad"), ("unidad", "unidad"), ("precio", "precio"), ("unitario", "precio_unitario"), ("valor", "valor_venta"), ("importe", "importe"), ("total", "total")]


def detect_rows(words: DataFrame, tolerance: int = 10, partition_by_page: bool = True) -> DataFrame:
    """words and row_id, row_pos. In order of (y0, x0) a word joins the row while it is within the
    tolerance of the row's first word; rows are then read by x0.

    The distinct heights of a page are folded in order, so the fold's state is small
    however many words there are.
    """
    keys = ["doc_id", "page"] if partition_by_page else ["doc_id"]
    heights = words.groupBy(*keys).agg(F.array_sort(F.collect_set("y0")).alias("ys"))

    def step(acc: Column, y: Column) -> Column:
        new = acc["anchor"].isNull() | (F.abs(y - acc["anchor"]) > tolerance)
        row = acc["row"] + F.when(new, 1).otherwise(0)
        return F.struct(F.when(new, y).otherwise(acc["anchor"]).alias("anchor"), row.alias("row"), F.concat(acc["out"], F.array(F.struct(y.alias("y0"), row.alias("row_id")))).alias("out"))

    start = F.struct(F.lit(None).cast("int").alias("anchor"), F.lit(-1).alias("row"), F.array().cast("array<struct<y0:int,row_id:int>>").alias("out"))
    rows = heights.select(*keys, F.inline(F.aggregate("ys", start, step)["out"]))
    order = Window.partitionBy(*keys, "row_id").orderBy("x0", "y0", "word_idx")
    return words.join(rows, [*keys, "y0"]).withColumn("row_pos", (F.row_number().over(order) - 1).cast("int"))


def filter_table_rows(rows: DataFrame, least: int = 3, most: int | None = None, keys=("doc_id", "page", "row_id")) -> DataFrame:
    """Words of rows with at least `least` and at most `most` words."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    kept = rows.withColumn("__n", n).filter(F.col("__n") >= least)
    return (kept.filter(F.col("__n") <= most) if most is not None else kept).drop("__n")


def detect_columns(words: DataFrame, gap: int = 15, keys=("doc_id",)) -> DataFrame:
    """keys, col_idx, center, n: left edges in order, a new column where the step is over `gap`."""
    counts = words.groupBy(*keys, "x0").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("x0")
    marked = counts.withColumn("start", F.when(F.col("x0") - F.lag("x0").over(order) > gap, 1).otherwise(0))
    marked = marked.withColumn("col_idx", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return marked.groupBy(*keys, "col_idx").agg(F.floor(F.sum(F.col("x0").cast("long") * F.col("n")) / F.sum("n")).cast("int").alias("center"), F.sum("n").alias("n"))


def column_ranges(columns: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, col_idx, x_start, x_end: from a centre half way to the next; the last reaches the edge."""
    nxt = F.lead("center").over(Window.partitionBy(*keys).orderBy("col_idx"))
    return columns.select(*keys, "col_idx", F.col("center").alias("x_start"), F.coalesce(F.floor((F.col("center") + nxt) / 2).cast("int"), F.lit(1000)).alias("x_end"))


def assign_columns(words: DataFrame, ranges: DataFrame, keys=("doc_id",)) -> DataFrame:
    """words and col_idx of the range that holds x0; words between the ranges are left out."""
    return words.join(ranges, list(keys)).filter("x0 >= x_start AND x0 < x_end").drop("x_start", "x_end")


def extract_columns(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """doc_id, page, row_id, col_idx, value: the words of each cell, empty text for an empty one."""
    cells = rows.select("doc_id", "page", "row_id").distinct().join(ranges.select("doc_id", "col_idx"), "doc_id")
    own = assign_columns(rows, ranges).groupBy("doc_id", "page", "row_id", "col_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_pos", "text"))), lambda e: e["text"]), " ").alias("value"))
    return cells.join(own, ["doc_id", "page", "row_id", "col_idx"], "left").withColumn("value", F.coalesce("value", F.lit("")))


def detect_table_v1(words: DataFrame, least_rows: int = 3) -> DataFrame:
    """doc_id, n_rows, n_words, x0, y0, x1, y1 of the rows of three or more words, if there are enough."""
    rows = filter_table_rows(detect_rows(words))
    found = rows.groupBy("doc_id").agg(F.count_distinct("page", "row_id").alias("n_rows"), F.count(F.lit(1)).alias("n_words"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return found.filter(F.col("n_rows") >= least_rows)


def density_bands(words: DataFrame, n: int = 20, height: int = 1000, keys=("doc_id",)) -> DataFrame:
    """keys, band, y_start, y_end, words: a histogram over the page's height, empty bands too, the last one open."""
    step = height // n
    counts = words.groupBy(*keys, F.least(F.floor(F.col("y0") / step), F.lit(n - 1)).cast("int").alias("band")).agg(F.count(F.lit(1)).alias("words"))
    everything = words.select(*keys).distinct().withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return everything.join(counts, [*keys, "band"], "left").select(*keys, "band", (F.col("band") * step).alias("y_start"), ((F.col("band") + 1) * step).alias("y_end"), F.coalesce("words", F.lit(0)).alias("words"))


def table_region(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, table_start, table_end: from the first to the last band of ten with three words, if two have."""
    dense = words.groupBy(*keys, band(F.col("y0"), 10).alias("b")).count().filter("count >= 3")
    return dense.groupBy(*keys).agg(F.min("b").alias("table_start"), (F.max("b") + 20).alias("table_end"), F.count(F.lit(1)).alias("n")).filter("n >= 2").drop("n")


def totals_region(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, totals_start, totals_end around the words that hold a word of totals."""
    hits = words.filter(F.lower("text").rlike("|".join(TOTAL_WORDS)))
    return hits.groupBy(*keys).agg(F.greatest(F.lit(0), F.min("y0") - 50).alias("totals_start"), (F.max("y0") + 30).alias("totals_end"))


def combine_regions(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, and start and end of header, items and totals; where nothing is found: items from 250, totals from 800 to 1000."""
    pages = words.select(*keys).distinct()
    got = pages.join(table_region(words, keys), list(keys), "left").join(totals_region(words, keys), list(keys), "left")
    got = got.withColumn("totals_start", F.coalesce("totals_start", F.lit(800))).withColumn("totals_end", F.coalesce("totals_end", F.lit(1000)))
    start = F.coalesce("table_start", F.lit(250))
    end = F.when(F.col("table_end").isNull() | (F.col("table_end") > F.col("totals_start")), F.col("totals_start") - 10).otherwise(F.col("table_end"))
    return got.select(*keys, F.lit(0).alias("header_start"), (start - 10).alias("header_end"), start.alias("items_start"), end.alias("items_end"), "totals_start", "totals_end")


def assign_regions(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """words and region: above the header's end, above the items' end, or below."""
    found = combine_regions(words, keys).select(*keys, "header_end", "items_end")
    region = F.when(F.col("y0") < F.col("header_end"), "header").when(F.col("y0") < F.col("items_end"), "items").otherwise("totals")
    return words.join(found, list(keys)).withColumn("region", region).drop("header_end", "items_end")


def detect_regions(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, region, y_start, y_end, word_count: three rows for each."""
    spans = F.array(*(F.struct(F.lit(r).alias("region"), F.col(f"{r}_start").alias("y_start"), F.col(f"{r}_end").alias("y_end")) for r in ("header", "items", "totals")))
    three = combine_regions(words, keys).select(*keys, F.inline(spans))
    counts = assign_regions(words, keys).groupBy(*keys, "region").agg(F.count(F.lit(1)).alias("word_count"))
    return three.join(counts, [*keys, "region"], "left").withColumn("word_count", F.coalesce("word_count", F.lit(0)))


def region_stats(regions: DataFrame, height: int = 1000) -> DataFrame:
    return regions.select("doc_id", "region", (F.col("y_end") - F.col("y_start")).alias("height"), "word_count", ((F.col("y_end") - F.col("y_start")) * 100.0 / height).cast("double").alias("percentage"))


def table_words(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """Words of the items' region."""
    return assign_regions(words, keys).filter("region = 'items'").drop("region")


def banded_rows(words: DataFrame, keys=("doc_id",), height: int = 10) -> DataFrame:
    """words, band and row_id: bands of the height in order; the first is the head unless it is the only one."""
    own = words.withColumn("band", band(F.col("y0"), height))
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy("band"))
    own = own.withColumn("__rank", rank)
    own = own.withColumn("__n", F.max("__rank").over(Window.partitionBy(*keys)))
    return own.filter("__rank > 1 OR __n = 1").withColumn("row_id", (F.col("__rank") - F.when(F.col("__n") > 1, 2).otherwise(1)).cast("int")).drop("__rank", "__n")


def detect_columns_v2(words: DataFrame, width: int = 15, share: float = 0.05, keys=("doc_id",)) -> DataFrame:
    """keys, x_start, x_end, n: bands of left edges with at least 5 % of the words, each up to 15 before the next."""
    counts = words.groupBy(*keys, band(F.col("x0"), width).alias("x_start")).agg(F.count(F.lit(1)).alias("n"))
    kept = counts.withColumn("all", F.sum("n").over(Window.partitionBy(*keys))).filter(F.col("n") >= F.col("all") * share)
    nxt = F.lead("x_start").over(Window.partitionBy(*keys).orderBy("x_start"))
    return kept.select(*keys, "x_start", F.coalesce(nxt - width, F.lit(1000)).alias("x_end"), "n")


def column_names(words: DataFrame, columns: DataFrame, keys=("doc_id",)) -> DataFrame:
    """columns and name: of the first word near the top of the column with a column keyword, else its place."""
    top = F.min("y0").over(Window.partitionBy(*keys))
    name = F.lit(None).cast("string")
    for word, column in reversed(COLUMN_NAMES):
        name = F.when(F.lower("text").contains(word), F.lit(column)).otherwise(name)
    heads = words.withColumn("__top", top).filter(F.col("y0") < F.col("__top") + 50).withColumn("name", name).filter("name IS NOT NULL")
    named = heads.join(columns, list(keys)).filter("x0 >= x_start AND x0 < x_end").groupBy(*keys, "x_start").agg(F.min_by("name", "word_idx").alias("name"))
    return columns.join(named, [*keys, "x_start"], "left").withColumn("name", F.coalesce("name", F.concat(F.lit("col_"), F.col("x_start").cast("string"))))


def table_header(words: DataFrame, keys=("doc_id",)) -> DataFrame:
    """Words less than 30 below the table's first."""
    return words.withColumn("__top", F.min("y0").over(Window.partitionBy(*keys))).filter(F.col("y0") < F.col("__top") + 30).drop("__top")


def extract_columns_v2(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """doc_id, row_id, name, value: a row's words by column; of columns with one name the last wins, empty ones are missing."""
    cells = rows.join(columns.select("doc_id", "x_start", "x_end", "name"), "doc_id").filter("x0 >= x_start AND x0 < x_end")
    cells = cells.groupBy("doc_id", "row_id", "name", "x_start").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "text"))), lambda e: e["text"]), " ").alias("value"))
    return cells.groupBy("doc_id", "row_id", "name").agg(F.max_by("value", "x_start").alias("value"))


def detect_table_v2(words: DataFrame) -> DataFrame:
    """doc_id, y_start, y_end, num_columns, num_rows, header_words; a row for each document with words in the items' region."""
    own = table_words(words)
    columns = detect_columns_v2(own).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("num_columns"))
    rows = banded_rows(own).groupBy("doc_id").agg(F.count_distinct("band").cast("int").alias("num_rows"))
    heads = table_header(own).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("header_words"))
    span = combine_regions(words).select("doc_id", F.col("items_start").alias("y_start"), F.col("items_end").alias("y_end"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.join(span, "doc_id").join(columns, "doc_id", "left").join(heads, "doc_id", "left").select("doc_id", "y_start", "y_end", zero("num_columns"), "num_rows", zero("header_words"))


def table_stats(structure: DataFrame) -> DataFrame:
    return structure.select("doc_id", "num_columns", "num_rows", (F.col("y_end") - F.col("y_start")).alias("region_height"), (F.col("header_words") > 0).alias("has_header"))
