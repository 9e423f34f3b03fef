"""End-user pipelines, composed of the operators. Each is words and fields to a table; no step leaves Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmap.functions import text as t
from quillmap.operators import elements as e
from quillmap.operators import layout, quality
from quillmap.operators import matching as m
from quillmap.storage import written

BOX = ["x0", "y0", "x1", "y1"]
KEYS = ["doc_id", "section", "item_idx", "ord"]


def header_elements(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Elements of the header's fields, found among all words given; ids in the fields' order."""
    return e.format_v1(m.match_fields(fields.filter("section = 'header'"), words, threshold), *KEYS[1:])


def item_elements(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Elements of the items' fields, found among all words given; ids in the items' order."""
    return e.format_v1(m.match_fields(fields.filter("section = 'items'"), words, threshold), *KEYS[1:])


def header_elements_v2(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """The second formatter's: without metadata fields, weak matches and invalid boxes."""
    return e.format_v2(m.match_fields(e.drop_metadata_fields(fields.filter("section = 'header'")), words, threshold), *KEYS[1:])


def single_page(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Elements of one-page documents in reading order: every field matched among all words."""
    return e.create_document(e.format_v1(m.match_fields(fields, words, threshold), *KEYS[1:]))


def items_via_table(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Matches of item fields, each within its item's best row; rows are of one page."""
    return m.item_row_hits(fields, layout.filter_table_rows(layout.detect_rows(words), 2), threshold)


def _by_role(fields: DataFrame, words: DataFrame, split: DataFrame | None, threshold: float) -> DataFrame:
    """Matches of documents whose pages have roles, and of all others as a whole; split: the former, None for all."""
    own = words if split is None else words.join(split, "doc_id", "left_semi")
    asked = fields if split is None else fields.join(split, "doc_id", "left_semi")
    roles = m.split_pages(asked, own, threshold).select("doc_id", "page", "role")
    # read by text, numbers and rows: written once
    placed = written(words.join(roles, ["doc_id", "page"], "left"), "roles")
    whole = asked.filter("section = 'header'") if split is None else asked.filter("section = 'header'").unionByName(fields.join(split, "doc_id", "left_anti"))
    found = m.match_fields(whole, placed.filter("role IS NULL OR role = 'header'").drop("role"), threshold)
    rows = items_via_table(asked, placed.filter("role = 'items'").drop("role"), threshold)
    return found.unionByName(rows, allowMissingColumns=True)


def multi_page(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Header fields among the header pages' words, items through the rows of the items' pages."""
    return e.create_document(e.format_v1(_by_role(fields, written(words, "words"), None, threshold), *KEYS[1:]))


def process_documents(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """One page or several: each document by its own pipeline, all in one pass over the words."""
    words = written(words, "words")
    several = words.groupBy("doc_id").agg(F.count_distinct("page").alias("n")).filter("n > 1").select("doc_id")
    return e.create_document(e.format_v1(_by_role(fields, words, several, threshold), *KEYS[1:]))


def enhance_match(matches: DataFrame, words: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """Confidence up for known patterns and near keywords, boxes around all of a value's words and its currency sign."""
    pattern = t.detect_pattern(F.col("text"))
    out = matches.withColumn("pattern_detected", pattern)
    sure = F.when(F.col("pattern_detected").isNotNull(), F.least(F.lit(1.0), F.col("confidence") + 0.15)).otherwise(F.col("confidence"))
    out = out.withColumn("confidence", sure)
    if context is not None:
        boost = m.context_boost(matches, context)
        out = out.join(boost, ["doc_id", "box_id"], "left").withColumn("confidence", F.least(F.lit(1.0), F.col("confidence") + F.coalesce("boost", F.lit(0.0)))).drop("boost")
    return m.expand_currency(m.expand_multiword_bbox(out, words), words)


def enhance_batch(matches: DataFrame, words: DataFrame) -> DataFrame:
    """All matches of a batch, each with the words within 100 of it as context; matches without a box stay as they are.

    The boost looks no further than 50, so all words within 100 give what the document's words give.
    """
    some = F.col("x0").isNotNull()
    return enhance_match(matches.filter(some), words, words).unionByName(matches.filter(~some), allowMissingColumns=True)


def with_box_id(matches: DataFrame) -> DataFrame:
    """box_id: the field's place in its document."""
    return matches.withColumn("box_id", F.struct("section", "item_idx", "ord"))


def enrich_fields(fields: DataFrame, words: DataFrame, least: float = 0.5, threshold: float = 85) -> DataFrame:
    """Every field with its box and confidence, or marked as not found; absent values pass unchanged."""
    found = enhance_match(with_box_id(m.match_fields(fields, words, threshold)), words).filter(F.col("confidence") >= least)
    got = fields.join(found.select(*KEYS, *BOX, "confidence"), KEYS, "left")
    asked = m.present(F.col("value"))
    box = F.when(F.col("x0").isNotNull(), F.array(*BOX))
    return got.select(*KEYS, "field_name", "value", box.alias("bbox"), F.when(asked, F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.when(asked, F.col("x0").isNull()).alias("not_found"))


def enrich_items(fields: DataFrame, words: DataFrame, least: float = 0.5, threshold: float = 85) -> DataFrame:
    """doc_id, item_idx, item: one row an item, its enriched fields in their order."""
    each = enrich_fields(fields.filter("section = 'items'"), words, least, threshold)
    return each.groupBy("doc_id", "item_idx").agg(F.array_sort(F.collect_list(F.struct("ord", "field_name", "value", "bbox", "confidence", "not_found"))).alias("item"))


def reprocess(fields: DataFrame, words: DataFrame, strategy: str = "keep_best", threshold: float = 85) -> DataFrame:
    """The second formatter: metadata fields out, weak matches out, duplicates resolved, then ordered."""
    found = m.match_fields(e.drop_metadata_fields(fields), words, threshold)
    return e.create_document(e.format_v2(found, *KEYS[1:]), strategy, True)


def reprocess_report(fields: DataFrame, words: DataFrame, strategy: str = "keep_best", threshold: float = 85) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(elements, their quality per document, improvements per document): the same with what the validation reports."""
    found = written(m.match_fields(e.drop_metadata_fields(fields), words, threshold), "found")
    formatted = e.format_v2(found, *KEYS[1:])
    out = written(e.create_document(formatted, strategy, True), "reprocessed")
    gone = fields.filter(F.col("field_name").isin(e.METADATA_FIELDS)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("removed_metadata_fields"))
    left = e.resolve_duplicates(formatted, strategy).groupBy("doc_id").agg(F.count(F.lit(1)).alias("resolved"))
    per = e.format_counters(found).join(left, "doc_id", "left").join(gone, "doc_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    each = per.select("doc_id", "total_fields", "filtered_low_confidence", "filtered_invalid_bbox", "expanded_bboxes", (F.col("emitted") - zero("resolved")).alias("resolved_duplicates"), zero("removed_metadata_fields").alias("removed_metadata_fields"))
    return out, quality.quality_metrics(out), each


def optimized_pipeline(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """Header fields outside the items' region, items through the second detector's rows outside the header; both enhanced, the header with context; the second formatter."""
    # words and matches are read several times: written once, which also keeps the plan small
    parts = written(layout.assign_regions(words), "regions")
    head = m.match_fields(fields.filter("section = 'header'"), parts.filter("region <> 'items'").drop("region"), threshold)
    everywhere = parts.drop("region")
    head = enhance_match(written(with_box_id(head), "head"), everywhere, everywhere).drop("box_id", "pattern_detected")
    table = parts.filter("region <> 'header'").drop("region")
    items = m.item_row_hits(fields, layout.banded_rows(table, ("doc_id", "page")), threshold)
    items = enhance_match(written(with_box_id(items), "items"), table).drop("box_id", "pattern_detected")
    return e.create_document(e.format_v2(head.unionByName(items, allowMissingColumns=True), *KEYS[1:]), "keep_best", True)


def process_batch(fields: DataFrame, words: DataFrame, done: DataFrame | None = None, threshold: float = 85) -> DataFrame:
    """One row a document: processed, failed (no words) or skipped (done before), with the match rates of process_documents()."""
    docs = fields.select("doc_id").distinct()
    skip = done.select("doc_id").distinct().withColumn("skip", F.lit(True)) if done is not None else docs.limit(0).withColumn("skip", F.lit(True))
    some = words.select("doc_id").distinct().withColumn("some", F.lit(True))
    status = docs.join(skip, "doc_id", "left").join(some, "doc_id", "left").select("doc_id", F.when(F.col("skip"), "skipped").when(F.col("some"), "processed").otherwise("failed").alias("status"))
    todo = fields.join(status.filter("status = 'processed'").select("doc_id"), "doc_id", "left_semi")
    found = process_documents(todo, words.join(todo.select("doc_id").distinct(), "doc_id", "left_semi"), threshold)
    return status.join(quality.match_rates(todo, found), "doc_id", "left")
