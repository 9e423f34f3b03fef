"""Validation, quality metrics, comparison of runs and reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmap.functions import geometry as g

BOX = ["x0", "y0", "x1", "y1"]
# Fields of a page's totals.
TOTALS_FIELDS = ["subtotal", "igv", "importe_total", "descuento_global", "total_operaciones_gravadas", "total_operaciones_inafectas", "total_descuentos", "redondeo", "valor_venta", "precio_venta"]
REQUIRED = ["id", "text", "box", "label", "field_name", "words", "page"]


def quality_metrics(elements: DataFrame, keys=("doc_id",)) -> DataFrame:
    """Per document: elements, valid, invalid, small, without confidence, groups of duplicates and their
    surplus, inconsistent words; quality_score = (n - invalid - without confidence) / n."""
    box, t = [F.col(c) for c in BOX], F.col("text")
    bad = ~g.is_valid(*box)
    dup = elements.groupBy(*keys, *BOX).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("total_duplicates"))
    words = F.col("words") if "words" in elements.columns else g.split_words(t, *box)
    each = elements.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_elements"), F.count_if(~bad).alias("valid_bboxes"), F.count_if(bad).alias("invalid_bboxes"), F.count_if(g.is_small(t, *box)).alias("small_bboxes"), F.count_if(F.col("confidence") < 0.01).alias("zero_confidence"), F.count_if(~g.words_consistent(t, words, F.col("x0"), F.col("x1"))).alias("inconsistent_words"))
    n = F.col("total_elements")
    return each.join(dup, list(keys)).withColumn("quality_score", (n - F.col("invalid_bboxes") - F.col("zero_confidence")) / n)


def analyze_documents(elements: DataFrame) -> DataFrame:
    """Per document what the comparison of runs looks at."""
    zero = (F.col("x0") == 0) & (F.col("y0") == 0) & (F.col("x1") == 0) & (F.col("y1") == 0)
    dup = elements.groupBy("doc_id", *BOX).agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.sum(F.col("n") - 1).alias("duplicate_count"))
    box = [F.col(c) for c in BOX]
    each = elements.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_elements"), F.count_if(zero).alias("zero_coords"), F.count_if(~g.is_valid(*box)).alias("invalid_bbox"), F.count_if(g.is_small(F.col("text"), *box)).alias("small_bbox"), F.count_if(F.col("confidence") < 0.5).alias("low_confidence"))
    return each.join(dup, "doc_id")


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per document of both runs its changes."""
    a, b = analyze_documents(before).alias("a"), analyze_documents(after).alias("b")
    both = a.join(b, "doc_id")
    minus = lambda x, y, c: (F.col(f"{x}.{c}") - F.col(f"{y}.{c}"))
    return both.select("doc_id", F.col("a.total_elements").alias("original_elements"), F.col("b.total_elements").alias("improved_elements"), F.col("a.zero_coords").alias("zero_original"), F.col("b.zero_coords").alias("zero_improved"), F.col("a.duplicate_count").alias("dup_original"), F.col("b.duplicate_count").alias("dup_improved"), minus("b", "a", "total_elements").alias("elements_change"), minus("a", "b", "zero_coords").alias("zero_coords_removed"), minus("a", "b", "duplicate_count").alias("duplicates_resolved"), minus("a", "b", "low_confidence").alias("low_confidence_filtered"))


def improvement_report(changes: DataFrame) -> DataFrame:
    """One row: totals, means for each document, reductions in percent (0 where nothing was to reduce)."""
    n = F.count(F.lit(1))
    less = lambda a, b: F.when(F.sum(a) > 0, (1 - F.sum(b) / F.sum(a)) * 100).otherwise(F.lit(0.0))
    return changes.agg(n.alias("documents_analyzed"), F.sum("original_elements").alias("original_elements"), F.sum("improved_elements").alias("improved_elements"), F.sum(-F.col("elements_change")).alias("elements_removed"), F.sum("zero_coords_removed").alias("zero_coords_removed"), F.sum("duplicates_resolved").alias("duplicates_resolved"), F.sum("low_confidence_filtered").alias("low_confidence_filtered"), F.try_divide(F.sum("dup_original"), n).alias("duplicates_original"), F.try_divide(F.sum("dup_improved"), n).alias("duplicates_improved"), less("zero_original", "zero_improved").alias("zero_coords_reduction"), less("dup_original", "dup_improved").alias("duplicates_reduction"))


def validate_elements(elements: DataFrame) -> DataFrame:
    """doc_id, id, severity, rule: one row for each rule that an element breaks; a rule on words for each word.

    A column that the elements do not have is missing in each of them.
    """
    own = lambda c, kind="string": F.col(c) if c in elements.columns else F.lit(None).cast(kind)
    x0, y0, x1, y1 = (own(c, "int") for c in BOX)
    outside = (F.least(x0, y0, x1, y1) < 0) | (F.greatest(x0, y0, x1, y1) > 1000)
    conf, words = own("confidence", "double"), own("words", "array<struct<text:string,box:array<int>>>")
    absent = [("error", f"missing_{c}", own(c).isNull()) for c in ("id", "text", "label", "field_name", "page")]
    rules = [*absent, ("error", "missing_words", words.isNull()), ("error", "missing_box", x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull()), ("error", "out_of_range", outside), ("error", "x_order", x1 <= x0), ("error", "y_order", y1 <= y0), ("warning", "confidence_range", conf.isNull() | (conf < 0) | (conf > 1))]
    verdict = lambda s, r: F.struct(F.lit(s).alias("severity"), F.lit(r).alias("rule"))
    of_word = lambda w: F.array(F.when(w["text"].isNull(), verdict("warning", "word_text")), F.when(w["box"].isNull(), verdict("warning", "word_box")), F.when(F.size(w["box"]) != 4, verdict("error", "word_box_size")))
    broken = F.concat(F.array(*(F.when(c, verdict(s, r)) for s, r, c in rules)), F.coalesce(F.flatten(F.transform(words, of_word)), F.array()))
    return elements.select("doc_id", own("id").alias("id"), F.explode(F.filter(broken, lambda b: b.isNotNull())).alias("b")).select("doc_id", "id", "b.*")


def validate_metadata(metadata: DataFrame, required=("doc_id", "num_pages", "components", "statistics")) -> DataFrame:
    """metadata and missing: which of the required fields a record does not have."""
    have = F.filter(F.array(*(F.when(F.col(c).isNotNull(), F.lit(c)) for c in required if c in metadata.columns)), lambda x: x.isNotNull())
    return metadata.withColumn("missing", missing_fields(have, required))


def validation_summary(elements: DataFrame) -> DataFrame:
    """One row: documents, valid ones, their share, mean elements and words of valid ones."""
    from quillmap.operators.elements import document_stats

    bad = validate_elements(elements).filter("severity = 'error'").select("doc_id").distinct().withColumn("bad", F.lit(True))
    docs = document_stats(elements).join(bad, "doc_id", "left").withColumn("valid", F.col("bad").isNull())
    n, good = F.count(F.lit(1)), F.count_if(F.col("valid"))
    mean = lambda c: F.when(good > 0, F.sum(F.when(F.col("valid"), F.col(c)).otherwise(0)) / good).otherwise(F.lit(0.0))
    return docs.agg(n.alias("total_documents"), good.alias("valid_documents"), (n - good).alias("invalid_documents"), F.try_divide(good, n).alias("success_rate"), mean("num_elements").alias("avg_elements"), mean("num_words").alias("avg_words"))


def missing_fields(have: Column, required=REQUIRED) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), have)


def match_rates(fields: DataFrame, found: DataFrame) -> DataFrame:
    """Per document the three rates: header fields found of all; item fields found of those present (null
    without items); fields found of those present, header and items together."""
    present = F.col("value").isNotNull() & (F.col("value") != "")
    keys = ["doc_id", "section", "item_idx", "ord"]
    hit = fields.join(found.select(*keys).distinct().withColumn("hit", F.lit(True)), keys, "left")
    head, hits = F.col("section") == "header", F.col("hit").isNotNull()
    agg = hit.groupBy("doc_id").agg(F.count_if(head).alias("header_total"), F.count_if(head & hits).alias("header_found"), F.count_if(~head & present).alias("item_fields_total"), F.count_if(~head & hits).alias("item_fields_found"), F.count_distinct(F.when(~head, F.col("item_idx"))).alias("items_total"), F.count_if(present).alias("fields_total"), F.count_if(hits).alias("fields_found"))
    return rates_of(agg)


def rates_of(counts: DataFrame) -> DataFrame:
    """counts and the three rates of match_rates()."""
    rate = lambda a, b: F.when(b > 0, a / b).when(b == 0, F.lit(1.0))
    return counts.select("*", rate(F.col("header_found"), F.col("header_total")).alias("header_match_rate"), F.when(F.col("items_total") > 0, rate(F.col("item_fields_found"), F.col("item_fields_total"))).alias("items_match_rate"), rate(F.col("fields_found"), F.col("fields_total")).alias("match_rate"))


def match_warnings(rates: DataFrame, least: float = 0.85) -> DataFrame:
    """doc_id, warnings: which of the two rates are too low; items only where there are any."""
    return rates.select("doc_id", low_rates(least).alias("warnings"))


def low_rates(least: float = 0.85) -> Column:
    low = [F.when(F.col("header_match_rate") < least, F.lit("header_match_rate")), F.when(F.col("items_match_rate") < least, F.lit("items_match_rate"))]
    return F.filter(F.array(*low), lambda x: x.isNotNull())


def quality_band(rate: Column, high: float = 0.85, fair: float = 0.70) -> Column:
    return F.when(rate >= high, "high").when(rate >= fair, "fair").otherwise("low")


def low_match_docs(rates: DataFrame, below: float = 0.7) -> DataFrame:
    return rates.filter(F.col("match_rate") < below)


def batch_stats(runs: DataFrame) -> DataFrame:
    """One row over runs (doc_id, status, header_match_rate, items_match_rate): counts, success over all documents,
    skipped ones too, and the mean of the documents' rates; with `seconds` the total and mean time of processed ones."""
    n, ok = F.count(F.lit(1)), F.col("status") == "processed"
    time = [F.sum(F.when(ok, F.col("seconds"))).alias("total_seconds"), F.avg(F.when(ok, F.col("seconds"))).alias("avg_seconds")] if "seconds" in runs.columns else []
    return runs.agg(n.alias("total_documents"), F.count_if(ok).alias("processed"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.try_divide(F.count_if(ok), n).alias("success_rate"), F.avg(F.when(ok, F.col("header_match_rate"))).alias("avg_header_match_rate"), F.avg(F.when(ok, F.col("items_match_rate"))).alias("avg_items_match_rate"), *time)


def failed_documents(runs: DataFrame, most: int = 100) -> DataFrame:
    """The first failed documents for a report."""
    return runs.filter("status = 'failed'").orderBy("doc_id").limit(most).select("doc_id")


def enrich_batch_stats(rates: DataFrame) -> DataFrame:
    """One row: fields found over fields asked, over all documents; with `status` the share of processed documents, with
    `seconds` the mean time of these."""
    ok = F.col("status") == "processed" if "status" in rates.columns else F.lit(True)
    more = [F.try_divide(F.count_if(ok), F.count(F.lit(1))).alias("success_rate")] if "status" in rates.columns else []
    more += [F.avg(F.when(ok, F.col("seconds"))).alias("avg_seconds")] if "seconds" in rates.columns else []
    return rates.agg(F.count(F.lit(1)).alias("documents"), F.sum("fields_total").alias("fields_total"), F.sum("fields_found").alias("fields_found"), F.try_divide(F.sum("fields_found"), F.sum("fields_total")).alias("match_rate"), *more)


def extraction_stats(words: DataFrame) -> DataFrame:
    """Per document: pages, words, words of each page, mean words a page, mean confidence, method and rotation.

    These are the tags of page 0's first word where words are tagged; without tags more
    than ten words on page 0 make a native document, and nothing was rotated.
    """
    first = F.when(F.col("page") == 0, F.struct("page", "word_idx"))
    tags = {c: F.min_by(c, first).alias(c) for c in ("extraction_method", "rotation") if c in words.columns}
    per = words.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("confidence") * 100).cast("long")).alias("c"), *tags.values())
    own = {c: F.min_by(c, F.when(F.col("page") == 0, F.col("page"))).alias(c) for c in tags}
    docs = per.groupBy("doc_id").agg(F.count(F.lit(1)).alias("num_pages"), F.sum("n").alias("total_words"), F.transform(F.array_sort(F.collect_list(F.struct("page", "n"))), lambda e: e["n"]).alias("words_per_page"), F.sum("c").alias("c"), F.max(F.when(F.col("page") == 0, F.col("n") > 10).otherwise(False)).alias("native"), *own.values())
    guess = F.when(F.col("native"), "native").otherwise("ocr")
    method = F.coalesce("extraction_method", F.lit("unknown")) if "extraction_method" in tags else guess
    rotation = [F.coalesce("rotation", F.lit(0)).alias("rotation")] if "rotation" in tags else []
    return docs.select("doc_id", "num_pages", "total_words", "words_per_page", (F.col("total_words") / F.col("num_pages")).alias("avg_words_per_page"), (F.col("c") / F.col("total_words") / 100).alias("avg_confidence"), method.alias("method"), *rotation)


def extraction_metadata_v2(words: DataFrame) -> DataFrame:
    """Per document: pages, words, mean words a page to one place, and the words of each region; words with their region."""
    n = lambda r: F.count_if(F.col("region") == r).alias(f"{r}_words")
    return words.groupBy("doc_id").agg(F.count_distinct("page").alias("num_pages"), F.count(F.lit(1)).alias("total_words"), F.round(F.count(F.lit(1)) / F.count_distinct("page"), 1).alias("avg_words_per_page"), n("header"), n("items"), n("totals"))


def union_bbox(words: DataFrame, *keys: str) -> DataFrame:
    return words.groupBy(*keys).agg(F.coalesce(F.min("x0"), F.lit(0)).alias("x0"), F.coalesce(F.min("y0"), F.lit(0)).alias("y0"), F.coalesce(F.max("x1"), F.lit(0)).alias("x1"), F.coalesce(F.max("y1"), F.lit(0)).alias("y1"))


def histogram(values: DataFrame, column: str, n: int = 20, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """bin, count; the last bin is closed, empty bins are there."""
    at = F.least(F.floor((F.col(column) - low) / (high - low) * n), F.lit(n - 1)).cast("int")
    counts = values.filter(F.col(column).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    bins = values.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def confidence_summary(rows: DataFrame, column: str = "confidence") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(column).alias("mean"), F.min(column).alias("min"), F.max(column).alias("max"), F.stddev_samp(column).alias("stdev"))


def enhancement_stats(pairs: DataFrame) -> DataFrame:
    """doc_id, box_id, change of confidence and area, absolute and in percent (0 for a zero start)."""
    area = lambda p: (F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0"))
    dc, da = F.col("n_confidence") - F.col("confidence"), area("n_") - area("")
    return pairs.select("doc_id", "box_id", dc.alias("confidence_change"), F.when(F.col("confidence") > 0, dc / F.col("confidence") * 100).otherwise(0.0).alias("confidence_percent"), da.alias("area_change"), F.when(area("") > 0, da / area("") * 100).otherwise(0.0).alias("area_percent"))


def confidence_compare(before: DataFrame, after: DataFrame, column: str = "confidence") -> DataFrame:
    """One row: both summaries, and how much the mean rose in percent (0 where it was 0)."""
    a, b = confidence_summary(before, column), confidence_summary(after, column)
    both = a.withColumnsRenamed({c: f"before_{c}" for c in a.columns}).unionByName(b.withColumnsRenamed({c: f"after_{c}" for c in b.columns}), allowMissingColumns=True)
    both = both.agg(*(F.max(c).alias(c) for c in both.columns))  # of two rows one
    return both.withColumn("improvement", F.when(F.col("before_mean") > 0, (F.col("after_mean") - F.col("before_mean")) / F.col("before_mean") * 100).otherwise(F.lit(0.0)))


def sample_audit(rates: DataFrame, n: int = 100, seed: str = "audit") -> DataFrame:
    """One row over n documents picked by a hash: their number, fields found and asked, how many have a rate above 0 and the mean of these."""
    picked = rates.withColumn("__h", F.md5(F.concat(F.lit(seed), F.col("doc_id").cast("string")))).orderBy("__h", "doc_id").limit(n)
    some = F.col("match_rate") > 0
    return picked.agg(F.count(F.lit(1)).alias("documents"), F.sum("fields_found").alias("fields_found"), F.sum("fields_total").alias("fields_total"), F.count_if(some).alias("with_match"), F.avg(F.when(some, F.col("match_rate"))).alias("mean_rate"))


def document_metadata(rates: DataFrame, extraction: DataFrame, stats: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """One record a document: pages, method, header and items components, statistics, warnings, errors.

    failed: doc_id, error of documents that could not be read; their records have errors and nothing else.
    """
    joined = rates.join(extraction, "doc_id").join(stats.select("doc_id", "num_elements"), "doc_id", "left").join(match_warnings(rates), "doc_id")
    rotation = F.col("rotation") if "rotation" in extraction.columns else F.lit(0)
    out = metadata_record(joined.withColumn("orientation_detected", rotation).withColumn("total_elements", F.coalesce("num_elements", F.lit(0))))
    if failed is None:
        return out
    return out.unionByName(failed.select("doc_id", F.array().cast("array<string>").alias("warnings"), F.array("error").alias("errors"), F.lit("failed").alias("status")), allowMissingColumns=True)


def metadata_record(each: DataFrame) -> DataFrame:
    """The columns of a processed document's record, in their order."""
    return each.select("doc_id", "num_pages", "method", "orientation_detected", "header_total", "header_found", "header_match_rate", "items_total", "item_fields_total", "item_fields_found", "items_match_rate", "total_elements", "total_words", "words_per_page", "avg_confidence", "warnings", F.array().cast("array<string>").alias("errors"), F.lit("processed").alias("status"))


def improvements_total(each: DataFrame) -> DataFrame:
    """One row: the sums of the documents' improvements, 0 without any."""
    return each.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("filtered_low_confidence", "filtered_invalid_bbox", "expanded_bboxes", "resolved_duplicates", "removed_metadata_fields")))


def verification_counters(counters: DataFrame, rates: DataFrame) -> DataFrame:
    """One row over format_counters() and match_rates(): documents, fields attempted, extracted and filtered and why, items, documents with fields missing."""
    fields = counters.agg(F.count(F.lit(1)).alias("total_documents"), *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("total_fields", "total_fields_attempted"), ("emitted", "total_fields_extracted"), ("filtered_low_confidence", "filtered_by_confidence"), ("filtered_invalid_bbox", "filtered_by_bbox"))))
    items = rates.agg(F.coalesce(F.sum("item_fields_total"), F.lit(0)).alias("total_items_attempted"), F.coalesce(F.sum("item_fields_found"), F.lit(0)).alias("total_items_extracted"), F.count_if(F.col("fields_found") < F.col("fields_total")).alias("documents_with_missing_fields"))
    both = fields.withColumn("total_fields_filtered", F.col("filtered_by_confidence") + F.col("filtered_by_bbox")).unionByName(items, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))  # of two rows one


def throughput(runs: DataFrame) -> DataFrame:
    """runs (batch_size, documents, seconds) and seconds_per_document, documents_per_second, speedup over batches of one."""
    each = runs.groupBy("batch_size").agg(F.sum("documents").alias("documents"), F.sum("seconds").alias("seconds"))
    each = each.withColumn("seconds_per_document", F.col("seconds") / F.col("documents")).withColumn("documents_per_second", F.col("documents") / F.col("seconds"))
    one = F.max(F.when(F.col("batch_size") == 1, F.col("documents_per_second"))).over(Window.partitionBy())  # a row for each size of batch: few
    return each.withColumn("speedup", F.col("documents_per_second") / one)


def best_batch_size(runs: DataFrame) -> DataFrame:
    """One row: the batch size with the most documents a second, of equals the smallest."""
    return throughput(runs).agg(F.max_by("batch_size", F.struct("documents_per_second", -F.col("batch_size"))).alias("batch_size"), F.max("documents_per_second").alias("documents_per_second"))


def column_means(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: the mean of each column over its values."""
    return rows.agg(*(F.avg(c).alias(c) for c in columns))


def totals_fields(fields: DataFrame) -> DataFrame:
    """Fields of a page's totals that have a value."""
    return fields.filter(F.col("field_name").isin(TOTALS_FIELDS) & F.col("value").isNotNull() & (F.col("value") != ""))


def best_orientation(scores: DataFrame) -> DataFrame:
    """doc_id, angle: the angle with the most confidence, of equals the first tried (0, 90, 180, 270)."""
    return scores.groupBy("doc_id").agg(F.max_by("angle", F.struct("confidence", -F.col("angle"))).alias("angle"))


def skew_angle(lines: DataFrame, most: float = 10.0) -> DataFrame:
    """doc_id, angle: the median of the lines' angles under the limit, 0 without any."""
    docs = lines.select("doc_id").distinct()
    return docs.join(lines.filter(F.abs("angle") < most).groupBy("doc_id").agg(F.median("angle").alias("angle")), "doc_id", "left").withColumn("angle", F.coalesce("angle", F.lit(0.0)))


def low_quality(variance: Column, least: float = 100.0) -> Column:
    """Whether an image's Laplacian variance calls for enhancement."""
    return variance < least


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def field_prefix_counts(fields: DataFrame) -> DataFrame:
    """prefix, count: the part of a field's name before its first point."""
    return fields.groupBy(F.split_part("field_name", F.lit("."), F.lit(1)).alias("prefix")).agg(F.count(F.lit(1)).alias("count"))


def running_progress(done: DataFrame) -> DataFrame:
    """done (doc_id, batch, finished as a timestamp) and n, share, seconds_left: progress of each batch in order of completion."""
    order, whole = Window.partitionBy("batch").orderBy("finished", "doc_id"), Window.partitionBy("batch")
    out = done.withColumn("n", F.row_number().over(order)).withColumn("all", F.count(F.lit(1)).over(whole))
    spent = F.unix_micros("finished") / 1e6 - F.unix_micros(F.min("finished").over(whole)) / 1e6
    return out.withColumn("share", F.col("n") / F.col("all")).withColumn("seconds_left", spent / F.col("n") * (F.col("all") - F.col("n"))).drop("all")
