"""Elements: words split from values, identifiers, order, duplicates, documents and chunks.

elements: doc_id, id, page, text, x0, y0, x1, y1, confidence and more columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmap.functions import geometry as g
from quillmap.functions.text import token_count

BOX = ["x0", "y0", "x1", "y1"]
# Fields that describe the processing and are no content.
METADATA_FIELDS = ["augmentation", "is_augmented", "extraction_method", "rotation_corrected", "match_score", "word_count"]


def _box(names=BOX) -> list[Column]:
    return [F.col(c) for c in names]


def drop_metadata_fields(fields: DataFrame) -> DataFrame:
    return fields.filter(~F.col("field_name").isin(METADATA_FIELDS))


def duplicate_boxes(elements: DataFrame, keys=("doc_id",)) -> DataFrame:
    """keys, box, n: boxes that several elements have."""
    return elements.groupBy(*keys, *BOX).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def dedup_keep_best(elements: DataFrame, keys=("doc_id", "page")) -> DataFrame:
    """Of one box the element with the most confidence, of equals the first."""
    best = Window.partitionBy(*keys, *BOX).orderBy(F.col("confidence").desc(), "id")
    return elements.withColumn("__rank", F.row_number().over(best)).filter("__rank = 1").drop("__rank")


def dedup_expand(elements: DataFrame, keys=("doc_id", "page"), step: int = 2) -> DataFrame:
    """All elements; the k-th of one box moves right by 2 k, within the page."""
    k = (F.row_number().over(Window.partitionBy(*keys, *BOX).orderBy("id")) - 1) * step
    moved = elements.withColumn("__k", k.cast("int"))
    return moved.withColumn("x0", F.least(F.lit(1000), F.col("x0") + F.col("__k"))).withColumn("x1", F.least(F.lit(1000), F.col("x1") + F.col("__k"))).drop("__k")


def dedup_remove_all(elements: DataFrame, keys=("doc_id", "page")) -> DataFrame:
    """Elements whose box no other has."""
    return elements.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys, *BOX))).filter("__n = 1").drop("__n")


STRATEGIES = {"keep_best": dedup_keep_best, "expand": dedup_expand, "remove_all": dedup_remove_all}


def resolve_duplicates(elements: DataFrame, strategy: str = "keep_best", keys=("doc_id", "page")) -> DataFrame:
    return STRATEGIES[strategy](elements, keys)


def assign_ids(elements: DataFrame, *order: str) -> DataFrame:
    """id: 0, 1, ... within a document, of the emitted elements only."""
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy(*(order or ("id",)))) - 1
    return elements.withColumn("id", at.cast("int"))


def reading_order(elements: DataFrame) -> DataFrame:
    """position: by page, then top, then left; ties keep their order."""
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "y0", "x0", "id")) - 1
    return elements.withColumn("position", at.cast("int"))


def format_v1(matches: DataFrame, *order: str) -> DataFrame:
    """Elements of matches: words split from the box, ids in order; every match is emitted."""
    out = matches.withColumn("words", g.split_words(F.col("text"), *_box())).withColumn("label", F.lit("answer"))
    return assign_ids(out, *order)


def confident(elements: DataFrame, least: float = 0.5) -> DataFrame:
    """Elements with at least so much confidence."""
    return elements.filter(F.col("confidence") >= least)


def drop_reason(min_confidence: float = 0.5) -> Column:
    """Why the second formatter leaves a match out, or null."""
    return F.when(F.col("confidence") < min_confidence, "low_confidence").when(~g.is_valid(*_box()), "invalid_bbox")


def format_v2(matches: DataFrame, *order: str, min_confidence: float = 0.5, expand_small: bool = True) -> DataFrame:
    """Matches with enough confidence and a valid box; small boxes grow, others get least sides."""
    kept = matches.filter(drop_reason(min_confidence).isNull())
    t = F.col("text")
    small = F.lit(expand_small) & g.is_small(t, *_box())
    grown = g.expand(t, *_box())
    kept = kept.select("*", *(F.when(small, e).otherwise(F.col(c)).alias(f"__{c}") for c, e in zip(BOX, grown, strict=True))).drop(*BOX)
    kept = kept.select("*", *(c.alias(n) for n, c in zip(BOX, g.fix(t, *_box([f"__{c}" for c in BOX])), strict=True))).drop(*[f"__{c}" for c in BOX])
    out = kept.withColumn("words", g.split_words(t, *_box(), 5, 2)).withColumn("label", F.lit("answer"))
    return assign_ids(out, *order)


def format_counters(matches: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Per document: fields seen, left out for confidence or box, expanded, emitted."""
    reason, n = drop_reason(min_confidence), lambda c: F.sum(F.when(c, 1).otherwise(0))
    small = reason.isNull() & g.is_small(F.col("text"), *_box())
    return matches.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_fields"), n(reason == "low_confidence").alias("filtered_low_confidence"), n(reason == "invalid_bbox").alias("filtered_invalid_bbox"), n(small).alias("expanded_bboxes"), n(reason.isNull()).alias("emitted"))


def create_document(elements: DataFrame, strategy: str | None = None, check_words: bool = False) -> DataFrame:
    """Elements in reading order; the second version resolves duplicates and drops inconsistent words first."""
    out = resolve_duplicates(elements, strategy) if strategy else elements
    if check_words:
        out = out.filter(g.words_consistent(F.col("text"), F.col("words"), F.col("x0"), F.col("x1")))
    return reading_order(out)


def to_documents(elements: DataFrame) -> DataFrame:
    """doc_id, form: one row a document, elements in position order, for a sink."""
    element = F.struct("position", "id", "text", F.array(*BOX).alias("box"), "label", "field_name", "words", "page", F.round("confidence", 3).alias("confidence"))
    return elements.groupBy("doc_id").agg(F.array_sort(F.collect_list(element)).alias("form")).withColumn("form", F.transform("form", lambda e: e.dropFields("position")))


def document_stats(elements: DataFrame) -> DataFrame:
    return elements.groupBy("doc_id").agg(F.count(F.lit(1)).alias("num_elements"), F.sum(token_count(F.col("text"))).alias("num_words"), (F.sum(F.round(F.col("confidence") * 1000).cast("long")) / F.count(F.lit(1)) / 1000).alias("avg_confidence"), F.sort_array(F.collect_set("page")).alias("pages"))


def estimate_tokens(text: Column, n_words: Column | None = None, per_word: float = 2.0) -> Column:
    """Tokens of an element: twice its words, and four."""
    return ((n_words if n_words is not None else token_count(text)) * per_word).cast("int") + 4


def _cut(most: int, overlap: int):
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("position", kind="stable", ignore_index=True)
        tokens = pdf["tokens"].tolist()
        spans, begin, size = [], 0, 0
        keep, kept = 0, 0  # where the overlap begins, and its tokens
        for i, t in enumerate(tokens if sum(tokens) > most else []):
            if size + t > most and i > begin:
                spans.append((begin, i))
                begin, size, keep, kept = keep, kept, i, 0
            size, kept = size + t, kept + t
            while kept > overlap and keep < i:
                kept -= tokens[keep]
                keep += 1
        spans.append((begin, len(tokens)))
        at = [(c, p, k) for c, (lo, hi) in enumerate(spans) for p, k in enumerate(range(lo, hi))]
        rows = pdf.iloc[[k for _, _, k in at]]
        return pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "chunk_index": [c for c, _, _ in at], "pos": [p for _, p, _ in at], "id": rows["id"].to_numpy(), "tokens": rows["tokens"].to_numpy()})

    return run


def chunk_elements(elements: DataFrame, most: int = 384, overlap: int = 128) -> DataFrame:
    """doc_id, chunk_index, pos, id, tokens: elements in position order cut into chunks.

    A document within `most` tokens is one chunk. Otherwise an element that would pass
    `most` starts the next chunk, which begins with the elements kept for overlap; these
    are then cleared. The overlap is what was added last, its oldest going while it has
    more than `overlap` tokens and one element. Elements with `words` count these. One document's elements are folded in
    one group; documents go to different tasks.
    """
    given = F.size("words") if "words" in elements.columns else None
    own = elements.select("doc_id", "position", "id", estimate_tokens(F.col("text"), given).alias("tokens"))
    return own.groupBy("doc_id").applyInPandas(_cut(most, overlap), f"doc_id {elements.schema['doc_id'].dataType.simpleString()}, chunk_index int, pos int, id {elements.schema['id'].dataType.simpleString()}, tokens int")


def chunk_info(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_index, total_chunks, num_elements, estimated_tokens."""
    each = chunks.groupBy("doc_id", "chunk_index").agg(F.count(F.lit(1)).alias("num_elements"), F.sum("tokens").alias("estimated_tokens"))
    return each.withColumn("total_chunks", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Per document: its chunks, their elements and tokens in sum and in a list each, the most and the mean tokens."""
    each = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", c))), lambda e: e[c])
    return chunk_info(chunks).groupBy("doc_id").agg(each("num_elements").alias("elements_per_chunk"), each("estimated_tokens").alias("tokens_per_chunk"), F.count(F.lit(1)).alias("num_chunks"), F.sum("num_elements").alias("total_elements"), F.sum("estimated_tokens").alias("total_tokens"), F.max("estimated_tokens").alias("max_tokens"), (F.sum("estimated_tokens") / F.count(F.lit(1))).alias("avg_tokens"))


def validate_chunks(chunks: DataFrame, most: int = 384) -> DataFrame:
    """doc_id, valid: no chunk of a document has more than `most` tokens."""
    return chunk_info(chunks).groupBy("doc_id").agg(F.min(F.col("estimated_tokens") <= most).alias("valid"))


def reassemble_chunks(chunks: DataFrame) -> DataFrame:
    """Each element once, where it occurs first; elements without an id all stay."""
    first = Window.partitionBy("doc_id", "id").orderBy("chunk_index", "pos")
    return chunks.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1 OR id IS NULL").drop("__rank")
