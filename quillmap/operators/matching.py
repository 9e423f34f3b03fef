"""Finding field values among a document's words.

words: doc_id, word_idx, page, text, x0, y0, x1, y1, confidence. fields: doc_id,
section, item_idx, ord, field_name, value, kind. Lists are ordered by word_idx and
ties go to the first word. All joins are on the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmap.functions import geometry as g
from quillmap.functions import similarity as s
from quillmap.functions.similarity import slices
from quillmap.functions.text import extract_number, family_keywords, is_currency_symbol, keyword_family, normalize_text, normalize_text_keep_points, tokens

FIELD = ["doc_id", "section", "item_idx", "ord", "field_name", "value"]
BOX = ["x0", "y0", "x1", "y1"]
#: The longest run of words that a value of several words is compared to.
MOST_WORDS = 9


#: A block of a document holds so many words, and a block of its fields so many fields; all blocks of one meet all of the other.
BLOCK_WORDS, BLOCK_FIELDS = 1024, 512
KEY = ["section", "item_idx", "ord", "field_name"]
_HIT = "word_idx int, word_count int, page int, text string, x0 int, y0 int, x1 int, y1 int, word_confidence double, score double"


def present(value: Column) -> Column:
    return value.isNotNull() & (F.trim(value) != "")


def matchable(fields: DataFrame) -> DataFrame:
    """Fields with a value, and its normal form."""
    return fields.filter(present(F.col("value"))).withColumn("norm", normalize_text(F.col("value")))


def _first(rows: DataFrame, *order: Column) -> DataFrame:
    """One row a field: the first in the order."""
    rank = F.row_number().over(Window.partitionBy("doc_id", "section", "item_idx", "ord", "field_name").orderBy(*order))
    return rows.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def match_exact(fields: DataFrame, words: DataFrame) -> DataFrame:
    """Equal normal forms; the first word wins with score 1 and its own confidence."""
    own = matchable(fields).select(*FIELD, "norm")
    found = own.join(words.withColumn("norm", normalize_text(F.col("text"))), ["doc_id", "norm"])
    return _first(found, F.col("word_idx")).select(*FIELD, "word_idx", "page", "text", *BOX, "confidence", F.lit(1.0).alias("match_score"))


def _searcher(threshold: float, n_group: int):
    """Arrow rows of a block of fields `f` and a block of words `w` into the best run of words of each field and group."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            chars = [sum(len(x["norm"]) for x in r) for r in b.column("w").to_pylist()] if b.num_rows else []
            for lo, hi in slices(chars, 100_000):
                part = b.slice(lo, hi - lo)
                f, w = part.column("f"), part.column("w")
                row = lambda c: np.repeat(np.arange(len(c)), c.value_lengths().to_numpy(zero_copy_only=False))
                q_row, w_row, fs, ws = row(f), row(w), f.flatten(), w.flatten()
                names = [x.name for x in ws.type]
                col = lambda c: ws.field(names.index(c))
                group = np.zeros(len(ws), np.int64)
                for k in range(n_group):
                    v = pa.compute.dictionary_encode(col(f"g{k}"), null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
                    group = group * (int(v.max(initial=0)) + 1) + v
                # words by row, group and place, as a run is of words that follow each other in a group
                order = np.lexsort((col("word_idx").to_numpy(zero_copy_only=False), group, w_row))
                ws, group, w_row = ws.take(pa.array(order)), group[order], w_row[order]
                most = fs.field("most").to_numpy(zero_copy_only=False)
                q, at, n, score = s.scored_runs(fs.field("norm").to_pylist(), most, col("norm").to_pylist(), group, q_row, w_row, col("tail").to_numpy(zero_copy_only=False), threshold)
                best = np.lexsort((n, at, -score, group[at], q))
                q, at, n, score = q[best], at[best], n[best], score[best]
                first = np.ones(len(q), bool)
                first[1:] = (q[1:] != q[:-1]) | (group[at[1:]] != group[at[:-1]])
                q, at, n, score = q[first], at[first], n[first], score[first]
                spans = [range(i, i + k) for i, k in zip(at.tolist(), n.tolist(), strict=True)]
                own = {c: col(c).to_pylist() for c in ("text", *BOX, "confidence")}
                of = lambda c, how: [how([own[c][i] for i in span]) for span in spans]
                known = lambda how: lambda v: how([x for x in v if x is not None], default=None)
                take = pa.array(at)
                cols = {c: fs.field(c).take(pa.array(q)) for c in (*KEY, "value")}
                cols |= {f"g{k}": col(f"g{k}").take(take) for k in range(n_group)}
                cols |= {"word_idx": col("word_idx").take(take), "word_count": pa.array(n, pa.int32()), "page": col("page").take(take), "text": pa.array(of("text", " ".join), pa.string())}
                cols |= {c: pa.array(of(c, known(min if c in BOX[:2] else max)), pa.int32()) for c in BOX}
                cols |= {"word_confidence": pa.array(of("confidence", lambda v: None if None in v else sum(v) / len(v)), pa.float64()), "score": pa.array(score, pa.float64())}
                doc = part.column("doc_id").take(pa.array(q_row[q]))
                yield pa.RecordBatch.from_arrays([doc, *cols.values()], ["doc_id", *cols])

    return run


def best_runs(fields: DataFrame, words: DataFrame, threshold: float, groups: tuple[str, ...] = ()) -> DataFrame:
    """The most similar run of a document's words for each field, and each group of words if groups are named.

    fields: with norm and most, the longest run that the field is compared to. FIELD, the
    groups, word_idx (the first word's), word_count, page, text, box, word_confidence (mean),
    score. Ties: the first word, then the shortest run. A document's fields and words go in
    blocks of bounded size, so no document is held whole; only the hits of a block come back.
    """
    by_word = Window.partitionBy("doc_id").orderBy(*groups, "word_idx")
    at = F.row_number().over(by_word) - 1
    home = F.floor(F.col("__at") / BLOCK_WORDS).cast("int")
    # the words after a block's last belong to it too, as a run's end but not as its start
    ahead = (F.col("__at") % BLOCK_WORDS < MOST_WORDS - 1) & (home > 0)
    copies = F.filter(F.array(F.struct(home.alias("wb"), F.lit(False).alias("tail")), F.when(ahead, F.struct((home - 1).alias("wb"), F.lit(True).alias("tail")))), lambda c: c.isNotNull())
    dealt = words.withColumn("__at", at).select("*", F.inline(copies))
    word = F.struct(F.col("word_idx").cast("int").alias("word_idx"), F.col("page").cast("int").alias("page"), F.col("text"), *(F.col(c).cast("int").alias(c) for c in BOX), F.col("confidence").cast("double").alias("confidence"), normalize_text(F.col("text")).alias("norm"), "tail", *(F.col(c).alias(f"g{k}") for k, c in enumerate(groups)))
    wordy = dealt.filter(F.col("text").isNotNull()).groupBy("doc_id", "wb").agg(F.collect_list(word).alias("w"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*KEY)) - 1
    asked = fields.withColumn("fb", F.floor(place / BLOCK_FIELDS)).groupBy("doc_id", "fb").agg(F.collect_list(F.struct(*KEY, F.col("value"), "norm", F.col("most").cast("int").alias("most"))).alias("f"))
    kinds = [f"{c} {fields.schema[c].dataType.simpleString()}" for c in FIELD] + [f"g{k} {words.schema[c].dataType.simpleString()}" for k, c in enumerate(groups)]
    found = asked.join(wordy, "doc_id").select("doc_id", "f", "w").mapInArrow(_searcher(threshold, len(groups)), ", ".join([*kinds, _HIT]))
    # of several blocks the best
    keys = ["doc_id", *KEY, *(f"g{k}" for k in range(len(groups)))]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "word_idx", "word_count"))
    one = found.repartition("doc_id", "section", "item_idx").withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
    return one.withColumnsRenamed({f"g{k}": c for k, c in enumerate(groups)}) if "page" not in groups else one.drop("page").withColumnsRenamed({f"g{k}": c for k, c in enumerate(groups)})


def _sure() -> list[Column]:
    score = F.col("score")
    return [F.when(score == 100, F.col("word_confidence")).otherwise(F.col("word_confidence") * score / 100).alias("confidence"), (score / 100).alias("match_score")]


def match_fuzzy(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """The most similar single word at or above the threshold; equal normal forms score 1, ties go to the first word."""
    own = matchable(fields).withColumn("most", F.lit(1))
    return best_runs(own, words, threshold).select(*FIELD, "word_idx", "page", "text", *BOX, *_sure())


def word_ngrams(words: DataFrame, most: int = MOST_WORDS, per_page: bool = False) -> DataFrame:
    """doc_id, word_idx (the first's), n, text, box, mean confidence, page (the first's) of 1 to `most` consecutive words."""
    w = Window.partitionBy("doc_id").orderBy("word_idx").rowsBetween(0, most - 1)
    runs = words.withColumn("run", F.collect_list(F.struct("text", *BOX, "confidence")).over(w))
    runs = runs.select("doc_id", "word_idx", "page", "run", F.explode(F.sequence(F.lit(1), F.size("run"))).alias("n")).withColumn("run", F.slice("run", 1, F.col("n")))
    part = lambda c: F.transform("run", lambda e: e[c])
    mean = F.aggregate(part("confidence"), F.lit(0.0), lambda a, x: a + x) / F.col("n")
    return runs.select("doc_id", "word_idx", "page", "n", F.array_join(part("text"), " ").alias("text"), F.array_min(part("x0")).alias("x0"), F.array_min(part("y0")).alias("y0"), F.array_max(part("x1")).alias("x1"), F.array_max(part("y1")).alias("y1"), mean.alias("confidence"))


def match_multiword(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """The most similar run of up to nine words: ties to the earliest, then the shortest."""
    own = matchable(fields).withColumn("most", F.lit(MOST_WORDS))
    return best_runs(own, words, threshold).select(*FIELD, "word_idx", "page", "text", *BOX, *_sure(), "word_count")


def match_numeric(fields: DataFrame, words: DataFrame, tolerance: float = 0.01, mode: str = "decimal_aware") -> DataFrame:
    """The number with the least relative difference within the tolerance; score 1 - difference."""
    own = fields.withColumn("target", F.col("value").try_cast("double")).filter("target IS NOT NULL").select(*FIELD, "target")
    numbers = words.withColumn("number", extract_number(F.col("text"), mode)).filter("number IS NOT NULL")
    base = F.greatest(F.abs("target"), F.lit(0.01))
    pairs = own.join(numbers, "doc_id").withColumn("diff", F.abs(F.col("number") - F.col("target")) / base).filter(F.col("diff") <= tolerance)
    return _first(pairs, F.col("diff"), F.col("word_idx")).select(*FIELD, "word_idx", "page", "text", *BOX, "confidence", (1 - F.col("diff")).alias("match_score"), F.col("number").alias("numeric_value"))


def match_fields(fields: DataFrame, words: DataFrame, threshold: float = 85, tolerance: float = 0.01, mode: str = "decimal_aware") -> DataFrame:
    """Numbers by tolerance, several words as runs, others as single words; a number that is none is text.

    All text goes through one pass over the documents' words.
    """
    number = (F.col("kind") == "numeric") & F.col("value").try_cast("double").isNotNull()
    text = matchable(fields.filter(~F.coalesce(number, F.lit(False)))).withColumn("most", F.when(F.col("kind") == "multiword", MOST_WORDS).otherwise(1))
    found = best_runs(text, words, threshold).select(*FIELD, "word_idx", "page", "text", *BOX, *_sure(), "word_count")
    return found.unionByName(match_numeric(fields.filter(number), words, tolerance, mode), allowMissingColumns=True)


def match_five_strategy(fields: DataFrame, words: DataFrame) -> DataFrame:
    """The documented five strategies in order: equal, contained, ratio, partial ratio, sorted tokens; the first best word wins."""
    own = fields.filter(present(F.col("value"))).select(*FIELD).withColumn("norm", normalize_text_keep_points(F.col("value")))
    pairs = own.join(words, "doc_id").withColumn("wnorm", normalize_text_keep_points(F.col("text"))).filter((F.col("norm") != "") & (F.col("wnorm") != ""))
    q, w = F.col("norm"), F.col("wnorm")
    long_both = (F.length(q) >= 8) & (w.contains(q) | q.contains(w))
    # only what can reach a strategy's least score is compared: the others' scores would not be used
    sorted_q, sorted_w = s.token_sort(q), s.token_sort(w)
    near, long_value = s.may_reach(F.length(q), F.length(w), 70), F.length(q) > 10
    near_sorted = ((sorted_q != q) | (sorted_w != w)) & s.may_reach(F.length(sorted_q), F.length(sorted_w), 75)
    pairs = pairs.filter((q == w) | long_both | near | long_value | near_sorted)
    distinct = pairs.select("norm", "wnorm").distinct()
    scored = distinct.withColumn("ratio", s.similarity_ratio(F.when(near, q), w)).withColumn("partial", s.partial_ratio_at(75)(F.when(long_value, q), w)).withColumn("sorted", s.similarity_ratio(F.when(near_sorted, sorted_q), sorted_w))
    pick = [(q == w, F.lit(100.0), "exact"), (long_both, F.lit(95.0), "substring"), (F.col("ratio") >= 70, F.col("ratio"), "ratio"), ((F.length(q) > 10) & (F.col("partial") >= 75), F.col("partial"), "partial"), (F.col("sorted") >= 75, F.col("sorted"), "token_sort")]
    best = F.array_max(F.array(*(F.when(ok, F.struct(score.alias("score"), F.lit(-k).alias("k"), F.lit(name).alias("strategy"))) for k, (ok, score, name) in enumerate(pick))))
    scored = scored.withColumn("best", best).filter("best IS NOT NULL").select("norm", "wnorm", "best.score", "best.strategy")
    found = _first(pairs.join(scored, ["norm", "wnorm"]), F.col("score").desc(), F.col("word_idx"))
    return found.select(*FIELD, "word_idx", "page", "text", *BOX, (F.col("confidence") * F.col("score") / 100).alias("confidence"), (F.col("score") / 100).alias("match_score"), "strategy")


def item_row_hits(fields: DataFrame, row_words: DataFrame, threshold: float = 85) -> DataFrame:
    """Matches of the items' fields within each item's best row: FIELD, page, row_id, word_idx, text, box, confidence,
    match_score, and the row's fields_matched and row_score.

    row_words: words with row_id; a row is of one page. Fields of any kind are compared to
    single words as text. The best row has the most fields found, then the greatest sum of
    scores (to nine places), then comes first by page and row. Several items may take one
    row, an item without any field found takes none. Every field meets every word of its
    document once; only its best word in each row goes on.
    """
    items = matchable(fields.filter("section = 'items'")).withColumn("most", F.lit(1))
    hits = best_runs(items, row_words, threshold, ("page", "row_id")).select(*FIELD, "page", "row_id", "word_idx", "text", *BOX, *_sure())
    of_row = Window.partitionBy("doc_id", "section", "item_idx", "page", "row_id")
    hits = hits.withColumn("fields_matched", F.count(F.lit(1)).over(of_row)).withColumn("row_score", F.sum(F.round(F.col("match_score") * 1e9).cast("long")).over(of_row))
    rank = F.rank().over(Window.partitionBy("doc_id", "section", "item_idx").orderBy(F.col("fields_matched").desc(), F.col("row_score").desc(), "page", "row_id"))
    return hits.withColumn("__rank", rank).filter("__rank = 1").drop("__rank").withColumn("row_score", F.col("row_score") / 1e9)


def map_items_rows(fields: DataFrame, row_words: DataFrame, threshold: float = 85) -> DataFrame:
    """doc_id, item_idx, page, row_id, fields_matched, match_score of each item's best row, as item_row_hits() finds it."""
    return item_row_hits(fields, row_words, threshold).groupBy("doc_id", "item_idx", "page", "row_id").agg(F.max("fields_matched").alias("fields_matched"), F.max("row_score").alias("match_score"))


def map_items_rows_v2(fields: DataFrame, words: DataFrame, threshold: float = 85) -> DataFrame:
    """The same over the second detector's rows, bands of ten of each page's words without the head; item_index for item_idx."""
    from quillmap.operators.layout import banded_rows

    return map_items_rows(fields, banded_rows(words, ("doc_id", "page")), threshold).withColumnRenamed("item_idx", "item_index")


def split_pages(fields: DataFrame, words: DataFrame, threshold: float = 85, keys=("serie_completa", "emisor_ruc", "receptor_numero_doc", "importe_total")) -> DataFrame:
    """doc_id, page, hits, role: header pages have at least half the most hits of key fields, page 0 if none has any."""
    pages = words.select("doc_id", "page").distinct()
    asked = matchable(fields.filter((F.col("section") == "header") & F.col("field_name").isin(*keys))).withColumn("most", F.lit(1))
    hits = best_runs(asked, words, threshold, ("page",)).groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("hits"))
    most = F.max("hits").over(Window.partitionBy("doc_id"))
    scored = pages.join(hits, ["doc_id", "page"], "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    header = F.when(most == 0, F.col("page") == 0).otherwise(F.col("hits") >= most * 0.5)
    with_items = fields.filter("section = 'items'").select("doc_id").distinct().withColumn("some", F.lit(True))
    return scored.withColumn("header", header).join(with_items, "doc_id", "left").select("doc_id", "page", "hits", F.when(F.col("header"), "header").when(F.col("some"), "items").otherwise("none").alias("role"))


def nearby_words(boxes: DataFrame, words: DataFrame, distance: float = 30, cell: int | None = None) -> DataFrame:
    """Pairs of a box and the words of its document with centres closer than `distance`.

    boxes: doc_id, box_id and a box. Both are dealt to cells of the page, so a box only
    meets words of its own and the neighbouring cells.
    """
    side = cell or max(1, int(distance))
    cx, cy = F.floor((F.col("x0") + F.col("x1")) / 2 / side), F.floor((F.col("y0") + F.col("y1")) / 2 / side)
    own = boxes.select("doc_id", "box_id", *(F.col(c).alias(f"b_{c}") for c in BOX), F.explode(F.array(*(F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("cell")).select("*", "cell.*").drop("cell")
    dealt = words.withColumn("cx", cx).withColumn("cy", cy)
    d = g.distance([F.col(f"b_{c}") for c in BOX], [F.col(c) for c in BOX])
    return own.join(dealt, ["doc_id", "cx", "cy"]).withColumn("distance", d).filter(F.col("distance") < distance).drop("cx", "cy")


def context_boost(matches: DataFrame, words: DataFrame, proximity: float = 50, boost: float = 0.1) -> DataFrame:
    """doc_id, box_id, boost: per near word with a keyword of the field's family, more the nearer, at most 0.3."""
    asked = matches.withColumn("keywords", family_keywords(keyword_family(F.col("field_name"))))
    near = nearby_words(matches, words, proximity).select("doc_id", "box_id", "text", "distance").join(asked.select("doc_id", "box_id", "keywords"), ["doc_id", "box_id"])
    hit = F.exists("keywords", lambda k: F.contains(F.lower(F.col("text")), k))
    sums = near.filter(hit).groupBy("doc_id", "box_id").agg(F.sum(boost * (1 - F.col("distance") / proximity)).alias("boost"))
    return asked.select("doc_id", "box_id").join(sums, ["doc_id", "box_id"], "left").select("doc_id", "box_id", F.least(F.lit(0.3), F.coalesce("boost", F.lit(0.0))).alias("boost"))


def expand_multiword_bbox(matches: DataFrame, words: DataFrame) -> DataFrame:
    """The box around all words of the document that equal a token of the match's text; single words keep theirs."""
    multi = matches.withColumn("__t", tokens(F.col("text")))
    hits = multi.filter(F.size("__t") > 1).select("doc_id", "box_id", F.explode(F.array_distinct("__t")).alias("text")).join(words.select("doc_id", "text", *BOX), ["doc_id", "text"])
    around = hits.groupBy("doc_id", "box_id").agg(F.min("x0").alias("e0"), F.min("y0").alias("e1"), F.max("x1").alias("e2"), F.max("y1").alias("e3"))
    grown = matches.join(around, ["doc_id", "box_id"], "left")
    return grown.select(*[c for c in matches.columns if c not in BOX], *(F.coalesce(f"e{i}", c).alias(c) for i, c in enumerate(BOX)))


def expand_currency(matches: DataFrame, words: DataFrame, distance: float = 30) -> DataFrame:
    """Boxes of amounts grow left over near currency signs, one after the other in word order."""
    asked = F.lower("field_name").rlike("precio|monto|total|subtotal|igv")
    near = nearby_words(matches.filter(asked), words.filter(is_currency_symbol(F.col("text"))), distance)
    signs = near.groupBy("doc_id", "box_id").agg(F.array_sort(F.collect_list(F.struct("word_idx", "x0", "x1"))).alias("signs"))
    left = F.aggregate("signs", F.col("x0"), lambda x, e: F.when(e["x1"] <= x, F.least(x, e["x0"])).otherwise(x))
    return matches.join(signs, ["doc_id", "box_id"], "left").withColumn("x0", F.coalesce(left, "x0")).drop("signs")


def cluster_fields(matches: DataFrame, gap: float = 20) -> DataFrame:
    """doc_id, box_id, cluster: fields in vertical order, a new cluster where centres are `gap` or more apart."""
    y = (F.col("y0") + F.col("y1")) / 2
    order = Window.partitionBy("doc_id").orderBy("y", "box_id")
    own = matches.withColumn("y", y)
    start = F.when(F.col("y") - F.lag("y").over(order) >= gap, 1).otherwise(0)
    return own.withColumn("start", start).withColumn("cluster", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).select("doc_id", "box_id", "field_name", "cluster")
