"""Mixing sources to target weights, in DataFrame functions only.

Tokens are aggregated per source, the target shares give every source a repetition
rate, and each document is emitted floor(rate) times plus one hash-seeded Bernoulli
copy with probability equal to the fraction. A document's draw depends on the seed and
its id alone, so it stays when other documents come or go, and it costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmap.llm.common import n_words, written

#: Most sources whose rates are broadcast; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def _hash(*parts: Column) -> Column:
    """48 bits of MD5 over the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, cycle=(1, 2, 3), most: int = 3) -> DataFrame:
    """Per source: source, n, source_size, target.

    sizes: source, size. Sources in code-point order, null last, weigh as `cycle`
    repeats; all sizes are shared by weight, and no target exceeds `most` times its
    source's size: the excess goes to the others by weight. The bounded shares are
    min(most * size, w * level); sorted by size / w, the first source that its level
    does not fill fixes the level. One row per source, so one small window.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, cycle)), (rank - 1) % len(cycle) + 1).cast("long")).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(everything))
    per = per.withColumn("before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    per = per.withColumn("after", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))).withColumn("at", F.row_number().over(order))
    open_ = (F.col("total") - F.col("before")) * F.col("w") <= F.col("cap") * F.col("after")
    per = per.withColumn("first", F.min(F.when(open_, F.struct("at", "before", "after"))).over(everything))
    level = (F.col("w") * (F.col("total") - F.col("first.before"))).cast("double") / F.col("first.after").cast("double")
    return per.select("source", "n", "source_size", F.when(F.col("at") < F.col("first.at"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def _draw(docs: DataFrame, seed: str, id_col: str, text_col: str) -> Column:
    """A uniform number of the seed and the id; a row without an id draws by its text."""
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    return _hash(F.lit(seed), own) / F.lit(float(2**48))


def _copies() -> Column:
    """floor(rate), and one more where the draw is below the fraction."""
    size, target = F.col("__t_source_size"), F.col("__t_target")
    rate = F.when(size > 0, target / size.cast("double")).otherwise(F.lit(0.0))
    return (F.floor(rate) + F.when(F.col("__draw") < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _with_targets(rows: DataFrame, targets: DataFrame, source_col: str) -> DataFrame:
    own = targets.withColumnsRenamed({c: f"__t_{c}" for c in targets.columns})
    side = F.broadcast(own) if targets.count() <= BROADCAST_SOURCES else own
    return rows.join(side, F.col(source_col).eqNullSafe(F.col("__t_source")))


def mix_plan(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target (its source's), taken.

    A null text has size 0, a null source is a source of its own and comes last. Rows
    with one id draw alike, so repeated rows are all taken as often as the first; rows
    without an id draw by their text. Empty tables give no rows. Sources without words
    have target 0 and give no copies. Other columns are ignored. Each text is read once.
    """
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), _draw(docs, seed, id_col, text_col).alias("__draw")), "sizes")
    got = _with_targets(sized, written(source_targets(sized), "targets"), "source")
    return got.select("doc_id", "size", F.col("__t_source_size").alias("source_size"), F.col("__t_target").alias("target"), (F.col("size") * _copies()).alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix, with docs' columns: as many rows of each as it has copies, by mix_plan()'s rules."""
    targets = written(source_targets(docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))), "targets")
    got = _with_targets(docs.withColumn("__draw", _draw(docs, seed, id_col, text_col)), targets, source_col)
    return got.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), _copies())).alias("__copy")).drop("__copy")


SQL = r"""
WITH s AS (SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w FROM s GROUP BY source),
q AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
  CAST(sum(3 * source_size) OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - 3 * source_size AS before,
  CAST(sum(w) OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS after,
  row_number() OVER (ORDER BY source_size / CAST(w AS DOUBLE), source NULLS LAST) AS pos FROM p),
f AS (SELECT pos AS fat, before AS fbefore, after AS fafter FROM q WHERE (total - before) * w <= 3 * source_size * after ORDER BY pos LIMIT 1),
t AS (SELECT source, n, source_size, CASE WHEN pos < fat THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(w * (total - fbefore) AS DOUBLE) / CAST(fafter AS DOUBLE) END AS target FROM q, f),
u AS (SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))), 1, 12) AS BIGINT) / CAST(281474976710656 AS DOUBLE) AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM u
"""
