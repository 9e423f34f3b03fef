"""Queries of geometry, elements, chunks, validation, reports and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmap.fixtures import elements, fields_inv, table, words_doc, words_inv
from quillmap.functions import geometry as g
from quillmap.functions import text as t
from quillmap.operators import elements as e
from quillmap.operators import quality as q
from quillmap.plans.registry import query
from quillmap.plans.sql import SMALL, TOKENS, VALID, expanded
from quillmap.sources import tables as s

BOX = ["x0", "y0", "x1", "y1"]


def _c():
    return [F.col(c) for c in BOX]


@query("SELECT doc_id, word_idx, CAST(least(1000, greatest(0, trunc(x0/612.0*1000))) AS INT) AS x0, CAST(least(1000, greatest(0, trunc(y0/792.0*1000))) AS INT) AS y0 FROM wd", "wd")
def normalize_bbox(spark, d):
    return words_doc(spark, d).select("doc_id", "word_idx", g.scale(F.col("x0"), F.lit(612.0)).alias("x0"), g.scale(F.col("y0"), F.lit(792.0)).alias("y0"))


@query("SELECT doc_id, word_idx, x0 AS a, y0-1 AS b, x1+2 AS c, y1 AS d FROM wd", "wd")
def polygon_to_rect(spark, d):
    p = F.expr("array(array(x0, y0), array(x1, y0-1), array(x1+2, y1), array(x0+1, y1))")
    return words_doc(spark, d).select("doc_id", "word_idx", *(c.alias(n) for n, c in zip("abcd", g.polygon_to_rect(p), strict=True)))


@query("SELECT doc_id, word_idx, [x0, y0, x1, y1] AS box FROM wd", "wd")
def xywh_to_xyxy(spark, d):
    return words_doc(spark, d).select("doc_id", "word_idx", g.xywh_to_xyxy(F.expr("array(x0, y0, x1-x0, y1-y0)")).alias("box"))


@query(f"SELECT doc_id, word_idx, {expanded()} FROM wd", "wd")
def expand_bbox(spark, d):
    return words_doc(spark, d).select("doc_id", "word_idx", *(c.alias(f"e{i}") for i, c in enumerate(g.expand(F.col("text"), *_c()))))


_FIX = f"""fx AS (SELECT * EXCLUDE (e0,e1,e2,e3,x0,y0,x1,y1), CASE WHEN sm THEN e0 ELSE x0 END f0, CASE WHEN sm THEN e1 ELSE y0 END f1, CASE WHEN sm THEN e2 WHEN x1-x0<5 THEN least(1000,x0+5) ELSE x1 END f2, CASE WHEN sm THEN e3 WHEN y1-y0<5 THEN least(1000,y0+5) ELSE y1 END f3
 FROM (SELECT *, {SMALL} sm, {expanded()} FROM src))"""


@query(f"WITH src AS (SELECT doc_id, word_idx, text, x0, y0, x0+(x1-x0)//4 AS x1, y0+3 AS y1 FROM wd), {_FIX} SELECT doc_id, word_idx, f0, f1, f2, f3 FROM fx", "wd")
def fix_bbox(spark, d):
    thin = words_doc(spark, d).selectExpr("doc_id", "word_idx", "text", "x0", "y0", "CAST(x0+(x1-x0) div 4 AS INT) x1", "y0+3 y1")
    return thin.select("doc_id", "word_idx", *(c.alias(f"f{i}") for i, c in enumerate(g.fix(F.col("text"), *_c()))))


@query(f"SELECT doc_id, word_idx, {VALID} AS valid FROM wd", "wd")
def bbox_valid(spark, d):
    return words_doc(spark, d).select("doc_id", "word_idx", g.is_valid(*_c()).alias("valid"))


@query(f"SELECT doc_id, word_idx, {SMALL} AS small FROM wi", "wi")
def bbox_small(spark, d):
    return words_inv(spark, d).select("doc_id", "word_idx", g.is_small(F.col("text"), *_c()).alias("small"))


@query("SELECT doc_id, word_idx, text FROM wd WHERE confidence >= 0.6", "wd")
def filter_confidence(spark, d):
    return e.confident(words_doc(spark, d), 0.6).select("doc_id", "word_idx", "text")


@query(rf"SELECT doc_id, ord, item_idx, len(list_filter(regexp_split_to_array(coalesce(value,''), '\s+'), lambda x: x<>''))*2+4 AS tokens FROM fi", "fi")
def estimate_tokens(spark, d):
    return fields_inv(spark, d).select("doc_id", "ord", "item_idx", e.estimate_tokens(F.coalesce("value", F.lit(""))).alias("tokens"))


@query("SELECT doc_id, x0, y0, x1, y1, count(*) AS n FROM el GROUP BY ALL HAVING count(*) > 1", "el")
def duplicate_boxes(spark, d):
    return e.duplicate_boxes(elements(spark, d))


_BEST = "kb AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, x0, y0, x1, y1 ORDER BY confidence DESC, id) rk FROM el) WHERE rk=1)"


@query(f"WITH {_BEST} SELECT * FROM kb", "el")
def dedup_keep_best(spark, d):
    return e.dedup_keep_best(elements(spark, d))


@query("SELECT * EXCLUDE (rk) REPLACE (least(1000, x0+2*rk)::INT AS x0, least(1000, x1+2*rk)::INT AS x1) FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, x0, y0, x1, y1 ORDER BY id)-1 rk FROM el)", "el")
def dedup_expand(spark, d):
    return e.dedup_expand(elements(spark, d))


@query("SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, page, x0, y0, x1, y1) n FROM el) WHERE n=1", "el")
def dedup_remove_all(spark, d):
    return e.dedup_remove_all(elements(spark, d))


@query(f"WITH {_BEST} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY id)-1 AS INT) AS id, text FROM kb", "el")
def assign_ids(spark, d):
    return e.assign_ids(e.dedup_keep_best(elements(spark, d)), "id").select("doc_id", "id", "text")


@query("SELECT doc_id, id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, x0, id)-1 AS INT) AS position FROM el", "el")
def reading_order(spark, d):
    return e.reading_order(elements(spark, d)).select("doc_id", "id", "position")


_FIELD = "doc_id, section, item_idx, ord"


def _split_sql(width: str, gap: str) -> str:
    return rf"""SELECT {_FIELD}, CAST(i-1 AS INT) AS i, ws[i] AS word, CASE WHEN len(ws)=1 THEN 100 ELSE CAST(100+coalesce(list_sum(list_transform(ws[1:i-1], lambda v: {width.format('v')}+{gap})),0) AS INT) END AS x0,
 CASE WHEN len(ws)=1 THEN 400 ELSE CAST(least(100+coalesce(list_sum(list_transform(ws[1:i-1], lambda v: {width.format('v')}+{gap})),0)+{width.format('ws[i]')}, 400) AS INT) END AS x1
 FROM (SELECT *, unnest(range(1, len(ws)+1)) i FROM (SELECT {_FIELD}, {TOKENS} ws, text FROM (SELECT {_FIELD}, value AS text FROM fi WHERE value <> '')))"""


def _valued(spark, d):
    return fields_inv(spark, d).filter("value <> ''")


def _split(spark, d, *least):
    words = g.split_words(F.col("value"), F.lit(100), F.lit(50), F.lit(400), F.lit(70), *least)
    keys = _FIELD.split(", ")
    return _valued(spark, d).select(*keys, F.posexplode(words).alias("i", "w")).select(*keys, "i", F.col("w.text").alias("word"), F.element_at("w.box", 1).alias("x0"), F.element_at("w.box", 3).alias("x1"))


_WIDTH, _WIDTH_V2 = "CAST(trunc(CAST(length({0}) AS DOUBLE)/length(text)*300) AS INT)", "greatest(CAST(trunc(CAST(length({0}) AS DOUBLE)/length(text)*300) AS INT), 5)"


# header and item values alike
@query(_split_sql(_WIDTH, "6"), "fi")
def split_words(spark, d):
    return _split(spark, d)


@query(_split_sql(_WIDTH_V2, "6"), "fi")
def split_words_v2(spark, d):
    return _split(spark, d, 5, 2)


@query("SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY id)-1 AS INT) AS id, text, [x0,y0,x1,y1] AS box, 'answer' AS label, [text] AS words FROM el", "el")
def format_v1(spark, d):
    return e.format_v1(elements(spark, d), "id").select("doc_id", "id", "text", F.array(*BOX).alias("box"), "label", F.transform("words", lambda w: w["text"]).alias("words"))


_V2 = f"""src AS (SELECT * FROM el WHERE confidence >= 0.8 AND {VALID}), ex2 AS (SELECT * EXCLUDE (x0,y0,x1,y1,e0,e1,e2,e3,sm), CASE WHEN sm THEN e0 ELSE x0 END x0, CASE WHEN sm THEN e1 ELSE y0 END y0, CASE WHEN sm THEN e2 ELSE x1 END x1, CASE WHEN sm THEN e3 ELSE y1 END y1 FROM (SELECT *, {SMALL} sm, {expanded()} FROM src)),
{_FIX.replace('FROM src)', 'FROM ex2)')}"""


@query(f"WITH {_V2} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY id)-1 AS INT) AS id, text, [f0,f1,f2,f3] AS box FROM fx", "el")
def format_v2(spark, d):
    return e.format_v2(elements(spark, d), "id", min_confidence=0.8).select("doc_id", "id", "text", F.array(*BOX).alias("box"))


@query(f"SELECT doc_id, count(*) AS total_fields, count(*) FILTER (confidence < 0.8) AS filtered_low_confidence, count(*) FILTER (confidence >= 0.8 AND NOT {VALID}) AS filtered_invalid_bbox, count(*) FILTER (confidence >= 0.8 AND {VALID} AND {SMALL}) AS expanded_bboxes, count(*) FILTER (confidence >= 0.8 AND {VALID}) AS emitted FROM el GROUP BY doc_id", "el")
def format_counters(spark, d):
    return e.format_counters(elements(spark, d), 0.8)


@query(f"WITH {_BEST} SELECT doc_id, id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, x0, id)-1 AS INT) AS position FROM kb", "el")
def create_document_v2(spark, d):
    own = elements(spark, d).withColumn("words", g.split_words(F.col("text"), *_c(), 5, 2))
    return e.create_document(own, "keep_best", True).select("doc_id", "id", "position")


# each token a word, some values with one word left out, some words twice to three times too wide
@query(rf"""SELECT {_FIELD}, CASE WHEN doc_id % 5 = 0 AND len(ws) > 1 THEN len(ws) - 1 ELSE len(ws) END = len(ws) AND list_sum(list_transform(ws[1:CASE WHEN doc_id % 5 = 0 AND len(ws) > 1 THEN len(ws) - 1 ELSE len(ws) END], lambda w: length(w)*(4 + 2*(ord % 5)))) <= length(text)*8*1.5 AS consistent
 FROM (SELECT {_FIELD}, {TOKENS} ws, text FROM (SELECT {_FIELD}, value AS text FROM fi WHERE value <> ''))""", "fi")
def words_consistent(spark, d):
    v = _valued(spark, d).withColumn("ws", t.tokens(F.col("value")))
    kept = F.when((F.col("doc_id") % 5 == 0) & (F.size("ws") > 1), F.slice("ws", F.lit(1), F.size("ws") - 1)).otherwise(F.col("ws"))
    words = F.transform(kept, lambda w: F.struct(w.alias("text"), F.array(F.lit(0), F.lit(0), F.length(w) * (4 + 2 * (F.col("ord") % 5)), F.lit(10)).alias("box")))
    return v.select(*_FIELD.split(", "), g.words_consistent(F.col("value"), words, F.lit(0), F.length("value") * 8).alias("consistent"))


@query(f"""SELECT doc_id, total_elements, valid_bboxes, invalid_bboxes, small_bboxes, zero_confidence, inconsistent_words, duplicate_groups, total_duplicates, (total_elements-invalid_bboxes-zero_confidence)/CAST(total_elements AS DOUBLE) AS quality_score
FROM (SELECT doc_id, count(*) total_elements, count(*) FILTER ({VALID}) valid_bboxes, count(*) FILTER (NOT {VALID}) invalid_bboxes, count(*) FILTER ({SMALL}) small_bboxes, count(*) FILTER (confidence < 0.01) zero_confidence, CAST(0 AS BIGINT) inconsistent_words FROM el GROUP BY 1)
JOIN (SELECT doc_id, count(*) FILTER (n>1) duplicate_groups, CAST(sum(n-1) AS BIGINT) total_duplicates FROM (SELECT doc_id, count(*) n FROM el GROUP BY doc_id, x0, y0, x1, y1) GROUP BY 1) USING (doc_id)""", "el")
def quality_metrics(spark, d):
    return q.quality_metrics(elements(spark, d))


@query("SELECT doc_id, count(*) AS num_elements, count(*) AS num_words, CAST(sum(CAST(round(confidence*1000) AS BIGINT)) AS BIGINT)/CAST(count(*) AS DOUBLE)/1000 AS avg_confidence, list_sort(list(DISTINCT page)) AS pages FROM el GROUP BY doc_id", "el")
def document_stats(spark, d):
    return e.document_stats(elements(spark, d))


_CHUNKS = """es AS (SELECT doc_id, list(word_idx ORDER BY word_idx) ids, CAST(count(*)*6 AS INT) total FROM wd GROUP BY doc_id),
ck AS (SELECT doc_id, ids, total, CASE WHEN total <= 384 THEN [{'b': 0, 'f': len(ids)::INT}] ELSE list_transform(range(CAST(CASE WHEN len(ids) <= 64 THEN 1 ELSE 1+ceil((len(ids)-64)/43.0) END AS INT)), lambda k: {'b': CAST(43*k AS INT), 'f': CAST(least(len(ids), 64+43*k) AS INT)}) END cs FROM es),
ch AS (SELECT doc_id, CAST(k-1 AS INT) chunk_index, cs[k].b b, cs[k].f f, ids FROM (SELECT *, unnest(range(1, len(cs)+1)) k FROM ck)),
ce AS (SELECT doc_id, chunk_index, CAST(p AS INT) pos, ids[b+p+1] id, 6 tokens FROM (SELECT *, unnest(range(f-b)) p FROM ch))"""


def _chunks(spark, d):
    return e.chunk_elements(words_doc(spark, d).select("doc_id", F.col("word_idx").alias("position"), F.col("word_idx").alias("id"), "text"))


# every word is an element of six tokens: 64 fill a chunk, 21 overlap
@query(f"WITH {_CHUNKS} SELECT doc_id, chunk_index, pos, id, tokens FROM ce", "wd")
def chunk_elements(spark, d):
    return _chunks(spark, d)


@query(f"WITH {_CHUNKS} SELECT doc_id, chunk_index, count(*) AS num_elements, CAST(sum(tokens) AS BIGINT) AS estimated_tokens, max(tc) AS total_chunks FROM ce JOIN (SELECT doc_id, count(*) tc FROM ch GROUP BY 1) USING (doc_id) GROUP BY ALL", "wd")
def chunk_info(spark, d):
    return e.chunk_info(_chunks(spark, d))


@query(f"WITH {_CHUNKS}, ci AS (SELECT doc_id, chunk_index, count(*) n, CAST(sum(tokens) AS BIGINT) t FROM ce GROUP BY ALL) SELECT doc_id, list(n ORDER BY chunk_index) AS elements_per_chunk, list(t ORDER BY chunk_index) AS tokens_per_chunk, count(*) AS num_chunks, CAST(sum(n) AS BIGINT) AS total_elements, CAST(sum(t) AS BIGINT) AS total_tokens, max(t) AS max_tokens, CAST(sum(t) AS DOUBLE)/count(*) AS avg_tokens FROM ci GROUP BY 1", "wd")
def chunk_stats(spark, d):
    return e.chunk_stats(_chunks(spark, d))


@query(f"WITH {_CHUNKS} SELECT doc_id, min(t <= 384) AS valid FROM (SELECT doc_id, chunk_index, sum(tokens) t FROM ce GROUP BY ALL) GROUP BY 1", "wd")
def validate_chunks(spark, d):
    return e.validate_chunks(_chunks(spark, d))


@query("SELECT doc_id, word_idx AS id FROM wd", "wd")
def reassemble_chunks(spark, d):
    return e.reassemble_chunks(_chunks(spark, d)).select("doc_id", "id")


def _broken(spark, d):
    """Elements some of which break rules: every tenth turned, every eleventh outside, every thirteenth too sure."""
    word = "named_struct('text', CASE WHEN id % 23 = 0 THEN NULL ELSE text END, 'box', CASE WHEN id % 29 = 0 THEN array(x0, y0, x1) WHEN id % 31 = 0 THEN NULL ELSE array(x0, y0, x1, y1) END)"
    return elements(spark, d).selectExpr("doc_id", "id", "page", "nullif(text, '1') text", "x0", "y0", "CASE WHEN id % 10 = 0 THEN x0 ELSE x1 END x1", "CASE WHEN id % 11 = 0 THEN 1001 ELSE y1 END y1", "CASE WHEN id % 13 = 0 THEN 1.5D ELSE confidence END confidence", "field_name", "CASE WHEN id % 17 = 0 THEN NULL ELSE 'answer' END label", f"CASE WHEN id % 19 = 0 THEN NULL ELSE array({word}) END words")


_BR = "br AS (SELECT doc_id, id, page, nullif(text, '1') AS text, text AS word, x0, y0, CASE WHEN id%10=0 THEN x0 ELSE x1 END x1, CASE WHEN id%11=0 THEN 1001 ELSE y1 END y1, CASE WHEN id%13=0 THEN 1.5 ELSE confidence END confidence, field_name FROM el)"
_VE = f"""{_BR}, ve AS (SELECT doc_id, id, unnest(list_filter([CASE WHEN text IS NULL THEN 'error:missing_text' END, CASE WHEN least(x0,y0,x1,y1)<0 OR greatest(x0,y0,x1,y1)>1000 THEN 'error:out_of_range' END, CASE WHEN x1<=x0 THEN 'error:x_order' END, CASE WHEN y1<=y0 THEN 'error:y_order' END, CASE WHEN confidence<0 OR confidence>1 THEN 'warning:confidence_range' END, CASE WHEN id%17=0 THEN 'error:missing_label' END, CASE WHEN id%19=0 THEN 'error:missing_words' END,
  CASE WHEN id%19<>0 AND (id%23=0 OR word IS NULL) THEN 'warning:word_text' END, CASE WHEN id%19<>0 AND id%29=0 THEN 'error:word_box_size' END, CASE WHEN id%19<>0 AND id%29<>0 AND id%31=0 THEN 'warning:word_box' END], lambda x: x IS NOT NULL)) r FROM br)"""


@query(f"WITH {_VE} SELECT doc_id, id, split_part(r, ':', 1) AS severity, split_part(r, ':', 2) AS rule FROM ve", "el")
def validate_elements(spark, d):
    return q.validate_elements(_broken(spark, d))


@query(f"""WITH {_VE}, ds AS (SELECT doc_id, count(*) n, count(text) nw FROM br GROUP BY 1), dv AS (SELECT ds.*, NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT doc_id FROM ve WHERE r LIKE 'error%') b WHERE b.doc_id=ds.doc_id) ok FROM ds)
SELECT count(*) AS total_documents, count(*) FILTER (ok) AS valid_documents, count(*) FILTER (NOT ok) AS invalid_documents, count(*) FILTER (ok)/CAST(count(*) AS DOUBLE) AS success_rate, CASE WHEN count(*) FILTER (ok)>0 THEN CAST(sum(n) FILTER (ok) AS DOUBLE)/count(*) FILTER (ok) ELSE 0.0 END AS avg_elements, CASE WHEN count(*) FILTER (ok)>0 THEN CAST(sum(nw) FILTER (ok) AS DOUBLE)/count(*) FILTER (ok) ELSE 0.0 END AS avg_words FROM dv""", "el")
def validation_summary(spark, d):
    return q.validation_summary(_broken(spark, d))


_AN = """{0}a AS (SELECT doc_id, CAST(sum(n) AS BIGINT) te, CAST(sum(n) FILTER (x0=0 AND y0=0 AND x1=0 AND y1=0) AS BIGINT) z, CAST(sum(lc) AS BIGINT) lc, CAST(sum(n-1) AS BIGINT) dc FROM (SELECT doc_id, x0, y0, x1, y1, count(*) n, count(*) FILTER (confidence < 0.5) lc FROM {0} GROUP BY ALL) GROUP BY doc_id)"""
_CMP = f"""{_BEST}, {_AN.format('el')}, {_AN.format('kb')}, cp AS (SELECT doc_id, a.te original_elements, b.te improved_elements, coalesce(a.z,0) zero_original, coalesce(b.z,0) zero_improved, a.dc dup_original, b.dc dup_improved, b.te-a.te elements_change, coalesce(a.z,0)-coalesce(b.z,0) zero_coords_removed, a.dc-b.dc duplicates_resolved, a.lc-b.lc low_confidence_filtered FROM ela a JOIN kba b USING (doc_id))"""


@query(f"WITH {_CMP} SELECT * FROM cp", "el")
def compare_runs(spark, d):
    before = elements(spark, d)
    return q.compare_runs(before, e.dedup_keep_best(before))


@query(f"""WITH {_CMP} SELECT count(*) AS documents_analyzed, CAST(sum(original_elements) AS BIGINT) AS original_elements, CAST(sum(improved_elements) AS BIGINT) AS improved_elements, CAST(sum(-elements_change) AS BIGINT) AS elements_removed, CAST(sum(zero_coords_removed) AS BIGINT) AS zero_coords_removed, CAST(sum(duplicates_resolved) AS BIGINT) AS duplicates_resolved, CAST(sum(low_confidence_filtered) AS BIGINT) AS low_confidence_filtered,
 CAST(sum(dup_original) AS DOUBLE)/count(*) AS duplicates_original, CAST(sum(dup_improved) AS DOUBLE)/count(*) AS duplicates_improved, CAST(0.0 AS DOUBLE) AS zero_coords_reduction, (1-CAST(sum(dup_improved) AS DOUBLE)/CAST(sum(dup_original) AS DOUBLE))*100 AS duplicates_reduction FROM cp""", "el")
def improvement_report(spark, d):
    return q.improvement_report(compare_runs(spark, d))


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def value_counts(spark, d):
    return q.value_counts(table(spark, d, "documents"), "lang")


@query("SELECT count(*) AS n, round(avg(confidence), 9) AS mean, min(confidence) AS min, max(confidence) AS max, round(stddev_samp(confidence), 9) AS stdev FROM wd", "wd")
def confidence_summary(spark, d):
    return q.confidence_summary(words_doc(spark, d)).withColumn("mean", F.round("mean", 9)).withColumn("stdev", F.round("stdev", 9))


_V2C = f"vc AS (SELECT doc_id, count(*) total_fields, count(*) FILTER (confidence < 0.8) low, count(*) FILTER (confidence >= 0.8 AND NOT {VALID}) bad, count(*) FILTER (confidence >= 0.8 AND {VALID} AND {SMALL}) small, count(*) FILTER (confidence >= 0.8 AND {VALID}) emitted FROM el GROUP BY 1)"


@query("SELECT CAST(sum(n_chars) AS DOUBLE)/count(n_chars) AS n_chars, avg(CAST(doc_id AS DOUBLE)) AS doc_id FROM documents")
def column_means(spark, d):
    return q.column_means(table(spark, d, "documents"), "n_chars", "doc_id")


@query("SELECT round(avg(confidence), 9) AS before_mean, round(avg(least(1.0, confidence+0.15)), 9) AS after_mean, round((avg(least(1.0, confidence+0.15))-avg(confidence))/avg(confidence)*100, 6) AS improvement FROM wi", "wi")
def confidence_compare(spark, d):
    w = words_inv(spark, d)
    both = q.confidence_compare(w, w.withColumn("confidence", F.least(F.lit(1.0), F.col("confidence") + 0.15)))
    return both.select(F.round("before_mean", 9).alias("before_mean"), F.round("after_mean", 9).alias("after_mean"), F.round("improvement", 6).alias("improvement"))


def _batches(spark, d):
    """Orders as runs of batches of 1, 4, 8 and 16 documents."""
    o = table(spark, d, "orders")
    size = F.element_at(F.array(*map(F.lit, (1, 4, 8, 16))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select(size.alias("batch_size"), size.alias("documents"), (size * 0.125 + F.col("o_custkey") % 2).alias("seconds"))


_BATCHES = """bt AS (SELECT [1,4,8,16][o_orderkey % 4 + 1] AS batch_size, o_custkey % 2 AS late FROM orders), th AS (SELECT batch_size, CAST(sum(batch_size) AS BIGINT) AS documents, sum(batch_size*CAST(0.125 AS DOUBLE)+late) AS seconds FROM bt GROUP BY 1),
td AS (SELECT *, seconds/documents AS seconds_per_document, documents/seconds AS documents_per_second FROM th)"""


@query(f"WITH {_BATCHES} SELECT *, documents_per_second/(SELECT documents_per_second FROM td WHERE batch_size=1) AS speedup FROM td")
def throughput(spark, d):
    return q.throughput(_batches(spark, d))


@query(f"WITH {_BATCHES} SELECT batch_size, documents_per_second FROM td ORDER BY documents_per_second DESC, batch_size LIMIT 1")
def best_batch_size(spark, d):
    return q.best_batch_size(_batches(spark, d))


@query("SELECT o_orderkey AS doc_id, o_orderstatus AS batch, CAST(row_number() OVER k AS INT) AS n, CAST(row_number() OVER k AS DOUBLE)/count(*) OVER (PARTITION BY o_orderstatus) AS share FROM orders WINDOW k AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)")
def running_progress(spark, d):
    done = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("batch"), F.col("o_orderdate").cast("timestamp").alias("finished"))
    return q.running_progress(done).select("doc_id", "batch", "n", "share")


@query(f"WITH {_V2C} SELECT count(*) AS total_documents, sum(total_fields)::BIGINT AS total_fields_attempted, sum(emitted)::BIGINT AS total_fields_extracted, sum(low)::BIGINT AS filtered_by_confidence, sum(bad)::BIGINT AS filtered_by_bbox, sum(low+bad)::BIGINT AS total_fields_filtered FROM vc", "el")
def verification_counters(spark, d):
    none = spark.createDataFrame([], "item_fields_total long, item_fields_found long, fields_found long, fields_total long")
    return q.verification_counters(e.format_counters(elements(spark, d), 0.8), none).drop("total_items_attempted", "total_items_extracted", "documents_with_missing_fields")


@query(f"WITH {_V2C} SELECT sum(low)::BIGINT AS filtered_low_confidence, sum(bad)::BIGINT AS filtered_invalid_bbox, sum(small)::BIGINT AS expanded_bboxes FROM vc", "el")
def improvements_total(spark, d):
    each = e.format_counters(elements(spark, d), 0.8).withColumn("resolved_duplicates", F.lit(0)).withColumn("removed_metadata_fields", F.lit(0))
    return q.improvements_total(each).select("filtered_low_confidence", "filtered_invalid_bbox", "expanded_bboxes")


@query("SELECT doc_id, word_idx AS box_id, least(1.0, confidence+0.15) - confidence AS confidence_change, (least(1.0, confidence+0.15) - confidence)/confidence*100 AS confidence_percent, (x1-x0+4)*(y1-y0)-(x1-x0)*(y1-y0) AS area_change, CASE WHEN (x1-x0)*(y1-y0) > 0 THEN CAST((x1-x0+4)*(y1-y0)-(x1-x0)*(y1-y0) AS DOUBLE)/((x1-x0)*(y1-y0))*100 ELSE 0.0 END AS area_percent FROM wi".replace("1.0, confidence+0.15", "CAST(1.0 AS DOUBLE), confidence+CAST(0.15 AS DOUBLE)"), "wi")
def enhancement_stats(spark, d):
    w = words_inv(spark, d).withColumn("box_id", F.col("word_idx")).withColumn("n_confidence", F.least(F.lit(1.0), F.col("confidence") + 0.15))
    return q.enhancement_stats(w.select("*", F.col("x0").alias("n_x0"), F.col("y0").alias("n_y0"), (F.col("x1") + 4).alias("n_x1"), F.col("y1").alias("n_y1")))


@query("SELECT doc_id, arg_max(angle, c*1000-angle) AS angle FROM (SELECT doc_id, CAST(a AS INT) AS angle, (doc_id*7+a) % 11 c FROM documents, (SELECT unnest([0,90,180,270]) a)) GROUP BY doc_id")
def best_orientation(spark, d):
    scores = table(spark, d, "documents").select("doc_id", F.explode(F.array(*map(F.lit, (0, 90, 180, 270)))).alias("angle")).withColumn("confidence", (F.col("doc_id") * 7 + F.col("angle")) % 11)
    return q.best_orientation(scores)


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE doc_id % 90 + CAST(0.25 AS DOUBLE) END AS confidence FROM documents")
def osd_confidence(spark, d):
    report = F.when(F.col("doc_id") % 3 == 0, F.lit("Rotate: 90\nScript: Latin")).otherwise(F.concat(F.lit("Rotate: 90\nOrientation confidence: "), (F.col("doc_id") % 90).cast("string"), F.lit(".25")))
    return table(spark, d, "documents").select("doc_id", t.osd_confidence(report).alias("confidence"))


@query("SELECT o_orderkey AS doc_id, coalesce(median(a) FILTER (abs(a) < 10), 0.0) AS angle FROM (SELECT o_orderkey, CAST(l_linenumber*3-8 AS DOUBLE) a FROM orders JOIN lineitem ON l_orderkey=o_orderkey) GROUP BY 1")
def skew_angle(spark, d):
    lines = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("doc_id"), (F.col("l_linenumber") * 3 - 8).cast("double").alias("angle"))
    return q.skew_angle(lines)


@query("SELECT doc_id, n_chars/CAST(20 AS DOUBLE) < 100 AS low FROM documents")
def low_quality(spark, d):
    return table(spark, d, "documents").select("doc_id", q.low_quality(F.col("n_chars") / F.lit(20.0)).alias("low"))


@query("SELECT printf('/in/%08d.pdf', o_orderkey) AS path FROM orders ORDER BY path LIMIT 500 OFFSET 100")
def scan_slice(spark, d):
    return s.scan_slice(table(spark, d, "orders").select(F.format_string("/in/%08d.pdf", "o_orderkey").alias("path")), 100, 600)


@query("SELECT doc_id, page, count(*) AS word_count, count(*) > 10 AS native FROM wd GROUP BY ALL", "wd")
def native_page_flag(spark, d):
    return s.native_page_flag(words_doc(spark, d))


@query("SELECT doc_id, count(DISTINCT page) AS num_pages FROM wd GROUP BY ALL", "wd")
def page_count(spark, d):
    return s.page_count(words_doc(spark, d))


def _stems(spark, d):
    return table(spark, d, "orders").select(s.stem(F.format_string("/in/%08d.pdf", "o_orderkey")).alias("stem"), "o_orderstatus")


@query("SELECT printf('%08d', o_orderkey) AS stem, CASE WHEN o_orderstatus <> 'P' THEN 'paired' ELSE 'no_annotation' END AS status FROM orders")
def pair_documents(spark, d):
    docs = _stems(spark, d)
    return s.pair_documents(docs.select("stem"), docs.filter("o_orderstatus <> 'P'"))


@query("SELECT printf('%08d', o_orderkey) AS stem FROM orders WHERE o_orderstatus <> 'F'")
def pending_documents(spark, d):
    docs = _stems(spark, d)
    return s.pending_documents(docs.select("stem"), docs.filter("o_orderstatus = 'F'"))


@query("SELECT doc_id, page, CASE WHEN np=1 THEN 'single' WHEN page=0 THEN 'header' ELSE 'items' END AS kind, CASE WHEN np=1 THEN doc_id || '_layout.json' WHEN page=0 THEN doc_id || '_header.json' ELSE doc_id || '_items_p' || page || '.json' END AS file_name FROM (SELECT doc_id, page, count(*) OVER (PARTITION BY doc_id) np FROM (SELECT DISTINCT doc_id, page FROM wd))", "wd")
def output_file_plan(spark, d):
    return s.output_file_plan(words_doc(spark, d))


def _files(spark, d):
    return table(spark, d, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_enriched.json")).alias("name"), F.nullif("o_orderstatus", F.lit("P")).alias("metadata"))


@query("SELECT o_orderkey || '_enriched.json' AS name, CASE WHEN o_orderstatus <> 'P' THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey || '.json' END AS target FROM orders")
def reorg_validate(spark, d):
    return s.reorganize(_files(spark, d))


@query("SELECT count(*) AS total, CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS accepted, CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END)*100.0/count(*) AS DOUBLE) AS success_percent FROM orders")
def dataset_summary(spark, d):
    return s.dataset_summary(s.reorganize(_files(spark, d)))


@query("SELECT name FROM (SELECT o_orderkey || CASE o_orderstatus WHEN 'P' THEN '_metadata.json' WHEN 'O' THEN '_checkpoint.json' ELSE '_layout.json' END AS name FROM orders) WHERE name LIKE '%layout%'")
def content_files(spark, d):
    name = F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "P", "_metadata.json").when(F.col("o_orderstatus") == "O", "_checkpoint.json").otherwise("_layout.json"))
    return s.content_files(table(spark, d, "orders").select(name.alias("name")))
