"""Queries of rows, columns, regions and tables, over every word of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmap.fixtures import lines_inv, words_doc, words_inv, words_of_lines
from quillmap.operators import layout as y
from quillmap.operators import quality as q
from quillmap.operators import whole
from quillmap.plans.registry import query
from quillmap.plans.sql import EXTRACTION, REGIONS, ROWS

WD, WI = "w AS (SELECT * FROM wd)", "w AS (SELECT * FROM wi)"
PAGE = "w AS (SELECT doc_id*1000+page AS doc_id, word_idx, page, text, x0, y0, x1, y1, confidence FROM wd)"


def _pages(spark, d):
    """Each page as a document of its own, as detection sees one page at a time."""
    return words_doc(spark, d).withColumn("doc_id", F.col("doc_id") * 1000 + F.col("page"))


@query(f"WITH {WD}, {ROWS} SELECT doc_id, page, word_idx, row_id, row_pos FROM rw", "wd")
def detect_rows(spark, d):
    return y.detect_rows(words_doc(spark, d)).select("doc_id", "page", "word_idx", "row_id", "row_pos")


@query(f"WITH {WI}, {ROWS} SELECT doc_id, page, row_id, count(*) AS n, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM rw GROUP BY ALL HAVING count(*) >= 3", "wi")
def filter_table_rows(spark, d):
    rows = y.filter_table_rows(y.detect_rows(words_inv(spark, d)))
    return rows.groupBy("doc_id", "page", "row_id").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


_COLS = """cs AS (SELECT doc_id, x0, count(*) n FROM w GROUP BY ALL), cg AS (SELECT *, CASE WHEN x0 - lag(x0) OVER k > 15 THEN 1 ELSE 0 END st FROM cs WINDOW k AS (PARTITION BY doc_id ORDER BY x0)),
ci AS (SELECT *, CAST(sum(st) OVER (PARTITION BY doc_id ORDER BY x0 ROWS UNBOUNDED PRECEDING) AS INT) col_idx FROM cg),
cc AS (SELECT doc_id, col_idx, CAST(floor(CAST(sum(x0*n) AS DOUBLE)/CAST(sum(n) AS DOUBLE)) AS INT) center, CAST(sum(n) AS BIGINT) n FROM ci GROUP BY ALL),
cr AS (SELECT doc_id, col_idx, center x_start, coalesce(CAST(floor((center + lead(center) OVER (PARTITION BY doc_id ORDER BY col_idx))/2.0) AS INT), 1000) x_end FROM cc)"""


@query(f"WITH {WI}, {_COLS} SELECT * FROM cc", "wi")
def detect_columns(spark, d):
    return y.detect_columns(words_inv(spark, d))


@query(f"WITH {WI}, {_COLS} SELECT * FROM cr", "wi")
def column_ranges(spark, d):
    return y.column_ranges(y.detect_columns(words_inv(spark, d)))


@query(f"WITH {WI}, {_COLS} SELECT doc_id, word_idx, col_idx FROM w JOIN cr USING (doc_id) WHERE x0 >= x_start AND x0 < x_end", "wi")
def assign_columns(spark, d):
    w = words_inv(spark, d)
    return y.assign_columns(w, y.column_ranges(y.detect_columns(w))).select("doc_id", "word_idx", "col_idx")


@query(f"""WITH {WI}, {ROWS}, {_COLS} SELECT c.doc_id, c.page, c.row_id, c.col_idx, coalesce(value, '') AS value FROM (SELECT * FROM (SELECT DISTINCT doc_id, page, row_id FROM rw) JOIN (SELECT doc_id, col_idx FROM cr) USING (doc_id)) c
LEFT JOIN (SELECT doc_id, page, row_id, col_idx, string_agg(text, ' ' ORDER BY row_pos) value FROM rw JOIN cr USING (doc_id) WHERE x0 >= x_start AND x0 < x_end GROUP BY ALL) v USING (doc_id, page, row_id, col_idx)""", "wi")
def extract_columns(spark, d):
    return whole.extract_columns(lines_inv(spark, d), words_of_lines)


@query(f"WITH {WD}, {ROWS}, f AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, row_id) c FROM rw) SELECT doc_id, count(DISTINCT page*100000+row_id) AS n_rows, count(*) AS n_words, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM f WHERE c >= 3 GROUP BY doc_id HAVING count(DISTINCT page*100000+row_id) >= 3", "wd")
def detect_table_v1(spark, d):
    return y.detect_table_v1(words_doc(spark, d))


@query("SELECT doc_id, CAST(b AS INT) AS band, CAST(b*50 AS INT) AS y_start, CAST((b+1)*50 AS INT) AS y_end, count(y0) AS words FROM (SELECT doc_id, unnest(range(20)) b FROM (SELECT DISTINCT doc_id FROM wd)) LEFT JOIN wd USING (doc_id) WHERE b = least(floor(y0/50.0), 19) GROUP BY ALL UNION ALL SELECT doc_id, CAST(b AS INT), CAST(b*50 AS INT), CAST((b+1)*50 AS INT), 0 FROM (SELECT doc_id, unnest(range(20)) b FROM (SELECT DISTINCT doc_id FROM wd)) a WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT doc_id, least(floor(y0/50.0), 19) bb FROM wd) x WHERE x.doc_id=a.doc_id AND bb=b)", "wd")
def density_bands(spark, d):
    return y.density_bands(words_doc(spark, d))


@query(f"WITH {PAGE}, {REGIONS} SELECT doc_id, ts AS table_start, te AS table_end FROM tr", "wd")
def table_region(spark, d):
    return y.table_region(_pages(spark, d))


@query(f"WITH {WI}, {REGIONS} SELECT doc_id, us AS totals_start, ue AS totals_end FROM tt", "wi")
def totals_region(spark, d):
    return y.totals_region(words_inv(spark, d))


@query(f"WITH {PAGE}, {REGIONS} SELECT * FROM rg", "wd")
def combine_regions(spark, d):
    return y.combine_regions(_pages(spark, d))


@query(f"WITH {PAGE}, {REGIONS} SELECT doc_id, word_idx, region FROM ra", "wd")
def assign_regions(spark, d):
    return y.assign_regions(_pages(spark, d)).select("doc_id", "word_idx", "region")


_DET = """dr AS (SELECT s.doc_id, s.region, s.y_start, s.y_end, coalesce(c.n, 0) word_count FROM (SELECT doc_id, 'header' region, header_start y_start, header_end y_end FROM rg UNION ALL SELECT doc_id, 'items', items_start, items_end FROM rg UNION ALL SELECT doc_id, 'totals', totals_start, totals_end FROM rg) s
LEFT JOIN (SELECT doc_id, region, count(*) n FROM ra GROUP BY ALL) c USING (doc_id, region))"""


@query(f"WITH {PAGE}, {REGIONS}, {_DET} SELECT * FROM dr", "wd")
def detect_regions(spark, d):
    return y.detect_regions(_pages(spark, d))


@query(f"WITH {PAGE}, {REGIONS}, {_DET} SELECT doc_id, region, y_end-y_start AS height, word_count, CAST((y_end-y_start)*100.0/1000 AS DOUBLE) AS percentage FROM dr", "wd")
def region_stats(spark, d):
    return y.region_stats(y.detect_regions(_pages(spark, d)))


_BAND = """br AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY band) rk FROM (SELECT *, CAST(floor(y0/10.0)*10 AS INT) band FROM tw)) JOIN (SELECT doc_id, count(DISTINCT CAST(floor(y0/10.0)*10 AS INT)) nb FROM tw GROUP BY doc_id) USING (doc_id)),
bw AS (SELECT * EXCLUDE (rk, nb), CAST(CASE WHEN nb > 1 THEN rk-2 ELSE rk-1 END AS INT) row_id FROM br WHERE rk > 1 OR nb = 1)"""
_C2 = """c2 AS (SELECT doc_id, x_start, coalesce(lead(x_start) OVER (PARTITION BY doc_id ORDER BY x_start) - 15, 1000) x_end, n FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id) a FROM (SELECT doc_id, CAST(floor(x0/15.0)*15 AS INT) x_start, count(*) n FROM tw GROUP BY ALL)) WHERE n >= a*0.05)"""


@query(f"WITH {PAGE}, {REGIONS}, {_BAND} SELECT doc_id, word_idx, band, row_id FROM bw", "wd")
def banded_rows(spark, d):
    return y.banded_rows(y.table_words(_pages(spark, d))).select("doc_id", "word_idx", "band", "row_id")


@query(f"WITH {PAGE}, {REGIONS}, {_C2} SELECT * FROM c2", "wd")
def detect_columns_v2(spark, d):
    return y.detect_columns_v2(y.table_words(_pages(spark, d)))


@query("WITH tw AS MATERIALIZED (SELECT * FROM wi), " + _C2 + ", hd AS (SELECT doc_id, min(y0) m FROM tw GROUP BY 1), hits AS (SELECT doc_id, x_start, arg_min(nme, word_idx) nme FROM (SELECT c2.doc_id, c2.x_start, word_idx, CASE " + " ".join(f"WHEN contains(lower(text), '{a}') THEN '{b}'" for a, b in y.COLUMN_NAMES) + " END nme FROM (SELECT tw.* FROM tw JOIN hd USING (doc_id) WHERE y0 < m+50) tp JOIN c2 ON tp.doc_id=c2.doc_id AND x0 >= x_start AND x0 < x_end) WHERE nme IS NOT NULL GROUP BY ALL) SELECT c2.*, coalesce(nme, 'col_' || x_start) AS name FROM c2 LEFT JOIN hits USING (doc_id, x_start)", "wi")
def column_names(spark, d):
    w = words_inv(spark, d)
    return y.column_names(w, y.detect_columns_v2(w))


@query(f"WITH {PAGE}, {REGIONS} SELECT doc_id, word_idx FROM tw JOIN (SELECT doc_id, min(y0) m FROM tw GROUP BY 1) USING (doc_id) WHERE y0 < m+30", "wd")
def table_header(spark, d):
    return y.table_header(y.table_words(_pages(spark, d))).select("doc_id", "word_idx")


@query("WITH tw AS MATERIALIZED (SELECT * FROM wi), " + _BAND + ", " + _C2 + """, cells AS (SELECT bw.doc_id, row_id, x_start, CASE WHEN x_start > 500 THEN 'right' ELSE 'col_' || x_start END nme, string_agg(text, ' ' ORDER BY word_idx) v FROM bw JOIN c2 USING (doc_id) WHERE x0 >= x_start AND x0 < x_end GROUP BY ALL)
SELECT doc_id, row_id, nme AS "name", arg_max(v, x_start) AS value FROM cells GROUP BY ALL""", "wi")
def extract_columns_v2(spark, d):
    w = words_inv(spark, d)
    columns = y.detect_columns_v2(w).withColumn("name", F.when(F.col("x_start") > 500, "right").otherwise(F.concat(F.lit("col_"), F.col("x_start").cast("string"))))
    return y.extract_columns_v2(y.banded_rows(w), columns)


_T2 = f"""{_BAND}, {_C2}, t2 AS (SELECT r.doc_id, items_start y_start, items_end y_end, coalesce(nc, 0) num_columns, nr num_rows, coalesce(nh, 0) header_words FROM (SELECT doc_id, CAST(count(DISTINCT band) AS INT) nr FROM bw GROUP BY 1) r JOIN rg USING (doc_id)
LEFT JOIN (SELECT doc_id, CAST(count(*) AS INT) nc FROM c2 GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, CAST(count(*) AS INT) nh FROM tw JOIN (SELECT doc_id, min(y0) m FROM tw GROUP BY 1) USING (doc_id) WHERE y0 < m+30 GROUP BY 1) USING (doc_id))"""


@query(f"WITH {PAGE}, {REGIONS}, {_T2} SELECT * FROM t2", "wd")
def detect_table_v2(spark, d):
    return y.detect_table_v2(_pages(spark, d))


@query(f"WITH {PAGE}, {REGIONS}, {_T2} SELECT doc_id, num_columns, num_rows, y_end-y_start AS region_height, header_words > 0 AS has_header FROM t2", "wd")
def table_stats(spark, d):
    return y.table_stats(y.detect_table_v2(_pages(spark, d)))


@query(f"WITH {WD}, {REGIONS} SELECT doc_id, count(DISTINCT page) AS num_pages, count(*) AS total_words, round(count(*)/CAST(count(DISTINCT page) AS DOUBLE), 1) AS avg_words_per_page, count(*) FILTER (region='header') AS header_words, count(*) FILTER (region='items') AS items_words, count(*) FILTER (region='totals') AS totals_words FROM ra GROUP BY doc_id", "wd")
def extraction_metadata_v2(spark, d):
    return q.extraction_metadata_v2(y.assign_regions(words_doc(spark, d)))


@query(f"WITH {WD}, {EXTRACTION} SELECT * FROM es", "wd")
def extraction_stats(spark, d):
    return q.extraction_stats(words_doc(spark, d))


@query("SELECT doc_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM wd GROUP BY ALL", "wd")
def union_bbox(spark, d):
    return q.union_bbox(words_doc(spark, d), "doc_id", "page")
