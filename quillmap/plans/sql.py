"""Pieces of DuckDB SQL that several queries share."""

NORM = r"trim(regexp_replace(regexp_replace(strip_accents(lower({0})), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"
VALID = "coalesce(NOT (x0=0 AND y0=0 AND x1=0 AND y1=0) AND x1-x0>=5 AND y1-y0>=5 AND least(x0,y0,x1,y1)>=0 AND greatest(x0,y0,x1,y1)<=1000, false)"
SMALL = "coalesce(length(text)>0 AND (x1-x0 < 0.5*length(text)*8 OR y1-y0 < 6), false)"
TOKENS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
TOTALS = "subtotal|igv|total|importe|neto|valor|descuento|suma|monto|pagar|cobrar"


def norm(c: str) -> str:
    return NORM.format(c)


def expanded(p: str = "") -> str:
    """x0..y1 grown from the centre, as e0..e3."""
    return """CASE WHEN x1-x0 < greatest(length(text)*8,5) THEN greatest(0, x0-CAST(floor((greatest(length(text)*8,5)-(x1-x0))/2.0) AS INT)) ELSE x0 END e0,
 CASE WHEN y1-y0 < 12 THEN greatest(0, y0-CAST(floor((12-(y1-y0))/2.0) AS INT)) ELSE y0 END e1,
 CASE WHEN x1-x0 < greatest(length(text)*8,5) THEN least(1000, x1+CAST(floor((greatest(length(text)*8,5)-(x1-x0))/2.0) AS INT)) ELSE x1 END e2,
 CASE WHEN y1-y0 < 12 THEN least(1000, y1+CAST(floor((12-(y1-y0))/2.0) AS INT)) ELSE y1 END e3"""


#: Number of a text, both modes.
STRIP = r"TRY_CAST(nullif(regexp_extract(regexp_replace(text, '[,.]', '', 'g'), '-?\d+'), '') AS DOUBLE)"
DECIMAL = r"""TRY_CAST(nullif(CASE WHEN ((t LIKE '%.%' AND t LIKE '%,%') OR (length(regexp_replace(t, '[^.,]', '', 'g')) = 1 AND length(regexp_extract(t, '[.,]([^.,]*)$', 1)) <> 3)) AND regexp_matches(t, '[.,]')
  THEN regexp_replace(regexp_extract(t, '^(.*)[.,]', 1), '[.,]', '', 'g') || '.' || regexp_extract(t, '[.,]([^.,]*)$', 1) ELSE regexp_replace(t, '[.,]', '', 'g') END, '') AS DOUBLE)"""
NUMBERS = rf"nums AS (SELECT *, {DECIMAL} number FROM (SELECT *, rtrim(regexp_extract(text, '-?\d[\d.,]*'), '.,') t FROM wi))"

#: Regions of each document from words `w`.
REGIONS = rf"""tr AS (SELECT doc_id, min(b) ts, max(b)+20 te FROM (SELECT doc_id, CAST(floor(y0/10.0)*10 AS INT) b FROM w GROUP BY ALL HAVING count(*) >= 3) GROUP BY doc_id HAVING count(*) >= 2),
tt AS (SELECT doc_id, greatest(0, min(y0)-50) us, max(y0)+30 ue FROM w WHERE regexp_matches(lower(text), '{TOTALS}') GROUP BY doc_id),
rg AS (SELECT doc_id, 0 header_start, coalesce(ts,250)-10 header_end, coalesce(ts,250) items_start,
 CASE WHEN te IS NULL OR te > coalesce(us,800) THEN coalesce(us,800)-10 ELSE te END items_end, coalesce(us,800) totals_start, coalesce(ue,1000) totals_end
 FROM (SELECT DISTINCT doc_id FROM w) LEFT JOIN tr USING (doc_id) LEFT JOIN tt USING (doc_id)),
ra AS (SELECT w.*, CASE WHEN y0 < header_end THEN 'header' WHEN y0 < items_end THEN 'items' ELSE 'totals' END region FROM w JOIN rg USING (doc_id)),
tw AS (SELECT * EXCLUDE (region) FROM ra WHERE region = 'items')"""
#: Rows of each page by an anchored fold over its distinct heights.
ROWS = """hs AS (SELECT doc_id, page, list_sort(list(DISTINCT y0)) ys FROM w GROUP BY ALL),
fd AS (SELECT doc_id, page, list_reduce(list_transform(ys, lambda y: {'anchor': y, 'row': CAST(0 AS INT), 'out': [{'y0': y, 'row_id': CAST(0 AS INT)}]}),
  lambda a, e: CASE WHEN abs(e.anchor - a.anchor) > 10 THEN {'anchor': e.anchor, 'row': CAST(a.row+1 AS INT), 'out': list_append(a.out, {'y0': e.anchor, 'row_id': CAST(a.row+1 AS INT)})}
   ELSE {'anchor': a.anchor, 'row': a.row, 'out': list_append(a.out, {'y0': e.anchor, 'row_id': a.row})} END).out o FROM hs),
rm AS (SELECT doc_id, page, u.y0 y0, u.row_id row_id FROM (SELECT doc_id, page, unnest(o) u FROM fd)),
rw AS (SELECT w.*, rm.row_id, CAST(row_number() OVER (PARTITION BY doc_id, page, rm.row_id ORDER BY x0, y0, word_idx)-1 AS INT) row_pos FROM w JOIN rm USING (doc_id, page, y0))"""
#: Exact matches of invoice fields.
EXACT = f"""fq AS (SELECT *, {norm('value')} nq FROM fi WHERE value IS NOT NULL AND value <> ''), wn AS (SELECT *, {norm('text')} nw FROM wi),
ex AS (SELECT * FROM (SELECT fq.doc_id, section, item_idx, ord, field_name, value, word_idx, page, text, x0, y0, x1, y1, confidence, CAST(1.0 AS DOUBLE) match_score,
 row_number() OVER (PARTITION BY fq.doc_id, section, item_idx, ord, field_name ORDER BY word_idx) rk FROM fq JOIN wn ON fq.doc_id=wn.doc_id AND nq=nw) WHERE rk=1)"""
RATES = """rt AS (SELECT doc_id, count(*) FILTER (section='header') header_total, count(*) FILTER (section='header' AND hit) header_found,
 count(*) FILTER (section<>'header' AND value IS NOT NULL AND value<>'') item_fields_total, count(*) FILTER (section<>'header' AND hit) item_fields_found,
 count(DISTINCT CASE WHEN section<>'header' THEN item_idx END) items_total, count(*) FILTER (value IS NOT NULL AND value<>'') fields_total, count(*) FILTER (hit) fields_found
 FROM (SELECT fi.*, coalesce(h.hit, false) hit FROM fi LEFT JOIN (SELECT DISTINCT doc_id, section, item_idx, ord, true hit FROM ex) h USING (doc_id, section, item_idx, ord)) GROUP BY doc_id),
rr AS (SELECT *, CASE WHEN header_total>0 THEN header_found/CAST(header_total AS DOUBLE) ELSE 1.0 END header_match_rate,
 CASE WHEN items_total>0 THEN CASE WHEN item_fields_total>0 THEN item_fields_found/CAST(item_fields_total AS DOUBLE) ELSE 1.0 END END items_match_rate,
 CASE WHEN fields_total>0 THEN fields_found/CAST(fields_total AS DOUBLE) ELSE 1.0 END match_rate FROM rt)"""
EXTRACTION = """es AS (SELECT doc_id, count(*) num_pages, CAST(sum(n) AS BIGINT) total_words, list(n ORDER BY page) words_per_page, CAST(sum(n) AS DOUBLE)/count(*) avg_words_per_page,
 CAST(sum(c) AS BIGINT)/CAST(sum(n) AS DOUBLE)/100 avg_confidence, CASE WHEN max(CASE WHEN page=0 THEN n>10 ELSE false END) THEN 'native' ELSE 'ocr' END "method"
 FROM (SELECT doc_id, page, count(*) n, sum(CAST(round(confidence*100) AS BIGINT)) c FROM w GROUP BY ALL) GROUP BY doc_id)"""

#: Longest common subsequence of a field's form nq (up to 61 characters) and a run's nw, bit by bit: each character
#: of nw takes the state v to (v + (v & u)) | (v - (v & u)), where u marks the character's places in nq.
_LCS = """(length(nq) - bit_count(list_reduce(list_prepend(CAST((1::BIGINT << length(nq)) - 1 AS BIGINT), list_transform(string_split(nw, ''), lambda c: CAST(coalesce(list_sum(list_transform(list_filter(range(length(nq)), lambda i: nq[i+1] = c), lambda i: 1::BIGINT << i)), 0) AS BIGINT))),
  lambda v, u: ((v + (v & u)) | (v - (v & u))) & CAST((1::BIGINT << length(nq)) - 1 AS BIGINT))))"""


def best_runs(name: str, fields: str, runs: str, groups: str = "") -> str:
    """CTEs ending in `name`: each field's best run, of each group where groups are named.

    fields: a CTE with the fields and nq; runs: one with words (or runs) and nw, n. No edit distance is below half of
    what insertions and deletions alone take, so what is beyond the threshold's by the native one is left out first.
    """
    by = f", w.{groups.replace(', ', ', w.')}" if groups else ""
    return f"""{name}d AS MATERIALIZED (SELECT DISTINCT nq, nw FROM {fields} f JOIN {runs} w ON f.doc_id=w.doc_id WHERE nq <> nw AND length(nq) > 0 AND length(nw) > 0
  AND least(length(nq), length(nw))*200 >= (length(nq)+length(nw))*85 AND levenshtein(nq, nw)*100 <= (length(nq)+length(nw))*15),
{name}s AS MATERIALIZED (SELECT * FROM (SELECT nq, nw, 200.0::DOUBLE*{_LCS}/(length(nq)+length(nw)) score FROM {name}d) WHERE score >= 85),
{name} AS MATERIALIZED (SELECT * EXCLUDE (rk) FROM (SELECT f.doc_id, f.section, f.item_idx, f.ord, f.field_name, f.value, w.* EXCLUDE (doc_id, confidence, nw), CASE WHEN s.nq IS NULL THEN w.confidence ELSE w.confidence*score/100 END confidence, CASE WHEN s.nq IS NULL THEN CAST(1.0 AS DOUBLE) ELSE score/100 END match_score,
  row_number() OVER (PARTITION BY f.doc_id, f.section, f.item_idx, f.ord, f.field_name{by} ORDER BY coalesce(score, 100.0) DESC, w.word_idx, w.n) rk
  FROM {fields} f JOIN {runs} w ON f.doc_id=w.doc_id LEFT JOIN {name}s s ON s.nq=f.nq AND s.nw=w.nw WHERE f.nq = w.nw OR s.nq IS NOT NULL) WHERE rk=1)"""


def one_word(words: str) -> str:
    """CTE body: words as runs of one."""
    return f"SELECT *, 1 n, {norm('text')} nw FROM {words}"


def up_to_nine(words: str) -> str:
    """CTE body: runs of up to nine words with their box and mean confidence."""
    return f"""SELECT * FROM (SELECT doc_id, i word_idx, p[1] page, array_to_string(t[1:n], ' ') "text", list_min(a[1:n]) x0, list_min(b[1:n]) y0, list_max(c[1:n]) x1, list_max(e[1:n]) y1, list_sum(k[1:n])/n confidence, n, {norm("array_to_string(t[1:n], ' ')")} nw
 FROM (SELECT *, unnest(range(1, len(t)+1))::INT AS n FROM (SELECT doc_id, word_idx i, list(text) OVER v t, list(page) OVER v p, list(x0) OVER v a, list(y0) OVER v b, list(x1) OVER v c, list(y1) OVER v e, list(confidence) OVER v k FROM {words} WINDOW v AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING))))"""


def numeric(fields: str, words: str) -> str:
    """CTE body: the nearest number of each numeric field."""
    return f"""SELECT * EXCLUDE (rk, diff), 1-diff match_score FROM (SELECT f.doc_id, section, item_idx, ord, field_name, value, word_idx, page, text, x0, y0, x1, y1, confidence, number numeric_value, abs(number-target)/greatest(abs(target),0.01::DOUBLE) diff,
  row_number() OVER (PARTITION BY f.doc_id, section, item_idx, ord, field_name ORDER BY abs(number-target)/greatest(abs(target),0.01::DOUBLE), word_idx) rk
  FROM (SELECT *, TRY_CAST(value AS DOUBLE) target FROM {fields} WHERE kind='numeric') f JOIN (SELECT *, {DECIMAL} number FROM (SELECT *, rtrim(regexp_extract(text, '-?\\d[\\d.,]*'), '.,') t FROM {words})) w ON f.doc_id=w.doc_id
  WHERE number IS NOT NULL AND target IS NOT NULL AND abs(number-target)/greatest(abs(target),0.01::DOUBLE) <= 0.01) WHERE rk=1"""


def matched(name: str, fields: str, words: str) -> str:
    """CTEs ending in `name`: fields of every kind matched, by name and place."""
    some = f"value IS NOT NULL AND trim(value) <> ''"
    return f"""{name}w1 AS MATERIALIZED ({one_word(words)}), {name}w9 AS MATERIALIZED ({up_to_nine(words)}),
{name}f1 AS (SELECT *, {norm('value')} nq FROM {fields} WHERE {some} AND (kind='single' OR kind='numeric' AND TRY_CAST(value AS DOUBLE) IS NULL)), {name}f9 AS (SELECT *, {norm('value')} nq FROM {fields} WHERE {some} AND kind='multiword'),
{best_runs(name + 'one', name + 'f1', name + 'w1')}, {best_runs(name + 'nine', name + 'f9', name + 'w9')}, {name}num AS ({numeric(fields, words)}),
{name} AS MATERIALIZED (SELECT doc_id, section, item_idx, ord, field_name, value, word_idx, page, "text", x0, y0, x1, y1, confidence, match_score, n word_count, CAST(NULL AS DOUBLE) numeric_value FROM {name}one UNION ALL SELECT doc_id, section, item_idx, ord, field_name, value, word_idx, page, "text", x0, y0, x1, y1, confidence, match_score, n, NULL FROM {name}nine
 UNION ALL SELECT doc_id, section, item_idx, ord, field_name, value, word_idx, page, "text", x0, y0, x1, y1, confidence, match_score, NULL, numeric_value FROM {name}num)"""


def item_rows(name: str, fields: str, rows: str) -> str:
    """CTEs ending in `name`: the matches of items' fields within each item's best row; rows: words with row_id."""
    return f"""{name}w AS MATERIALIZED ({one_word(rows)}), {name}f AS (SELECT *, {norm('value')} nq FROM {fields} WHERE section='items' AND value IS NOT NULL AND trim(value) <> ''),
{best_runs(name + 'h', name + 'f', name + 'w', 'page, row_id')},
{name}r AS (SELECT doc_id, item_idx, page, row_id, count(*) fields_matched, sum(CAST(round(match_score*1e9) AS BIGINT)) s FROM {name}h GROUP BY ALL),
{name} AS MATERIALIZED (SELECT h.*, fields_matched, CAST(s AS DOUBLE)/1e9 row_score FROM {name}h h JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id, item_idx ORDER BY fields_matched DESC, s DESC, page, row_id) rk FROM {name}r) r USING (doc_id, item_idx, page, row_id) WHERE rk=1)"""


def roles(name: str, fields: str, words: str) -> str:
    """CTEs ending in `name`: each page's hits of key fields and its role."""
    return f"""{name}w AS MATERIALIZED ({one_word(words)}), {name}f AS (SELECT *, {norm('value')} nq FROM {fields} WHERE section='header' AND field_name IN ('serie_completa', 'emisor_ruc', 'receptor_numero_doc', 'importe_total') AND value IS NOT NULL AND trim(value) <> ''),
{best_runs(name + 'h', name + 'f', name + 'w', 'page')},
{name} AS MATERIALIZED (SELECT doc_id, page, hits, CASE WHEN CASE WHEN mx=0 THEN page=0 ELSE hits*2 >= mx END THEN 'header' WHEN doc_id IN (SELECT doc_id FROM {fields} WHERE section='items') THEN 'items' ELSE 'none' END "role"
 FROM (SELECT *, max(hits) OVER (PARTITION BY doc_id) mx FROM (SELECT doc_id, page, coalesce(c, 0) hits FROM (SELECT DISTINCT doc_id, page FROM {words}) LEFT JOIN (SELECT doc_id, page, count(*) c FROM {name}h GROUP BY ALL) USING (doc_id, page))))"""


def rates(name: str, fields: str, found: str) -> str:
    """CTEs ending in `name`: the match rates of each document."""
    return RATES.replace("rr AS", f"{name} AS").replace("FROM rt)", f"FROM {name}t)").replace("rt AS", f"{name}t AS").replace("SELECT fi.*", "SELECT q.*").replace("FROM fi LEFT", f"FROM {fields} q LEFT").replace("FROM ex)", f"FROM {found})")


def positions(found: str) -> str:
    """Body: matches as elements with ids in the fields' order and positions in reading order."""
    return f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, x0, id)-1 AS INT) AS position, CAST(id AS INT) AS id, "text", x0, y0, x1, y1, field_name, page, confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY section, item_idx, ord)-1 id FROM {found})"""
