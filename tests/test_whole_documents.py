"""Operators over whole documents give what SQL or the operators on tables give, and shuffle lines only."""

import pytest

from quillmap.plans import catalog
from tests.test_whole_job import few  # noqa: F401

WITH_SQL = ["nearby_words", "context_boost", "document_metadata", "enhance_match", "header_elements_v2", "extract_columns", "items_via_table", "map_items_rows", "map_items_rows_v2", "word_ngrams", "multi_page", "process_documents", "process_batch"]
WITHOUT_SQL = ["reprocess", "optimized_pipeline", "enrich_fields", "enrich_items"]


def _rows(rows):
    plain = lambda v: round(v, 8) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v
    return sorted(map(repr, map(plain, map(tuple, rows))))


@pytest.mark.parametrize("name", WITH_SQL + WITHOUT_SQL)
def test_lines_only_are_shuffled(spark, few, name):  # noqa: F811
    plan = catalog.queries()[name](spark, few)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and plan.count("RepartitionByExpression") == 1


@pytest.mark.parametrize("name", WITH_SQL)
def test_documents_agree_with_sql(spark, few, name):  # noqa: F811
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for n in ("orders", "customer", "lineitem", "part"):
        db.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{few}/{n}.parquet/*.parquet')")
    got = catalog.queries()[name](spark, few)
    want = db.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in want.description]
    rows = _rows(got.select(*names).collect())
    assert sorted(got.columns) == sorted(names) and rows and rows == _rows(want.fetchall())


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_documents_agree_with_tables(spark, few, name):  # noqa: F811
    from quillmap.fixtures import fields_inv, words_inv
    from quillmap.plans import pipelines as p

    got = catalog.queries()[name](spark, few)
    want = getattr(p, name)(fields_inv(spark, few), words_inv(spark, few)).select(*got.columns)
    rows = _rows(got.collect())
    assert rows and rows == _rows(want.collect())
