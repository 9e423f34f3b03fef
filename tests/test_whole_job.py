"""Registered queries on a few invoices: nothing that should be worked on is left out."""

import random

import pytest

from quillmap.functions import similarity as s
from quillmap.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """A folder with the tables of three orders."""
    d = str(tmp_path_factory.mktemp("few"))
    read = lambda n: spark.read.parquet(f"{DATA}/{n}.parquet")
    orders = read("orders").orderBy("o_orderkey").limit(3)
    orders.write.parquet(f"{d}/orders.parquet")
    read("lineitem").join(orders.selectExpr("o_orderkey AS l_orderkey"), "l_orderkey", "left_semi").write.parquet(f"{d}/lineitem.parquet")
    for n in ("customer", "part"):
        read(n).write.parquet(f"{d}/{n}.parquet")
    return d


def test_five_strategies_match_items(spark, few):
    from quillmap.fixtures import fields_inv

    rows = catalog.queries()["match_five_strategy"](spark, few).collect()
    found = {(r["doc_id"], r["item_idx"], r["ord"]) for r in rows if r["section"] == "items"}
    # amounts are printed as they are asked for, so every item has at least that field
    asked = {(r["doc_id"], r["item_idx"], r["ord"]) for r in fields_inv(spark, few).filter("section = 'items' AND field_name = 'valor_venta'").collect()}
    assert asked and asked <= found
    assert all(r["value"] for r in rows) and any(r["section"] == "header" for r in rows)


def test_partial_ratio_cut_is_the_plain_one():
    rng = random.Random(5)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 25))) for _ in range(2))
        plain = s.partial_ratio_of(a, b)
        assert s.partial_ratio_from(a, b, 75) == (plain if plain >= 75 else 0.0)


@pytest.mark.parametrize("name", ["split_words", "split_words_v2", "words_consistent"])
def test_words_of_items_agree_with_sql(spark, few, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for n in ("orders", "customer", "lineitem", "part"):
        db.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{few}/{n}.parquet/*.parquet')")
    got = sorted(tuple(r) for r in catalog.queries()[name](spark, few).collect())
    assert got == sorted(db.execute(catalog.oracle_sql()[name]).fetchall())
    assert any(r[1] == "items" and r[3] == 2 for r in got) and any(r[1] == "header" for r in got)


def test_optimized_pipeline_enhances_items(spark):
    from quillmap.plans import pipelines as p
    from tests.test_matching import FIELD, WORD

    lines = [(300, "Item", "Codigo", "Moneda", "Precio"), (320, "1", "P00-0001", "S/.", "100.50"), (340, "2", "P00-0002", "S/.", "200.75")]
    left, right = (40, 100, 300, 322), (80, 160, 320, 350)
    w = [(1, 4 * r + k, 0, t, left[k], y, right[k], y + 12, 0.8) for r, (y, *texts) in enumerate(lines) for k, t in enumerate(texts)]
    # below the tenth pixel of its row's band: a row of its own for the second detector
    w.append((1, 12, 0, "P000003", 200, 349, 260, 361, 0.8))
    w.append((1, 13, 0, "KG", 400, 351, 430, 363, 0.8))
    f = [(1, "items", i, o, n, v, k) for i, (c, v) in enumerate((("P00-0001", "100.50"), ("P00-0002", "200.75"))) for o, n, v, k in ((0, "codigo", c, "single"), (1, "precio_unitario", v, "numeric"))]
    f.append((1, "items", 1, 2, "unidad", "KG", "single"))
    rows = p.optimized_pipeline(spark.createDataFrame(f, FIELD), spark.createDataFrame(w, WORD)).collect()
    got = {r["text"]: r for r in rows}
    assert sorted(got) == ["100.50", "200.75", "P00-0001", "P00-0002"]  # KG is in the next band
    assert [got[t]["x0"] for t in ("100.50", "200.75")] == [300, 300]
    assert [round(got[t]["confidence"], 9) for t in ("P00-0001", "P00-0002")] == [0.95, 0.95]
