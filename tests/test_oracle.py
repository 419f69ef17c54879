"""Every registered query against its SQL in DuckDB, on the driver's smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from claimloom.demo import catalog, oracle

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the driver's tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, str(SF_DIR))
    duck.execute(ORACLE[name])
    columns = [c[0] for c in duck.description]
    assert sorted(found.columns) == sorted(columns)
    rows = [tuple(r) for r in found.collect()]
    assert _rows(found.columns, rows) == _rows(columns, duck.fetchall())


def test_entry_is_lazy_and_complete(spark):
    df = entry.entry(spark)
    orders = spark.read.parquet(str(SF_DIR / "orders.parquet"))
    assert df.count() >= orders.count()


@pytest.mark.parametrize("sf_dir", [SF_DIR, SF_DIR.parent / "sf0.01"])
def test_derived_tables_drop_nothing(spark, sf_dir):
    """Every item fills a slot, and every part of the types used has its codes."""
    sizes = {
        name: QUERIES[name](spark, str(sf_dir)).count()
        for name in ("procedure_slots_long", "claims_view", "code_table_all")
    }
    items = spark.read.parquet(str(sf_dir / "lineitem.parquet"))
    orders = spark.read.parquet(str(sf_dir / "orders.parquet"))
    parts = spark.read.parquet(str(sf_dir / "part.parquet"))
    kinds = {r.p_type: r["count"] for r in parts.groupBy("p_type").count().collect()}
    drgs = parts.where("p_type in ('PROMO', 'SMALL')").select("p_brand", "p_size").distinct()
    icd = sum(kinds.get(k, 0) for k in ("ECONOMY", "MEDIUM", "SMALL"))
    hcpcs = sum(kinds.get(k, 0) for k in ("LARGE", "PROMO", "STANDARD"))
    held = items.join(orders, items.l_orderkey == orders.o_orderkey, "left_semi")
    assert held.count() == items.count()
    assert sizes["procedure_slots_long"] == items.count()
    assert sizes["claims_view"] >= orders.count()
    assert sizes["code_table_all"] == icd + hcpcs + drgs.count()
