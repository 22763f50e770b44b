import parity
import pytest

from tessella.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return parity.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    assert parity.compare(QUERIES[name](spark, SF), db, ORACLE[name]) == ""


def test_queries_without_sql(spark):
    assert {(r["path"], r["problem"]) for r in QUERIES["source_digests"](spark, SF).collect()} == {("nation.parquet", "changed"), ("gone.parquet", "missing")}
    found = QUERIES["ledger_stream"](spark, SF)
    assert found.count() == found.select("source_row_id").distinct().count() == QUERIES["ledger_conflicts"](spark, SF).sparkSession.read.parquet(f"{SF}/events.parquet").selectExpr("date(ts) d", "user_id").distinct().count()


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 100
    assert set(e.oracle_sql()) <= set(e.queries())
