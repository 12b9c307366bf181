"""Every registered query against its SQL counterpart, on plain and on heavily skewed tables."""

import duckdb
import pytest
from compare import TABLES, connect, difference
from conftest import SMALL

import __spark_entry__ as entry
from tillroll.catalog.oracle import ORACLE
from tillroll.catalog.queries import QUERIES

BOOSTED = {"model_xgb_rule", "model_lgbm_rule"}  # these score in Arrow batches
SLOW = {"model_gbt", "model_xgb", "model_lgbm", "train_all", "random_search_cv"}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One product, one customer and one order hold a third of the lines each."""
    folder = tmp_path_factory.mktemp("skewed")
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    changed = {
        "lineitem": """SELECT * REPLACE (CASE WHEN hash(l_orderkey, l_linenumber) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
            CASE WHEN hash(l_linenumber, l_orderkey, 1) % 3 = 0 THEN 33 ELSE l_orderkey END AS l_orderkey) FROM lineitem""",
        "orders": """SELECT * REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders""",
    }
    for table in TABLES:
        body = changed.get(table, f"SELECT * FROM {table}")
        db.execute(f"COPY ({body}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def plain_db():
    return connect(SMALL)


@pytest.fixture(scope="module")
def skewed_db(skewed):
    return connect(skewed)


def test_every_counterpart_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, plain_db, name):
    frame = QUERIES[name](spark, SMALL)
    assert difference(frame, plain_db, ORACLE[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in BOOSTED:
        assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql_under_skew(spark, skewed, skewed_db, name):
    assert difference(QUERIES[name](spark, skewed), skewed_db, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_model_queries_return_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "segment"
    assert frame.count() > 0
