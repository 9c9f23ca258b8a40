"""The driver contract, and a sample of queries against their oracle on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from calipers.plans.bindings import QUERIES
from calipers.plans.oracles import ORACLES

SAMPLE = ("pointers_latest", "defect_version", "select_halves", "tree_diff", "choose_release", "directory_listing")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(entry.oracle_sql()) <= set(entry.queries())
    assert not [n for n in QUERIES if n.startswith("op") or "pipeline" in n]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["key", "version", "path"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "documents", "pages", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in cur.description)
    names = [d[0] for d in cur.description]
    want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == want


def test_no_product_joins(spark):
    for name in ("merge_conditions", "change_facts", "conformance_counts", "check_absence", "coverage"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
