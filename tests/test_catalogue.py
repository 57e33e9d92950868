"""Every registered query against its DuckDB twin on the smallest tables, and plans that must not appear."""

import os

import duckdb
import pytest

from showbill.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([None if v is None else v for v in (r[i] for i in order)]) for r in values)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if name not in registry.ORACLES:
        return
    rel = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, got) == rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", ["related_union_equi", "listing_filtered_topk", "survivorship_merge", "favourites_recommend", "override_overlay", "place_inherit_unambiguous"])
def test_plans_have_no_nested_loops_or_python(spark, name):
    plan = registry.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_listing_is_a_topk(spark):
    plan = registry.QUERIES["listing_filtered_topk"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
