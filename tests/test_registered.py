"""Registered queries: against their SQL on the smallest tables, and the shape of their plans."""

import io
from contextlib import redirect_stdout
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as repo
from skyledger.sources import readers

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES, SQL = repo.queries(), repo.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql_without_pairwise_joins(spark, duck, name):
    got = QUERIES[name](spark, SF)
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    want = ordered(cursor.fetchall())
    assert ordered(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["dedup_rows", "win_latest_per_key", "win_dedup_keep_first", "topk_context"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert plan(QUERIES[name](spark, SF)).count("WindowGroupLimit") >= 2


def test_merge_adds_no_shuffle_to_its_sources(spark):
    assert plan(QUERIES["join_full_outer_merge"](spark, SF)).count("Exchange hashpartitioning") <= 2


def test_filters_and_columns_reach_the_scan(spark):
    lines = readers.read_parquet(spark, f"{SF}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipdate"])
    text = plan(lines.where("l_shipdate >= timestamp_ntz'1998-01-01'").select("l_orderkey", "l_quantity"))
    assert "GreaterThanOrEqual(l_shipdate" in text
    schema = next(x for x in text.splitlines() if "ReadSchema" in x)
    assert "l_tax" not in schema and "l_quantity" in schema


@pytest.mark.parametrize("name", ["join_star_dims", "join_asof_backward", "join_month_normals", "win_label_encode"])
def test_same_result_when_nothing_is_small_enough_to_broadcast(spark, duck, name):
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for setting in settings:
        spark.conf.set(setting, "-1")
    try:
        got = QUERIES[name](spark, SF)
        text = plan(got)
        assert "SortMergeJoin" in text and "NestedLoopJoin" not in text
        cursor = duck.execute(SQL[name])
        names = [d[0] for d in cursor.description]
        rows = ordered(tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect())
        assert rows == ordered(cursor.fetchall())
    finally:
        for setting in settings:
            spark.conf.unset(setting)
