"""Nested events: rows are shuffled before arrays of them are begun."""

import pytest

from orderloom.plans import catalog
from orderloom.sources import events as ev


def test_arrays_are_not_begun_before_the_shuffle(spark):
    df = spark.range(40).selectExpr("id % 7 AS k", "id % 2 AS node", "id AS v")
    nested = ev.nest_children(df, ["k", "node"], "lines")
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("partial_collect_list") < plan.index("Exchange")  # printed from the top: the exchange is below
    got = {(r.k, r.node): [x.v for x in r.lines] for r in nested.collect()}
    assert got == {(k, n): [v for v in range(40) if (v % 7, v % 2) == (k, n)] for k in range(7) for n in range(2)}


# Rows of each query on ``_orders_and_lines``.
ROWS = {"release_line_counts": 5, "array_flatten_distinct": 5, "array_transform": 5, "release_item_explode": 7,
        "release_item_sku_join": 7, "description_array_cast": 14}


def _orders_and_lines(spark):
    """Orders 1 (twice) and 2 with lines, 3 without; order 4 and the null key have lines only."""
    orders = spark.range(1, 4).union(spark.range(1, 2)).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "TIMESTAMP_NTZ'1995-03-01 00:00:00' AS o_orderdate",
        "'1-URGENT' AS o_orderpriority")
    lines = spark.createDataFrame(
        [(1, 7, 1), (1, 7, 2), (1, 8, 3), (2, 7, 1), (4, 7, 1), (None, 7, 1)],
        "l_orderkey long, l_suppkey long, l_linenumber int").selectExpr(
        "l_orderkey", "l_linenumber", "10L AS l_partkey", "l_suppkey", "2D AS l_quantity", "100D AS l_extendedprice",
        "0.1D AS l_discount", "0.05D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "TIMESTAMP_NTZ'1995-03-05 00:00:00' AS l_shipdate")
    return orders, lines


def test_lines_are_shuffled_once_for_nesting_and_the_join_to_orders(spark):
    orders, lines = _orders_and_lines(spark)
    for build in (ev.release_events, ev.invoice_events):
        plan = build(orders, lines)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 2  # orders and lines, no nested lines


def test_events_of_orders_and_nodes(spark):
    d = "data.releaseEventDetails"
    got = ev.release_events(*_orders_and_lines(spark)).selectExpr(
        f"{d}.id", f"transform({d}.releaseItems, x -> x.releaseLineNumber)").collect()
    want = [("R1-7", ["1", "2"]), ("R1-8", ["3"])] * 2 + [("R2-7", ["1"]), ("R3-0", None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", [
    "release_line_counts",
    "array_flatten_distinct",
    "array_transform",
    "release_item_explode",
    "release_item_sku_join",
    "description_array_cast",
])
def test_a_query_shuffles_lines_once(spark, tmp_dir, name):
    for table, df in zip(("orders", "lineitem"), _orders_and_lines(spark), strict=True):
        df.write.parquet(f"{tmp_dir}/{table}.parquet")
    spark.sql("SELECT 10L AS p_partkey, 'STANDARD' AS p_type").write.parquet(f"{tmp_dir}/part.parquet")
    out = catalog.query(name)(spark, tmp_dir)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 2
    assert out.count() == ROWS[name]
