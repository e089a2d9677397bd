"""Relational queries: filters, aggregates, ranking, joins, duplicates.

Tables stand in for the exercise data: ``customer`` is the employee table
(salary = ``c_acctbal``), ``nation`` the department table, ``orders`` /
``lineitem`` the fact tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import dedupe, joins, ranking, reconcile
from orderloom.session import scratch_path
from orderloom.sources import events as ev
from orderloom.sources import sinks
from orderloom.sources.tables import load


def q_filter_rows(spark, sf):
    o = load(spark, sf, "orders")
    return o.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_orderstatus", "o_totalprice")


def q_last_six_months(spark, sf):
    """Rows within six months of the newest date (anchor = data, not now).

    The anchor is one scalar (a one-column aggregate job); it is applied as a
    literal so the date predicate reaches the Parquet scan (row-group min/max
    skipping, partition pruning on date-partitioned tables).  A scalar
    subquery would be evaluated at run time and not pushed down.
    """
    o = load(spark, sf, "orders")
    anchor = o.agg(F.max("o_orderdate").alias("m")).first()["m"]
    cutoff = F.lit(anchor).cast("timestamp_ntz") - F.make_ym_interval(F.lit(0), F.lit(6))
    return (o.filter(F.col("o_orderdate") >= cutoff)
            .select("o_orderkey", "o_orderdate", "o_totalprice"))


def q_sql_over_view(spark, sf):
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS order_count,
               sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total_price
        FROM {orders} GROUP BY o_orderpriority""", orders=load(spark, sf, "orders"))


def q_column_sum(spark, sf):
    l = load(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    row_total = price + price * F.col("l_tax").cast("decimal(15,2)")
    return l.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(price).alias("sum_price"), F.sum(row_total).alias("sum_price_with_tax"))


def q_conditional_status(spark, sf):
    o = load(spark, sf, "orders")
    state = (F.when(F.col("o_orderstatus") == "F", "fulfilled")
             .when(F.col("o_orderstatus") == "O", "open").otherwise("partial"))
    size = (F.when(F.col("o_totalprice") >= 300000, "large")
            .when(F.col("o_totalprice") >= 100000, "medium").otherwise("small"))
    return o.select("o_orderkey", state.alias("order_state"), size.alias("size_class"))


def q_limit_preview(spark, sf):
    return (load(spark, sf, "orders")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
            .orderBy("o_orderkey").limit(5))


def q_global_sort(spark, sf):
    return (load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")))


def q_row_count(spark, sf):
    parts = [load(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count")
             for t in ("orders", "lineitem", "customer")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_distinct_count(spark, sf):
    return (load(spark, sf, "orders").select("o_custkey").distinct()
            .agg(F.count(F.lit(1)).alias("distinct_customers")))


def q_group_count_distinct(spark, sf):
    return (load(spark, sf, "orders").groupBy("o_orderpriority")
            .agg(F.count_distinct("o_custkey").alias("ids")).orderBy(F.desc("ids")))


def q_group_having(spark, sf):
    return (load(spark, sf, "orders").groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("order_count")).filter(F.col("order_count") > 15))


def q_show_duplicates(spark, sf):
    return dedupe.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_remove_duplicates(spark, sf):
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_quantity")
    return dedupe.remove_duplicates(l, ["l_orderkey", "l_linenumber"])


def q_merge_multimap(spark, sf):
    """Two key->value maps merged into key->sorted distinct values.

    Map 1: customer -> market segment; map 2: customer -> highest order
    priority.  Each key holds at most one value per map, so the collected set
    is bounded by the number of maps.
    """
    m1 = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    m2 = (load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k"))
          .agg(F.max("o_orderpriority").alias("v")))
    return (m1.unionByName(m2).groupBy("k")
            .agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("vals"),
                 F.count_distinct("v").alias("n_values")))


def q_reduce_by_key(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("total_quantity"), F.count(F.lit(1)).alias("line_count"))


def q_second_extremes(spark, sf):
    e = ranking.extremes(load(spark, sf, "customer"), "c_acctbal", 2)
    return e.withColumn("pos", F.col("pos").cast("bigint"))


def q_reconcile_counts(spark, sf):
    """Orders per status (source) against statuses derived from the lines.

    An order is F when all its lines are F, O when all are O, else P.  Both
    sides are grouped counts; a full outer join lines them up with the
    difference.
    """
    src = load(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("source_orders"))
    per_order = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_linestatus").alias("lo"), F.max("l_linestatus").alias("hi"))
    derived = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit("P"))
    tgt = per_order.groupBy(derived.alias("status")).agg(F.count(F.lit(1)).alias("target_orders"))
    j = src.join(tgt, "status", "full_outer").na.fill(0, ["source_orders", "target_orders"])
    # scalar from a query as a scalar subquery (no collect to the driver)
    total = load(spark, sf, "orders").agg(F.count(F.lit(1))).scalar()
    return j.select("status", "source_orders", "target_orders",
                    (F.col("source_orders") - F.col("target_orders")).alias("difference"),
                    total.alias("total_orders"))


def _employees(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey",
                                           F.col("c_acctbal").alias("salary"))
    n = load(spark, sf, "nation").select("n_nationkey", "n_name")
    return c, n


def q_reconcile_rows(spark, sf):
    """Orders against what their lines say of them: order by order, the status
    that the lines give and whether the lines were shipped after the order.
    Names the orders without lines and those whose status or date differ."""
    src = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(False).alias("early"))
    lines = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linestatus").alias("lo"), F.max("l_linestatus").alias("hi"), F.min("l_shipdate").alias("first"))
    early = F.col("first") < F.lit("1996-01-01").cast("timestamp_ntz")
    tgt = lines.select("o_orderkey", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("P").alias("o_orderstatus"),
                       early.alias("early"))
    return reconcile.reconcile(src, tgt, ["o_orderkey"], ["o_orderstatus", "early"])


def _ledger(lines, parts):
    """Line quantities by part and supplier node, as the source states them."""
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_linestatus")


def q_reconcile_returns(spark, sf):
    """Lines against the stock ledger that leaves out promotional parts and
    counts returned lines of one supplier at zero: few ranges differ when few
    lines do."""
    lines, parts = load(spark, sf, "lineitem"), load(spark, sf, "part")
    source = _ledger(lines, parts)
    returned = (F.col("l_returnflag") == "R") & (F.col("l_suppkey") == 7)
    stated = lines.withColumn("l_quantity", F.when(returned, F.lit(0.0)).otherwise(F.col("l_quantity")))
    target = _ledger(stated, parts.where(~F.col("p_type").eqNullSafe("PROMO")))
    return reconcile.reconcile(source, target, ["l_orderkey", "l_linenumber"],
                               ["l_suppkey", "l_partkey", "l_quantity", "l_linestatus"])


# The ship quarter that is read back from the clustered table.
QUARTER = ("1997-04-01", "1997-07-01")


def clustered_lines(spark, sf):
    """Where the lines lie, written in the order of their ship date."""
    path = scratch_path(spark, "lineitem-clustered")
    lines = load(spark, sf, "lineitem").withColumn("ship_date", F.col("l_shipdate").cast("date"))
    sinks.write_clustered(lines, path, ["ship_date", "l_orderkey", "l_linenumber"], partitions=16)
    return path


def q_clustered_range_read(spark, sf):
    """One quarter's lines read back from a table clustered by ship date: the
    filter reaches the scan, which skips the files of other dates (O2, O4)."""
    lo, hi = (F.lit(d).cast("date") for d in QUARTER)
    lines = spark.read.parquet(clustered_lines(spark, sf)).where((F.col("ship_date") >= lo) & (F.col("ship_date") < hi))
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")


def q_join_filter_dimension(spark, sf):
    c, n = _employees(spark, sf)
    hr = n.filter(F.col("n_name") == "NATION_7")
    return joins.join_dimension(c, hr, c.c_nationkey == hr.n_nationkey).select(
        "c_custkey", "c_name", "salary", "n_name")


def q_cte_join_nth_highest(spark, sf):
    c, n = _employees(spark, sf)
    j = joins.join_dimension(c, n, c.c_nationkey == n.n_nationkey)
    return ranking.nth_highest(j, "salary", 10, "rank").select("salary")


def q_nth_highest_rank(spark, sf):
    c, _ = _employees(spark, sf)
    return ranking.nth_highest(c, "salary", 3, "rank").select("salary")


def q_nth_row_number(spark, sf):
    c, _ = _employees(spark, sf)
    return ranking.nth_highest(c, "salary", 10, "row_number", tie_break=["c_custkey"]).select(
        "c_custkey", "salary")


def q_top3_per_group(spark, sf):
    c, _ = _employees(spark, sf)
    return ranking.top_n_per_group(c, ["c_nationkey"], "salary", 3, "dense_rank").select(
        "c_nationkey", "c_custkey", "salary", F.col("rnk").cast("bigint").alias("rnk"))


def q_pair_connections(spark, sf):
    """Connections among the customers of each nation: n(n-1)/2."""
    return joins.connection_counts(load(spark, sf, "customer"), "c_nationkey", "c_custkey")


# Fixed value: the date splitting the known node set from the added one.
DELTA_ANCHOR = "1998-01-01"


def q_pair_connections_delta(spark, sf):
    """Per order priority: customers ordering before the anchor are the known
    nodes, customers first seen from the anchor on are added; new
    connections = k*n + k(k-1)/2."""
    o = load(spark, sf, "orders").select("o_orderpriority", "o_custkey", "o_orderdate")
    before = F.col("o_orderdate") < F.lit(DELTA_ANCHOR).cast("timestamp_ntz")
    return joins.added_connection_counts(o.filter(before), o.filter(~before),
                                         "o_orderpriority", "o_custkey")


# The first and last rate-version year and the yearly rate step
# (percent); the first version is open at its start, the last at its end.
VERSION_YEARS = (1992, 2002)
VERSION_STEP_PCT = 1


def rate_versions(supplier):
    """Yearly supplier rate versions: ``[Jan 1, next Jan 1)`` per supplier,
    without a start for the first and without an end for the last.

    An effective-dated dimension (SCD2-style): a few versions per supplier,
    so it stays a small fraction of the fact table.
    """
    y = F.explode(F.sequence(F.lit(VERSION_YEARS[0]), F.lit(VERSION_YEARS[1]))).alias("yr")
    s = supplier.select("s_suppkey", "s_acctbal", y)
    factor = (F.lit(100) + (F.col("yr") - VERSION_YEARS[0]) * VERSION_STEP_PCT).cast("decimal(5,0)") / 100
    return s.select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("yr") > VERSION_YEARS[0], F.make_date("yr", F.lit(1), F.lit(1))).alias("effective_start_date"),
        F.when(F.col("yr") < VERSION_YEARS[1], F.make_date(F.col("yr") + 1, F.lit(1), F.lit(1)))
        .alias("effective_end_date"),
        (F.col("s_acctbal").cast("decimal(12,2)") * factor.cast("decimal(5,2)")).alias("supplier_rate"))


def q_effective_dated_join(spark, sf):
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                          F.col("l_shipdate").cast("date").alias("ship_date"))
    v = rate_versions(load(spark, sf, "supplier"))
    return joins.effective_dated_join(l, v, "l_suppkey", "ship_date").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "effective_start_date", "supplier_rate")


def q_effective_dated_sweep(spark, sf):
    """The same join with the versions taken for too large to broadcast."""
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                          F.col("l_shipdate").cast("date").alias("ship_date"))
    v = rate_versions(load(spark, sf, "supplier"))
    return joins.effective_dated_join(l, v, "l_suppkey", "ship_date", max_bytes=0).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "effective_start_date", "supplier_rate")


def _items(spark, sf):
    e = ev.release_events(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    items = F.col("data.releaseEventDetails.releaseItems")
    return e.filter(F.size(items) > 0).select(
        F.col("data.releaseEventDetails.id").alias("release_id"), items.alias("items"))


def q_array_transform(spark, sf):
    r = _items(spark, sf)
    doubled = F.transform("items", lambda x: x["quantity"] * 2)
    return r.select("release_id",
                    F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("doubled_quantity"),
                    F.size(F.filter("items", lambda x: x["quantity"] > 20)).cast("bigint").alias("large_lines"))


def q_array_flatten_distinct(spark, sf):
    from orderloom.operators.explode import flatten_distinct
    r = _items(spark, sf)
    nested = F.transform("items", lambda x: F.array(x["quantity"], x["orderLineNumber"].cast("int")))
    return r.select("release_id", F.array_join(flatten_distinct(nested), ",").alias("values"))


QUERIES = {
    "filter_rows": q_filter_rows,
    "last_six_months": q_last_six_months,
    "sql_over_view": q_sql_over_view,
    "column_sum": q_column_sum,
    "conditional_status": q_conditional_status,
    "limit_preview": q_limit_preview,
    "global_sort": q_global_sort,
    "row_count": q_row_count,
    "distinct_count": q_distinct_count,
    "group_count_distinct": q_group_count_distinct,
    "group_having": q_group_having,
    "show_duplicates": q_show_duplicates,
    "remove_duplicates": q_remove_duplicates,
    "merge_multimap": q_merge_multimap,
    "reduce_by_key": q_reduce_by_key,
    "second_extremes": q_second_extremes,
    "reconcile_counts": q_reconcile_counts,
    "reconcile_rows": q_reconcile_rows,
    "reconcile_returns": q_reconcile_returns,
    "clustered_range_read": q_clustered_range_read,
    "join_filter_dimension": q_join_filter_dimension,
    "cte_join_nth_highest": q_cte_join_nth_highest,
    "nth_highest_rank": q_nth_highest_rank,
    "nth_row_number": q_nth_row_number,
    "top3_per_group": q_top3_per_group,
    "pair_connections": q_pair_connections,
    "pair_connections_delta": q_pair_connections_delta,
    "effective_dated_join": q_effective_dated_join,
    "effective_dated_sweep": q_effective_dated_sweep,
    "array_transform": q_array_transform,
    "array_flatten_distinct": q_array_flatten_distinct,
}

_NODES = """
WITH known AS (SELECT DISTINCT o_orderpriority AS g, o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
added AS (SELECT DISTINCT o_orderpriority AS g, o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
fresh AS (SELECT * FROM added a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.g = a.g AND k.k = a.k)),
nk AS (SELECT g, count(*) AS n FROM known GROUP BY g),
nf AS (SELECT g, count(*) AS k FROM fresh GROUP BY g)"""

ORACLES = {
    "filter_rows": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
    "last_six_months": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 6 MONTH""",
    "sql_over_view": """SELECT o_orderpriority, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total_price
FROM orders GROUP BY o_orderpriority""",
    "column_sum": """SELECT l_returnflag, l_linestatus,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS sum_price,
  sum(CAST(l_extendedprice AS DECIMAL(15,2)) + CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)))
    AS sum_price_with_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "conditional_status": """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE 'partial' END AS order_state,
  CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END
    AS size_class
FROM orders""",
    "limit_preview": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders ORDER BY o_orderkey LIMIT 5""",
    "global_sort": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
    "row_count": """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer""",
    "distinct_count": "SELECT count(DISTINCT o_custkey) AS distinct_customers FROM orders",
    "group_count_distinct": """SELECT o_orderpriority, count(DISTINCT o_custkey) AS ids FROM orders
GROUP BY o_orderpriority ORDER BY ids DESC""",
    "group_having": """SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey
HAVING count(*) > 15""",
    "show_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "remove_duplicates": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
WHERE rn = 1""",
    "merge_multimap": """WITH u AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer
  UNION ALL SELECT o_custkey, max(o_orderpriority) FROM orders GROUP BY o_custkey)
SELECT k, array_to_string(list_sort(list(DISTINCT v)), ',') AS vals, count(DISTINCT v) AS n_values
FROM u GROUP BY k""",
    "reduce_by_key": """SELECT l_suppkey, sum(l_quantity) AS total_quantity, count(*) AS line_count
FROM lineitem GROUP BY l_suppkey""",
    "second_extremes": """WITH v AS (SELECT DISTINCT c_acctbal FROM customer WHERE c_acctbal IS NOT NULL)
SELECT 'max' AS kind, pos, value FROM (SELECT c_acctbal AS value,
  row_number() OVER (ORDER BY c_acctbal DESC) AS pos FROM v) WHERE pos <= 2
UNION ALL
SELECT 'min', pos, value FROM (SELECT c_acctbal AS value,
  row_number() OVER (ORDER BY c_acctbal ASC) AS pos FROM v) WHERE pos <= 2""",
    "reconcile_counts": """WITH src AS (SELECT o_orderstatus AS status, count(*) AS source_orders FROM orders GROUP BY 1),
per AS (SELECT l_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS status
        FROM lineitem GROUP BY l_orderkey),
tgt AS (SELECT status, count(*) AS target_orders FROM per GROUP BY status)
SELECT COALESCE(src.status, tgt.status) AS status, COALESCE(source_orders, 0) AS source_orders,
  COALESCE(target_orders, 0) AS target_orders,
  COALESCE(source_orders, 0) - COALESCE(target_orders, 0) AS difference,
  (SELECT count(*) FROM orders) AS total_orders
FROM src FULL OUTER JOIN tgt ON src.status = tgt.status""",
    "clustered_range_read": """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-04-01' AND l_shipdate < TIMESTAMP '1997-07-01'""",
    "join_filter_dimension": """SELECT c_custkey, c_name, c_acctbal AS salary, n_name FROM customer e
JOIN nation d ON e.c_nationkey = d.n_nationkey WHERE d.n_name = 'NATION_7'""",
    "cte_join_nth_highest": """WITH ranked AS (SELECT e.c_acctbal AS salary,
  rank() OVER (ORDER BY e.c_acctbal DESC) AS salary_rank
  FROM customer e JOIN nation d ON e.c_nationkey = d.n_nationkey)
SELECT salary FROM ranked WHERE salary_rank = 10""",
    "nth_highest_rank": """SELECT salary FROM (SELECT c_acctbal AS salary,
  rank() OVER (ORDER BY c_acctbal DESC) AS rnk FROM customer) WHERE rnk = 3""",
    "nth_row_number": """SELECT c_custkey, salary FROM (SELECT c_custkey, c_acctbal AS salary,
  row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn = 10""",
    "top3_per_group": """SELECT * FROM (SELECT c_nationkey, c_custkey, c_acctbal AS salary,
  dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rnk FROM customer)
WHERE rnk <= 3""",
    "pair_connections": """SELECT c_nationkey, count(DISTINCT c_custkey) AS node_count,
  count(DISTINCT c_custkey) * (count(DISTINCT c_custkey) - 1) // 2 AS connections
FROM customer GROUP BY c_nationkey""",
    "pair_connections_delta": f"""{_NODES}
SELECT COALESCE(nk.g, nf.g) AS o_orderpriority, COALESCE(n, 0) AS known_nodes, COALESCE(k, 0) AS new_nodes,
  COALESCE(k, 0) * COALESCE(n, 0) + COALESCE(k, 0) * (COALESCE(k, 0) - 1) // 2 AS new_connections
FROM nk FULL OUTER JOIN nf ON nk.g = nf.g""",
    "effective_dated_join": """SELECT l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN yr > 1992 THEN make_date(yr, 1, 1) END AS effective_start_date,
  CAST(CAST(s_acctbal AS DECIMAL(12,2)) * CAST((100 + (yr - 1992)) / 100 AS DECIMAL(5,2))
    AS DECIMAL(18,4)) AS supplier_rate
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN range(1992, 2003) AS r(yr) ON (yr = 1992 OR CAST(l_shipdate AS DATE) >= make_date(yr, 1, 1))
  AND (yr = 2002 OR CAST(l_shipdate AS DATE) < make_date(yr + 1, 1, 1))""",
    "array_transform": """SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id,
  CAST(sum(CAST(l_quantity AS INTEGER) * 2) AS BIGINT) AS doubled_quantity,
  count(*) FILTER (WHERE CAST(l_quantity AS INTEGER) > 20) AS large_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l_orderkey, l_suppkey""",
    "array_flatten_distinct": """SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id,
  array_to_string(list_sort(list_distinct(flatten(list([CAST(l_quantity AS INTEGER), l_linenumber])))), ',') AS "values"
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l_orderkey, l_suppkey""",
}
ORACLES["effective_dated_sweep"] = ORACLES["effective_dated_join"]

ORACLES["reconcile_rows"] = """WITH t AS (
  SELECT l_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS s,
         min(l_shipdate) < TIMESTAMP '1996-01-01' AS early
  FROM lineitem GROUP BY l_orderkey),
s AS (SELECT o_orderkey, o_orderstatus, false AS early FROM orders)
SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey,
  CASE WHEN l_orderkey IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status,
  CAST(o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(l_orderkey IS NOT NULL AS BIGINT) AS target_rows,
  concat_ws(',', CASE WHEN o_orderstatus <> s THEN 'o_orderstatus' END, CASE WHEN s.early <> t.early THEN 'early' END) AS changed_columns
FROM s FULL OUTER JOIN t ON o_orderkey = l_orderkey
WHERE l_orderkey IS NULL OR o_orderkey IS NULL OR o_orderstatus <> s OR s.early <> t.early"""

# Lines that repeat a key (order, line number) count as one set: a key is
# compared by its sorted rows, its columns by their sorted values.
ORACLES["reconcile_returns"] = """WITH
src AS (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p, l_quantity AS q, l_linestatus AS t
        FROM lineitem JOIN part ON l_partkey = p_partkey),
tgt AS (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p,
               CASE WHEN l_returnflag = 'R' AND l_suppkey = 7 THEN 0.0 ELSE l_quantity END AS q, l_linestatus AS t
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IS DISTINCT FROM 'PROMO'),
a AS (SELECT k, n, count(*) AS c, list_sort(list((s, p, q, t))) AS r, list_sort(list(s)) AS s, list_sort(list(p)) AS p,
             list_sort(list(q)) AS q, list_sort(list(t)) AS t FROM src GROUP BY k, n),
b AS (SELECT k, n, count(*) AS c, list_sort(list((s, p, q, t))) AS r, list_sort(list(s)) AS s, list_sort(list(p)) AS p,
             list_sort(list(q)) AS q, list_sort(list(t)) AS t FROM tgt GROUP BY k, n)
SELECT coalesce(a.k, b.k) AS l_orderkey, coalesce(a.n, b.n) AS l_linenumber,
  CASE WHEN b.c IS NULL THEN 'missing' WHEN a.c IS NULL THEN 'extra' ELSE 'changed' END AS status,
  coalesce(a.c, 0) AS source_rows, coalesce(b.c, 0) AS target_rows,
  concat_ws(',', CASE WHEN a.s <> b.s THEN 'l_suppkey' END, CASE WHEN a.p <> b.p THEN 'l_partkey' END,
            CASE WHEN a.q <> b.q THEN 'l_quantity' END, CASE WHEN a.t <> b.t THEN 'l_linestatus' END) AS changed_columns
FROM a FULL OUTER JOIN b ON a.k = b.k AND a.n = b.n
WHERE a.r IS DISTINCT FROM b.r"""
