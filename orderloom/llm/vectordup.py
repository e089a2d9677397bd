"""Near-duplicate embeddings by spherical-cap filters (operator 7).

Directions of filters are a structured random product code: a rotated vector
is cut into ``BLOCKS`` parts, each part has ``CODES`` random directions, and
every choice of one direction a part is a filter.  A vector's cap is its
``LISTED``-th largest product with a filter, and it is listed at all filters
that reach its cap (one cap for all would leave vectors between the random
directions with empty lists); list decoding sorts the sums of two halves of
the parts and pairs only those that can be among so many.
Vectors that share a label and a filter meet, and each pair is verified by
cosine in double precision.  A pair counts at its first common filter only.

Equal vectors of a label are one node with a multiplicity.  A filter's
members are compared in blocks of ``GROUP``, a task for each two blocks, so
no task holds a whole hot filter; what leaves a task is one row a member,
not its pairs.

The search is approximate in one way: a pair is missed if no filter holds
both; tests measure the recall against brute force.

Defined cases: null, zero, empty vectors and vectors with null or non-finite
components, and vectors whose label is null, link with nothing; vectors of
different lengths link with nothing of another length; repeated rows link as
equal vectors; a null vec_id is never a component's id unless it has no
other.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.llm.components import connected

COSINE = 0.98
BLOCKS = 4
CODES = 32
LISTED = 16
GROUP = 1024


class ProductCode:
    """Filters for vectors of one length."""

    def __init__(self, dim: int):
        rng = np.random.default_rng(20240601)
        self.width = -(-max(dim, BLOCKS) // BLOCKS)
        full = self.width * BLOCKS
        self.turn = np.linalg.qr(rng.standard_normal((full, full)))[0][:dim]
        self.codes = rng.standard_normal((BLOCKS, CODES, self.width))

    def filters(self, unit: np.ndarray) -> np.ndarray:
        """Ids of the filters that a unit vector exceeds, sorted."""
        parts = (unit @ self.turn).reshape(BLOCKS, self.width)
        products = np.einsum("bcw,bw->bc", self.codes, parts)
        half = BLOCKS // 2
        left = _sums(products[:half])
        right = _sums(products[half:])
        best_left, best_right = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        # The pair of ranks i and j is behind (i + 1) * (j + 1) - 1 others at least.
        i, j = _RANKS
        ok = (i < len(left)) & (j < len(right))
        a, b = best_left[i[ok]], best_right[j[ok]]
        total, ids = left[a] + right[b], a * len(right) + b
        return np.sort(ids[np.lexsort((ids, -total))[:LISTED]])


_RANKS = tuple(np.array([(i, j) for i in range(LISTED) for j in range(LISTED // (i + 1))]).T)


def _sums(products: np.ndarray) -> np.ndarray:
    """Sums of one product of each part, by the index of the choice."""
    total = products[0]
    for row in products[1:]:
        total = (total[:, None] + row[None, :]).ravel()
    return total


def _valid(column: str, label: str):
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (F.col(label).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (node, dim, v) the list of filters and the unit vector."""
    codes: dict[int, ProductCode] = {}
    for b in batches:
        units, filters = [], []
        for v in b.column(2):
            x = np.array(v.values, dtype=np.float64)
            x /= np.abs(x).max()
            x /= math.sqrt(float(x @ x))
            if len(x) not in codes:
                codes[len(x)] = ProductCode(len(x))
            filters.append(codes[len(x)].filters(x).astype(np.int32))
            units.append(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(units, pa.binary()), pa.array(filters, pa.list_(pa.int32()))],
            names=["node", "dim", "unit", "filters"])


def _links(table: pa.Table) -> pa.Table:
    """One filter and two blocks of its members: for each member with links
    that count here, their number (with multiplicity), and the smallest node
    of its component within the task."""
    first, second = table["x"][0].as_py(), table["y"][0].as_py()
    here = table["filter"][0].as_py()
    node = np.asarray(table["node"])
    block = np.asarray(table["block"])
    mult = np.asarray(table["mult"])
    units = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(len(node), -1)
    near = units @ units.T >= COSINE
    np.fill_diagonal(near, False)
    if first != second:  # pairs inside a block belong to the block's own task
        near &= block[:, None] != block[None, :]
    # Components of what meets here, whether it counts here or not.
    order = np.argsort(node)
    label = np.empty(len(node), np.int64)  # the order of a node's root
    label[order] = np.arange(len(node))
    while True:
        least = np.minimum(label, np.where(near, label[None, :], len(node)).min(axis=1))
        least = least[order[least]]
        if (least == label).all():
            break
        label = least
    # A pair counts at the first filter that both are listed at.
    lists = table["filters"].to_pylist()
    width = max(map(len, lists))
    earlier = np.array([[f if f < here else -1 - k for f in fs] + [-1 - k] * (width - len(fs))
                        for k, fs in enumerate(lists)], np.int64)
    earlier = earlier[:, (earlier >= 0).any(axis=0)]
    i, j = np.nonzero(np.triu(near))
    counts = np.zeros(len(node), np.int64)
    for a in range(0, len(i), 1 << 14):
        p, q = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
        seen = (earlier[p][:, :, None] == earlier[q][:, None, :]).any(axis=(1, 2))
        np.add.at(counts, p[~seen], mult[q[~seen]])
        np.add.at(counts, q[~seen], mult[p[~seen]])
    some = near.any(axis=1)
    return pa.table({"node": pa.array(node[some], pa.int64()), "n": pa.array(counts[some], pa.int64()),
                     "root": pa.array(node[order[label]][some], pa.int64())})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
                          F.col(f"`{label_col}`").alias("label"))
    # -0.0 equals 0.0: one node.
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    node = F.when(_valid("v", "label"), F.xxhash64("label", "v"))
    rows = rows.withColumn("node", node)
    nodes = C.stored(rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("least_id"),
        F.count(F.lit(1)).alias("mult")), "vector-nodes")
    listed = C.stored(nodes.select("node", F.size("v").alias("dim"), "v").mapInArrow(
        _listed, "node long, dim int, unit binary, filters array<int>")
        .join(nodes.select("node", "label", "mult"), "node"), "vector-filters")
    at = listed.select("node", "label", "dim", F.explode("filters").alias("filter"))
    groups = C.stored(at.groupBy("label", "dim", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "label", "dim", "filter", F.ceil(F.col("n") / GROUP).cast("int").alias("blocks")), "vector-groups")
    met = at.join(groups, ["label", "dim", "filter"]).withColumn(
        "block", F.pmod(F.xxhash64("node", "filter"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.join(listed.select("node", "unit", "mult", "filters"), "node").select(
        "label", "dim", "filter", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "node", "block", "mult", "unit", "filters")
    found = C.stored(met.groupBy("label", "dim", "filter", "x", "y").applyInArrow(
        _links, "node long, n long, root long"), "vector-links")
    degree = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = C.stored(connected(found.select(F.col("node").alias("u"), F.col("root").alias("v"))), "vector-roots")
    known = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = C.stored(known.join(least, "root").join(degree, "node", "left").select(
        "node", "component_id", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "vector-classes")
    return rows.select("vec_id", "node").join(known, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long")
        .alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark)
    return near_duplicates(C.read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_vector_duplicates": op7_vector_duplicates}

ORACLES = {"op7_vector_duplicates": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e, len(e) AS dim, list_dot_product(e, e) AS sq FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(a.sq) * sqrt(b.sq)) >= 0.98),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION
  SELECT r.node, l.b FROM reach r JOIN link l ON r.seen = l.a),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c ON c.node = v.vec_id LEFT JOIN deg d ON d.a = v.vec_id
"""}
