"""Centroid clustering by dimension-sharded Lloyd rounds (operator 12).

Vectors become rows of integers, so every result is exact and does not
depend on how rows are spread.  They are written once as chunks of ``CHUNK``
vectors, each chunk cut into blocks of ``block_dims`` columns.  In a round

* a task of a column block knows that block's slice of the centroids only and
  gives, for each chunk, the exact partial distance of every vector to every
  slice;
* the partial distances of a chunk's blocks are added by the chunk's number,
  and the sums' argmin assigns its vectors;
* every column block adds up its own columns by cluster (combined in each
  task before the shuffle) and updates its own slice.

The driver holds the centroids (clusters x dimensions numbers, set by
parameters) and nothing that grows with the rows.  Chunks are of one size,
so no cluster or vector can make a task large.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components are left out; with fewer vectors than clusters every
vector is a centroid at the start; repeated rows are kept and weigh as many;
of equal ids the smaller vector comes first at the start, a null id is hashed
as an empty text; component integers beyond ``LIMIT`` in size count as it,
so that a distance fits a long; sums of distances that do not fit are null;
an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.session import scratch_path

CHUNK = 256
BLOCK_DIMS = 32
LIMIT = 1 << 27
# Products of integers below it are exact in double precision.
_EXACT = 1 << 20


def kept_vectors(vectors: DataFrame, dims: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the vectors that take part; x is an array of doubles."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where((F.size("x") == dims) & finite)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 * x), within ``LIMIT``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256.0 * x), -LIMIT, LIMIT).astype(np.int32)


def _chunks(rows: DataFrame, dims: int, block_dims: int) -> DataFrame:
    """(chunk, ids, data, block): a row for each column block of a chunk, and
    one of block -1 with its ids; a stored table, a folder a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                x = integers(np.asarray(part.column(2).flatten()).reshape(-1, dims))
                chunk = (part.column(0)[0].as_py() << 33) + made
                made += 1
                data = [None] + [np.ascontiguousarray(x[:, c:c + block_dims]).tobytes() for c in range(0, dims, block_dims)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(data), pa.int64()),
                     pa.array([part.column(1).to_pylist()] + [None] * (len(data) - 1), pa.list_(pa.int64())),
                     pa.array(data, pa.binary()), pa.array(range(-1, len(data) - 1), pa.int32())],
                    names=["chunk", "ids", "data", "block"])

    schema = "chunk long, ids array<long>, data binary, block int"
    path = scratch_path(rows.sparkSession, "lloyd-chunks")
    rows.select(F.spark_partition_id().alias("part"), "id", "x").mapInArrow(run, schema).write.partitionBy("block").parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to rows of c."""
    small = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < _EXACT
    a, b = (x.astype(np.float64), c.astype(np.float64)) if small else (x.astype(np.int64), c.astype(np.int64))
    if small:
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)


def _partial(blocks: DataFrame, block: int, centroids: np.ndarray) -> DataFrame:
    """(chunk, partial): distances of a column block to its centroid slice."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_squared(np.frombuffer(d.as_buffer(), np.int32).reshape(-1, width), centroids).tobytes()
                   for d in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["chunk", "partial"])

    return blocks.where(F.col("block") == block).select("chunk", "data").mapInArrow(run, "chunk long, partial binary")


def _assigned(blocks: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """(chunk, cluster, distance) of every chunk: int32 and int64 arrays."""
    k = len(slices[0])
    partial = reduce(DataFrame.union, [_partial(blocks, j, c) for j, c in enumerate(slices)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = total = None

        def nearest() -> pa.RecordBatch:
            d = total.reshape(-1, k)
            cluster = d.argmin(axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([cluster.astype(np.int32).tobytes()], pa.binary()),
                 pa.array([d[np.arange(len(d)), cluster].tobytes()], pa.binary())], names=["chunk", "cluster", "distance"])

        for b in batches:
            for key, d in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                d = np.frombuffer(d.as_buffer(), np.int64)
                if key == chunk:
                    total = total + d
                    continue
                if chunk is not None:
                    yield nearest()
                chunk, total = key, d
        if chunk is not None:
            yield nearest()

    return (partial.repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(run, "chunk long, cluster binary, distance binary"))


def _sums(blocks: DataFrame, assigned: DataFrame, block: int, k: int, width: int) -> DataFrame:
    """(block, cluster, col, total, n): a task's sums of a column block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for d, c in zip(b.column(0), b.column(1), strict=True):
                cluster = np.frombuffer(c.as_buffer(), np.int32)
                np.add.at(total, cluster, np.frombuffer(d.as_buffer(), np.int32).reshape(-1, width))
                n += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some) * width, block, np.int32)), pa.array(np.repeat(some, width).astype(np.int32)),
             pa.array(np.tile(np.arange(width, dtype=np.int32), len(some))), pa.array(total[some].ravel()),
             pa.array(np.repeat(n[some], width))], names=["block", "cluster", "col", "total", "n"])

    mine = blocks.where(F.col("block") == block).select("chunk", "data").join(assigned.select("chunk", "cluster"), "chunk")
    return mine.select("data", "cluster").mapInArrow(run, "block int, cluster int, col int, total long, n long")


def _updated(blocks: DataFrame, assigned: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """The slices after a round; empty clusters keep their centroid."""
    sums = reduce(DataFrame.union, [_sums(blocks, assigned, j, *c.shape) for j, c in enumerate(slices)])
    means = (sums.groupBy("block", "cluster", "col").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
             .select("block", "cluster", "col", F.expr("(total - pmod(total, n)) div n").alias("mean")))
    new = [c.copy() for c in slices]
    for r in means.collect():  # clusters x dimensions rows
        new[r["block"]][r["cluster"], r["col"]] = r["mean"]
    return new


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2, id_col: str = "vec_id",
              vec_col: str = "embedding", block_dims: int = BLOCK_DIMS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector kept, and the centroids.

    The centroids start as the ``k`` vectors whose ``<seed>:<id>`` has the
    smallest SHA-256.
    """
    spark = vectors.sparkSession
    rows = kept_vectors(vectors, dims, id_col, vec_col)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64)
    start = integers(np.array([r["x"] for r in first])).astype(np.int64)
    slices = [start[:, c:c + block_dims] for c in range(0, dims, block_dims)]
    blocks = _chunks(rows, dims, block_dims)
    for _ in range(rounds):
        slices = _updated(blocks, C.stored(_assigned(blocks, slices), "lloyd-assigned"), slices)
    last = _assigned(blocks, slices)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, distance = (np.frombuffer(b"".join(b.column(i).to_pylist()), t) for i, t in ((1, np.int32), (2, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).flatten(), pa.array(cluster), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    ids = blocks.where("block = -1").select("chunk", "ids")
    found = ids.join(last, "chunk").select("ids", "cluster", "distance").mapInArrow(
        listed, "vec_id long, cluster int, distance long")
    return C.stored(found, "lloyd-found"), np.concatenate(slices, axis=1)


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``clustered``'s rows with inertia by cluster and over all, and a digest
    of the centroid.  One row a cluster is broadcast."""
    import hashlib
    spark = found.sparkSession
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    total = sums.agg(F.sum("s").try_cast("long")).first()[0]
    known = spark.createDataFrame(
        [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string")
    per_cluster = sums.select("cluster", F.col("s").try_cast("long").alias("cluster_inertia")).join(known, "cluster")
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark, C.BATCH_BYTES)
    return with_inertia(*clustered(C.read_table(spark, sf_dir, "embeddings")))


def _oracle(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """The rounds spelled out, one row a vector and dimension."""
    def nearest(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT v.vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{i} c ON v.i = c.i GROUP BY v.vec_id, c.k)
  GROUP BY vec_id)"""

    steps = []
    for i in range(rounds):
        steps += [nearest(i), f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{i} c LEFT JOIN (SELECT a.k, v.i, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n
                        FROM v JOIN a{i} a ON v.vec_id = a.vec_id GROUP BY a.k, v.i) m ON c.k = m.k AND c.i = m.i)"""]
    return f"""
WITH kept AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {dims}),
v AS MATERIALIZED (
  SELECT vec_id, unnest(generate_series(1, {dims})) AS i, CAST(floor(256 * unnest(e)) AS BIGINT) AS x FROM kept),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT s.k, v.i, v.x FROM s JOIN v ON s.vec_id = v.vec_id WHERE s.k < {k}),
{",".join(steps)},
{nearest(rounds)},
sha AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha.h AS centroid_sha256
FROM a{rounds} a JOIN sha ON a.k = sha.k
"""


QUERIES = {"op12_centroids": op12_centroids}
ORACLES = {"op12_centroids": _oracle()}
