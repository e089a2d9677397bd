"""Latest-wins upsert into a Parquet table, batch or per micro-batch.

The table is stored partitioned by a key-hash bucket.  One upsert reads only
the buckets the incoming batch touches, keeps the newest row per primary key
over (stored rows + batch), and replaces just those bucket folders through a
dynamic partition overwrite.  Cost per batch is O(batch + touched buckets); a
batch of random keys that has more rows than there are buckets touches them
all, so it costs the table.

The number of buckets follows the stored rows: a table starts with what its
first batch needs and, when it has outgrown its buckets, is written anew with
more of them (``rebucket``): the new layout aside, then one appended line in
``_layout`` makes it the current one, so a run that is lost in between leaves
the old one in force.  Each layout but the first is a hidden folder of the
table; read the table with ``read_current``.

Ordering: a larger sort value wins; a null sort value loses to any dated
row; on equal sort values the tie-break columns decide, then the later batch.
Keys match null-safely (grouping treats nulls as equal, K17).

Replay safety: re-applying the same batch yields the same table (latest-wins
is idempotent and the batch id is part of the ordering), so a micro-batch
retried after an executor or driver failure cannot duplicate or regress rows.
A lost executor only costs task retries: the batch is persisted for its two
uses and recomputes from the micro-batch's fixed input if blocks are lost;
the write goes through Spark's staging folder, and only the job commit swaps
the bucket folders, so the folders being replaced are read only before they
change.  The commit itself swaps folder by folder (not atomically across
buckets); a table format with transactional MERGE closes that window where
one is installed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.dedupe import latest_per_key

BATCH_COL = "_batch_id"
BUCKET_COL = "_bucket"
NBUCKETS_COL = "_n_buckets"
# Rows that a bucket is meant to hold; a table with ``GROWTH`` times as many
# gets that many times the buckets.
ROWS_PER_BUCKET = 1 << 20
GROWTH = 4
# Folders that a table has at most; beyond, its buckets grow with it.  Each
# upsert of random keys writes to every folder.
MAX_BUCKETS = 1024
LAYOUT = "_layout"
_LAYOUT_SCHEMA = "gen int, folder string"


def _layout(spark: SparkSession, path: str) -> tuple[int, str]:
    """Number and folder of the current layout; the first is ``path`` itself."""
    try:
        rows = spark.read.schema(_LAYOUT_SCHEMA).json(f"{path}/{LAYOUT}")
        last = rows.agg(F.max(F.struct("gen", "folder")).alias("m")).select("m.*").first()
    except AnalysisException:
        return 0, path
    return (0, path) if last["gen"] is None else (last["gen"], f"{path}/{last['folder']}")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_layout(spark, path)[1])
    except AnalysisException:
        return None


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Buckets of a table, None for one without rows."""
    stored = read_table(spark, path)
    seen = stored.select(NBUCKETS_COL).limit(1).collect() if stored is not None else []
    return seen[0][0] if seen else None


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The power of ``GROWTH`` that gives buckets of at most so many rows, or
    ``MAX_BUCKETS``."""
    n = 1
    while n < MAX_BUCKETS and n * rows_per_bucket < rows:
        n *= GROWTH
    return n


def _write(rows: DataFrame, folder: str, keys: Sequence[str], files_per_folder: int) -> None:
    """Replace the bucket folders that ``rows`` fall into.  Rows are clustered
    by folder; AQE merges small shuffle partitions back together."""
    spread = [F.col(BUCKET_COL)]
    if files_per_folder > 1:
        spread.append(F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(7)), F.lit(files_per_folder)))
    (rows.repartition(*spread).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL).parquet(folder))


def _files_per_folder(spark: SparkSession, folders: int) -> int:
    """As many writers a folder as keep every shuffle partition busy."""
    return max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, folders)))


def rebucket(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write the table with another number of buckets and make that layout
    the current one.  The old layout stays as it is (readers may be on it)."""
    gen, folder = _layout(spark, path)
    new = f"_gen-{gen + 1}-{uuid.uuid4().hex[:8]}"
    rows = spark.read.parquet(folder).withColumns({BUCKET_COL: bucket_of(keys, buckets),
                                                   NBUCKETS_COL: F.lit(buckets).cast("int")})
    _write(rows, f"{path}/{new}", keys, _files_per_folder(spark, buckets))
    spark.createDataFrame([(gen + 1, new)], _LAYOUT_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{LAYOUT}")


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as users see it (internal columns removed)."""
    t = read_table(spark, path)
    if t is None:
        return None
    return t.drop(BATCH_COL, BUCKET_COL, NBUCKETS_COL)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table, so that readers find it before the first batch."""
    if read_table(spark, path) is None:
        stored = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.LongType()),
                               T.StructField(NBUCKETS_COL, T.IntegerType())])
        spark.createDataFrame([], stored).write.parquet(f"{path}/{BUCKET_COL}=0")


def upsert(batch: DataFrame, path: str, keys: Sequence[str], sort_col: str,
           batch_id: int, tie_break: Sequence[str] = (),
           buckets: int | None = None, files_per_folder: int | None = None,
           rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Merge ``batch`` into the table at ``path`` (latest wins per key).

    ``buckets`` fixes the number of buckets (a table with another one is
    refused); by default it follows the stored rows.  ``files_per_folder``
    fixes how many tasks write a bucket; by default all shuffle partitions
    share the touched buckets.
    """
    spark = batch.sparkSession
    b = batch.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = bucket_count(spark, path)
        if buckets is not None and count not in (None, buckets):
            raise ValueError(f"table at {path} has {count} buckets, upsert asked for {buckets}")
        if buckets is None:
            rows = b.count() if count is None else read_table(spark, path).count()
            buckets = max(buckets_for(rows, rows_per_bucket), count or 1)
            if count is not None and buckets > count:
                rebucket(spark, path, keys, buckets)
        # the bucket count travels with every row (one run-length-encoded int),
        # so an upsert with another count -- which would place a key in a
        # different folder and duplicate it -- is seen
        b2 = b.withColumns({BUCKET_COL: bucket_of(keys, buckets), NBUCKETS_COL: F.lit(buckets).cast("int")})
        # touched folders: at most ``buckets`` numbers
        touched = [r[0] for r in b2.select(BUCKET_COL).distinct().collect()]
        if not touched:
            return
        stored = read_table(spark, path)
        merged = b2 if stored is None else stored.filter(F.col(BUCKET_COL).isin(touched)).unionByName(b2)
        latest = latest_per_key(merged, keys, sort_col, [*tie_break, BATCH_COL])
        _write(latest, _layout(spark, path)[1], keys, files_per_folder or _files_per_folder(spark, len(touched)))
    finally:
        b.unpersist()


def upsert_writer(path: str, keys: Sequence[str], sort_col: str,
                  tie_break: Sequence[str] = (), buckets: int | None = None,
                  prepare=None, files_per_folder: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET):
    """``foreachBatch`` callback; ``prepare(batch_df, batch_id)`` runs first if given."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        df = prepare(batch_df, batch_id) if prepare is not None else batch_df
        if "epoch_id" in df.columns:  # audit column: the micro-batch id
            df = df.withColumn("epoch_id", F.lit(batch_id).cast("bigint"))
        upsert(df, path, keys, sort_col, batch_id, tie_break, buckets, files_per_folder, rows_per_bucket)
    return write
