"""Uniform sharding by a hypergeometric communication matrix (operator 8),
DataFrame functions only.

Rows lie in hashed cells (the logical input partitions), ``CELLS`` or, beyond
67 million rows, as many as leave about ``CELL_ROWS`` rows each.  The matrix of exact cell-to-shard counts is drawn as a uniform shuffle would give
it, by a splitting tree of multivariate hypergeometric draws; each cell's
rows are permuted and dealt out by their cell's row of the matrix, exchanged,
and permuted again inside their shard.  Shard sizes are exact: row counts
differ by one at most (law ``rows``).  Cells come from hashes of the row's
values, not from where Spark happens to read it, so reruns and recomputed
tasks agree.

The second permutation works on hashed parts of each shard (``SUB_CELLS`` or
more, by the same rule), so a task sorts a cell or a part of a shard, never a
shard.  Rows repeated more often than four even cells hold are told apart
first (``repeats``), so that no cell outgrows the others.

Defined cases: a null text has no bytes; null ids and repeated rows are
placed like any row (equal rows may trade places, which changes nothing);
groups of equal texts are spread like other rows, since the law fixes counts;
an empty table gives no rows.  Other columns stay, whatever their names; one
named like an added column (see ``prefix``) is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.llm.hypergeometric import split
from orderloom.llm.repeats import cell_count, limit, told_apart

SHARDS = 40
CELLS = 1024
SUB_CELLS = 64
PROBES = 1 << 16  # finer than cells, to find keys of many rows
LAW = "rows"


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
           cells: int | None = None, sub_cells: int | None = None, prefix: str = "") -> DataFrame:
    """``docs`` with {prefix}shard and {prefix}slot (gapless from 0).

    ``cells`` and ``sub_cells`` follow from the number of rows where they are
    not given; the result depends on them.
    """
    key = "__key"
    own, names = C.apart(docs)
    n = docs.count()
    cells = cells or cell_count(n, CELLS)
    sub_cells = sub_cells or cell_count(-(-n // shards), SUB_CELLS)
    probes = max(PROBES, cells)
    probe = F.pmod(F.xxhash64(F.lit(seed), F.lit("cell"), key), F.lit(probes)).cast("int")

    def counted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = rows.withColumn("__probe", probe)
        return rows, C.stored(rows.groupBy("__probe").agg(F.count(F.lit(1)).alias("n")), "shard-probes")

    rows, sizes = counted(own.withColumn(key, C.row_key(names[id_col], names[text_col])))
    apart = told_apart(rows, [key], key, "__probe", sizes, limit(n, cells))
    if apart is not None:
        rows, sizes = counted(apart)
    cell = F.pmod(F.col("__probe"), F.lit(cells)).alias("__cell")
    counts = sizes.groupBy(cell).agg(F.sum("n").alias("n"))
    rows = rows.select("*", cell).drop("__probe")
    spark = docs.sparkSession
    leaves = C.stored(spark.range(cells).join(counts, F.col("id") == F.col("__cell"), "left").select(
        F.col("id").alias("leaf"), F.coalesce("n", F.lit(0)).cast("long").alias("n")), "shard-leaves")
    total = F.sum("n")
    sizes = leaves.agg(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: (
        F.floor((s + 1) * total / shards) - F.floor(s * total / shards)).cast("long")).alias("left"))
    # Row c of the matrix: how many rows of cell c go to each shard.
    matrix = C.stored(split(leaves, cells, sizes, seed).select(
        F.col("leaf").cast("int").alias("__cell"),
        F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(
            F.slice("share", F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x)).alias("__upto")),
        "shard-matrix")
    in_cell = Window.partitionBy("__cell").orderBy(F.xxhash64(F.lit(seed), F.lit("first"), key), key)
    dealt = (rows.withColumn("__r", F.row_number().over(in_cell)).join(matrix, "__cell")
             .withColumn("__shard", F.size(F.filter("__upto", lambda x: x < F.col("__r"))))
             .withColumn("__sub", F.pmod(F.xxhash64(F.lit(seed), F.lit("sub"), key), F.lit(sub_cells)).cast("int"))
             .drop("__upto", "__cell", "__r"))
    dealt = C.stored(dealt, "shard-dealt")
    subs = dealt.groupBy("__shard", "__sub").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__shard").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    base = subs.select("__shard", "__sub", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__base"))
    in_sub = Window.partitionBy("__shard", "__sub").orderBy(F.xxhash64(F.lit(seed), F.lit("second"), key), key)
    placed = (dealt.withColumn("__s", F.row_number().over(in_sub) - 1).join(base, ["__shard", "__sub"]))
    return C.with_added(placed, names, {f"{prefix}shard": F.col("__shard"),
                                        f"{prefix}slot": (F.col("__base") + F.col("__s")).cast("long")})


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_table(spark, sf_dir, "documents")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"),
                         F.crc32(raw).alias("text_crc32"))
    return assign(narrow, text_col="text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_shard": op8_shard}
ORACLES: dict[str, str] = {}  # a seeded shuffle: its laws are tested, not its rows
