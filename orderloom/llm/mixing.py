"""Mixing sources to target weights (operator 1), DataFrame functions only.

Every source is a stream of its documents in hashed order, repeated up to
``MAX_REPEATS`` times; the mix takes the first ``target`` words of it.  The
stream is cut into blocks of ``BLOCK_WORDS`` words; a splitting tree of
multivariate hypergeometric draws shares the sources' exact block quotas
among output shards of ``SHARD_BLOCKS`` blocks, each shard takes its disjoint
range of every source's permuted blocks, and its documents are put in random
order.  A document goes where its first word goes and is taken whole.  Of the
document in which a source's quota ends, as much is taken as comes nearer to
the target: all of it if at least half of its words fit, else nothing, so a
source's words miss its target by half of one document at most.

A source's prefix sums are taken over hashed cells (``CELLS``, or as many
more as leave about ``CELL_ROWS`` rows each), so a source with a third of all
rows is spread over as many window partitions; rows repeated more often than
four even cells hold are told apart first (``repeats``).

Defined cases: null and empty texts have size 0 and are not taken; a null
source is a source of its own, last in order; rows that are equal in all
columns are taken independently; an empty table gives an empty mix.  All
columns stay, whatever their names; one named like an added column (see
``prefix``) is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.llm.hypergeometric import split
from orderloom.llm.repeats import cell_count, limit, told_apart

# Fixed by the contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 4096
SHARD_BLOCKS = 256
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """(sid, source, words) with rank, target and take for each source.

    Weights repeat over the sources in code point order.  Targets fill up by
    weight like vessels: in the order of cap / weight, each source is either
    full or gets its part of what the full ones leave.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("rank", F.row_number().over(ordered))
    w = w.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                            F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    w = w.withColumn("cap", F.lit(float(repeats)) * F.col("words"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    w = (w.withColumn("level", (F.lit(share) * F.sum("words").over(every)
                                - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
         .withColumn("open", F.when(F.col("weight") * F.col("level") < F.col("cap"), F.col("level"))))
    # The first source that is not full tells the level of all others.
    w = w.withColumn("final", F.min(F.struct(F.col("open").isNull().alias("n"),
                                             (F.col("cap") / F.col("weight")).alias("r"), F.col("rank").alias("k"),
                                             F.col("open").alias("open"))).over(every)["open"])
    target = F.least("cap", F.coalesce(F.col("weight") * F.col("final"), F.col("cap")))
    return w.select("sid", "source", "words", "rank", F.greatest(target, F.lit(0.0)).alias("target")).withColumn(
        "take", F.round("target").cast("long"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float,
             repeats: int, seed: int) -> DataFrame:
    """``docs`` (its columns set apart) with size, source_size, target, copies
    and key."""
    spark = docs.sparkSession
    source = F.col(source_col)
    n = docs.count()
    cell_number = cell_count(n, CELLS)
    sized = (docs.withColumn("size", word_count(F.col(text_col)))
             .withColumn("sid", F.xxhash64(source, source.isNull()))
             .withColumn("key", F.xxhash64(F.lit(seed), id_col, text_col)))

    def placed_in_cells(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = rows.withColumn("cell", F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(cell_number)).cast("int"))
        return rows, C.stored(rows.groupBy("sid", "cell").agg(
            F.min(source).alias("source"), F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-cells")

    sized, cells = placed_in_cells(sized)
    apart = told_apart(sized, ["sid", "key"], "key", "cell", cells.groupBy("cell").agg(F.sum("n").alias("n")),
                       limit(n, cell_number))
    if apart is not None:
        sized, cells = placed_in_cells(apart.drop("cell"))
    sources = C.stored(targets(cells.groupBy("sid").agg(F.min("source").alias("source"),
                                                        F.sum("words").alias("words")),
                               weights, share, repeats), "mix-sources")
    # Quotas in blocks, and shards of equal numbers of blocks.
    quotas = sources.withColumn("blocks", F.ceil(F.col("take") / F.lit(float(BLOCK_WORDS))).cast("long"))
    blocks = quotas.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    shards = max(1, -(-blocks // SHARD_BLOCKS))
    leaves = spark.range(shards).select(
        F.col("id").alias("leaf"),
        (F.floor((F.col("id") + 1) * F.lit(blocks) / F.lit(shards))
         - F.floor(F.col("id") * F.lit(blocks) / F.lit(shards))).cast("long").alias("n"))
    colours = quotas.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "blocks"))),
                                     lambda x: x["blocks"]).alias("left"))
    dealt = split(leaves, shards, colours, seed)
    owned = (dealt.select(F.col("leaf").alias("shard"), F.posexplode(F.arrays_zip("share", "before")))
             .where(F.col("col.share") > 0)
             .select("shard", (F.col("pos") + 1).alias("rank"), F.explode(F.sequence(
                 F.col("col.before"), F.col("col.before") + F.col("col.share") - 1)).alias("block")))
    owner = owned.join(F.broadcast(quotas.select("sid", "rank")), "rank") if blocks else owned.withColumn(
        "sid", F.lit(0).cast("long"))
    # Where each cell lies in its source's stream, and the shards it meets.
    upto = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("offset", F.coalesce(F.sum("words").over(upto), F.lit(0))).select(
        "sid", "cell", "offset", F.col("words").alias("cell_words"))
    placed = placed.join(sources.select("sid", F.col("words").alias("source_size"), "target", "take"), "sid")

    def cell_blocks(k: Column) -> Column:
        lo = k * F.col("source_size") + F.col("offset")
        hi = F.least(lo + F.col("cell_words"), F.col("take")) - 1
        return F.when(hi >= lo, F.sequence(F.floor(lo / BLOCK_WORDS), F.floor(hi / BLOCK_WORDS))).otherwise(
            F.array().cast("array<bigint>"))

    passes = F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))
    meets = (placed.select("sid", "cell", F.explode(F.array_distinct(F.flatten(F.transform(passes, cell_blocks))))
                           .alias("block")).join(owner.select("sid", "block", "shard"), ["sid", "block"])
             .groupBy("sid", "cell", "shard").agg(F.min("block").alias("block"))
             .groupBy("sid", "cell").agg(F.array_sort(F.collect_list(F.struct("block", "shard"))).alias("ranges")))
    known = C.stored(placed.join(meets, ["sid", "cell"], "left"), "mix-places")
    # Each row's place in its cell; then its words in each pass.
    order = Window.partitionBy("sid", "cell").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("in_cell", F.coalesce(F.sum("size").over(order), F.lit(0))).join(known, ["sid", "cell"])

    def copy(k: Column) -> Column:
        lo = k * F.col("source_size") + F.col("offset") + F.col("in_cell")
        block = F.floor(lo / BLOCK_WORDS)
        fits = F.col("take") - lo
        # Whole or not at all, whichever is nearer to the quota.
        words = F.when((fits > 0) & (2 * fits >= F.col("size")), F.col("size")).otherwise(F.lit(0).cast("long"))
        shard = F.element_at(F.filter("ranges", lambda r: r["block"] <= block), -1)["shard"]
        return F.struct(k.alias("pass"), F.when(words > 0, shard).alias("shard"), block.alias("block"),
                        words.alias("words"))

    copies = F.filter(F.transform(passes, copy), lambda c: c["words"] > 0)
    return rows.select(*docs.columns, "size", "source_size", "target", copies.alias("copies"), "key")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS, seed: int = 1,
         prefix: str = "mix_") -> DataFrame:
    """``docs`` with size, source_size, target and copies (each named with the
    prefix): copies lists every time that the row is taken, as (pass, shard,
    block, words)."""
    own, names = C.apart(docs)
    rows = _planned(own, names[id_col], names[text_col], names[source_col], weights, share, repeats, seed)
    return C.with_added(rows, names, {f"{prefix}{c}": F.col(c) for c in ("size", "source_size", "target", "copies")})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS, seed: int = 1,
        prefix: str = "mix_") -> DataFrame:
    """The mixed documents: a row for each copy, with its shard, its slot in
    the shard's random order, its pass and its number of words."""
    own, names = C.apart(docs)
    rows = _planned(own, names[id_col], names[text_col], names[source_col], weights, share, repeats, seed)
    copies = rows.select(*own.columns, "key", F.explode("copies").alias("copy")).select(*own.columns, "key", "copy.*")
    # A shard holds SHARD_BLOCKS * BLOCK_WORDS words (and the ends of its last
    # documents), so its window is bounded.
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit("slot"), "key", "pass"))
    added = {c: F.col(c) for c in ("shard", "pass", "words")} | {"slot": F.row_number().over(in_shard) - 1}
    return C.with_added(copies, names, {f"{prefix}{c}": v for c, v in added.items()})


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = F.aggregate("mix_copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return plan(docs).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                             F.col("mix_target").alias("target"), taken.alias("taken"),
                             F.transform("mix_copies", lambda c: c["shard"]).alias("shards"))


QUERIES = {"op1_mix": op1_mix}
ORACLES: dict[str, str] = {}  # which documents are taken depends on hashes that SQL engines do not share
