"""Connected components of a link table, as rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import common as C

# A node with very many links is joined in so many parts.
SALTS = 16


def _with_least(links: DataFrame) -> DataFrame:
    """(u, v, m): every link with the least neighbour of u, or u itself.

    The aggregate combines before its shuffle, and the join back is salted,
    so a hub's links are spread over ``SALTS`` tasks.
    """
    least = (links.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")))
    return links.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "s"])


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: long); root is the
    smallest node of its component.  Links may repeat; (u, u) adds nothing.

    Alternates large-star and small-star rounds until nothing changes.  Each
    round is written to the shared folder; the driver sees one count and one
    checksum a round.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    links = C.stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .distinct(), name)
    before = state(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        near = _with_least(large)
        small = (near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        links = C.stored(small, name)
        after = state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
