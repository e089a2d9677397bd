"""Exact duplicates by skew-safe combining (operator 13).

Two texts are equal when they are identical without white space.  Every row
gets a number, the digest of its text and its length, and is written once.
Then equal rows are combined in three steps, and in each the grouping key
holds the full content next to the digest, so that two texts with one digest
are never taken for equal:

1. every task combines its own rows (Spark's partial aggregate);
2. rows of a hot digest, one that more than 1 in ``HOT_SHARE`` rows have, are
   merged under a salt, the task they come from modulo the square root of
   the number of tasks; so one group of copies is spread over many reducers;
3. the salts' winners are combined over the whole table.

Rows of other digests have no need of a salt and are merged in step 2 alone.
At most ``HOT_SHARE`` digests can be hot, so their list is broadcast.  The
winners are joined back to all rows by digest, those of hot digests by a
broadcast.  A digest that turned out to have several contents is joined back
on the content as well.

Of equal texts the row with the most code points in its original text stays,
then the smallest id, then the first row.

Defined cases: null texts count as empty, and all texts of white space alone
are equal to them; a null id counts as larger than any other; of repeated
rows one stays; an empty table gives no rows.  The caller's columns are
packed in one struct, so their names may be any.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import common as C

# A digest is hot if it has more than one in so many rows; fewer than this can be.
HOT_SHARE = 2048
WHITE_SPACE = r"[\x20\x09-\x0D]+"  # fixed by the contract


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _numbered(docs: DataFrame, text_col: str, digest_chars: int) -> DataFrame:
    """(row, doc, n, sha, digest) of every row, as a stored table."""
    text = F.col("doc").getField(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc",
                       F.length(F.coalesce(text, F.lit(""))).alias("n"), F.sha2(normalised(text), 256).alias("sha"))
    return C.stored(rows.withColumn("digest", F.substring("sha", 1, digest_chars)), "exactdup-rows")


def _hot(rows: DataFrame) -> tuple[DataFrame, int]:
    """The hot digests, and how many salts each is spread over."""
    total, tasks = rows.agg(F.count(F.lit(1)), F.max(F.shiftright("row", 33)) + 1).first()
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    hot = C.stored(counts.where(F.col("n") * HOT_SHARE > total).select("digest"), "exactdup-hot")
    return hot, math.isqrt(tasks or 1) + 1


def _groups(rows: DataFrame, hot: DataFrame, salts: int, id_col: str, text_col: str) -> DataFrame:
    """(digest, content, size, keep) of every group of equal texts."""
    doc = F.col("doc")
    keep = F.struct((-F.col("n")).alias("n"), doc.getField(id_col).isNull().alias("no_id"),
                    doc.getField(id_col).alias("id"), "row")
    combined = [F.sum("size").alias("size"), F.min("keep").alias("keep")]

    def contents(part: DataFrame) -> DataFrame:
        return part.select("digest", normalised(doc.getField(text_col)).alias("content"), F.lit(1).cast("long").alias("size"),
                           keep.alias("keep"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))

    salted = (contents(rows.join(F.broadcast(hot), "digest", "left_semi"))
              .groupBy("digest", "salt", "content").agg(*combined)
              .groupBy("digest", "content").agg(*combined))
    others = contents(rows.join(F.broadcast(hot), "digest", "left_anti")).groupBy("digest", "content").agg(*combined)
    return salted.union(others)


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_chars: int = 64) -> DataFrame:
    """(doc, keep_id, group_size, kept, text_sha256) for every row.

    ``doc`` is the row itself, as a struct; ``keep_id`` is the id of the row
    of its group that stays.  ``digest_chars`` of the hexadecimal SHA-256 are
    used as the digest.
    """
    rows = _numbered(docs, text_col, digest_chars)
    hot, salts = _hot(rows)
    found = C.stored(_groups(rows, hot, salts, id_col, text_col).drop("content"), "exactdup-groups")
    several = C.stored(found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"),
                       "exactdup-several")
    if several.head(1):
        apart = rows.join(several, "digest", "left_semi").withColumn(
            "content", normalised(F.col("doc").getField(text_col)))
        by_content = apart.join(_groups(apart, hot, salts, id_col, text_col), ["digest", "content"]).drop("content")
        rows, found = (df.join(several, "digest", "left_anti") for df in (rows, found))
    else:
        by_content = None
    joined = (rows.join(F.broadcast(found.join(F.broadcast(hot), "digest", "left_semi")), "digest")
              .union(rows.join(F.broadcast(hot), "digest", "left_anti")
                     .join(found.join(F.broadcast(hot), "digest", "left_anti"), "digest")))
    if by_content is not None:
        joined = joined.union(by_content.select(*joined.columns))
    return joined.select("doc", F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"),
                         (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    rows = marked(docs, id_col, text_col).where("kept")
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark)
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return marked(docs).select(F.col("doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {"op13_exact_duplicates": op13_exact_duplicates}

ORACLES = {"op13_exact_duplicates": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
"""}
