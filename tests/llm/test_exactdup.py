import hashlib
import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import exactdup


def content(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    """(doc_id, keep_id, size, sha) of every row, and the number kept."""
    groups = {}
    for d, t in rows:
        groups.setdefault(content(t), []).append((-len(t or ""), d is None, d if d is not None else 0))
    out = []
    for d, t in rows:
        c = content(t)
        best = min(groups[c])
        out.append((d, None if best[1] else best[2], len(groups[c]), hashlib.sha256(c.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


def check(df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = exactdup.marked(df, **options).select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"),
                                                "keep_id", "group_size", "kept", "text_sha256").collect()
    expected, groups = brute(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out], key=str) == expected
    kept = [r for r in out if r["kept"]]
    assert len({content(r["text"]) for r in kept}) == len(kept) == groups
    for r in kept:
        assert r["doc_id"] == r["keep_id"]
    return out


def test_against_plain_grouping(docs):
    check(docs)
    check(docs.repartition(7))


@pytest.mark.parametrize("chars", [1, 2])
def test_texts_that_share_a_digest_stay_apart(docs, chars):
    check(docs.repartition(5), digest_chars=chars)


def test_hot_and_cold_groups(spark, monkeypatch):
    """With a low bound some groups are hot, others not; one group holds a
    third of all rows, and half of those are one repeated row."""
    monkeypatch.setattr(exactdup, "HOT_SHARE", 20)
    rows = spark.range(0, 3000, 1, 12).select(
        F.when(F.col("id") % 6 == 0, F.lit(6)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("a hot text")).when(F.col("id") % 3 == 1, F.concat(F.lit("t "), F.col("id") % 400))
        .otherwise(F.concat(F.lit("one"), F.repeat(F.lit(" "), (F.col("id") % 7).cast("int")), F.col("id") % 900)).alias("text"))
    for chars in (64, 1):
        check(rows, digest_chars=chars)


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(None, "a  b", 1, "x"), (5, "ab", 2, "y"), (4, "a b", 3, "z"), (4, "a b", 4, "z"), (9, "é", 5, None),
            (10, " é", 6, None), (11, None, 7, "e"), (12, "\t\r\n\x0b\x0c ", 8, "e"), (13, " ", 9, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, digest string")
    out = {tuple(r) for r in exactdup.deduplicated(docs).collect()}
    assert {r for r in out if r[0] != 4} == {(None, "a  b", 1, "x"), (10, " é", 6, None),
                                             (12, "\t\r\n\x0b\x0c ", 8, "e"), (13, " ", 9, "n")}
    assert len(out) == 4
    for names in (["keep_id", "kept"], ["doc", "content"], ["salt", "size"], ["keep", "sha"], ["n", "group_size"]):
        assert exactdup.deduplicated(docs.toDF("doc_id", "text", *names)).columns == ["doc_id", "text", *names]
    assert exactdup.deduplicated(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(1, long), (2, long + " "), (3, long + "x"), (4, long.replace(" ", "\n"))],
                                 "doc_id long, text string")
    out = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in check(docs)}
    assert out == {1: (2, 3), 2: (2, 3), 3: (3, 1), 4: (2, 3)}
