"""One row repeated for a third of a table: no cell or range holds it whole."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import mixing, repeats, sharding, tokenfiles


@pytest.fixture
def repeated(spark):
    """2000 rows and 1000 copies of one row."""
    rows = spark.range(2000).select("id", F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"))
    copies = spark.range(1000).select(F.lit(7).cast("long").alias("id"), F.lit("text of 7").alias("text"))
    return rows.union(copies).select(F.col("id").alias("doc_id"), "text", F.lit("s").alias("source"))


def apart(df, most, cells=16):
    rows = df.select("doc_id", F.xxhash64("doc_id").alias("key"))
    place = F.pmod(F.xxhash64(F.lit("x"), "key"), F.lit(cells)).alias("place")
    rows = rows.select("*", place)
    return repeats.told_apart(rows, ["key"], "key", "place", rows.groupBy("place").agg(F.count("*").alias("n")), most)


def test_repeats_get_keys_of_their_own(repeated):
    rows = apart(repeated, 200).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({7: 1001}) + Counter(k for k in range(2000) if k != 7)
    keys = Counter(r["key"] for r in rows)
    assert len(keys) == 3000 and max(keys.values()) == 1
    # The keys do not depend on how the rows lie.
    again = apart(repeated.repartition(13), 200).collect()
    assert sorted((r["doc_id"], r["key"]) for r in again) == sorted((r["doc_id"], r["key"]) for r in rows)


def test_crowded_places_without_repeats_stay(repeated):
    assert apart(repeated.where("doc_id <> 7"), 100) is None  # places of 125 rows, keys of one
    assert apart(repeated.limit(0), 100) is None
    assert apart(repeated, 5000) is None


def test_cells_follow_the_rows():
    assert repeats.cell_count(0, 1024) == 1024 == repeats.cell_count(1024 << 16, 1024)
    assert repeats.cell_count((1024 << 16) + 1, 1024) == 2048
    assert repeats.cell_count(10**10, 1024) * repeats.CELL_ROWS >= 10**10


def test_shards_hold_their_laws(repeated, monkeypatch):
    cells = []
    real = sharding.split
    monkeypatch.setattr(sharding, "split", lambda leaves, *a: cells.append(leaves) or real(leaves, *a))
    got = sharding.assign(repeated, shards=7, cells=64, sub_cells=4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == [428] * 3 + [429] * 4
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in repeated.collect())
    # The repeated row is spread evenly over the shards, and no cell holds it.
    assert max(Counter(r["shard"] for r in got if r["doc_id"] == 7).values()) < 200
    assert cells[0].agg(F.max("n")).first()[0] < 100
    place = lambda rows: Counter((r["doc_id"], r["shard"], r["slot"]) for r in rows)
    assert place(sharding.assign(repeated.repartition(9), shards=7, cells=64, sub_cells=4).collect()) == place(got)


def test_mix_takes_repeated_rows(repeated, monkeypatch):
    monkeypatch.setattr(mixing, "CELLS", 64)
    calls = []
    real = mixing.told_apart
    monkeypatch.setattr(mixing, "told_apart", lambda *a: calls.append(real(*a)) or calls[-1])
    rows = mixing.plan(repeated).collect()
    assert calls[0] is not None and len(rows) == 3000
    taken = sum(c["words"] for r in rows for c in r["mix_copies"])
    assert abs(taken - rows[0]["mix_target"]) <= 3
    # Of the repeated row's 1001 places about half are taken twice, half once.
    hot = Counter(len(r["mix_copies"]) for r in rows if r["doc_id"] == 7)
    assert set(hot) <= {1, 2} and 380 <= hot[2] <= 620


def test_token_files_split_a_repeated_row(spark, repeated):
    path = tokenfiles.write_shards(repeated.repartition(8), tokenfiles.default_tokenizer())
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    total = sum(r["n"] for r in parts)
    assert max(r["n"] for r in parts) * len(parts) < 2 * total
    got = tokenfiles.read_shards(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids) and Counter(ids)[7] == 1001
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]
