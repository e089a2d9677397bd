import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderloom.llm import hypergeometric, mixing, sharding


def fill(sizes, weights, share, repeats):
    """Targets by the rounds of the contract: cap, then reshare."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    cap = {s: repeats * sizes[s] for s in names}
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(w[s] for s in open_)
        rest = left - sum(cap[s] for s in full)
        over = [s for s in open_ if rest * w[s] / total > cap[s]]
        if not over:
            return {s: cap[s] if s in full else rest * w[s] / total for s in names}
        full |= set(over)


def test_targets_and_taken(docs):
    rows = mixing.plan(docs).collect()
    assert len(rows) == docs.count()
    size, longest = defaultdict(int), defaultdict(int)
    for r in rows:
        longest[r["source"]] = max(longest[r["source"]], r["mix_size"])
        assert r["mix_size"] == len((r["text"] or "").split())
        size[r["source"]] += r["mix_size"]
    want = fill(size, mixing.WEIGHTS, mixing.SHARE, mixing.MAX_REPEATS)
    taken = defaultdict(int)
    for r in rows:
        own = sum(c["words"] for c in r["mix_copies"])
        assert own <= 2 * r["mix_size"] and r["mix_source_size"] == size[r["source"]]
        assert all(c["words"] == r["mix_size"] for c in r["mix_copies"])
        assert math.isclose(r["mix_target"], want[r["source"]])
        taken[r["source"]] += own
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 0.5 for s in want)


def test_mix_rows(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 8)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_pass", "mix_words", "mix_slot"]
    whole = {r["text"] for r in docs.collect()}
    for r in rows:
        assert len(r["text"].split()) == r["mix_words"] > 0 and r["text"] in whole
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["mix_shard"]].append(r["mix_slot"])
    assert len(by_shard) > 3
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    again = Counter((r["doc_id"], r["mix_shard"], r["mix_slot"], r["text"]) for r in mixing.mix(docs).collect())
    assert again == Counter((r["doc_id"], r["mix_shard"], r["mix_slot"], r["text"]) for r in rows)


@pytest.mark.parametrize("share, times", [(0.2, 0), (0.5, 1), (0.7, 1), (1.2, 1), (1.6, 2)])
def test_one_giant_text_is_taken_whole_or_not(spark, share, times):
    giant = spark.createDataFrame([(1, "word " * 30000, "a")], "doc_id long, text string, source string")
    assert [r["mix_words"] for r in mixing.mix(giant, share=share).collect()] == [30000] * times


def test_mix_of_nothing(docs):
    assert mixing.plan(docs.limit(0)).count() == 0
    empty = docs.where("text is null or text = ''")
    assert [r["mix_copies"] for r in mixing.plan(empty).collect()] == [[], []]


def test_draw_is_hypergeometric(spark):
    """Frequencies of 4000 draws against the exact distribution."""
    u = spark.range(4000).select(hypergeometric.draw(
        F.lit(30), F.lit(12), F.lit(10), (F.col("id") + 0.5) / 4000).alias("x"))
    got = Counter(r["x"] for r in u.collect())
    for x in range(11):
        p = math.comb(12, x) * math.comb(18, 10 - x) / math.comb(30, 10)
        assert abs(got[x] - 4000 * p) <= 1.01


def test_split_margins(spark):
    sizes = [7, 0, 30, 1, 12, 50, 3] * 20
    colours = [900, 0, 700, 1, sum(sizes) - 1601]
    leaves = spark.createDataFrame(list(enumerate(sizes)), "leaf long, n long")
    out = hypergeometric.split(leaves, len(sizes), spark.createDataFrame([(colours,)], "left array<long>"), 3).collect()
    rows = {r["leaf"]: r for r in out}
    assert [sum(rows[k]["share"]) for k in range(len(sizes))] == sizes
    upto = [0] * len(colours)
    for k in range(len(sizes)):
        assert rows[k]["before"] == upto and min(rows[k]["share"]) >= 0
        upto = [a + b for a, b in zip(upto, rows[k]["share"])]
    assert upto == colours


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_exact(docs, shards):
    rows = sharding.assign(docs, shards=shards, cells=32, sub_cells=4).collect()
    assert len(rows) == docs.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    place = lambda rs: sorted((str(r["doc_id"]), r["text"] or "", r["shard"], r["slot"]) for r in rs)
    assert place(sharding.assign(docs.repartition(5), shards=shards, cells=32, sub_cells=4).collect()) == place(rows)


def test_shards_of_nothing(docs):
    assert sharding.assign(docs.limit(0)).count() == 0


def test_shards_are_uniform(spark):
    """Each row's shard is near uniform over seeds."""
    rows = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    hits = Counter()
    for seed in range(6):
        for r in sharding.assign(rows, shards=4, seed=seed, cells=8, sub_cells=2).collect():
            hits[(r["doc_id"] % 4, r["shard"])] += 1
    assert all(6 <= hits[(a, b)] <= 45 for a in range(4) for b in range(4))
