"""Columns of a caller that are named like inner or added ones."""

import pytest
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, mixing, secretscan, sharding

INNER = ["__n_hit", "__n_words", "runs", "row", "items", "__cell", "__key", "__shard", "__sub", "__blob", "__spans",
         "__found", "size", "sid", "key", "cell", "block", "pass", "copies", "copy", "in_0", "in_1", "IN_3", "offset"]
MIX = ["mix_shard", "mix_pass", "mix_words", "mix_slot"]

OPERATORS = {
    "mix": (mixing.mix, MIX),
    "plan": (mixing.plan, ["mix_size", "mix_source_size", "mix_target", "mix_copies"]),
    "shard": (lambda d: sharding.assign(d, shards=3, cells=8, sub_cells=2), ["shard", "slot"]),
    "secrets": (lambda d: secretscan.scan(d), ["spans"]),
    "clean": (lambda d: decontaminate.without_hits(d, d.sparkSession.createDataFrame(
        [(1, "one"), (2, "alpha1 beta2")], "item_id long, text string")), []),
    "cut": (lambda d: decontaminate.without_hits(d, d.sparkSession.createDataFrame(
        [(1, "one"), (2, "alpha1 beta2")], "item_id long, text string"), "spans"), []),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_names_change_nothing(docs, name):
    run, added = OPERATORS[name]
    docs = docs.drop("n_words")
    clash = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate([*INNER, *added])])
    plain, got = run(docs), run(clash)
    assert got.columns == [*docs.columns, *INNER, *added]
    for k, c in enumerate(INNER):
        assert [r[0] for r in got.select(f"`{c}`").distinct().collect()] == [k]
    assert sorted(got.select(plain.columns).collect(), key=str) == sorted(plain.collect(), key=str)
