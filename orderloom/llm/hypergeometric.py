"""Multivariate hypergeometric splitting trees in Spark SQL functions.

``split`` shares the units of several colours (source quotas, shard sizes)
among leaves of known sizes, as if all units had been shuffled and dealt:
every leaf gets exactly its size and every colour is used up exactly.  The
tree has ``FAN`` children a node, so a node's work and its arrays are bounded
and the nodes of a level are independent rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*cols) -> Column:
    """A number in [0, 1) that the given columns decide."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def draw(total: Column, colour: Column, n: Column, u: Column) -> Column:
    """How many of ``n`` units drawn from ``total`` without replacement are of
    the ``colour`` units: the inverse of the distribution at ``u``.

    The walk covers nine standard deviations and 20 units on either side of
    the mean; what lies beyond is below double precision.
    """
    def ratio(q: Column, x: Column) -> Column:  # of the probabilities of x + 1 and x
        return ((q["k"] - x) * (q["d"] - x)) / ((x + 1) * (q["n"] - q["k"] - q["d"] + x + 1))

    def bounds(q: Column) -> Column:
        size = F.greatest(q["n"], F.lit(1.0))
        mean = q["d"] * q["k"] / size
        var = mean * (1 - q["k"] / size) * (q["n"] - q["d"]) / F.greatest(q["n"] - 1, F.lit(1.0))
        span = F.sqrt(F.greatest(var, F.lit(0.0))) * 9 + 20
        lo = F.greatest(F.lit(0.0), q["d"] - (q["n"] - q["k"]), F.floor(mean - span))
        hi = F.least(q["d"], q["k"], F.ceil(mean + span))
        return F.struct(*[q[c].alias(c) for c in "nkdu"], F.sequence(lo.cast("long"), hi.cast("long")).alias("xs"))

    def mass(w: Column) -> Column:
        return F.aggregate(
            w["xs"], F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s")),
            lambda a, x: F.struct((a["p"] * ratio(w, x)).alias("p"), (a["s"] + a["p"]).alias("s")),
            lambda a: a["s"])

    def pick(w: Column) -> Column:
        return _let(mass(w) * w["u"], lambda goal: F.aggregate(
            w["xs"], F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s"), F.element_at(w["xs"], 1).alias("v")),
            lambda a, x: F.struct((a["p"] * ratio(w, x)).alias("p"), (a["s"] + a["p"]).alias("s"),
                                  F.when(a["s"] + a["p"] < goal, x + 1).otherwise(a["v"]).alias("v")),
            lambda a: F.least(a["v"], F.element_at(w["xs"], -1))))

    q = F.struct(total.cast("double").alias("n"), colour.cast("double").alias("k"),
                 n.cast("double").alias("d"), u.alias("u"))
    return _let(q, lambda v: _let(bounds(v), pick))


def _deal(left: Column, n: Column, *seed) -> Column:
    """One leaf's share of each colour out of the array ``left``."""
    total = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(n.alias("n"), total.alias("t"), F.array().cast("array<long>").alias("out"))

    def step(a: Column, c: Column) -> Column:
        k = F.element_at(left, c)
        x = draw(a["t"], k, a["n"], uniform(*seed, c))
        return _let(x, lambda v: F.struct((a["n"] - v).alias("n"), (a["t"] - k).alias("t"),
                                          F.concat(a["out"], F.array(v)).alias("out")))

    return F.aggregate(F.sequence(F.lit(1), F.size(left)), start, step, lambda a: a["out"])


def split(leaves: DataFrame, leaf_count: int, colours: DataFrame, seed: int) -> DataFrame:
    """(leaf, share, before): arrays over the colours.

    ``leaves`` (leaf: 0 to leaf_count - 1, n) is a stored table; ``colours``
    has one row (left: array of longs) whose sum is that of all n.  ``share``
    is what a leaf gets of each colour and ``before`` what leaves of smaller
    numbers get of it.
    """
    levels = [leaves.select(F.col("leaf").cast("long").alias("leaf"), F.col("n").cast("long").alias("n"))]
    count = leaf_count
    while count > 1:
        below = levels[-1]
        levels.append(below.groupBy(F.floor(F.col("leaf") / FAN).cast("long").alias("leaf"))
                      .agg(F.sum("n").cast("long").alias("n")))
        count = -(-count // FAN)
    nodes = colours.select(F.lit(0).cast("long").alias("leaf"), F.col("left").alias("share"),
                           F.transform("left", lambda x: F.lit(0).cast("long")).alias("before"))
    for depth in range(len(levels) - 2, -1, -1):
        kids = (levels[depth].groupBy(F.floor(F.col("leaf") / FAN).cast("long").alias("parent"))
                .agg(F.array_sort(F.collect_list(F.struct("leaf", "n"))).alias("kids")))
        start = F.struct(F.col("share").alias("left"), F.col("before").alias("before"), F.array().cast(
            "array<struct<leaf:bigint,share:array<bigint>,before:array<bigint>>>").alias("out"))

        nodes = (nodes.join(kids, F.col("leaf") == F.col("parent"))
                 .select(F.explode(F.aggregate("kids", start, _child(seed, depth), lambda a: a["out"])).alias("k"))
                 .select("k.*"))
    return nodes


def _child(seed: int, depth: int) -> Callable[[Column, Column], Column]:
    """Deals one child its share of what its elder siblings leave."""
    def step(a: Column, kid: Column) -> Column:
        def add(share: Column) -> Column:
            return F.struct(
                F.zip_with(a["left"], share, lambda x, y: x - y).alias("left"),
                F.zip_with(a["before"], share, lambda x, y: x + y).alias("before"),
                F.concat(a["out"], F.array(F.struct(kid["leaf"].alias("leaf"), share.alias("share"),
                                                    a["before"].alias("before")))).alias("out"))
        return _let(_deal(a["left"], kid["n"], F.lit(seed), F.lit(depth), kid["leaf"]), add)
    return step
