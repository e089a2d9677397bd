"""Rule-based data quality: tag, quarantine, score, constraints.

A rule is ``(rule_id, passes)`` where ``passes`` is a boolean Column; a null
result counts as a failure.  Tagging never drops rows: ``failed_rule_id``
holds the ids of the rules a row failed (empty when clean) and
``dq_processed_timestamp`` the check time.  All of it is column arithmetic in
one projection -- no UDF, no extra pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def failed_rules(rules: Sequence[Rule]) -> Column:
    if not rules:
        return F.array().cast("array<string>")
    tags = F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string"))
                     .otherwise(F.lit(rid)) for rid, ok in rules])
    return F.filter(tags, lambda x: x.isNotNull())


def tag_rows(df: DataFrame, rules: Sequence[Rule], checked_at: Column | None = None,
             keep_previous: bool = True) -> DataFrame:
    """Set ``failed_rule_id`` / ``dq_processed_timestamp``.

    With ``keep_previous`` the ids already on the row (from an earlier layer)
    are kept in front of the new ones.
    """
    new = failed_rules(rules)
    if keep_previous and "failed_rule_id" in df.columns:
        new = F.array_distinct(F.concat(F.coalesce(F.col("failed_rule_id"),
                                                   F.array().cast("array<string>")), new))
    at = checked_at if checked_at is not None else F.current_timestamp()
    return df.withColumns({"failed_rule_id": new, "dq_processed_timestamp": at})


def passed(df: DataFrame) -> DataFrame:
    return df.filter(F.size("failed_rule_id") == 0)


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.size("failed_rule_id") > 0)


def scorecard(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Share of rows passing each rule: one row per rule, one pass over data."""
    if not rules:
        raise ValueError("scorecard needs at least one rule")
    aggs = []
    for rid, ok in rules:
        aggs.append(F.sum(F.coalesce(ok, F.lit(False)).cast("int")).alias(f"p_{rid}"))
    totals = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    stack = ", ".join(f"'{rid}', p_{rid}" for rid, _ in rules)
    return totals.selectExpr("n", f"stack({len(rules)}, {stack}) as (rule_id, passed_rows)").select(
        "rule_id", F.col("n").alias("total_rows"), F.col("passed_rows").cast("bigint").alias("passed_rows"),
        F.round(F.col("passed_rows") / F.col("n"), 6).alias("pass_rate"))


def not_null(*cols: str) -> Rule:
    return (f"not_null_{'_'.join(cols)}",
            reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def in_domain(col: str, values: Sequence) -> Rule:
    return (f"domain_{col}", F.col(col).isin(list(values)))


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def foreign_key_violations(child: DataFrame, parent: DataFrame, child_key: str,
                           parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
            .join(p, F.col(child_key) == F.col("_pk"), "left_anti"))
