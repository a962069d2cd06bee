"""Lookup joins: one output row for each row of the driving side."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], last_by: Sequence[str], prefix: str = "", broadcast_rows: int | None = None) -> DataFrame:
    """Left join with the last row of each key on the right, so that the left never fans out.

    The right is reduced to one row a key before the join. It is broadcast if broadcast_rows is given
    and it has no more rows; otherwise the planner chooses by size at run time.
    """
    rest = [c for c in right.columns if c not in on]
    one = right.groupBy(*on).agg(F.max_by(F.struct(*rest), F.struct(*last_by)).alias("_row"))
    one = one.select(*on, F.lit(True).alias(f"{prefix}matched"), *[F.col(f"_row.{c}").alias(f"{prefix}{c}") for c in rest])
    if broadcast_rows is not None and one.count() <= broadcast_rows:
        one = F.broadcast(one)
    return left.join(one, list(on), "left")


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose key is not null and has no parent: what a foreign key would refuse."""
    keys = parent.select(*[F.col(p).alias(f"_p_{p}") for p in on.values()])
    match = None
    present = None
    for c, p in on.items():
        term, full = child[c] == keys[f"_p_{p}"], child[c].isNotNull()
        match = term if match is None else match & term
        present = full if present is None else present & full
    return child.filter(present).join(keys, match, "left_anti")


def reconcile(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Counts of keys in both, only in a and only in b, and of rows that agree in every column."""
    left = a.select(*key, F.xxhash64(*sorted(a.columns)).alias("_a"))
    right = b.select(*key, F.xxhash64(*sorted(b.columns)).alias("_b"))
    both = left.join(right, list(key), "full_outer")
    return both.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("in_both"),
        F.count_if(F.col("_b").isNull()).alias("only_left"),
        F.count_if(F.col("_a").isNull()).alias("only_right"),
        F.count_if(F.col("_a") == F.col("_b")).alias("equal_rows"),
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with multiplicity, that one side has beyond the other; empty if a replay agrees."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def freshness(events: DataFrame, by: Sequence[str], at: str, now) -> DataFrame:
    """Of each source the latest event and how many whole seconds it lies behind the run."""
    latest = events.groupBy(*by).agg(F.max(at).alias("latest"))
    second = F.date_trunc("second", F.col("latest").cast("timestamp"))
    return latest.withColumn("lag_seconds", (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(second)).cast("bigint"))
