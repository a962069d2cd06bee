"""Last-by-sequence deduplication on a natural key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str], first_seen: str | None = None) -> DataFrame:
    """Of each key the row that is greatest by the order columns; later columns break ties.

    An aggregation with partial results before the shuffle, so a key with many versions sends one row
    a task. first_seen names the column whose smallest value of the key is kept as `first_seen`.
    """
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    seen = [F.min(first_seen).alias("first_seen")] if first_seen else []
    out = df.groupBy(*key).agg(best, *seen)
    names = [F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    return out.select(*names, *(["first_seen"] if first_seen else []))


def accounting(accepted: DataFrame, kept: DataFrame, by: str) -> DataFrame:
    """Per source: accepted, silver and deduplicated rows, counted independently of each other."""
    a = accepted.groupBy(by).agg(F.count("*").alias("accepted"))
    k = kept.groupBy(by).agg(F.count("*").alias("silver"))
    out = a.join(k, by, "left").withColumn("silver", F.coalesce("silver", F.lit(0)))
    return out.withColumn("deduplicated", F.col("accepted") - F.col("silver"))
