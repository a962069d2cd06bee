"""Upserts and inserts of absent rows as pure DataFrame operations, for tables without MERGE."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], keep_old: Sequence[str] = (), touch: dict[str, Column] | None = None) -> DataFrame:
    """old with the rows of new inserted or, by key, replaced.

    Columns in keep_old stay what they were where a row existed. touch gives values for the rows that
    new wrote. Keys of new must be unique. One full join, one shuffle a side.
    """
    mark = new.select(*[F.col(c).alias(f"_n_{c}") for c in new.columns], F.lit(True).alias("_new"))
    on = None
    for k in key:
        term = old[k] == mark[f"_n_{k}"]
        on = term if on is None else on & term
    both = old.withColumn("_old", F.lit(True)).join(mark, on, "full_outer")
    written, existed = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def value(c: str) -> Column:
        if touch and c in touch:
            return F.when(written, touch[c]).otherwise(F.col(c))
        if c not in new.columns:
            return F.col(c)
        if c in keep_old:
            return F.when(written & ~existed, F.col(f"_n_{c}")).otherwise(F.col(c))
        return F.when(written, F.col(f"_n_{c}")).otherwise(F.col(c))

    return both.select(*[value(c).alias(c) for c in old.columns])


def insert_absent(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """old and the rows of new whose key it has not: inserting twice changes nothing."""
    return old.unionByName(new.join(old.select(*key), list(key), "left_anti").select(*old.columns))


def ordered_json(df: DataFrame, key: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows as one JSON array a group, ordered by key."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(key).alias("_k"), F.struct(*columns).alias("_v"))))
    payload = F.to_json(F.transform(rows, lambda x: x["_v"]), {"ignoreNullFields": "false"}).alias("payload")
    return df.groupBy(*by).agg(payload, F.count("*").alias("rows"))
