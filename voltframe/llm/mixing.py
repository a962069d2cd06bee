"""Mixing of sources to target weights by capped water-filling.

The mix is to hold a share of all words. Each source gets a part in proportion to its weight, but at
most `epochs` times its own size; what a clamped source cannot take goes to the others by weight
until none is above its cap. Clamping in order of cap per weight does this in one pass: the level of
the water is found with a running sum over the table of sources. A source's target is then met by
whole repetitions of all of its documents and, for the rest, by one further repetition of the
documents that come first in a seeded order; the document at the edge is taken in part.

Positions in the seeded order come from two running sums, over buckets of hash values and within a
bucket, so a source that holds most of the rows is spread over all buckets.

Cases: a null text has size 0 and is taken 0 times; null is a source of its own, ranked last; a
source without words has target 0; equal rows are separate documents; an empty table gives an empty
one; very long texts count whole. Reruns agree whatever the partitions. Extra columns are kept,
whatever their names; columns named like the added ones are replaced.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import PLAIN_WORD, packed, table, unpacked

WEIGHTS, SHARE, EPOCHS, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, "mix-1"
#: Hex digits of the order key that name a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3
ADDED = ("size", "source_size", "target", "taken")


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(PLAIN_WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """From (source, source_size), one row a source: the same with weight and target.

    The table of sources is small beside that of documents: its windows have one row a source.
    """
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns(
        {
            "left_over": F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # the level if all sources before this one are clamped; it holds from the first source that it leaves unclamped
    t = t.withColumn("level", F.col("left_over") / F.col("open_weight"))
    t = t.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"])
    target = F.when(F.col("level").isNull() | (F.col("level") >= F.col("ratio")), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return t.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """docs with size, source_size, target (of the source) and taken (words that the mix takes)."""
    kept = unpacked(docs, without=ADDED)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    docs = docs.select(packed(docs), F.col("source").alias("source"), word_count(F.col("text")).alias("size"), order.alias("_order"), named.alias("_source"), F.xxhash64("text").alias("_tie"))
    docs = docs.withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    by_bucket = docs.groupBy("_source", "_bucket").agg(F.sum("size").alias("held"), F.first("source").alias("source"))
    running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = by_bucket.withColumn("_before", F.coalesce(F.sum("held").over(running), F.lit(0)))
    sources = by_bucket.groupBy("_source").agg(F.first("source").alias("source"), F.sum("held").alias("source_size"))
    aims = targets(sources.select("source", "source_size"), weights, share, epochs)
    aims = aims.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source", "weight")
    offsets = by_bucket.select("_source", "_bucket", "_before").join(aims, "_source")
    within = Window.partitionBy("_source", "_bucket").orderBy("_order", "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.drop("source").join(offsets, ["_source", "_bucket"]).withColumn("_before", F.col("_before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - whole * F.col("source_size")).cast("bigint")
    part = F.least(F.greatest(rest - F.col("_before"), F.lit(0).cast("bigint")), F.col("size"))
    return placed.withColumn("taken", (whole * F.col("size") + part).cast("bigint")).select(*kept, *ADDED)


def sample(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: a row for each repetition, with its number and the words of the text it takes."""
    mixed = mix(docs, **how)
    times = F.when(F.col("taken") > 0, F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    out = mixed.withColumn("repetition", F.explode(times))
    return out.withColumn("words_taken", F.least(F.col("size"), F.col("taken") - F.col("repetition") * F.col("size")))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS w
  FROM d GROUP BY source),
-- clamp whatever is above its cap, share the rest by weight, and again until nothing is
fill(step, source, source_size, w, clamped) AS (
  SELECT 0, source, source_size, w, source_size = 0 FROM s
  UNION ALL
  SELECT step + 1, source, source_size, w,
         clamped OR w * (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) FILTER (WHERE clamped) OVER (), 0))
                    / nullif(sum(w) FILTER (WHERE NOT clamped) OVER (), 0) > 2.0 * source_size
  FROM fill WHERE step < 64),
aims AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN 2.0 * source_size
              ELSE w * (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) FILTER (WHERE clamped) OVER (), 0))
                     / nullif(sum(w) FILTER (WHERE NOT clamped) OVER (), 0) END::DOUBLE AS target
  FROM fill WHERE step = 64),
p AS (
  SELECT d.doc_id, d.size, CAST(a.source_size AS BIGINT) AS source_size, a.target,
         CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null'))
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(whole * size + least(greatest(CAST(round(target - whole * source_size) AS BIGINT) - before, 0), size) AS BIGINT) AS taken
FROM p
"""
