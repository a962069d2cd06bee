"""Bronze, quarantine, Silver and Gold as DataFrames."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, Source
from ..functions.json import parse_strict
from ..functions.time import let, utc_text
from ..operators.dedup import keep_last
from ..operators.enrich import lookup
from ..operators.quality import split, validate
from ..sources import read_source


def bronze(spark: SparkSession, source: Source, ingested_at: str) -> DataFrame:
    """Every raw line with its place, and its JSON value if it has one."""
    return read_source(spark, source).select(
        F.lit(source.source_id).alias("source_id"),
        "source_file",
        F.col("source_row_number").cast("bigint").alias("source_row_number"),
        "raw_line",
        parse_strict(F.col("raw_line")).alias("raw_record"),
        F.lit(ingested_at).alias("_ingested_at"),
    )


def lineage(source: Source) -> Column:
    d = source.definition
    fixed = {k: F.lit(d[k]) for k in ("source_id", "source_version", "provider", "dataset", "licensing_provenance")}
    parts = fixed | {k: F.col(k) for k in ("source_file", "source_row_number")}
    return F.struct(*[parts[k].alias(k) for k in sorted(parts)]).alias("lineage")


def refine(raw: DataFrame, source: Source, with_declared: bool = False) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, normalised, and quarantined ones, from one source's Bronze."""
    good, bad = split(validate(raw, source, with_declared))
    accepted = good.select("source_id", "source_file", "source_row_number", "region", "interval_utc", "ingestion_sequence", lineage(source), *source.measures)
    rejected = bad.select("source_id", "source_file", "source_row_number", "reason_codes", F.col("_ingested_at").alias("rejected_at"), "raw_record")
    return accepted, rejected


def silver(accepted: DataFrame, source: Source) -> DataFrame:
    """The last row of each natural key, with the place where the key was first seen."""
    kept = keep_last(accepted, list(dict.fromkeys(source.key_columns)), ["ingestion_sequence", "source_row_number"], first_seen="source_row_number")
    return kept.select(*accepted.columns, "first_seen")


SILVER_ORDER = ("region", "interval_utc", "first_seen")


def gold(market: DataFrame, weather: DataFrame, contract: Contract, ingested_at: str) -> DataFrame:
    """Each market row with the weather of its region and interval, if there is any.

    Where the weather's natural key is finer than the join's, the last row in Silver order counts.
    """
    side = weather.select("region", "interval_utc", "temperature_c", F.col("lineage").alias("weather_lineage"), F.col("first_seen").alias("weather_seen"))
    joined = lookup(market, side, ["region", "interval_utc"], ["weather_seen"])
    return joined.select(
        "region",
        "interval_utc",
        "demand_mw",
        "price_per_mwh",
        "temperature_c",
        F.struct(utc_text(F.col("interval_utc")).alias("latest_event_utc"), F.lit(ingested_at).alias("pipeline_ingested_at")).alias("freshness"),
        F.struct(F.col("lineage").alias("market"), F.array(F.lit(contract.market().source_id), F.lit(contract.weather().source_id)).alias("source_ids"), F.col("weather_lineage").alias("weather")).alias("lineage"),
        "first_seen",
    )


def as_json(df: DataFrame) -> Column:
    """A row as JSON with sorted names, nulls written, UTC text for instants, and ASCII only.

    Numbers that are not finite are the texts nan, inf and -inf.
    """

    def shown(f) -> Column:
        value, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "timestamp":
            return utc_text(value)
        return value

    text = F.to_json(F.struct(*[shown(f).alias(f.name) for f in sorted(df.schema, key=lambda f: f.name)]), {"ignoreNullFields": "false"})
    # to_json writes "NaN", "Infinity" and "-Infinity" as texts: only a value of a double is one
    for f in (f for f in df.schema if f.dataType.typeName() in ("double", "float")):
        for mine, theirs in (("NaN", "nan"), ("Infinity", "inf"), ("-Infinity", "-inf")):
            special = F.col(f"`{f.name}`") == F.lit(float(theirs))  # NaN equals itself here
            there = F.lit(f'"{f.name}":"{mine}"')
            text = F.replace(text, F.when(special, there).otherwise(F.lit("\0")), F.lit(f'"{f.name}":"{theirs}"'))
    return let(text, lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), escaped(t)).otherwise(t))


def escaped(text: Column) -> Column:
    """Characters beyond ASCII as JSON escapes of UTF-16 units."""
    unit = lambda u: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(u), 4, "0")))
    point = lambda c: F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("bigint")

    def shown(c: Column, v: Column) -> Column:
        pair = F.concat(unit(F.lit(0xD800) + F.shiftright(v - 0x10000, 10)), unit(F.lit(0xDC00) + (v - 0x10000).bitwiseAND(F.lit(0x3FF))))
        return F.when(F.octet_length(c) == 1, c).when(v >= 0x10000, pair).otherwise(unit(v))

    def one(c: Column) -> Column:
        return let(point(c), lambda v: shown(c, v))

    return F.array_join(F.transform(F.split(text, ""), one), "")
