"""Price spikes: a rule of an absolute threshold and one relative to the trailing median.

Decisions: a price is above a threshold, not at it; the median is that of the 24 hours before the
row, without it, and counts from MIN_HISTORY intervals on; the absolute rule wins when both fire;
prices of zero or less are never spikes. Severity goes by the price alone.

The trailing median: rows are dealt by region and block of hours, each block with the prices of the
window's hours before it; in a block the window is a sorted list that gains and loses a price as it
moves. A region's history is so cut into pieces of bounded time, and each costs n log w.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError
from ..functions.time import business_day


@dataclass(frozen=True)
class SpikeRules:
    absolute: float | None = 300.0
    factor: float | None = 5.0
    window_hours: int = 24
    min_history: int = 12
    severity: tuple[tuple[str, float], ...] = (("extreme", 5000.0), ("high", 1000.0), ("warn", 300.0))
    interval_minutes: int = 5
    top: int = 10
    whole: tuple[str, ...] = field(default=("window_hours", "min_history", "interval_minutes", "top"), repr=False)

    @classmethod
    def from_source(cls, definition: dict) -> SpikeRules:
        """The spike_rules block of a market source; defaults for what is absent.

        Numbers are positive, counts whole; severity gives a least price for each name.
        """
        block = definition.get("spike_rules")
        if block is None:
            return cls()
        known = {"absolute", "factor", *cls().whole}
        number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and 0 < v < float("inf")
        fine = isinstance(block, dict) and set(block) <= {*known, "severity"}
        fine = fine and all(number(v) and (k not in cls().whole or v == int(v)) for k, v in block.items() if k in known)
        levels = block.get("severity", {}) if fine else {}
        if not fine or not isinstance(levels, dict) or not all(number(v) for v in levels.values()) or ("severity" in block and not levels):
            raise ContractError("INVALID_SPIKE_RULES")
        given = {k: int(v) if k in cls().whole else float(v) for k, v in block.items() if k in known}
        if levels:
            given["severity"] = tuple(sorted(((k, float(v)) for k, v in levels.items()), key=lambda x: -x[1]))
        return cls(**given)


#: Hours of a block; rows of the window's hours before it are looked at as well.
BLOCK_HOURS = 24 * 7


def trailing_medians(at: np.ndarray, price: np.ndarray, span: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, ordered by time: the median and the number of prices from span to gap before it, both included."""
    first, last = np.searchsorted(at, at - span, side="left"), np.searchsorted(at, at - gap, side="right")
    median, count = np.full(len(at), np.nan), np.zeros(len(at), np.int64)
    held: list[float] = []
    low = high = 0
    values = price.tolist()
    for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        while high < b:
            if values[high] == values[high]:
                insort(held, values[high])
            high += 1
        while low < a:
            if values[low] == values[low]:
                del held[bisect_left(held, values[low])]
            low += 1
        if n := len(held):
            median[i] = held[n // 2] if n % 2 else held[n // 2 - 1] + (held[n // 2] - held[n // 2 - 1]) * 0.5
            count[i] = n
    return median, count


def _medians(span: int, gap: int, schema: list[str]):
    """Rows (block, other, turn, at, price, row) ordered by block and time: rows of turn 0 with their median and count."""

    def run(batches):
        held, now = [], None

        def done():
            rows = pa.Table.from_batches(held)
            at = rows.column("at").to_numpy()
            price = rows.column("price").to_numpy(zero_copy_only=False).astype(np.float64)
            median, count = trailing_medians(at, price, span, gap)
            mine = np.flatnonzero(rows.column("turn").to_numpy() == 0)
            kept = rows.column("row").take(pa.array(mine)).combine_chunks()
            kept = kept if isinstance(kept, pa.Array) else pa.concat_arrays(kept.chunks)
            found = pa.array(median[mine], pa.float64(), mask=count[mine] == 0)
            return pa.RecordBatch.from_arrays([kept, found, pa.array(count[mine])], names=schema)

        for batch in batches:
            block, other = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (other[1:] != other[:-1])) + 1).tolist(), len(block)] if len(block) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if now is not None and (block[a], other[a]) != now:
                    yield done()
                    held = []
                now = block[a], other[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield done()

    return run


def with_medians(df: DataFrame, rules: SpikeRules, region: str, at: str, price: str) -> DataFrame:
    """The rows as structs `row`, with median and history."""
    span, gap, block = rules.window_hours * 3600 * 1_000_000, 1_000_000, BLOCK_HOURS * 3600 * 1_000_000
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), micros.alias("at"), F.col(price).cast("double").alias("price"), F.col(region).alias("region"))
    number = F.floor(F.col("at") / block)
    # a block's rows, and once more those that lie in a later block's window, without what is not needed there
    later = F.sequence(number + 1, F.floor((F.col("at") + span) / block))
    mine = rows.select("region", number.alias("number"), F.lit(0).alias("turn"), "at", "price", "row")
    before = rows.filter(F.floor((F.col("at") + span) / block) > number).select("region", F.explode(later).alias("number"), F.lit(1).alias("turn"), "at", "price", F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    # two hashes stand for region and number
    dealt = mine.union(before).withColumns({"block": F.xxhash64("region", "number"), "other": F.xxhash64("number", F.lit("block"), "region")})
    dealt = dealt.repartition("block", "other").sortWithinPartitions("block", "other", "at")
    out = T.StructType([rows.schema["row"], T.StructField("median", T.DoubleType()), T.StructField("history", T.LongType())])
    return dealt.select("block", "other", "turn", "at", "price", "row").filter("at IS NOT NULL").mapInArrow(_medians(span, gap, out.names), out).union(
        rows.filter("at IS NULL").select("row", F.lit(None).cast("double"), F.lit(0).cast("bigint"))
    )


def flag(df: DataFrame, rules: SpikeRules = SpikeRules(), *, region: str = "region", at: str = "interval_utc", price: str = "price_per_mwh") -> DataFrame:
    """df with is_spike, spike_rule, spike_threshold and spike_severity. Rows without a time have no history."""
    if rules.factor is None:
        staged = df.withColumns({"_median": F.lit(None).cast("double"), "_history": F.lit(0).cast("bigint")})
        p, median, history = F.col(price), F.col("_median"), F.col("_history")
        kept = [F.col(f"`{c}`") for c in df.columns]
    else:
        staged = with_medians(df, rules, region, at, price)
        p, median, history = F.col(f"row.`{price}`"), F.col("median"), F.col("history")
        kept = [F.col(f"row.`{c}`").alias(c) for c in df.columns]
    by_value = F.lit(False) if rules.absolute is None else F.coalesce(p > rules.absolute, F.lit(False))
    limit = F.lit(None).cast("double") if rules.factor is None else median * rules.factor
    by_median = F.coalesce((history >= rules.min_history) & (p > limit) & (p > 0), F.lit(False))
    severity: Column = F.lit(None).cast("string")
    for name, least in reversed(rules.severity):
        severity = F.when(p > least, F.lit(name)).otherwise(severity)
    rule = F.when(by_value, F.lit("absolute")).when(by_median, F.lit("relative"))
    return staged.select(
        *kept,
        (by_value | by_median).alias("is_spike"),
        rule.alias("spike_rule"),
        F.when(by_value, F.lit(rules.absolute)).when(by_median, limit).alias("spike_threshold"),
        F.when(by_value | by_median, severity).alias("spike_severity"),
    )


def top_region(df: DataFrame, start: str, end: str, rules: SpikeRules = SpikeRules(), *, region: str = "region", at: str = "interval_utc", price: str = "price_per_mwh") -> DataFrame:
    """The region with most spikes from start to before end. Only these hours and the window before them are read."""
    begin, stop = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    near = df.filter((F.col(at) >= begin - F.expr(f"INTERVAL {rules.window_hours} HOURS")) & (F.col(at) < stop))
    found = flag(near, rules, region=region, at=at, price=price).filter((F.col(at) >= begin) & F.col("is_spike"))
    return found.groupBy(region).agg(F.count("*").alias("spikes")).orderBy(F.desc("spikes"), region).limit(1)


def highest_interval(df: DataFrame, day: Column, *, region: str = "region", at: str = "interval_utc", price: str = "price_per_mwh") -> DataFrame:
    """Of each region and day the highest price and when it occurred; of equal ones the earliest."""
    best = F.max_by(F.struct(F.col(price).alias("price"), F.col(at).alias("at")), F.struct(F.col(price), -F.unix_micros(F.col(at).cast("timestamp"))))
    rows = df.groupBy(F.col(region).alias("region"), day.alias("day")).agg(best.alias("best"))
    return rows.select("region", "day", F.col("best.price").alias("max_price"), F.col("best.at").alias("max_at"))


def vwap(price: Column, volume: Column) -> Column:
    """Volume-weighted average price; null without volume."""
    return F.sum(price * volume) / F.nullif(F.sum(volume), F.lit(0.0))


def daily_metrics(flagged: DataFrame, zone: str, rules: SpikeRules = SpikeRules(), *, region: str = "region", at: str = "interval_utc", price: str = "price_per_mwh", demand: str = "demand_mw") -> DataFrame:
    """Per region and business day in the zone: spikes, extremes, volume-weighted price, spend shares."""
    p, d = F.col(price), F.col(demand)
    day = flagged.withColumns({"business_day": business_day(F.col(at), zone), "_spend": p * d})
    rank = F.row_number().over(Window.partitionBy(region, "business_day").orderBy(p.desc(), F.col(at), d, F.xxhash64(*[c for c in flagged.columns if c in (region, at, price, demand)])))
    day = day.withColumn("_rank", rank)
    spend = F.sum("_spend")
    return day.groupBy(region, "business_day").agg(
        F.count_if("is_spike").alias("spike_interval_count"),
        (F.count_if("is_spike") * rules.interval_minutes).alias("spike_minutes"),
        F.max(p).alias("max_price_per_mwh"),
        F.min(F.when(F.col("_rank") == 1, F.col(at))).alias("max_price_interval"),
        vwap(p, d).alias("vwap_per_mwh"),
        F.when(spend > 0, F.sum(F.when(F.col("_rank") <= rules.top, F.col("_spend"))) / spend).alias("top10_interval_spend_share"),
        F.count_if(p < 0).alias("negative_price_interval_count"),
    )
