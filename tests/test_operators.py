from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.contract import ContractError
from voltframe.operators import spikes
from voltframe.operators.dedup import accounting, keep_last
from voltframe.operators.enrich import difference, freshness, lookup, orphans, reconcile
from voltframe.operators.quality import Rule, declared_rule, reasons
from voltframe.operators.upsert import insert_absent, ordered_json, upsert


def test_keep_last_breaks_ties_by_later_columns(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 2, 3, "z"), (None, 0, 4, "n"), ("b", 5, 5, None)], "k string, seq int, row int, v string")
    got = {r.k: (r.v, r.first_seen) for r in keep_last(df, ["k"], ["seq", "row"], "row").collect()}
    assert got == {"a": ("z", 1), None: ("n", 4), "b": (None, 5)}
    assert sorted((r.k, r.accepted, r.silver, r.deduplicated) for r in accounting(df.filter("k is not null"), keep_last(df, ["k"], ["seq"]), "k").collect()) == [("a", 3, 1, 2), ("b", 1, 1, 0)]


def test_dedup_sends_one_row_a_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"))
    plan = keep_last(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan


def test_lookup_never_fans_out(spark):
    left = spark.createDataFrame([(1, "l"), (1, "m"), (2, "n")], "k int, v string")
    right = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (3, 1, "none")], "k int, n int, w string")
    got = sorted((r.k, r.v, r.w) for r in lookup(left, right, ["k"], ["n"], broadcast_rows=10).collect())
    assert got == [(1, "l", "new"), (1, "m", "new"), (2, "n", None)]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert [r.k for r in orphans(child, spark.createDataFrame([(1,)], "p int"), {"k": "p"}).collect()] == [2]


def test_reconcile_and_difference(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "q"), (4, "w")], "k int, v string")
    assert tuple(reconcile(a, b, ["k"]).first()) == (2, 1, 1, 1)
    assert difference(a, a).count() == 0 and difference(a, a.union(a)).filter("side = 'right'").count() == 3


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([(1, "a", "cat", 1), (2, "b", "cat", 1)], "k int, v string, kept string, n int")
    new = spark.createDataFrame([(2, "B", "dog"), (3, "C", "dog")], "k int, v string, kept string")
    out = upsert(old, new, ["k"], ["kept"], {"n": F.coalesce(F.col("n"), F.lit(0)) + 1})
    assert sorted(map(tuple, out.collect())) == [(1, "a", "cat", 1), (2, "B", "cat", 2), (3, "C", "dog", 1)]
    once = insert_absent(old, old.withColumn("v", F.lit("z")), ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, old.collect()))
    assert ordered_json(old, "k", ["k", "v"]).first().payload == '[{"k":1,"v":"a"},{"k":2,"v":"b"}]'


def test_reasons_keep_the_order_of_rules(spark):
    df = spark.range(3).select(reasons([Rule("ODD", F.col("id") % 2 == 1), Rule("SMALL", F.col("id") < 2), Rule("UNKNOWN", F.lit(None).cast("boolean"))]).alias("r"))
    assert [r.r for r in df.collect()] == [["SMALL"], ["ODD", "SMALL"], []]


@pytest.mark.parametrize(("text", "broken"), [("a >= 1", False), ("a > 1", True), ("a = 1", False), ("a < 0.5", True), ("a is null", True), ("A is not null", True), ("a IS NOT NULL", False), ("b is null", False), ("b > 0", True)])
def test_declared_rules(spark, text, broken):
    record = F.try_parse_json(F.lit('{"a":1}'))
    assert spark.range(1).select(declared_rule(text, record).broken).first()[0] is broken
    with pytest.raises(ContractError):
        declared_rule(text + " ; --", record)


def prices(spark, values, minutes=30, region="R", demand=None):
    start = datetime(2024, 1, 1)
    rows = [(region, datetime.fromtimestamp(start.timestamp() + 60 * minutes * i), float(v) if v is not None else None, float((demand or [1] * len(values))[i])) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "region string, interval_utc timestamp, price_per_mwh double, demand_mw double")


def test_spike_rules(spark):
    rows = spikes.flag(prices(spark, [10] * 12 + [50, 50.5, 300, 301, -5, 5001])).orderBy("interval_utc").collect()
    assert [r.is_spike for r in rows[:13]] == [False] * 13  # 50 is at five times the median, not above
    assert (rows[13].spike_rule, rows[13].spike_threshold, rows[13].spike_severity) == ("relative", 50.0, None)
    assert (rows[14].spike_rule, rows[14].spike_severity) == ("relative", None)
    assert (rows[15].spike_rule, rows[15].spike_threshold, rows[15].spike_severity) == ("absolute", 300.0, "warn")
    assert not rows[16].is_spike and rows[17].spike_severity == "extreme"


def test_short_history_has_no_relative_rule(spark):
    rows = spikes.flag(prices(spark, [10] * 11 + [200])).orderBy("interval_utc").collect()
    assert not rows[11].is_spike
    assert spikes.flag(prices(spark, [])).count() == 0


def test_daily_metrics(spark):
    df = spikes.flag(prices(spark, [400, 400, -10, 20], demand=[2, 3, 1, 4]))
    r = spikes.daily_metrics(df, "UTC").first()
    assert (r.spike_interval_count, r.spike_minutes, r.max_price_per_mwh, r.negative_price_interval_count) == (2, 10, 400.0, 1)
    assert str(r.max_price_interval) == "2024-01-01 00:00:00" and abs(r.vwap_per_mwh - (2000 - 10 + 80) / 10) < 1e-9
    assert r.top10_interval_spend_share == 1.0
    poor = spikes.daily_metrics(spikes.flag(prices(spark, [-1, -2])), "UTC").first()
    assert poor.top10_interval_spend_share is None


def test_spike_rules_of_a_source():
    read = spikes.SpikeRules.from_source
    assert read({}) == spikes.SpikeRules()
    assert read({"spike_rules": {"absolute": 100, "window_hours": 6}}).window_hours == 6
    assert read({"spike_rules": {"severity": {"low": 1, "top": 9}}}).severity == (("top", 9.0), ("low", 1.0))
    for bad in ({"absolute": -1}, {"other": 1}, [], {"factor": "5"}, {"factor": True}, {"min_history": 1.5}, {"severity": {}}, {"severity": {"x": -1}}, {"severity": [1]}):
        with pytest.raises(ContractError, match="INVALID_SPIKE_RULES"):
            read({"spike_rules": bad})


def test_packaged_sources_carry_the_documented_defaults():
    from voltframe.contract import load
    from voltframe.plans.run import DEFAULT_LIVE_METADATA, DEFAULT_METADATA

    for path, mode in ((DEFAULT_METADATA, "fixture"), (DEFAULT_LIVE_METADATA, "live")):
        market = load(path, mode=mode).market().definition
        assert spikes.SpikeRules.from_source(market) == spikes.SpikeRules() and market["spike_rules"]


@pytest.mark.parametrize("seed", range(3))
def test_trailing_medians_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    at = np.sort(rng.integers(0, 4000, 600))
    price = np.round(rng.normal(size=600), 1)
    price[rng.random(600) < 0.05] = np.nan
    median, count = spikes.trailing_medians(at, price, 500, 7)
    for i in range(600):
        near = price[(at >= at[i] - 500) & (at <= at[i] - 7)]
        near = near[~np.isnan(near)]
        assert count[i] == len(near) and (len(near) == 0 or abs(median[i] - np.median(near)) < 1e-9)


def test_blocks_of_hours_meet_without_a_seam(spark, monkeypatch):
    """One region with all rows, over blocks far shorter than the window, gives what one block gives."""
    rows = prices(spark, [10 + (i * 37) % 11 + (200 if i % 97 == 0 else 0) for i in range(700)])
    rows = rows.union(rows.limit(1).withColumn("interval_utc", F.lit(None).cast("timestamp")))
    shown = lambda: sorted(map(repr, spikes.flag(rows.repartition(4)).collect()))
    whole = shown()
    monkeypatch.setattr(spikes, "BLOCK_HOURS", 1)
    assert shown() == whole and any("relative" in r for r in whole) and len(whole) == 701


def test_freshness(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 0, 5)), ("a", datetime(2024, 1, 1)), ("b", None)], "s string, at timestamp")
    got = {r.s: r.lag_seconds for r in freshness(df, ["s"], "at", F.lit("2024-01-01 00:01:00")).collect()}
    assert got == {"a": 55, "b": None}
