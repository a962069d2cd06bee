"""A whole run: contract, layers, reconciliation, manifest, publication."""
from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contract import MARKET_MEASURES, WEATHER_MEASURES, Contract, check_dispatch, load
from ..operators import spikes
from ..session import ensure
from ..sources import ADAPTERS
from . import layers
from .publish import version
from ..storage import Storage, below

RESOURCES = Path(__file__).resolve().parent.parent / "resources"
DEFAULT_METADATA = RESOURCES / "metadata" / "sources.json"
ALL_MEASURES = (*MARKET_MEASURES, *WEATHER_MEASURES)
DEFAULT_LIVE_METADATA = RESOURCES / "metadata" / "sources.live.json"


@dataclass(frozen=True)
class RunResult:
    counts: dict[str, int]
    manifest: dict

    def __getitem__(self, layer: str) -> int:
        return self.counts[layer]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _per_source(df: DataFrame) -> dict[str, int]:
    """Rows by source: one row a source of the contract reaches the driver."""
    return {r["source_id"]: r["n"] for r in df.groupBy("source_id").agg(F.count("*").alias("n")).collect()}


def reconcile(contract: Contract, bronze: dict, accepted: dict, rejected: dict, silver: dict) -> dict[str, dict[str, int]]:
    """The row accounting of every source, from counts that were taken independently of each other."""
    out = {}
    for s in sorted(contract.sources, key=lambda s: s.source_id):
        name = s.source_id
        b, a, q, v = (counts.get(name, 0) for counts in (bronze, accepted, rejected, silver))
        if b != a + q:
            raise RuntimeError(f"BRONZE_RECONCILIATION_FAILED:{name}")
        if not 0 <= a - v <= a or (a > 0) != (v > 0):
            raise RuntimeError(f"SILVER_RECONCILIATION_FAILED:{name}")
        out[name] = {"bronze": b, "accepted": a, "quarantine": q, "silver": v, "deduplicated": a - v}
    return out


class _Layers:
    """Layers of a run as Parquet; what a later layer needs is read back, not computed again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
        path = below(self.root, name)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _export(df: DataFrame, target: str, order: list[str]) -> None:
    """JSON lines in total order: a folder of parts, which follow each other by name. No task or driver holds them all."""
    df.orderBy(*order).select(layers.as_json(df.drop("first_seen")).alias("value")).write.text(target)


def run(
    spark: SparkSession,
    metadata_path: str | Path = DEFAULT_METADATA,
    output_dir: str | Path = "output",
    *,
    metadata_root: str | Path | None = None,
    mode: str | None = "fixture",
    run_id: str | None = None,
    metadata_snapshot_id: str | None = None,
    output_format: str = "jsonl",
    declared_checks: bool = False,
    with_spikes: bool = False,
    approved_versions: dict[str, set[str]] | None = None,
    approved_licences: set[str] | None = None,
) -> RunResult:
    """Run a contract and publish its layers under output_dir.

    output_format "jsonl" gives the exchange layout (JSON lines a source and layer), "parquet" partitioned
    tables; both below publish.published(spark, output_dir). run_id makes the output write-once. A source
    that names an unknown parser, or a version or licence that is not approved, is refused before
    anything is read; None approves all.
    """
    if output_format not in ("jsonl", "parquet"):
        raise ValueError(f"output_format must be jsonl or parquet, not {output_format!r}")
    ensure(spark)
    mode = mode or "fixture"
    contract = load(metadata_path, root=metadata_root, mode=mode, snapshot_id=metadata_snapshot_id, output=output_dir, spark=spark)
    check_dispatch(contract, parsers=set(ADAPTERS), versions=approved_versions, licences=approved_licences)
    rules = spikes.SpikeRules.from_source(contract.market().definition) if with_spikes else None
    ingested_at = contract.ingested_at(mode)
    with version(spark, output_dir, write_once=run_id is not None) as folder:
        store = _Layers(spark, folder if output_format == "parquet" else below(folder, "_layers"))
        raw = _union([layers.bronze(spark, s, ingested_at) for s in contract.sources])
        raw = store.write(raw, "bronze", "source_id")
        mine = lambda df, s: df.filter(F.col("source_id") == s.source_id)
        refined = {s.source_id: layers.refine(mine(raw, s), s, declared_checks) for s in contract.sources}
        rejected = store.write(_union([r[1] for r in refined.values()]), "quarantine")
        # accepted rows are counted as they pass on to Silver: no third run of the rules
        seen = {s.source_id: Observation(f"accepted {s.source_id}") for s in contract.sources}
        kept = {s.source_id: layers.silver(refined[s.source_id][0].observe(seen[s.source_id], F.count("*").alias("n")), s) for s in contract.sources}
        silver = store.write(_union(list(kept.values())), "silver", "source_id")
        accepted = {name: o.get["n"] for name, o in seen.items()}
        market, weather = (mine(silver, s).drop(*[c for c in ALL_MEASURES if c not in s.measures]) for s in (contract.market(), contract.weather()))
        enriched = layers.gold(market, weather, contract, ingested_at)
        if with_spikes:
            enriched = spikes.flag(enriched, rules)
        gold = store.write(enriched, "gold")
        counted = reconcile(contract, _per_source(raw), accepted, _per_source(rejected), _per_source(silver))
        totals = {"bronze": raw.count(), "silver": silver.count(), "quarantine": rejected.count(), "gold": gold.count()}
        manifest = {
            "layers": totals,
            "source_definitions": {"read": len(contract.document["sources"]), "selected": len(contract.sources)},
            "sources": counted,
            "source_ids": sorted(counted),
            "pipeline_ingested_at": ingested_at,
            "metadata_sha256": contract.sha256,
            "mode": mode,
        }
        manifest |= {k: v for k, v in (("run_id", run_id), ("metadata_snapshot_id", metadata_snapshot_id)) if v is not None}
        if with_spikes:
            metrics = store.write(spikes.daily_metrics(gold, contract.market().source_timezone, rules), "spike_metrics")
            found = metrics.agg(F.coalesce(F.sum("spike_interval_count"), F.lit(0)).alias("n")).first()["n"]
            if found != gold.filter("is_spike").count():
                raise RuntimeError("SPIKE_RECONCILIATION_FAILED")
            manifest["spikes"] = {"intervals": found, "region_days": metrics.count()}
        if output_format == "jsonl":
            for s in contract.sources:
                _export(mine(raw, s), below(folder, "bronze", f"{s.source_id}.jsonl"), ["source_row_number"])
                _export(mine(silver, s).drop(*[c for c in ALL_MEASURES if c not in s.measures]), below(folder, "silver", f"{s.source_id}.jsonl"), list(layers.SILVER_ORDER))
            _export(rejected, below(folder, "quarantine", "rejected.jsonl"), ["source_id", "source_row_number"])
            _export(gold, below(folder, "gold", "market_weather.jsonl"), list(layers.SILVER_ORDER))
            if with_spikes:
                _export(metrics, below(folder, "gold", "spike_metrics.jsonl"), ["region", "business_day"])
            Storage(spark).remove(store.root)
        Storage(spark).write(below(folder, "manifest.json"), (json.dumps(manifest, sort_keys=True, indent=2) + "\n").encode())
    return RunResult(totals, manifest)
