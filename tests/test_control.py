from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from voltframe.contract import ContractError, load
from voltframe.control import ControlPlane
from voltframe.plans.run import DEFAULT_METADATA, RESOURCES, run
from voltframe.plans.publish import published
from voltframe.streaming import compact, silver, start_refinement

SOURCES = json.loads(DEFAULT_METADATA.read_text())["sources"]


def test_control_plane_from_sources_to_evidence(spark, tmp_path):
    plane = ControlPlane(spark, tmp_path / "control")
    at = lambda d: F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp")
    plane.upsert_sources(SOURCES, "ana", at(1))
    kept = plane.table("source_metadata").withColumn("target_schema", F.lit("gold"))
    plane.replace("source_metadata", spark.createDataFrame(kept.collect(), kept.schema))
    plane.upsert_sources([SOURCES[0] | {"provider": "other", "target_schema": "lost"}], "bo", at(2))
    rows = {r.source_id: r for r in plane.table("source_metadata").collect()}
    assert (rows["market_dispatch"].provider, rows["market_dispatch"].updated_by, rows["market_dispatch"].target_schema) == ("other", "bo", "gold")
    assert rows["weather_hourly"].updated_by == "ana" and rows["weather_hourly"].natural_key == ["region", "observed_at"]

    snap = plane.snapshot("s-1", "ana", "2024-04-07T00:00:00Z", at(3)).first()
    assert snap.source_ids == ["market_dispatch", "weather_hourly"] and snap.status == "validated"
    plane.upsert_sources([SOURCES[0] | {"provider": "third"}], "bo", at(4))
    assert plane.snapshot("s-1", "bo", "x").first().metadata_payload == snap.metadata_payload

    root = tmp_path / "root"
    contract = plane.export_snapshot("s-1", root / "metadata" / "s-1.json")
    (root / "fixtures").mkdir()
    for f in (RESOURCES / "fixtures").iterdir():
        (root / "fixtures" / f.name).write_bytes(f.read_bytes())
    result = run(spark, contract, tmp_path / "out", metadata_root=root, run_id="r1", metadata_snapshot_id="s-1", output_format="parquet")
    assert result.counts["gold"] == 3
    plane.record_run(result, "s-1", at=at(5))
    plane.record_run(result, "s-1", at=at(6))
    assert [(r.run_id, r.accepted_count, r.gold_count, str(r.created_at)) for r in plane.recent_runs(status="succeeded").collect()] == [("r1", 8, 3, "2024-01-05 00:00:00")]
    assert plane.table("pipeline_run_sources").count() == 2 and plane.recent_runs(status="failed").count() == 0

    gold = spark.read.parquet(published(spark, tmp_path / "out") + "/gold")
    plane.annotate("a1", "NSW1|2024-04-07T00:00:00Z", "seen", "open", "ana", at(7))
    plane.annotate("a1", "NSW1|2024-04-07T00:00:00Z", "checked", "closed", "bo", at(8))
    plane.annotate("a2", "NSW1|1999-01-01T00:00:00Z", "gone", "open", "ana", at(8))
    notes = {r.annotation_id: r for r in plane.table("operator_annotations").collect()}
    assert (notes["a1"].audit_version, notes["a1"].note, str(notes["a1"].created_at)) == (2, "checked", "2024-01-07 00:00:00")
    assert [r.annotation_id for r in plane.annotation_orphans(gold).collect()] == ["a2"]

    plane.register("control_test")
    plane.register("control_test")
    assert spark.table("control_test.pipeline_runs").count() == 1 and spark.table("control_test.operator_annotations").count() == 2
    with pytest.raises(ContractError, match="ORPHAN_ROWS"):
        plane.record_run(result, "s-9")
    with pytest.raises(ContractError, match="INVALID_STATUS"):
        plane.record_run(result, "s-1", status="odd")
    with pytest.raises(ContractError, match="ROLE_MAY_NOT_WRITE"):
        plane.annotate("a3", "k", "n", "open", "eve", role="viewer")
    again = plane.run_snapshot("s-1", root, tmp_path / "out2", "r2")
    assert again.manifest["run_id"] == "r2" and plane.recent_runs().count() == 2
    with pytest.raises(ContractError, match="UNAPPROVED_LICENCE"):
        plane.run_snapshot("s-1", root, tmp_path / "out3", "r3", approved_licences=set())
    with pytest.raises(ContractError, match="UNKNOWN_SNAPSHOT"):
        plane.export_snapshot("s-9", tmp_path / "x.json")


def test_streams_resolve_late_rows_like_one_batch(spark, tmp_path):
    source = load(DEFAULT_METADATA).market()
    landing, out = tmp_path / "landing", tmp_path / "out"
    landing.mkdir()
    row = lambda **f: json.dumps({"region": "NSW1", "interval_datetime": "2024-04-07T10:00:00", "demand_mw": 1, "price_per_mwh": 2, "ingestion_sequence": 1} | f)

    def go():
        start_refinement(spark, landing.as_uri(), source, out, (tmp_path / "checkpoint").as_uri(), "2024-04-07T00:00:00Z").awaitTermination()
        return sorted((r.region, r.demand_mw) for r in silver(spark, out, source).collect())

    (landing / "a.jsonl").write_text(row(ingestion_sequence=3, demand_mw=30) + "\n\nnot json\n")
    assert go() == [("NSW1", 30.0)]
    (landing / "b.jsonl").write_text(row(ingestion_sequence=2, demand_mw=20) + "\n" + row(region="VIC1", demand_mw=5) + "\n")
    assert go() == [("NSW1", 30.0), ("VIC1", 5.0)]
    assert go() == [("NSW1", 30.0), ("VIC1", 5.0)]
    compact(spark, out, source)
    assert go() == [("NSW1", 30.0), ("VIC1", 5.0)] and not list((out / "parts").glob("batch=*"))
    (landing / "c.jsonl").write_text(row(region="VIC1", demand_mw=6, ingestion_sequence=2) + "\n")
    assert go() == [("NSW1", 30.0), ("VIC1", 6.0)]
    compact(spark, out, source)
    assert go() == [("NSW1", 30.0), ("VIC1", 6.0)]
    bad = spark.read.parquet((out / "quarantine").as_uri())
    assert [(r.source_row_number, r.reason_codes[0]) for r in bad.collect()] == [(3, "INVALID_JSON:malformed")]
