"""Control plane: source definitions, immutable snapshots, runs and operator notes as Spark tables.

Tables are Parquet folders under one root, on any storage, replaced as a whole on change; they are
small beside data. The constraints that a database would hold are checked before a write. They can
be copied to and from a database over JDBC (export_jdbc, import_jdbc).
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contract import ContractError, need
from .operators.enrich import orphans
from .operators.upsert import insert_absent, ordered_json, upsert
from .plans.publish import published, version
from .storage import Storage, below

# The states that the tables admit.
SNAPSHOT_STATES = ("validated", "superseded", "rejected")
RUN_STATES = ("planned", "running", "succeeded", "failed", "cancelled")
SOURCE_STATES = ("planned", "running", "succeeded", "failed", "skipped")

_TEXT, _BIG, _TIME = T.StringType(), T.LongType(), T.TimestampType()


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in columns.items()])


_DEFINITION = ("source_version provider dataset region url_or_fixture_path fixture_path file_name_regex format compression extraction_mode schedule event_timestamp_field ingestion_timestamp_field source_timezone schema_reference watermark_field deduplication_rule quarantine_policy licensing_provenance parser_key serverless_worker_key landing_volume_path").split()
TABLES = {
    "source_metadata": _schema(source_id=_TEXT, **{c: _TEXT for c in _DEFINITION}, natural_key=T.ArrayType(_TEXT), quality_checks=T.ArrayType(_TEXT), allowed_hosts=T.ArrayType(_TEXT), spike_rules=_TEXT, active=T.BooleanType(), target_catalog=_TEXT, target_schema=_TEXT, updated_at=_TIME, updated_by=_TEXT),
    "metadata_versions": _schema(snapshot_id=_TEXT, source_ids=T.ArrayType(_TEXT), metadata_payload=_TEXT, created_at=_TIME, created_by=_TEXT, status=_TEXT),
    "pipeline_runs": _schema(run_id=_TEXT, snapshot_id=_TEXT, mode=_TEXT, window_start=_TIME, window_end=_TIME, status=_TEXT, bronze_count=_BIG, accepted_count=_BIG, quarantine_count=_BIG, silver_count=_BIG, gold_count=_BIG, watermark=_TEXT, freshness=_TEXT, failure_stage=_TEXT, failure_code=_TEXT, created_at=_TIME, updated_at=_TIME),
    "pipeline_run_sources": _schema(run_id=_TEXT, source_id=_TEXT, worker_run_id=_TEXT, status=_TEXT, bronze_count=_BIG, accepted_count=_BIG, quarantine_count=_BIG, silver_count=_BIG, watermark=_TEXT, freshness=_TEXT, failure_stage=_TEXT, failure_code=_TEXT, started_at=_TIME, completed_at=_TIME),
    "operator_annotations": _schema(annotation_id=_TEXT, gold_entity_key=_TEXT, note=_TEXT, status=_TEXT, author_identity=_TEXT, created_at=_TIME, updated_at=_TIME, audit_version=T.IntegerType()),
}
KEYS = {"source_metadata": ["source_id"], "metadata_versions": ["snapshot_id"], "pipeline_runs": ["run_id"], "pipeline_run_sources": ["run_id", "source_id"], "operator_annotations": ["annotation_id"]}
STATES = {"metadata_versions": SNAPSHOT_STATES, "pipeline_runs": RUN_STATES, "pipeline_run_sources": SOURCE_STATES}
PARENTS = {"pipeline_runs": ("metadata_versions", {"snapshot_id": "snapshot_id"}), "pipeline_run_sources": ("pipeline_runs", {"run_id": "run_id"})}

COMMENTS = {
    "source_metadata": "Current definition of each source",
    "metadata_versions": "Immutable snapshots of definitions that runs name",
    "pipeline_runs": "One row a run: state, counts, freshness, failure",
    "pipeline_run_sources": "One row a run and source",
    "operator_annotations": "Notes on Gold rows, with an audit version",
}


def recent(rows: DataFrame, n: int, *, at: str = "created_at", key: str = "run_id", state: str = "status", status: str | None = None) -> DataFrame:
    """The n most recent rows, of one state if it is given; of equal times the smallest key first."""
    chosen = rows if status is None else rows.filter(F.col(state) == status)
    return chosen.orderBy(F.desc(at), key).limit(n)


@dataclass
class ControlPlane:
    spark: SparkSession
    root: str | Path

    def table(self, name: str) -> DataFrame:
        folder = published(self.spark, below(self.root, name))
        if folder is None:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(folder)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Check constraints and swap the whole table; readers see the old or the new one."""
        rows = rows.select(*TABLES[name].names)
        keys = KEYS[name]
        bad = rows.filter(" OR ".join(f"{k} IS NULL" for k in keys))
        need(bad.isEmpty(), f"NULL_KEY:{name}")
        need(rows.groupBy(*keys).count().filter("count > 1").isEmpty(), f"DUPLICATE_KEY:{name}")
        if name in STATES:
            need(rows.filter(~F.coalesce(F.col("status").isin(*STATES[name]), F.lit(False))).isEmpty(), f"INVALID_STATUS:{name}")
        if name in PARENTS:
            parent, on = PARENTS[name]
            need(orphans(rows, self.table(parent), on).isEmpty(), f"ORPHAN_ROWS:{name}")
        with version(self.spark, below(self.root, name)) as folder:
            rows.coalesce(1).write.parquet(folder)

    def register(self, database: str = "control") -> None:
        """Name the tables in the session's catalogue, with comments; a second call changes nothing."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, schema in TABLES.items():
            place = below(self.root, name)
            if published(self.spark, place) is None:
                self.replace(name, self.table(name))
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            # a table is a name for the version in force
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            self.spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{published(self.spark, place)}'")
            self.spark.sql(f"COMMENT ON TABLE {database}.{name} IS '{COMMENTS[name]}'")

    def export_jdbc(self, name: str, url: str, mode: str = "append", **options: str) -> None:
        """Copy a table to a database; arrays as JSON text. The driver's jar must be on the class path."""
        flat = self.table(name)
        for f in TABLES[name]:
            if isinstance(f.dataType, T.ArrayType):
                flat = flat.withColumn(f.name, F.to_json(f.name))
        flat.write.jdbc(url, name, mode, options)

    def import_jdbc(self, name: str, url: str, **options: str) -> None:
        """Replace a table with what a database has, after the same checks."""
        rows = self.spark.read.jdbc(url, name, properties=options)
        value = lambda f: F.from_json(f.name, f.dataType) if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast(f.dataType)
        self.replace(name, rows.select(*[value(f).alias(f.name) for f in TABLES[name]]))

    def upsert_sources(self, definitions: Sequence[dict], by: str, at: Column | None = None) -> None:
        """Insert or replace definitions; target_catalog and target_schema of known sources stay."""
        schema = T.StructType([f for f in TABLES["source_metadata"] if f.name not in ("updated_at", "updated_by")])
        known = set(schema.names)
        shown = lambda k, v: json.dumps(v, sort_keys=True) if k == "spike_rules" and v is not None else v
        new = self.spark.createDataFrame([{**{k: shown(k, v) for k, v in d.items() if k in known}, "active": d.get("active", True)} for d in definitions], schema)
        touch = {"updated_at": F.current_timestamp() if at is None else at, "updated_by": F.lit(by)}
        self.replace("source_metadata", upsert(self.table("source_metadata"), new, ["source_id"], ["target_catalog", "target_schema"], touch))

    def snapshot(self, snapshot_id: str, by: str, ingested_at: str, at: Column | None = None) -> DataFrame:
        """Freeze the active definitions under an id, in order of source_id; a known id is left alone."""
        active = self.table("source_metadata").filter("active")
        payload = ordered_json(active, "source_id", [c for c in active.columns if c not in ("updated_at", "updated_by")])
        ids = active.agg(F.sort_array(F.collect_list("source_id")).alias("source_ids"))
        new = ids.withColumn("payload", payload.select("payload").scalar())
        new = new.select(
            F.lit(snapshot_id).alias("snapshot_id"),
            "source_ids",
            F.concat(F.lit('{"pipeline_ingestion_timestamp":'), F.lit(json.dumps(ingested_at)), F.lit(',"sources":'), F.coalesce("payload", F.lit("[]")), F.lit("}")).alias("metadata_payload"),
            (F.current_timestamp() if at is None else at).alias("created_at"),
            F.lit(by).alias("created_by"),
            F.lit("validated").alias("status"),
        )
        self.replace("metadata_versions", insert_absent(self.table("metadata_versions"), new, ["snapshot_id"]))
        return self.table("metadata_versions").filter(F.col("snapshot_id") == snapshot_id)

    def export_snapshot(self, snapshot_id: str, target: str | Path) -> str | Path:
        """The frozen contract as a file that a run can name."""
        row = self.table("metadata_versions").filter(F.col("snapshot_id") == snapshot_id).select("metadata_payload").first()
        if row is None:
            raise ContractError(f"UNKNOWN_SNAPSHOT:{snapshot_id}")
        document = json.loads(row[0])
        document["sources"] = [{k: json.loads(v) if k == "spike_rules" else v for k, v in s.items() if v is not None} for s in document["sources"]]
        Storage(self.spark).write(target, json.dumps(document, sort_keys=True, indent=1).encode())
        return target

    def run_snapshot(self, snapshot_id: str, root: str | Path, output: str | Path, run_id: str, **how):
        """Run a frozen contract out of a root that holds its fixtures, and record the evidence."""
        from .plans.run import run

        contract = self.export_snapshot(snapshot_id, below(root, "metadata", f"{snapshot_id}.json"))
        result = run(self.spark, contract, output, metadata_root=root, run_id=run_id, metadata_snapshot_id=snapshot_id, **how)
        self.record_run(result, snapshot_id)
        return result

    def record_run(self, result, snapshot_id: str, status: str = "succeeded", at: Column | None = None) -> None:
        """Evidence of a finished run: one row for it and one for each of its sources."""
        m = result.manifest
        run_id = m["run_id"]
        now = F.current_timestamp() if at is None else at
        sums = {k: sum(s[k] for s in m["sources"].values()) for k in ("bronze", "accepted", "quarantine", "silver")}
        run = {"run_id": run_id, "snapshot_id": snapshot_id, "mode": m["mode"], "status": status, "freshness": m["pipeline_ingested_at"], "gold_count": m["layers"]["gold"], **{f"{k}_count": v for k, v in sums.items()}}
        runs = self.spark.createDataFrame([run], TABLES["pipeline_runs"]).withColumns({"created_at": now, "updated_at": now})
        self.replace("pipeline_runs", upsert(self.table("pipeline_runs"), runs, ["run_id"], ["created_at"]))
        rows = [{"run_id": run_id, "source_id": name, "status": status, **{f"{k}_count": s[k] for k in ("bronze", "accepted", "quarantine", "silver")}} for name, s in m["sources"].items()]
        sources = self.spark.createDataFrame(rows, TABLES["pipeline_run_sources"]).withColumn("completed_at", now)
        self.replace("pipeline_run_sources", upsert(self.table("pipeline_run_sources"), sources, ["run_id", "source_id"]))

    def annotate(self, annotation_id: str, gold_entity_key: str, note: str, status: str, author: str, at: Column | None = None, role: str = "operator") -> None:
        """Add an operator's note, or change it, which raises its audit version. Other roles only read."""
        need(role == "operator", f"ROLE_MAY_NOT_WRITE:{role}")
        now = F.current_timestamp() if at is None else at
        old = self.table("operator_annotations")
        new = self.spark.createDataFrame([(annotation_id, gold_entity_key, note, status, author)], "annotation_id string, gold_entity_key string, note string, status string, author_identity string")
        new = new.withColumns({"created_at": now, "updated_at": now})
        merged = upsert(old, new, ["annotation_id"], ["created_at"], {"audit_version": F.coalesce(F.col("audit_version"), F.lit(0)) + 1})
        self.replace("operator_annotations", merged)

    def recent_runs(self, n: int = 20, status: str | None = None) -> DataFrame:
        return recent(self.table("pipeline_runs"), n, status=status)

    def annotation_orphans(self, gold: DataFrame) -> DataFrame:
        """Notes on rows that Gold does not have."""
        keys = gold.select(F.concat_ws("|", "region", F.date_format("interval_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("entity_key"))
        return orphans(self.table("operator_annotations"), keys, {"gold_entity_key": "entity_key"})
