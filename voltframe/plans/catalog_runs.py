"""Queries over whole runs: contracts, layers, publication, archives, control tables and streams.

Their inputs are the packaged fixtures and cases written out here; what they must give is written out
beside them, as rows of a VALUES list, and was traced by hand.
"""
from __future__ import annotations

import io
import json
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import ContractError, Source, check_dispatch, load, parse, validate_source
from ..control import ControlPlane
from ..functions.json import parse_strict
from ..functions.time import local_to_utc, parse_local, utc_text
from ..operators.quality import declared_rule, reasons, validate
from ..session import ensure
from ..sources import live, multirecord
from ..storage import Storage, below, shared_folder
from . import layers
from .publish import published
from .run import DEFAULT_LIVE_METADATA, DEFAULT_METADATA, RESOURCES, run

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _literal(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def query(columns: str, rows: list[tuple]):
    """Register a query with the rows that it must give; columns as "name TYPE, ..."."""
    named = [c.split() for c in columns.split(", ")]
    shown = ", ".join(f"CAST(c{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(named))
    values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    sql = f"SELECT {shown} FROM (VALUES {values}) AS t({', '.join(f'c{i}' for i in range(len(named)))})"

    def add(build):
        def ran(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure(spark)
            return build(spark)

        ran.__name__, ran.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__], ORACLES[build.__name__] = ran, sql
        return ran

    return add


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return below(shared_folder(spark), f"voltframe-{uuid.uuid4().hex}")


def _settled(spark: SparkSession, rows: DataFrame, place: str) -> DataFrame:
    """The few rows of a fixture, after the folder that they were read from has been removed."""
    found = rows.collect()
    Storage(spark).remove(place)
    return spark.createDataFrame(found, rows.schema)


def _fixture(spark: SparkSession):
    contract = load(DEFAULT_METADATA)
    at = contract.ingested_at("fixture")
    raw = {s.source_id: layers.bronze(spark, s, at) for s in contract.sources}
    return contract, raw, {s.source_id: layers.refine(raw[s.source_id], s) for s in contract.sources}


def _union(frames) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


@query("source_id VARCHAR, line BIGINT, is_json BOOLEAN, ingested VARCHAR", [(s, n, "true", "2024-04-07T00:00:00Z") for s, k in (("market_dispatch", 6), ("weather_hourly", 5)) for n in range(1, k + 1)])
def fixture_bronze(spark):
    """Every raw line of the fixtures with its place."""
    return _union(_fixture(spark)[1].values()).select("source_id", F.col("source_row_number").alias("line"), F.col("raw_record").isNotNull().alias("is_json"), F.col("_ingested_at").alias("ingested"))


@query("source_id VARCHAR, line BIGINT, codes VARCHAR, rejected_at VARCHAR", [("market_dispatch", 4, "INVALID_DEMAND", "2024-04-07T00:00:00Z"), ("market_dispatch", 5, "MISSING_PRICE", "2024-04-07T00:00:00Z"), ("weather_hourly", 4, "MISSING_TEMPERATURE", "2024-04-07T00:00:00Z")])
def fixture_quarantine(spark):
    """Rejected rows with their reasons."""
    rejected = _union(r[1] for r in _fixture(spark)[2].values())
    return rejected.select("source_id", F.col("source_row_number").alias("line"), F.array_join("reason_codes", ",").alias("codes"), "rejected_at")


@query(
    "source_id VARCHAR, region VARCHAR, interval_utc VARCHAR, line BIGINT, first_seen BIGINT, provider VARCHAR",
    [
        ("market_dispatch", "NSW1", "2024-01-14T23:00:00Z", 6, 6, "synthetic"), ("market_dispatch", "NSW1", "2024-04-07T00:00:00Z", 2, 1, "synthetic"), ("market_dispatch", "VIC1", "2024-04-07T00:30:00Z", 3, 3, "synthetic"),
        ("weather_hourly", "NSW1", "2024-01-14T23:00:00Z", 5, 5, "synthetic"), ("weather_hourly", "NSW1", "2024-04-07T00:00:00Z", 3, 1, "synthetic"), ("weather_hourly", "VIC1", "2024-04-07T00:30:00Z", 2, 2, "synthetic"),
    ],
)
def fixture_silver(spark):
    """The last row of each key, with its lineage and where the key was first seen."""
    contract, _, refined = _fixture(spark)
    kept = _union(layers.silver(refined[s.source_id][0], s) for s in contract.sources)
    return kept.select("source_id", "region", utc_text(F.col("interval_utc")).alias("interval_utc"), F.col("source_row_number").alias("line"), "first_seen", F.col("lineage.provider").alias("provider"))


@query("layer VARCHAR, n BIGINT", [("bronze", 11), ("silver", 6), ("quarantine", 3), ("gold", 3)])
def layer_totals(spark):
    """Totals of the layers of a run (A2), from the manifest that it publishes."""
    place = scratch(spark)
    run(spark, output_dir=place, output_format="parquet")
    manifest = json.loads(Storage(spark).read(below(published(spark, place), "manifest.json")))
    Storage(spark).remove(place)
    return spark.createDataFrame(list(manifest["layers"].items()), "layer string, n long")


@query("source_id VARCHAR, bronze BIGINT, accepted BIGINT, quarantine BIGINT, silver BIGINT, deduplicated BIGINT", [("market_dispatch", 6, 4, 2, 3, 1), ("weather_hourly", 5, 4, 1, 3, 1)])
def run_reconciliation(spark):
    """The row accounting of each source of a run (A1, A3)."""
    place = scratch(spark)
    found = run(spark, output_dir=place).manifest["sources"]
    Storage(spark).remove(place)
    names = ("bronze", "accepted", "quarantine", "silver", "deduplicated")
    return spark.createDataFrame([(s, *(c[n] for n in names)) for s, c in found.items()], "source_id string, " + ", ".join(f"{n} long" for n in names))


@query(
    "n BIGINT, region VARCHAR, interval_utc VARCHAR, demand DOUBLE, price DOUBLE, temperature DOUBLE, market_line BIGINT, weather_line BIGINT",
    [(1, "NSW1", "2024-01-14T23:00:00Z", 8100.0, 68.0, 29.0, 6, 5), (2, "NSW1", "2024-04-07T00:00:00Z", 8250.0, 70.0, 24.5, 2, 3), (3, "VIC1", "2024-04-07T00:30:00Z", 5100.0, 65.0, 18.5, 3, 2)],
)
def published_gold(spark):
    """Gold as it is published: JSON lines in order, read back from a write-once output."""
    place = scratch(spark)
    run(spark, output_dir=place, run_id="r1")
    rows = spark.read.text(below(published(spark, place), "gold", "market_weather.jsonl")).select(parse_strict(F.col("value")).alias("v"), F.col("_metadata.file_name").alias("part"), F.monotonically_increasing_id().alias("at"))
    # the order of lines is that of the parts' names, then of the lines in each
    lines = sorted(rows.select("part", "at", F.to_json("v").alias("line")).collect(), key=lambda r: (r["part"], r["at"]))
    Storage(spark).remove(place)
    found = [(i, json.loads(r["line"])) for i, r in enumerate(lines, 1)]
    flat = [(i, g["region"], g["interval_utc"], float(g["demand_mw"]), float(g["price_per_mwh"]), float(g["temperature_c"]), g["lineage"]["market"]["source_row_number"], g["lineage"]["weather"]["source_row_number"]) for i, g in found]
    return spark.createDataFrame(flat, "n long, region string, interval_utc string, demand double, price double, temperature double, market_line long, weather_line long")


@query("attempt BIGINT, outcome VARCHAR, gold BIGINT", [(1, "published", 3), (2, "OUTPUT_ALREADY_EXISTS", 3), (3, "FileNotFoundError", 3)])
def publication_outcomes(spark):
    """A write-once output is written once, and a run that fails leaves what was there."""
    place, broken = scratch(spark), scratch(spark)
    out = []
    document = json.loads(DEFAULT_METADATA.read_text())
    document["sources"][0]["fixture_path"] = "fixtures/none.jsonl"
    Storage(spark).write(below(broken, "metadata", "m.json"), json.dumps(document).encode())
    for i, how in enumerate(({"run_id": "r1"}, {"run_id": "r1"}, {"metadata_path": below(broken, "metadata", "m.json")}), 1):
        try:
            run(spark, output_dir=place, output_format="parquet", **how)
            outcome = "published"
        except (FileExistsError, FileNotFoundError) as error:
            outcome = str(error) if "OUTPUT" in str(error) else type(error).__name__
        out.append((i, outcome, spark.read.parquet(below(published(spark, place), "gold")).count()))
    for folder in (place, broken):
        Storage(spark).remove(folder)
    return spark.createDataFrame(out, "attempt long, outcome string, gold long")


def _row(**fields) -> str:
    return json.dumps({"region": "NSW1", "interval_datetime": "2024-04-07T10:00:00", "demand_mw": 1, "price_per_mwh": 2} | fields)


_BROKEN = "INVALID_RECORD_SHAPE,MISSING_REGION,INVALID_DEMAND,MISSING_PRICE,MISSING_EVENT_TIMESTAMP"
_LINES = [
    ("not json", f"INVALID_JSON:malformed,{_BROKEN}"), ("null", _BROKEN), ("[1]", _BROKEN), ('{"a":1} x', f"INVALID_JSON:malformed,{_BROKEN}"), (_row().replace("2}", "NaN}"), f"INVALID_JSON:malformed,{_BROKEN}"),
    (_row(), ""), (_row(price_per_mwh=-40.5), ""), (_row(ingestion_sequence=7), ""), (_row(region=" "), ""),
    (_row(region=["NSW1"]), "INVALID_REGION"), (_row(region=None), "MISSING_REGION"), (_row(region=0), "MISSING_REGION"), (_row(region={}), "MISSING_REGION"),
    (_row(ingestion_sequence="1"), "INVALID_INGESTION_SEQUENCE"), (_row(ingestion_sequence=None), "INVALID_INGESTION_SEQUENCE"), (_row(ingestion_sequence=1.0), "INVALID_INGESTION_SEQUENCE"), (_row(ingestion_sequence=True), "INVALID_INGESTION_SEQUENCE"), (_row(ingestion_sequence=-1), "INVALID_INGESTION_SEQUENCE"),
    (_row(demand_mw=-1), "INVALID_DEMAND"), (_row(demand_mw=True), "INVALID_DEMAND"), (_row(demand_mw="1"), "INVALID_DEMAND"), (_row(price_per_mwh=None), "MISSING_PRICE"), (_row(price_per_mwh="2"), "MISSING_PRICE"),
    (_row(interval_datetime=""), "MISSING_EVENT_TIMESTAMP"), (_row(interval_datetime="later"), "INVALID_EVENT_TIMESTAMP"), (_row(interval_datetime="2024-04-07"), "INVALID_EVENT_TIMESTAMP"), (_row(interval_datetime=5), "INVALID_EVENT_TIMESTAMP"),
    (_row(interval_datetime="2024-04-07T10:00:00+10:00"), "OFFSET_NOT_ALLOWED"), (_row(interval_datetime="2024-10-06T02:30:00"), "NONEXISTENT_OR_AMBIGUOUS_LOCAL_TIME"), (_row(interval_datetime="2024-04-07T02:30:00"), "NONEXISTENT_OR_AMBIGUOUS_LOCAL_TIME"),
    (_row(region="", demand_mw=None, ingestion_sequence="x"), "MISSING_REGION,INVALID_INGESTION_SEQUENCE,INVALID_DEMAND"),
]


@query("line BIGINT, codes VARCHAR", [(i, codes) for i, (_, codes) in enumerate(_LINES, 1)])
def reason_code_matrix(spark):
    """All reason codes of each kind of broken line, in order."""
    raw = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(_LINES, 1)], "line long, raw_line string").withColumn("raw_record", parse_strict(F.col("raw_line")))
    return validate(raw, load(DEFAULT_METADATA).market()).select("line", F.array_join("reason_codes", ",").alias("codes"))


@query("n BIGINT, codes VARCHAR", [(1, ""), (2, "CHECK_FAILED:x >= 2"), (3, "CHECK_FAILED:x >= 2,CHECK_FAILED:y is null"), (4, "UNSUPPORTED_QUALITY_CHECK")])
def declared_checks(spark):
    """Rules that a contract declares, and one that no grammar admits (Q12)."""
    rows = spark.createDataFrame([(1, '{"x":2}'), (2, '{"x":1.5,"y":null}'), (3, '{"x":"5","y":0}')], "n long, raw string")
    record = parse_strict(F.col("raw"))
    good = rows.select("n", F.array_join(reasons([declared_rule(t, record) for t in ("x >= 2", "y is null")]), ",").alias("codes"))
    try:
        declared_rule("drop table", record)
        refused = "accepted"
    except ContractError as error:
        refused = str(error).partition(":")[0]
    return good.union(spark.createDataFrame([(4, refused)], "n long, codes string"))


_FORMS = [
    ("2024-01-15T10:00:00", "2024-01-14T23:00:00Z", "false"), ("2024-01-15 10:00", "2024-01-14T23:00:00Z", "false"), ("2024-01-15T10", "2024-01-14T23:00:00Z", "false"), ("20240115T100000", "2024-01-14T23:00:00Z", "false"),
    ("20240115T1000", "2024-01-14T23:00:00Z", "false"), ("2024-W03-1T10:00:00", "2024-01-14T23:00:00Z", "false"), ("2024W031T10:00", "2024-01-14T23:00:00Z", "false"), ("2024-01-15T10:00:00.5", "2024-01-14T23:00:00.500000Z", "false"),
    ("2024-01-15T10:00:00,123456789", "2024-01-14T23:00:00.123456Z", "false"), ("2024-01-15T10:00:00Z", "2024-01-14T23:00:00Z", "true"), ("2024-01-15T10:00:00+1000", "2024-01-14T23:00:00Z", "true"), ("2024-01-15", None, "false"),
    ("2024-10-06T02:30:00", None, "false"), ("2024-04-07T02:30:00", None, "false"), ("2023-W53-1T00:00", None, "false"), ("0000-01-01T00:00:00", None, "false"), ("2024-13-01T00:00:00", None, "false"), ("", None, "false"),
]


@query("text VARCHAR, instant VARCHAR, has_offset BOOLEAN", _FORMS)
def local_time_forms(spark):
    """Wall clocks in the forms of ISO 8601, and their instants in Sydney."""
    rows = spark.createDataFrame([(t,) for t, _, _ in _FORMS], "text string")
    parsed = parse_local(F.col("text"))
    rows = rows.select("text", parsed.wall.alias("wall"), parsed.has_offset.alias("has_offset"))
    return rows.select("text", utc_text(local_to_utc(F.col("wall"), "Australia/Sydney")).alias("instant"), "has_offset")


def _refused(call) -> str:
    try:
        call()
        return "accepted"
    except ContractError as error:
        return str(error)


_CASES = [
    *[(f"{f} missing", {f: None}, f"MISSING_SOURCE_FIELD:{f}") for f in ("source_version", "provider", "dataset", "source_timezone", "deduplication_rule", "licensing_provenance")],
    ("version a number", {"source_version": 1}, "MISSING_SOURCE_FIELD:source_version"), ("provider blank", {"provider": " "}, "MISSING_SOURCE_FIELD:provider"),
    ("no such zone", {"source_timezone": "Mars/Base"}, "INVALID_SOURCE_TIMEZONE"), ("other rule", {"deduplication_rule": "first"}, "UNSUPPORTED_DEDUPLICATION_RULE"), ("odd id", {"source_id": "../x"}, "INVALID_SOURCE_ID"),
    ("key of unknown fields", {"natural_key": ["region", "nothing"]}, "INVALID_NATURAL_KEY"), ("empty key", {"natural_key": []}, "INVALID_NATURAL_KEY"), ("mode", {"extraction_mode": "magic"}, "INVALID_EXTRACTION_MODE"),
    ("no path", {"fixture_path": None}, "INVALID_FIXTURE_PATH"), ("absolute path", {"fixture_path": "/etc/passwd"}, "FIXTURE_PATH_OUTSIDE_ROOT"), ("path out of the root", {"fixture_path": "a/../../b"}, "FIXTURE_PATH_OUTSIDE_ROOT"),
    ("live url", {"extraction_mode": "live", "url_or_fixture_path": "ftp://x"}, "INVALID_LIVE_SOURCE_URL"), ("sound", {}, "accepted"),
]
_RUNS = [
    ("run mode", "INVALID_RUN_MODE"), ("live in a fixture run", "LIVE_MODE_NOT_ALLOWED"), ("same id twice", "DUPLICATE_SOURCE_ID"), ("constant", "INVALID_METADATA_JSON:NaN"), ("contract out of the root", "METADATA_PATH_OUTSIDE_ROOT"),
    ("snapshot id", "INVALID_METADATA_SNAPSHOT_ID"), ("output over the contract", "OUTPUT_PATH_CONFLICTS_WITH_METADATA_ROOT"), ("parser", "UNKNOWN_PARSER_KEY:fixture"), ("licence", "UNAPPROVED_LICENCE:market_dispatch"),
    ("version", "UNSUPPORTED_SOURCE_VERSION:market_dispatch"), ("host", "LIVE_SOURCE_HOST_NOT_ALLOWED"), ("spike rules", "INVALID_SPIKE_RULES"),
]


@query("test VARCHAR, code VARCHAR", [*[(n, c) for n, _, c in _CASES], *_RUNS])
def contract_refusals(spark):
    """What a contract, a path or a mode is refused for."""
    from ..operators.spikes import SpikeRules

    document = json.loads(DEFAULT_METADATA.read_text())
    first = document["sources"][0]
    out = [(name, _refused(lambda c=change: validate_source({**first, **c}, RESOURCES))) for name, change, _ in _CASES]
    raw = json.dumps(document).encode()
    twice = json.dumps({**document, "sources": [first, first]}).encode()
    contract = load(DEFAULT_METADATA)
    calls = [
        lambda: parse(raw, RESOURCES, "other"), lambda: parse(DEFAULT_LIVE_METADATA.read_bytes(), RESOURCES), lambda: parse(twice, RESOURCES), lambda: parse(raw.replace(b'"1"', b"NaN", 1), RESOURCES),
        lambda: load(DEFAULT_METADATA, root=RESOURCES / "fixtures", snapshot_id="s"), lambda: load(DEFAULT_METADATA, root=RESOURCES, snapshot_id="../s"), lambda: load(DEFAULT_METADATA, output=RESOURCES),
        lambda: check_dispatch(contract, parsers={"none"}), lambda: check_dispatch(contract, parsers={"fixture"}, licences={"other"}), lambda: check_dispatch(contract, parsers={"fixture"}, versions={}),
        lambda: live.FetchPolicy.of({"url_or_fixture_path": "https://a.example/", "allowed_hosts": ["b.example"]}), lambda: SpikeRules.from_source({"spike_rules": {"factor": -1}}),
    ]
    return spark.createDataFrame([*out, *[(name, _refused(call)) for (name, _), call in zip(_RUNS, calls, strict=True)]], "test string, code string")


def _archive() -> bytes:
    head = "SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION"
    lines = [
        "C,NEMP.WORLD,DISPATCHIS", f"I,DISPATCH,PRICE,5,{head},RRP", 'D,DISPATCH,PRICE,5,"2024/04/07 10:00:00",1,NSW1,20240407120,0,123.45', f"I,DISPATCH,REGIONSUM,9,{head},TOTALDEMAND",
        'D,DISPATCH,REGIONSUM,9,"2024/04/07 10:00:00",1,NSW1,20240407120,0,9876.5', 'D,DISPATCH,PRICE,5,"2024/04/07 10:00:00",1,VIC1,,0,7', "D,DISPATCH,REGIONSUM,9,2024/04/07 10:00:00,1,VIC1,x,0,8", "D,DISPATCH,PRICE,7,2024/04/07 10:00:00,1,QLD1,1,0,1", "D,short",
    ]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("README", "no")
        z.writestr("PUBLIC.csv", "\n".join(lines).encode("latin-1"))
    return data.getvalue()


_MARKET = [("NSW1", "2024-04-07T10:00:00", 9876.5, 123.45, 20240407120, "3,5"), ("VIC1", "2024-04-07T10:00:00", 8.0, 7.0, 0, "6,7")]


@query("region VARCHAR, interval_datetime VARCHAR, demand DOUBLE, price DOUBLE, sequence BIGINT, lines VARCHAR", _MARKET)
def archive_records(spark):
    """Market rows of a multi-record CSV in a ZIP archive."""
    place = scratch(spark)
    Storage(spark).write(below(place, "a.zip"), _archive())
    rows = multirecord.parse_archives(spark, below(place, "a.zip"))
    rows = rows.select("region", "interval_datetime", F.col("demand_mw").alias("demand"), F.col("price_per_mwh").alias("price"), F.col("ingestion_sequence").alias("sequence"), F.array_join(F.col("source_line_numbers").cast("array<string>"), ",").alias("lines"))
    return _settled(spark, rows, place)


@query("line BIGINT, file VARCHAR, region VARCHAR, price DOUBLE", [(1, "https://m.example/f/PUBLIC_DISPATCHIS_2.zip", "NSW1", 123.45), (2, "https://m.example/f/PUBLIC_DISPATCHIS_2.zip", "VIC1", 7.0)])
def live_acquisition(spark):
    """The newest archive of a listing, landed and parsed; the transport is a stub."""
    definition = {"url_or_fixture_path": "https://m.example/l/", "allowed_hosts": ["m.example"], "landing_volume_path": scratch(spark)}
    pages = {"https://m.example/l/": b"<a href='/f/PUBLIC_DISPATCHIS_1.zip'> <A HREF=\"/f/PUBLIC_DISPATCHIS_2.zip\"> <a href='/f/Z.zip'>", "https://m.example/f/PUBLIC_DISPATCHIS_2.zip": _archive()}
    rows = live.read_source(spark, Source(definition, None), lambda url, policy: (200, pages[url]))
    record = parse_strict(F.col("raw_line"))
    rows = rows.select(F.col("source_row_number").alias("line"), F.col("source_file").alias("file"), F.try_variant_get(record, "$.region", "string").alias("region"), F.try_variant_get(record, "$.price_per_mwh", "double").alias("price"))
    return _settled(spark, rows, definition["landing_volume_path"])


@query(
    "what VARCHAR, n BIGINT, shown VARCHAR",
    [("annotations", 2, "2"), ("orphan notes", 1, "a2"), ("runs", 1, "succeeded"), ("snapshots", 1, "market_dispatch,weather_hourly"), ("sources", 2, "bo"), ("run sources", 2, "8"), ("unknown snapshot", 0, "ORPHAN_ROWS:pipeline_runs"), ("roles", 0, "ROLE_MAY_NOT_WRITE:viewer")],
)
def control_tables(spark):
    """Definitions, snapshots, runs and notes, and what their constraints refuse."""
    place = scratch(spark)
    plane = ControlPlane(spark, below(place, "control"))
    definitions = json.loads(DEFAULT_METADATA.read_text())["sources"]
    plane.upsert_sources(definitions, "ana")
    plane.upsert_sources(definitions[:1], "bo")
    snap = [plane.snapshot("s-1", "ana", "2024-04-07T00:00:00Z").first() for _ in range(2)][1]
    for f in (RESOURCES / "fixtures").iterdir():
        Storage(spark).write(below(place, "root", "fixtures", f.name), Path(f).read_bytes())
    result = plane.run_snapshot("s-1", below(place, "root"), below(place, "out"), "r1", output_format="parquet")
    for key, note in (("a1", "seen"), ("a1", "checked"), ("a2", "gone")):
        plane.annotate(key, "NSW1|2024-04-07T00:00:00Z" if key == "a1" else "none", note, "open", "ana")
    gold = spark.read.parquet(below(published(spark, below(place, "out")), "gold"))
    notes = {r["annotation_id"]: r for r in plane.table("operator_annotations").collect()}
    sources = {r["source_id"]: r for r in plane.table("source_metadata").collect()}
    parts = plane.table("pipeline_run_sources").collect()
    lost = [r["annotation_id"] for r in plane.annotation_orphans(gold).collect()]
    recent = plane.recent_runs(status="succeeded").collect()
    rows = [
        ("annotations", len(notes), str(notes["a1"]["audit_version"])), ("orphan notes", len(lost), ",".join(lost)), ("runs", len(recent), recent[0]["status"]), ("snapshots", plane.table("metadata_versions").count(), ",".join(snap["source_ids"])),
        ("sources", len(sources), sources["market_dispatch"]["updated_by"]), ("run sources", len(parts), str(sum(r["accepted_count"] for r in parts))),
        ("unknown snapshot", 0, _refused(lambda: plane.record_run(result, "s-9"))), ("roles", 0, _refused(lambda: plane.annotate("a3", "k", "n", "open", "eve", role="viewer"))),
    ]
    Storage(spark).remove(place)
    return spark.createDataFrame(rows, "what string, n long, shown string")


@query("step BIGINT, region VARCHAR, demand DOUBLE", [(1, "NSW1", 30.0), (2, "NSW1", 30.0), (2, "VIC1", 5.0), (3, "NSW1", 30.0), (3, "VIC1", 5.0)])
def stream_refinement(spark):
    """Silver of a landing folder as files arrive, late ones too, and after its parts are joined."""
    from ..streaming import compact, silver, start_refinement

    place, source = scratch(spark), load(DEFAULT_METADATA).market()
    store, out, rows = Storage(spark), below(place, "out"), []
    landed = [[_row(ingestion_sequence=3, demand_mw=30), "", "not json"], [_row(ingestion_sequence=2, demand_mw=20), _row(region="VIC1", demand_mw=5)]]
    for step in (1, 2, 3):
        if step < 3:
            store.write(below(place, "landing", f"{step}.jsonl"), "\n".join(landed[step - 1]).encode())
        start_refinement(spark, below(place, "landing"), source, out, below(place, "checkpoint"), "2024-04-07T00:00:00Z").awaitTermination()
        if step == 3:
            compact(spark, out, source)
        rows += [(step, r["region"], r["demand_mw"]) for r in silver(spark, out, source).collect()]
    store.remove(place)
    return spark.createDataFrame(rows, "step long, region string, demand double")


@query("line VARCHAR", [('{"a":null,"t":"\\u00e9 \\ud83d\\ude00","x":"inf"}',), ('{"a":"Infinity","t":"","x":1.5}',), ('{"a":"n","t":"q","x":"nan"}',)])
def json_lines(spark):
    """Rows as lines of JSON: sorted names, nulls written, ASCII only, named non-finite numbers."""
    rows = spark.createDataFrame([("é 😀", float("inf"), None), ("", 1.5, "Infinity"), ("q", float("nan"), "n")], "t string, x double, a string")
    return rows.select(layers.as_json(rows).alias("line"))
