from __future__ import annotations

import contextlib
import io
import json
import shutil
import threading
import zipfile

import pytest

from voltframe import cli
from voltframe.contract import ContractError
from voltframe.plans import publish
from voltframe.plans.run import DEFAULT_LIVE_METADATA, DEFAULT_METADATA, RESOURCES, run
from voltframe.sources import live
from voltframe.storage import Storage, below


def at(out):
    """The folder of the version in force."""
    return out / "versions" / (out / "CURRENT").read_text()


def lines(path):
    return [json.loads(x) for part in sorted(path.glob("part-*")) for x in part.read_text(encoding="utf-8").splitlines()]


def files(out):
    """What is published, by name; the parts of a folder of lines in order as one."""
    root, found = at(out), {}
    for p in sorted(root.rglob("*")):
        if p.is_file() and not p.name.startswith((".", "_")):
            name = str(p.parent.relative_to(root)) if p.name.startswith("part-") else str(p.relative_to(root))
            found[name] = found.get(name, b"") + p.read_bytes()
    return found


@pytest.fixture
def contract(tmp_path):
    """A copy of the packaged contract whose fixtures tests may change."""
    root = tmp_path / "contract"
    shutil.copytree(RESOURCES, root)
    return root


def market(root, *rows):
    (root / "fixtures" / "market_dispatch.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")


def sound(**fields):
    return {"region": "NSW1", "interval_datetime": "2024-04-07T10:00:00", "demand_mw": 1, "price_per_mwh": 2} | fields


def test_packaged_contract(spark, tmp_path):
    out = tmp_path / "out"
    result = run(spark, output_dir=out)
    assert result.counts == {"bronze": 11, "silver": 6, "quarantine": 3, "gold": 3}
    gold = lines(at(out) / "gold" / "market_weather.jsonl")
    assert [(g["region"], g["interval_utc"], g["demand_mw"], g["price_per_mwh"], g["temperature_c"], g["lineage"]["market"]["source_row_number"], g["lineage"]["weather"]["source_row_number"]) for g in gold] == [
        ("NSW1", "2024-01-14T23:00:00Z", 8100, 68.0, 29.0, 6, 5),
        ("NSW1", "2024-04-07T00:00:00Z", 8250, 70.0, 24.5, 2, 3),
        ("VIC1", "2024-04-07T00:30:00Z", 5100, 65.0, 18.5, 3, 2),
    ]
    assert all(g["freshness"] == {"pipeline_ingested_at": "2024-04-07T00:00:00Z", "latest_event_utc": g["interval_utc"]} for g in gold)
    manifest = json.loads((at(out) / "manifest.json").read_text())
    assert manifest["sources"]["market_dispatch"] == {"bronze": 6, "accepted": 4, "quarantine": 2, "silver": 3, "deduplicated": 1}
    assert manifest["sources"]["weather_hourly"] == {"bronze": 5, "accepted": 4, "quarantine": 1, "silver": 3, "deduplicated": 1}
    before = files(out)
    run(spark, output_dir=out)
    assert files(out) == before and len(before) == 7
    assert len(list((out / "versions").iterdir())) == 1  # what is no longer in force is gone


def test_write_once_and_context(spark, tmp_path):
    out = tmp_path / "run-1"
    result = run(spark, output_dir=out, run_id="r1", metadata_snapshot_id="s1", output_format="parquet")
    assert (result.manifest["run_id"], result.manifest["metadata_snapshot_id"], result.manifest["mode"]) == ("r1", "s1", "fixture")
    assert spark.read.parquet((at(out) / "gold").as_uri()).count() == 3
    with pytest.raises(FileExistsError, match="OUTPUT_ALREADY_EXISTS"):
        run(spark, output_dir=out, run_id="r1")
    dangling = tmp_path / "link"
    dangling.symlink_to(tmp_path / "nowhere")
    with pytest.raises(FileExistsError):
        run(spark, output_dir=dangling, run_id="r2")
    assert len(list((out / "versions").iterdir())) == 1


def test_failures_leave_the_old_output(spark, tmp_path, contract, monkeypatch):
    out = tmp_path / "out"
    run(spark, contract / "metadata" / "sources.json", out)
    before = files(out)
    (contract / "fixtures" / "weather_hourly.jsonl").unlink()
    with pytest.raises(FileNotFoundError):
        run(spark, contract / "metadata" / "sources.json", out)
    monkeypatch.setattr(publish.Storage, "write", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        run(spark, output_dir=out)
    assert files(out) == before and len(list((out / "versions").iterdir())) == 1


def test_of_runs_that_race_for_an_output_one_wins(spark, tmp_path):
    out, won = tmp_path / "out", []

    def race(name):
        with contextlib.suppress(FileExistsError), publish.version(spark, out, write_once=True) as folder:
            Storage(spark).write(below(folder, "who"), name.encode())
            barrier.wait()
            won.append(name)

    barrier = threading.Barrier(2)
    threads = [threading.Thread(target=race, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    folder = publish.published(spark, out)
    assert sorted(won) == ["a", "b"] and Storage(spark).read(below(folder, "who")) in (b"a", b"b")
    assert len(list((out / "versions").iterdir())) == 1


def test_outputs_on_storage_that_only_spark_reaches(spark, tmp_path):
    """Through a path that is no local one: every write and read goes through the file system interface."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shop.link./data", tmp_path.as_uri())
    shutil.copytree(RESOURCES, tmp_path / "contract")
    out = "viewfs://shop/data/out"
    result = run(spark, "viewfs://shop/data/contract/metadata/sources.json", out, metadata_root="viewfs://shop/data/contract", run_id="r1", metadata_snapshot_id="s1")
    assert result.counts == {"bronze": 11, "silver": 6, "quarantine": 3, "gold": 3}
    assert publish.published(spark, out).startswith("viewfs://shop/data/out/versions/") and len(lines(at(tmp_path / "out") / "gold" / "market_weather.jsonl")) == 3
    with pytest.raises(ContractError, match="METADATA_PATH_OUTSIDE_ROOT"):
        run(spark, "viewfs://shop/data/contract/metadata/sources.json", out, metadata_root="viewfs://shop/data/other", metadata_snapshot_id="s1")
    with pytest.raises(ContractError, match="OUTPUT_PATH_CONFLICTS"):
        run(spark, "viewfs://shop/data/contract/metadata/sources.json", "viewfs://shop/data/contract")


def test_dispatch_refuses_before_anything_is_written(spark, tmp_path):
    for how, code in (({"approved_licences": {"other"}}, "UNAPPROVED_LICENCE"), ({"approved_versions": {"market_dispatch": {"9"}}}, "UNSUPPORTED_SOURCE_VERSION")):
        with pytest.raises(ContractError, match=code):
            run(spark, output_dir=tmp_path / "out", **how)
    assert not (tmp_path / "out").exists()


def test_json_lines_are_ascii_and_name_numbers_that_are_not_finite(spark):
    from voltframe.plans.layers import as_json

    df = spark.createDataFrame([(1.5, "é 漢 😀 \\u0041 \"q\""), (float("inf"), "Infinity"), (float("-inf"), None), (float("nan"), "NaN")], "x double, t string")
    got = [r[0] for r in df.select(as_json(df)).collect()]
    assert all(g.isascii() for g in got)
    assert [json.loads(g) for g in got] == [{"x": 1.5, "t": "é 漢 😀 \\u0041 \"q\""}, {"x": "inf", "t": "Infinity"}, {"x": "-inf", "t": None}, {"x": "nan", "t": "NaN"}]


CODES = [
    ("not json", ["INVALID_JSON:malformed", "INVALID_RECORD_SHAPE", "MISSING_REGION", "INVALID_DEMAND", "MISSING_PRICE", "MISSING_EVENT_TIMESTAMP"]),
    ("null", ["INVALID_RECORD_SHAPE", "MISSING_REGION", "INVALID_DEMAND", "MISSING_PRICE", "MISSING_EVENT_TIMESTAMP"]),
    ('{"a":1} x', ["INVALID_JSON:malformed", "INVALID_RECORD_SHAPE", "MISSING_REGION", "INVALID_DEMAND", "MISSING_PRICE", "MISSING_EVENT_TIMESTAMP"]),
    ('{"a":1}] {', ["INVALID_JSON:malformed", "INVALID_RECORD_SHAPE", "MISSING_REGION", "INVALID_DEMAND", "MISSING_PRICE", "MISSING_EVENT_TIMESTAMP"]),
    (json.dumps(sound()).replace("2}", "NaN}"), ["INVALID_JSON:malformed", "INVALID_RECORD_SHAPE", "MISSING_REGION", "INVALID_DEMAND", "MISSING_PRICE", "MISSING_EVENT_TIMESTAMP"]),
    (sound(interval_datetime="later"), ["INVALID_EVENT_TIMESTAMP"]),
    (sound(interval_datetime="2024-04-07"), ["INVALID_EVENT_TIMESTAMP"]),
    (sound(interval_datetime=5), ["INVALID_EVENT_TIMESTAMP"]),
    (sound(interval_datetime="2024-04-07T10:00:00+10:00"), ["OFFSET_NOT_ALLOWED"]),
    (sound(interval_datetime="2024-10-06T02:30:00"), ["NONEXISTENT_OR_AMBIGUOUS_LOCAL_TIME"]),
    (sound(interval_datetime="2024-04-07T02:30:00"), ["NONEXISTENT_OR_AMBIGUOUS_LOCAL_TIME"]),
    (sound(interval_datetime=""), ["MISSING_EVENT_TIMESTAMP"]),
    (sound(region=["NSW1"]), ["INVALID_REGION"]),
    *[(sound(region=r), ["MISSING_REGION"]) for r in (None, "", 0, False, [], {})],
    (sound(region=" "), []),
    *[(sound(ingestion_sequence=s), ["INVALID_INGESTION_SEQUENCE"]) for s in ("1", None, True, -1, 1.0, [1])],
    (sound(ingestion_sequence=7), []),
    *[(sound(demand_mw=d), ["INVALID_DEMAND"]) for d in (-1, None, True, "1", [], -0.5)],
    (json.dumps(sound()).replace('"demand_mw": 1', '"demand_mw": 1e999'), ["INVALID_DEMAND"]),
    *[(sound(price_per_mwh=p), ["MISSING_PRICE"]) for p in (None, False, "2")],
    (sound(price_per_mwh=-40.5), []),
    ('{"region":"X","region":"NSW1","interval_datetime":"2024-04-07T10:00:00","demand_mw":1,"price_per_mwh":2}', []),
]


def test_reason_codes(spark, tmp_path, contract):
    market(contract, *[c[0] for c in CODES])
    out = tmp_path / "out"
    run(spark, contract / "metadata" / "sources.json", out)
    got = {r["source_row_number"]: r["reason_codes"] for r in lines(at(out) / "quarantine" / "rejected.jsonl") if r["source_id"] == "market_dispatch"}
    assert [got.get(i, []) for i in range(1, len(CODES) + 1)] == [c[1] for c in CODES]


def test_blank_lines_keep_their_numbers_and_ties_go_to_the_later_row(spark, tmp_path, contract):
    market(contract, "", sound(demand_mw=5), "   ", sound(demand_mw=6), sound(demand_mw=7, ingestion_sequence=-1))
    out = tmp_path / "out"
    assert run(spark, contract / "metadata" / "sources.json", out).counts["bronze"] == 8
    silver = lines(at(out) / "silver" / "market_dispatch.jsonl")
    assert [(s["source_row_number"], s["demand_mw"]) for s in silver] == [(4, 6)]
    assert "temperature_c" not in silver[0]


def test_finer_weather_keys_do_not_fan_out(spark, tmp_path, contract):
    path = contract / "metadata" / "sources.json"
    doc = json.loads(path.read_text())
    doc["sources"][1]["natural_key"] = ["region", "observed_at", "temperature_c"]
    path.write_text(json.dumps(doc))
    result = run(spark, path, tmp_path / "out")
    assert result.counts["gold"] == 3 and result.counts["silver"] == 7
    assert lines(at(tmp_path / "out") / "gold" / "market_weather.jsonl")[1]["temperature_c"] == 24.5


def test_third_class_and_empty_sources(spark, tmp_path, contract):
    path = contract / "metadata" / "sources.json"
    doc = json.loads(path.read_text())
    doc["sources"].append(doc["sources"][1] | {"source_id": "soil", "dataset": "SOIL"})
    path.write_text(json.dumps(doc))
    market(contract)
    result = run(spark, path, tmp_path / "out")
    assert result.counts["gold"] == 0 and result.manifest["sources"]["soil"]["silver"] == 3
    assert lines(at(tmp_path / "out") / "silver" / "market_dispatch.jsonl") == []


def test_declared_checks_and_spikes(spark, tmp_path, contract):
    path = contract / "metadata" / "sources.json"
    doc = json.loads(path.read_text())
    doc["sources"][0]["quality_checks"] = ["demand_mw > 6000"]
    doc["sources"][0]["spike_rules"] = {"absolute": 69, "severity": {"odd": 60, "very": 5000}}
    path.write_text(json.dumps(doc))
    result = run(spark, path, tmp_path / "out", declared_checks=True, with_spikes=True)
    assert result.manifest["sources"]["market_dispatch"]["accepted"] == 3
    assert result.manifest["spikes"] == {"intervals": 1, "region_days": 2}
    doc["sources"][0]["quality_checks"] = ["drop table"]
    path.write_text(json.dumps(doc))
    with pytest.raises(ContractError, match="UNSUPPORTED_QUALITY_CHECK"):
        run(spark, path, tmp_path / "out2", declared_checks=True)


def archive(*extra):
    text = "\n".join(
        [
            "C,NEMP.WORLD,DISPATCHIS",
            "I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION,RRP",
            'D,DISPATCH,PRICE,5,"2024/04/07 10:00:00",1,NSW1,20240407120,0,123.45',
            "I,DISPATCH,REGIONSUM,9,SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION,TOTALDEMAND",
            'D,DISPATCH,REGIONSUM,9,"2024/04/07 10:00:00",1,NSW1,20240407120,0,9876.5',
            *extra,
        ]
    )
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("README", "no")
        z.writestr("PUBLIC.csv", text.encode("latin-1"))
    return data.getvalue()


def fake(pages):
    def transport(url, policy):
        return 200, pages[url]

    return transport


LISTING = b"<a href='/f/PUBLIC_DISPATCHIS_1.zip'>1</a> <A HREF=\"/f/PUBLIC_DISPATCHIS_2.zip\">2</A> <a href='/f/OTHER_9.zip'>"


def test_live_run(spark, tmp_path, monkeypatch):
    listing = json.loads(DEFAULT_LIVE_METADATA.read_text())["sources"][0]["url_or_fixture_path"]
    pages = {listing: LISTING, live.urllib.parse.urljoin(listing, "/f/PUBLIC_DISPATCHIS_2.zip"): archive()}
    monkeypatch.setattr(live.read_source, "__defaults__", (fake(pages),))
    result = run(spark, DEFAULT_LIVE_METADATA, tmp_path / "out", mode="live")
    assert result.counts == {"bronze": 6, "silver": 4, "quarantine": 1, "gold": 1}
    gold = lines(at(tmp_path / "out") / "gold" / "market_weather.jsonl")[0]
    assert (gold["temperature_c"], gold["demand_mw"], gold["price_per_mwh"]) == (24.5, 9876.5, 123.45)
    assert gold["lineage"]["market"]["source_file"].endswith("PUBLIC_DISPATCHIS_2.zip")
    raw = json.loads(lines(at(tmp_path / "out") / "bronze" / "market_live.jsonl")[0]["raw_line"])
    assert raw["source_line_numbers"] == [3, 5] and raw["ingestion_sequence"] == 20240407120 and raw["source_record_types"] == ["PRICE", "REGIONSUM"]


def test_multirecord_rules(spark, tmp_path):
    from voltframe.sources.multirecord import parse_archives

    extra = [
        'D,DISPATCH,PRICE,5,"2024/04/07 10:00:00",1,NSW1,20240407121,0,50.5',  # the later row counts
        'D,DISPATCH,PRICE,5,"2024/04/07 10:00:00",1,NSW1,20240407122,0,',  # without a price it does not
        'D,DISPATCH,PRICE,7,"2024/04/07 10:05:00",1,NSW1,1,0,1',  # no header of that version
        'D,DISPATCH,PRICE,5,"2024/04/07 10:05:00",1,VIC1,1,0,9',  # no demand
        "I,DISPATCH,PRICE,5,REGIONID,SETTLEMENTDATE,RRP",  # a header changes, and has no INTERVENTION
        "D,DISPATCH,PRICE,5,QLD1,2024/04/07 10:00:00,7,surplus",
        "D,DISPATCH,REGIONSUM,9,2024/04/07 10:00:00,1,QLD1,x,0,8",
        "D,short",
    ]
    (tmp_path / "a.zip").write_bytes(archive(*extra))
    rows = {r.region: r for r in parse_archives(spark, tmp_path.as_uri()).collect()}
    assert set(rows) == {"NSW1", "QLD1"}
    assert (rows["NSW1"].price_per_mwh, rows["NSW1"].source_line_numbers, rows["NSW1"].ingestion_sequence) == (50.5, [6, 5], 20240407121)
    assert (rows["QLD1"].price_per_mwh, rows["QLD1"].demand_mw, rows["QLD1"].ingestion_sequence, rows["QLD1"].interval_datetime) == (7.0, 8.0, 0, "2024-04-07T10:00:00")


def test_acquisition_limits(spark, tmp_path):
    d = {"url_or_fixture_path": "https://example.org/listing/", "allowed_hosts": ["example.org"]}
    land = lambda definition, pages: live.acquire(spark, definition, str(tmp_path / "landing"), fake(pages))
    with pytest.raises(live.AcquisitionError, match="NEMWEB_NO_MATCHING_ARCHIVE"):
        land(d, {"https://example.org/listing/": b"none"})
    with pytest.raises(ContractError, match="NEMWEB_ARCHIVE_HOST_NOT_ALLOWED"):
        land(d, {"https://example.org/listing/": b"href='https://evil.org/PUBLIC_DISPATCHIS_1.zip'"})
    for bad in ({"allowed_hosts": []}, {"url_or_fixture_path": "http://example.org/"}):
        with pytest.raises(ContractError, match="LIVE_SOURCE_HOST_NOT_ALLOWED"):
            land(d | bad, {})
    url, place = land(d, {"https://example.org/listing/": LISTING, "https://example.org/f/PUBLIC_DISPATCHIS_2.zip": b"zip"})
    assert url.endswith("_2.zip") and Storage(spark).read(place) == b"zip"
    policy = live.FetchPolicy("https://example.org/", most_bytes=10)
    assert live.get("https://example.org/", policy, lambda u, p: (200, b"x" * 10)) == b"x" * 10
    for status, body, code in ((200, b"x" * 11, "NEMWEB_RESPONSE_TOO_LARGE"), (302, b"", "LIVE_SOURCE_REDIRECT_NOT_ALLOWED"), (404, b"", "LIVE_SOURCE_STATUS:404")):
        with pytest.raises(live.AcquisitionError, match=code):
            live.get("https://example.org/", policy, lambda u, p, a=(status, body): a)


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda master=None: spark)
    assert cli.main(["--output", str(tmp_path / "o"), "--metadata", "", "--run-id", "", "--metadata-root", "/ignored"]) == 0
    assert capsys.readouterr().out.strip() == "Pipeline complete: bronze=11, silver=6, quarantine=3, gold=3"


def test_large_files_are_numbered_in_splits(spark, tmp_path):
    from voltframe.sources.jsonl import numbered_lines

    path = tmp_path / "big.jsonl"
    path.write_text("".join("\n" if i % 7 == 0 else f'{{"i":{i}}}\r\n' if i % 2 else f'{{"i":{i}}}\n' for i in range(1, 20001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = numbered_lines(spark, path.as_uri(), whole=False)
        assert got.rdd.getNumPartitions() >= 1
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 20000 - 20000 // 7 and all(json.loads(r.raw_line)["i"] == r.source_row_number for r in rows)


@pytest.mark.parametrize("whole", [True, False])
def test_a_byte_order_mark_stays_whatever_the_size(spark, tmp_path, whole):
    from voltframe.sources.jsonl import numbered_lines

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "marked.jsonl").write_bytes(b'\xef\xbb\xbf{"i":1}\n{"i":2}\n')
    (tmp_path / "in" / "plain.jsonl").write_bytes(b'{"i":1}\n{"i":2}\n')
    got = sorted((r.file.rpartition("/")[2], r.source_row_number, r.raw_line) for r in numbered_lines(spark, (tmp_path / "in").as_uri(), whole=whole).collect())
    assert got == [("marked.jsonl", 1, '\ufeff{"i":1}'), ("marked.jsonl", 2, '{"i":2}'), ("plain.jsonl", 1, '{"i":1}'), ("plain.jsonl", 2, '{"i":2}')]


def test_default_contract_exists():
    assert DEFAULT_METADATA.exists()
