from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random

import pytest

from voltframe.llm import warc


def pages(n=60, seed=1):
    rnd = random.Random(seed)
    bodies = ["<p>é</p>", "", None, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n", "x" * 3000, "<html>tail\n"]
    rows = [(i, f"http://www.host{rnd.randint(0, 4)}.example.com:80/p/{rnd.randint(0, 9)}?q=é#frag", rnd.choice(bodies) if rnd.random() < 0.6 else f"<p>{i}</p>\r\n") for i in range(n)]
    return [*rows, (500, None, "<p>é</p>"), (None, "http://a b\r\nc/", "<p>é</p>"), (501, "HTTP://UPPER.example.org", "lonely")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= least and (h or "") in first and first[h or ""] != i and sum((x[2] or "") == (h or "") for x in rows) > 1
        out.append((-1 if i is None else i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def digest(df):
    return sorted(((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize(("least", "archive_bytes"), [(0, 1 << 20), (10, 4000)])
def test_round_trip(spark, tmp_path, least, archive_bytes):
    rows = pages()
    df = frame(spark, rows).repartition(4)
    history = warc.archive(df, (tmp_path / "w").as_uri(), least, archive_bytes)
    assert digest(history) == expected(rows, least)
    keys = [(r.urlkey, r.captured, r.run, r.offset) for r in history.collect()]
    assert keys == sorted(keys) and len({k[2] for k in keys}) > 1
    # the files are archives that stand on their own
    total = 0
    for f in (tmp_path / "w").glob("part-*"):
        raw = gzip.decompress(f.read_bytes())
        seen = [(at, h["warc-type"]) for at, h, _ in warc.parse(io.BytesIO(raw))]
        assert all(raw[at:].startswith(b"WARC/1.1\r\n") for at, _ in seen)
        total += len(seen)
        streamed = list(warc.parse(warc.Rejoined(raw.removesuffix(b"\r\n\r\n").split(b"\r\n\r\n")))) if raw else []
        assert streamed == list(warc.parse(io.BytesIO(raw)))
    assert total == len(rows)
    assert archive_bytes > 4000 or len(list((tmp_path / "w").glob("part-*"))) > 8


def test_join_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", 0)
    rows = [(i, f"http://h/{i}", "same" if i % 3 else f"own {i}") for i in range(90)]
    assert digest(warc.archive(frame(spark, rows), (tmp_path / "w").as_uri())) == expected(rows)


def test_empty_table_equal_rows_and_broken_archives(spark, tmp_path):
    assert warc.archive(frame(spark, []), (tmp_path / "e").as_uri()).count() == 0
    rows = [(1, "http://h/", "x"), (1, "http://h/", "x"), (2, "http://h/", "x")]
    assert [r[3] for r in digest(warc.archive(frame(spark, rows), (tmp_path / "d").as_uri()))] == ["response", "response", "revisit"]
    good = next(b for f in (tmp_path / "d").glob("part-*") if (b := gzip.decompress(f.read_bytes())))
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(good[:-3])))
    _, headers, block = next(warc.parse(io.BytesIO(good)))
    with pytest.raises(ValueError):
        warc.entry(headers, block[:-1] + b"?")


def test_one_url_with_most_captures_is_dealt_out_and_ordered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ENTRIES_A_RANGE", 20)
    rows = [(i, "http://hot.example.com/", f"body {i % 50}") for i in range(400)] + [(1000 + i, f"http://h{i}.example.com/", "x") for i in range(20)]
    history = warc.archive(frame(spark, rows).repartition(6), (tmp_path / "w").as_uri(), archive_bytes=20_000)
    parts = [len(p) for p in history.rdd.glom().collect()]
    keys = [(r.urlkey, r.captured, r.run, r.offset) for r in history.collect()]
    assert keys == sorted(keys) and len(keys) == 420 and max(parts) < 150
    assert digest(history) == expected(rows)


def test_segments_out_of_order_are_refused():
    import pyarrow as pa

    schema = pa.schema([("urlkey", pa.string()), ("captured", pa.string()), ("run", pa.string()), ("offset", pa.int64())])
    batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
    good = [("b", "1", "r1", 0), ("c", "1", "r1", 9), ("a", "2", "r2", 0), ("b", "1", "r2", 5)]
    out = [tuple(r.values()) for b in warc._merge([batch(good[:1]), batch(good[1:])]) for r in b.to_pylist()]
    assert out == sorted(good)
    with pytest.raises(ValueError):
        list(warc._merge([batch([good[1], good[0]])]))


def test_very_long_payloads_and_names_of_the_input(spark, tmp_path):
    rows = [(1, "http://h/1", "é\r\n\r\n" * 300_000), (2, "http://h/2", "é\r\n\r\n" * 300_000), (3, "http://h/3", "\r\n" * 7 + "\r")]
    df = frame(spark, rows)
    for name in ("run", "offset", "payload_digest", "urlkey", "value"):
        df = df.withColumn(name, warc.F.lit("mine"))
    assert digest(warc.archive(df, (tmp_path / "w").as_uri())) == expected(rows)


def test_url_keys(spark):
    urls = ["http://www.Example.com:80/A?b=C#d", "https://a.b.example.org", "", None, "no-scheme/path"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(warc.F.col("u")).alias("k"))
    assert [r.k for r in df.collect()] == ["com,example)/a?b=c", "org,example,b,a)/", "", "", "no-scheme)/path"]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rnd = random.Random(k)
    runs = [sorted(rnd.randint(0, 30) for _ in range(rnd.choice([0, 1, 7, 40]))) for _ in range(k)]
    got = list(warc.LoserTree(runs))
    assert [v for _, v in got] == sorted(v for r in runs for v in r)
    assert all(a[1] < b[1] or a[0] <= b[0] for a, b in zip(got, got[1:], strict=False))
