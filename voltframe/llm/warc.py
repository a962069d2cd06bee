"""WARC archives of pages, and their capture index by an external merge.

Writing: each page becomes a WARC/1.1 record. Of pages with equal payloads of at least a given size,
that with the smallest page_id is a response and the others are revisits that name it. Every task
sorts its records by URL key and time and writes one archive or more, compressed: each is a locally
sorted capture run. How many records an archive takes follows from their mean size.

Reading: each archive is streamed by one task, piece by piece, and parsed by Content-Length; what a
task holds is one record. Payload digests are computed anew and compared with the headers.

Index: the entries of all runs are dealt to ranges of (URL key, time, run, offset), of a bounded number
of entries each, so that the captures of a frequent URL are dealt out too. The segments of the runs
that fall into a range stay as they were sorted; a loser tree merges them, and its order is that of
the result: the globally ordered history.

Cases: a null html is an empty payload; payloads under the least size are all responses; equal
rows of the smallest page_id are all responses; a null page_id is written as such and never named
while its payload has another; a null url has the empty key; control characters and blanks of a
url are percent-encoded; very long payloads are limited by what a record may be in memory, not by
the archive; an empty table gives no records. Input columns beside page_id, url, html and the
optional captured_at, whatever their names, are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import io
import itertools
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import checkpoint_dir, remove, table

LEAST_BYTES = 0
#: Up to so many payloads that occur twice are broadcast (about 60 bytes each).
BROADCAST_PAYLOADS = 1_000_000
#: Bytes of payload that an archive is to hold, about, before compression; one task reads it.
ARCHIVE_BYTES = 256 << 20
#: Index entries that meet in one range of the merge.
ENTRIES_A_RANGE = 200_000
END = "\r\n\r\n"
EPOCH = 1704067200  # captures without a time of their own count seconds by page_id from here
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, run string, offset long"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column."""
    digits = F.sha1(payload)
    quad = lambda i: F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
    letter = lambda v, s: F.substring(F.lit(_BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*[letter(quad(i), s) for i in range(8) for s in (15, 10, 5, 0)])


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: com,example,www)/path?query, lower-cased."""
    text = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    text = F.regexp_replace(text, r"#.*$", "")
    host = F.regexp_replace(F.regexp_extract(text, r"^[^/?]*", 0), r"^(www\.)|(:\d+)$", "")
    rest = F.regexp_replace(text, r"^[^/?]*", "")
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(text == "", F.lit("")).otherwise(F.concat(turned, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest)))


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages with their role: url, urlkey, captured, html, payload_bytes, payload_digest, refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    when = F.col("captured_at").cast("timestamp") if "captured_at" in pages.columns else F.lit(None).cast("timestamp")
    counted = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(365 * 86400)))
    base = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
        url_key(F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")).alias("urlkey"),
        F.date_format(F.coalesce(when, counted), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        html.alias("html"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"),
        base32_sha1(html.cast("binary")).alias("payload_digest"),
    )
    # only payloads that occur more than once are joined back; one row each, found with partial sums
    twice = base.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    twice = twice.checkpoint()
    small = twice.count() <= BROADCAST_PAYLOADS
    joined = base.join(F.broadcast(twice) if small else twice, "payload_digest", "left")
    revisit = F.col("refers_to").isNotNull() & (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("refers_to")))


def _text(r: DataFrame) -> Column:
    """A record without the two line ends behind it, which the writer puts between lines."""
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    head = [
        ("WARC/1.1\r\nWARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("\r\nWARC-Record-ID: ", name("page_id")),
        ("\r\nWARC-Date: ", F.col("captured")),
        ("\r\nWARC-Target-URI: ", F.col("url")),
        ("\r\nWARC-Payload-Digest: sha1:", F.col("payload_digest")),
        ("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: ", size.cast("string")),
    ]
    more = F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("refers_to"))).otherwise(F.lit(""))
    return F.concat(*[x for text, value in head for x in (F.lit(text), value)], more, F.lit(END), body)


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of the pages, one or more a task, each sorted by URL key, time and page."""
    size = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("bytes")).first()
    mean = (size["bytes"] or 0) / max(size["n"], 1) + 500  # headers
    r = records(pages, least_bytes)
    lines = r.sortWithinPartitions("urlkey", "captured", "page_id").select(_text(r).alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", max(1, int(archive_bytes / mean))).option("compression", "gzip").text(path)


class Rejoined:
    """A file's bytes from its pieces between END marks, a record at a time.

    Where a payload ends in a part of the mark, the last piece has none behind it, and one too many
    ends the bytes.
    """

    def __init__(self, pieces):
        self.pieces, self.held, self.at = iter(pieces), bytearray(), 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        if self.at > 1 << 16:
            del self.held[: self.at]
            self.at = 0
        self.held += piece
        self.held += END.encode()
        return True

    def readline(self) -> bytes:
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.held) - 1
                break
        return self._take(end + 1)

    def read(self, size: int) -> bytes:
        while len(self.held) - self.at < size and self._more():
            pass
        return self._take(min(len(self.held), self.at + size))

    def _take(self, end: int) -> bytes:
        out, self.at = bytes(self.held[self.at : end]), end
        return out


def parse(stream: io.BufferedIOBase):
    """(offset, headers, block) of each record of an archive."""
    at = 0
    while line := stream.readline():
        begin = at
        if not line.startswith(b"WARC/"):
            if line == b"\r\n" and not stream.readline().strip() and not stream.readline():
                return  # blank lines at the end
            raise ValueError(f"no record at byte {at}")
        at += len(line)
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            at += len(line)
            key, _, value = line.decode("utf-8").partition(":")
            headers[key.lower()] = value.strip()
        at += len(line)
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at byte {begin} is cut off")
        at += len(block) + 4
        yield begin, headers, block


def entry(headers: dict, block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes and digest, type and reference of a record; digests are checked."""
    number = lambda urn: None if urn == "<urn:page:null>" else int(urn[len("<urn:page:") : -1])
    head, _, payload = block.partition(b"\r\n\r\n")
    declared = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(head.rpartition(b"Content-Length: ")[2])
    if headers["warc-type"] == "revisit":
        return number(headers["warc-record-id"]), size, declared, "revisit", number(headers["warc-refers-to"])
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest != declared or len(payload) != size:
        raise ValueError(f"payload of {headers['warc-record-id']} is not what its header says")
    return number(headers["warc-record-id"]), size, digest, "response", None


_ENTRY = pa.schema([("url", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("run", pa.string()), ("offset", pa.int64())])


def _entries(batches):
    """Pieces of archives, in order, to index entries."""
    pieces = ((name, value) for batch in batches for name, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True))
    rows = []
    for name, mine in itertools.groupby(pieces, key=lambda p: p[0]):
        for at, h, block in parse(Rejoined(v.as_py() for _, v in mine)):
            rows.append((h.get("warc-target-uri", ""), h["warc-date"], *entry(h, block), name, at))
            if len(rows) == 5_000:
                yield _batch(rows)
                rows = []
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ENTRY)], schema=_ENTRY)


def read_warc(spark, path: str) -> DataFrame:
    """Records of compressed archives in the order of each: run (the file), offset, headers' fields, payload facts."""
    # compressed text is never split: a task streams a whole file
    pieces = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").schema("value string").text(path).select("_metadata.file_path", "value")
    out = pieces.mapInArrow(_entries, INDEX.replace("urlkey", "url"))
    return out.withColumn("urlkey", url_key(F.col("url"))).select(*[c.split()[0] for c in INDEX.split(", ")])


class LoserTree:
    """K-way merge: inner nodes hold the losers of their matches, the winner is at the top."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.tree = [-1] * self.k
        for leaf in range(len(runs)):
            self._replay(leaf, seeding=True)

    def _before(self, a: int, b: int) -> bool:
        """Whether the head of run a comes before that of run b; ended runs come last, ties go by run."""
        ended_a, ended_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if ended_a or ended_b:
            return ended_b and not ended_a
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _replay(self, leaf: int, seeding: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0 and seeding:
                self.tree[node] = winner  # the first to come waits here for its match
                return
            if other >= 0 and self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        if not self.runs:
            return
        while True:
            run = self.tree[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield run, self.runs[run][self.at[run]]
            self.at[run] += 1
            self._replay(run)


def _merge(batches):
    """One range, ordered by run: the segments of the runs, merged."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    column = lambda name: rows.column(name).to_pylist()
    segments: list[list] = []
    before = None
    for i, (key, captured, run, offset) in enumerate(zip(column("urlkey"), column("captured"), column("run"), column("offset"), strict=True)):
        item = (key, captured, run, offset, i)
        if before is None or run != before[2]:
            segments.append([])
        elif item < before:
            raise ValueError(f"the segment of {run} is not sorted")
        segments[-1].append(item)
        before = item
    order = [item[4] for _, item in LoserTree(segments)]
    for at in range(0, len(order), 10_000):
        yield from rows.take(pa.array(order[at : at + 10_000], pa.int64())).combine_chunks().to_batches()


def capture_history(index: DataFrame) -> DataFrame:
    """The entries of all runs in global order: partitions ascend by (URL key, time), rows inside too."""
    index = index.checkpoint()  # ranges are sampled from it; archives are not read twice
    order = ["urlkey", "captured", "run", "offset"]
    ranges = -(-index.count() // ENTRIES_A_RANGE)
    usual = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    index = index.repartitionByRange(ranges, *order) if ranges > usual else index.repartitionByRange(*order)
    return index.sortWithinPartitions("run", "urlkey", "captured", "offset").mapInArrow(_merge, INDEX)


def archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as WARC archives under path, read them back and return the merged index."""
    spark = pages.sparkSession
    checkpoint_dir(spark)
    write_warc(pages, path, least_bytes, archive_bytes)
    return capture_history(read_warc(spark, path))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    history = archive(table(spark, sf_dir, "pages"), path)
    remove(spark, path)  # the index has been written by itself
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM s
"""
