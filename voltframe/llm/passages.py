"""Removal of passages that documents share, by automata over repeated phrases.

A window is n consecutive words of one document. Documents are dealt to shards by ranges of doc_id.
1. Confirm: the hashes of all windows are reported with their shards, and meet in ranges of hash
   values. Each shard that has a window is told which shard has it next.
2. Phrases: a shard cuts the passages (runs of such windows) out of its documents, as words, and sends
   them to the next shard that has them, and to itself where a later document of its own repeats
   them. A passage that a third of all documents share passes from shard to shard, once each.
3. Compile and stream: a shard compiles an Aho-Corasick automaton of the passages that it was sent,
   cut into pieces of half a window, and streams all of its documents through it. Every occurrence is
   extended over the words that agree with the passage; n words or more in a row go where the
   passage comes from a document with a smaller doc_id.

Hashes only decide where passages are sent. What is removed has been compared word by word with an
earlier document.

Cases: a null text has no words; documents of fewer than n words lose nothing; rows of equal doc_id
do not count as each other's earlier source, and share a shard; null ids sort first; windows within
one document do not count against each other; very long texts are hashed in pieces and belong to one
shard; an empty table gives an empty one. Extra columns, whatever their names, are kept by
remove_passages; n_words and n_removed of the input are replaced.
"""
from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ._common import Ranges, dealt, id_key, packed, partitions, quoted, table
from ._hashing import chunks, pack, slices, unpack, utf8, window_hashes, word_hashes

N = 50
SHARD_BYTES = 4 << 20
#: Hashes of about so many windows meet in one range of hash values.
RANGE_WINDOWS = 3_000_000
#: Windows that a task holds before it reports them.
HELD_WINDOWS = 1_000_000


def _windows(texts: list[bytes], n: int):
    """(window hashes, text index of each window, its first word in the text), in reading order."""
    hashes, owner, start = [], [], []
    for a, b in chunks(texts):
        w, c = word_hashes(texts[a:b])
        h = window_hashes(w, n)
        if not len(h):
            continue
        first = np.repeat(np.cumsum(c) - c, c)[: len(h)]
        of = np.repeat(np.arange(a, b), c)
        inside = of[: len(h)] == of[n - 1 :][: len(h)]
        hashes.append(h[inside])
        owner.append(of[: len(h)][inside])
        start.append((np.arange(len(h)) - first)[inside])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return join(hashes, np.uint64), join(owner, np.int64), join(start, np.int64)


_TOLD = "range int, shard int, known binary"


def _report(n: int, ranges: int):
    """Rows (text, shard) to the distinct window hashes of each shard, by range of values."""
    edges = np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges)

    def run(batches):
        held, size = [], 0

        def out():
            shards = np.concatenate([np.full(len(h), s, np.int32) for s, h in held])
            values = np.concatenate([h for _, h in held])
            order = np.lexsort((values, shards))
            shards, values = shards[order], values[order]
            new = np.r_[True, (shards[1:] != shards[:-1]) | (values[1:] != values[:-1])]
            shards, values = shards[new], values[new]
            rows = []
            cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])
            for s, mine in zip(shards[cuts].tolist(), np.split(values, cuts[1:]), strict=True):
                rows += [(r, s, pack(part)) for r, part in enumerate(np.split(mine, np.searchsorted(mine, edges))) if len(part)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["range", "shard", "known"])

        for batch in slices(batches):
            hashes, owner, _ = _windows(utf8(batch.column(0)), n)
            if len(hashes):
                of = batch.column(1).to_numpy()[owner]
                held += [(s, hashes[of == s]) for s in np.unique(of).tolist()]
                size += len(hashes)
            if size > HELD_WINDOWS:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return run


def _confirm(batches):
    """For one range of hash values: to each shard the windows that another has after it, and which one."""
    now, parts = None, []

    def told():
        values = [unpack(data) for _, data in parts]
        shards = np.repeat(np.array([s for s, _ in parts], np.int32), [len(v) for v in values])
        every = np.concatenate(values)
        order = np.lexsort((shards, every))
        every, shards = every[order], shards[order]
        same = np.flatnonzero((every[1:] == every[:-1]) & (shards[1:] != shards[:-1]))
        source, target, window = shards[same], shards[same + 1], every[same]
        order = np.lexsort((window, source))
        source, target, window = source[order], target[order], window[order]
        cuts = np.flatnonzero(np.r_[True, source[1:] != source[:-1]]) if len(source) else np.empty(0, np.int64)
        pressed = zstandard.ZstdCompressor(level=1)
        data = [pack(w) for w in np.split(window, cuts[1:])] if len(cuts) else []
        others = [pressed.compress(t.tobytes()) for t in np.split(target, cuts[1:])] if len(cuts) else []
        return pa.RecordBatch.from_arrays([pa.array(source[cuts]), pa.array(others, pa.binary()), pa.array(data, pa.binary())], names=["shard", "others", "data"])

    for batch in batches:
        for r, s, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now is not None and r != now:
                yield told()
                parts = []
            now = r
            parts.append((s, data))
    if parts:
        yield told()


def _compressed(batches):
    """Texts as zstd frames: they cross two shuffles, and are most of what does."""
    pressed = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches):
        at = batch.schema.get_field_index("data")
        texts = pa.array([pressed.compress(t) for t in utf8(batch.column(at))], pa.binary())
        yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)


def _by_shard(batches, done):
    """Rows (shard, kind, ...) ordered by shard and kind; yields what done(shard, messages, documents) does.

    Messages (kind 0) and documents (kind 1) come as tables of the rows of one shard.
    """
    held, now = [], None

    def whole():
        rows = pa.Table.from_batches(held)
        kind = rows.column("kind").to_numpy()
        cut = int(np.searchsorted(kind, 1))
        return done(int(now), rows.slice(0, cut), rows.slice(cut))

    for batch in batches:
        shard = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(shard):
            continue
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if now is not None and shard[a] != now:
                yield from whole()
                held = []
            now = shard[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield from whole()


def _texts(documents: pa.Table) -> list[bytes]:
    opened = zstandard.ZstdDecompressor()
    return [opened.decompress(v) for v in documents.column("data").to_pylist()]


def passages(ids: np.ndarray, texts: list[bytes], n: int, window: np.ndarray, other: np.ndarray, itself: int) -> dict[int, list[tuple[int, bytes]]]:
    """What a shard, ordered by id, sends: by shard, (doc_id of the source, words) of each passage.

    window and other: hashes of windows of the shard, and for each another shard that has it next.
    """
    hashes, owner, start = _windows(texts, n)
    out: dict[int, list[tuple[int, bytes]]] = {}
    if not len(hashes):
        return out
    order = np.argsort(hashes, kind="stable")
    new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
    first = order[new]  # of each window, its first place
    known = hashes[first]
    last = np.maximum.reduceat(ids[owner[order]], np.flatnonzero(new))
    own = first[last > ids[owner[first]]]
    at = np.minimum(np.searchsorted(known, window), len(known) - 1)
    there = known[at] == window
    place = np.concatenate([own, first[at[there]]])
    target = np.concatenate([np.full(len(own), itself, np.int32), other[there]])
    if not len(place):
        return out
    order = np.lexsort((place, target))
    place, target = place[order], target[order]
    begins = np.flatnonzero(np.r_[True, (target[1:] != target[:-1]) | (place[1:] != place[:-1] + 1) | (owner[place[1:]] != owner[place[:-1]])])
    ends = np.r_[begins[1:], len(place)] - 1
    split: dict[int, list[bytes]] = {}
    for shard, a, b in zip(target[begins].tolist(), place[begins].tolist(), place[ends].tolist(), strict=True):
        d = int(owner[a])
        if d not in split:
            split[d] = texts[d].split()
        out.setdefault(shard, []).append((int(ids[d]), b" ".join(split[d][start[a] : start[b] + n])))
    return out


_MESSAGE = "shard int, ids array<bigint>, data binary"


def _cut(n: int):
    def run(batches):
        pressed = zstandard.ZstdCompressor(level=3)

        def done(shard, messages, documents):
            opened = zstandard.ZstdDecompressor()
            join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
            window = join([unpack(v) for v in messages.column("data").to_pylist()], np.uint64)
            other = join([np.frombuffer(opened.decompress(v), np.int32) for v in messages.column("others").to_pylist()], np.int32)
            found = passages(documents.column("id").to_numpy(), _texts(documents), n, window, other, shard)
            for target, rows in found.items():
                data = pressed.compress(b"\n".join(words for _, words in rows))
                yield pa.RecordBatch.from_arrays([pa.array([target], pa.int32()), pa.array([[i for i, _ in rows]], pa.list_(pa.int64())), pa.array([data], pa.binary())], names=["shard", "ids", "data"])

        yield from _by_shard(batches, done)

    return run


class PassageAutomaton:
    """An Aho-Corasick automaton of passages, whose letters are words.

    Passages are cut into pieces of half a window, rounded up: n words in a row of a passage hold
    one of them whole, wherever they begin.
    """

    def __init__(self, found: list[tuple[int, bytes]], n: int):
        self.n, self.piece = n, (n + 1) // 2
        self.letters: dict[bytes, int] = {}
        self.sources: list[int] = []
        self.words: list[np.ndarray] = []
        places: dict[tuple, list[tuple[int, int]]] = {}
        for source, words in found:
            mine = [self.letters.setdefault(w, len(self.letters) + 1) for w in words.split(b" ")]
            for at in range(0, len(mine) - self.piece + 1, self.piece):
                places.setdefault(tuple(mine[at : at + self.piece]), []).append((len(self.words), at))
            self.sources.append(source)
            self.words.append(np.array(mine, np.int32))
        self.found = None
        if places:
            self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, value in places.items():
                self.found.add_word(key, value)
            self.found.make_automaton()

    def covered(self, doc_id: int, words: list[bytes]) -> np.ndarray | None:
        """Which words stand in a passage of an earlier document; None if there are none."""
        if self.found is None or len(words) < self.n:
            return None
        known = self.letters.get
        text = [known(w, 0) for w in words]
        gone, letters = None, None
        reached: dict[tuple[int, int], int] = {}  # by passage and offset, how far it has been looked at
        for end, places in self.found.iter(tuple(text)):
            at = end - self.piece + 1
            for passage, place in places:
                if self.sources[passage] >= doc_id or reached.get((passage, at - place), -1) > at:
                    continue
                if letters is None:
                    letters = np.array(text, np.int32)
                other = self.words[passage]
                back, ahead = min(at, place), min(len(letters) - at, len(other) - place)
                differ = np.flatnonzero(letters[at - back : at + ahead] != other[place - back : place + ahead])
                k = int(np.searchsorted(differ, back))
                a = at - back + (int(differ[k - 1]) + 1 if k else 0)
                b = at - back + int(differ[k]) if k < len(differ) else at + ahead
                reached[passage, at - place] = b
                if b - a >= self.n:
                    if gone is None:
                        gone = np.zeros(len(letters), bool)
                    gone[a:b] = True
        return gone


def _remove(n: int, schema: pa.Schema, digest: bool):
    def run(batches):
        def done(shard, messages, documents):
            opened = zstandard.ZstdDecompressor()
            sent = [(i, words) for ids, data in zip(messages.column("ids").to_pylist(), messages.column("data").to_pylist(), strict=True) for i, words in zip(ids, opened.decompress(data).split(b"\n"), strict=True)]
            automaton = PassageAutomaton(sent, n)
            counts, removed, kept = [], [], []
            for doc_id, frame in zip(documents.column("id").to_pylist(), documents.column("data").to_pylist(), strict=True):
                text = opened.decompress(frame)
                words = text.split()
                gone = automaton.covered(doc_id, words)
                counts.append(len(words))
                removed.append(0 if gone is None else int(gone.sum()))
                if gone is not None:
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                left = b" ".join(words) if digest or gone is not None else text
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode("utf-8", "replace"))
            row = documents.column("row").combine_chunks()
            row = row if isinstance(row, pa.Array) else pa.concat_arrays(row.chunks)
            yield pa.RecordBatch.from_arrays([row, *[pa.array(v, f.type) for v, f in zip([counts, removed, kept], list(schema)[1:], strict=True)]], schema=schema)

        for batch in _by_shard(batches, done):
            if batch.num_rows:
                yield batch

    return run


def _run(docs: DataFrame, n: int, digest: bool, shard_bytes: int) -> DataFrame:
    """row (the columns that are kept), n_words, n_removed and kept: the digest or the text."""
    spark = docs.sparkSession
    keep = docs.select("doc_id") if digest else docs.drop("text")
    base = docs.select(id_key(F.col("doc_id")).alias("id"), F.coalesce("text", F.lit("")).alias("data"), packed(keep))
    volume = base.agg(F.sum(F.octet_length("data")).alias("bytes")).first()["bytes"] or 0
    cuts = Ranges(base.select(F.col("id").alias("_id")), volume // shard_bytes + 1)
    # ranges count from the largest ids; shards from the smallest
    base = base.withColumn("shard", (F.lit(len(cuts) - 1) - cuts.index(F.col("id"))).cast("int"))
    ranges = max(1, volume // 6 // RANGE_WINDOWS * 2 + 1, spark.sparkContext.defaultParallelism)
    reports = base.select("data", "shard").mapInArrow(_report(n, ranges), _TOLD)
    told = dealt(reports, partitions(spark, volume), "range").sortWithinPartitions("range").mapInArrow(_confirm, "shard int, others binary, data binary")

    frames = base.select("shard", F.lit(1).alias("kind"), "id", "data", "row")
    frames = frames.mapInArrow(_compressed, T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "data" else f for f in frames.schema]))

    def meet(messages: DataFrame, documents: DataFrame) -> DataFrame:
        rows = messages.withColumn("kind", F.lit(0)).unionByName(documents, allowMissingColumns=True)
        rows = rows.select("shard", "kind", *[c for c in rows.columns if c not in ("shard", "kind")])
        return dealt(rows, partitions(spark, volume), "shard").sortWithinPartitions("shard", "kind", "id")

    sent = meet(told, frames.drop("row")).mapInArrow(_cut(n), _MESSAGE)
    out = T.StructType([T.StructField("row", frames.schema["row"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return meet(sent, frames).mapInArrow(_remove(n, to_arrow_schema(out), digest), out)


def remove_passages(docs: DataFrame, n: int = N, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs with n_words, n_removed and the text without recurring passages.

    A text that loses words comes back with one blank between those it keeps; others are unchanged,
    but that a null text is an empty one.
    """
    out = _run(docs, n, False, shard_bytes)
    columns = [F.col("kept").alias(c) if c.lower() == "text" else F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    return out.select(*columns, "n_words", "n_removed")


def op3_passages(spark, sf_dir: str) -> DataFrame:
    out = _run(table(spark, sf_dir, "documents").select("doc_id", "text"), N, True, SHARD_BYTES)
    return out.select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS win FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
early AS (SELECT win, min(doc_id) AS source FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN early USING (win), unnest(range(i, i + 50)) AS t(p) WHERE source < doc_id),
n AS (SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(ps, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id)
"""
