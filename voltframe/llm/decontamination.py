"""Removal of benchmark passages from training documents, in SQL functions only.

A window is n consecutive normalised words of a benchmark item; an item of fewer words, but not
none, is one window. The distinct windows form a hash set that is broadcast when its bytes are few
enough and joined by hash otherwise. Every window of every document is looked up: first, where the
set is broadcast, its outer words in a bitmap of theirs, within the row; the windows that pass are
joined with the set. Hits are verified word by word against the document, and then words, or whole
documents, are removed.

Cases: a null or empty text has no words; null or empty items have no windows; an item_id of null
makes hits but is not listed; equal rows are kept and judged alike; an empty benchmark hits nothing;
an empty table gives an empty one; very long texts are looked up whole. mark keeps extra columns and
replaces those named like the added ones; decontaminate returns the input's columns, whatever their
names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import MIXED_WORD, checkpoint_dir, folded_words, let, long_array, packed, row_key, table, unpacked

N = 10
#: Windows with their words and ids are broadcast up to so many bytes; more are joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Bits of the bitmap of outer words: 16 a window, between these.
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 24
ADDED = ("n_words", "hits", "n_hit", "item_ids", "n_items", "contaminated")


def windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: key (hash), size, words, item_ids (array of strings)."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item_id"), folded_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - n, F.lit(0)))
    grams = words.withColumn("start", F.explode(starts)).select("item_id", F.slice("words", F.col("start") + 1, n).alias("words"))
    grams = grams.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    return grams.select(F.aggregate(F.transform("words", lambda w: F.xxhash64(w)), F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x)).alias("key"), F.size("words").alias("size"), "words", "item_ids")


def _outer(first: Column, last: Column) -> Column:
    """A number for the first and the last word of a window, from their hashes."""
    return first.bitwiseXOR(F.shiftleft(last, 1))


def outer_words(found: DataFrame, bits: int) -> list[int]:
    """A bitmap of the outer words of all windows: at most 2^18 longs reach the driver."""
    word = lambda i: F.xxhash64(F.element_at("words", F.lit(i)))
    spot = found.select(_outer(word(1), word(-1)).bitwiseAND(F.lit(bits - 1)).alias("spot"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("spot").bitwiseAND(F.lit(63)).cast("int"))
    rows = spot.groupBy(F.shiftright("spot", 6).cast("int").alias("at")).agg(F.bit_or(one).alias("set")).collect()
    out = [0] * (bits // 64)
    for r in rows:
        out[r["at"]] = r["set"]
    return out


def _document_keys(h: Column, sizes: list[int], bitmap: list[int] | None) -> Column:
    """For an array of word hashes: structs (pos, size, key) of all windows of the given sizes that may be in the set."""

    def of(size: int) -> Column:
        def key(i: Column) -> Column:
            acc = F.lit(0).cast("bigint")
            for j in range(size):
                acc = F.xxhash64(acc, F.get(h, i + j))
            return F.struct(i.alias("pos"), F.lit(size).alias("size"), acc.alias("key"))

        starts = F.sequence(F.lit(0), F.size(h) - size)
        if bitmap is not None:
            mask = 64 * len(bitmap) - 1
            spot = lambda i: _outer(F.get(h, i), F.get(h, i + size - 1)).bitwiseAND(F.lit(mask))
            starts = F.filter(starts, lambda i: F.bit_get(F.get(long_array(bitmap), F.shiftright(spot(i), 6).cast("int")), spot(i).bitwiseAND(F.lit(63)).cast("int")) == 1)
        return F.when(F.size(h) >= size, F.transform(starts, key)).otherwise(F.array().cast("array<struct<pos:int,size:int,key:bigint>>"))

    return F.concat(*[of(s) for s in sizes])


def find_hits(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Per document with hits, by row key: array of (pos, size, words, item_ids), not yet verified."""
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # at most n numbers
    if not sizes:
        sizes = [N]
    volume = found.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "words")) + F.octet_length(F.concat_ws(",", "item_ids")) + 100).alias("bytes")).first()
    small = (volume["bytes"] or 0) <= BROADCAST_BYTES
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * volume["n"]).bit_length()))
    bitmap = outer_words(found, bits) if small else None
    hashes = F.transform(folded_words(F.col("text")), lambda w: F.xxhash64(w))
    at = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.explode(let(hashes, lambda h: _document_keys(h, sizes, bitmap))).alias("w")).select("_k1", "_k2", "w.pos", "w.size", "w.key")
    hit = at.join(F.broadcast(found) if small else found, ["key", "size"])
    return hit.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("pos", "size", "words", "item_ids")).alias("hits"))


def _marked(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """The input's rows as structs `row`, their text, and the added columns."""
    checkpoint_dir(docs.sparkSession)
    found = windows(benchmark, n).checkpoint()
    hits = find_hits(docs, found)
    n_words = F.coalesce(F.regexp_count(F.col("text"), F.lit(MIXED_WORD)), F.lit(0)).cast("bigint")
    keyed = docs.select(packed(docs), F.col("text").alias("text"), *row_key(F.col("doc_id"), F.col("text")), n_words.alias("n_words"))
    keyed = keyed.join(hits, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    verified = let(folded_words(F.col("text")), lambda w: F.filter("hits", lambda x: F.slice(w, x["pos"] + 1, x["size"]) == x["words"]))
    marked = keyed.withColumn("hits", F.when(F.col("hits").isNotNull(), F.sort_array(verified)))
    # the union of intervals, hits being ordered by their start
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["pos"] + x["size"] - F.greatest(x["pos"], acc["end"]))).cast("bigint").alias("n"),
        F.greatest(acc["end"], x["pos"] + x["size"]).alias("end"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    marked = marked.withColumns(
        {
            "n_hit": F.coalesce(F.aggregate("hits", zero, step, lambda acc: acc["n"]), F.lit(0).cast("bigint")),
            "item_ids": F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["item_ids"])))), F.array().cast("array<string>")),
            "hits": F.coalesce(F.transform("hits", lambda x: F.struct(x["pos"].alias("pos"), x["size"].alias("size"))), F.array().cast("array<struct<pos:int,size:int>>")),
        }
    )
    return marked.withColumn("n_items", F.size("item_ids").cast("bigint")).withColumn("contaminated", F.col("n_hit") > 0)


def mark(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """docs with n_words, hits (verified: pos, size), n_hit, item_ids, n_items, contaminated."""
    return _marked(docs, benchmark, n).select(*unpacked(docs, without=ADDED), *ADDED)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "drop", n: int = N) -> DataFrame:
    """docs without contaminated documents ("drop"), or without the words that were hit ("cut")."""
    marked = _marked(docs, benchmark, n)
    if action == "drop":
        return marked.filter(~F.col("contaminated")).select(*unpacked(docs))
    if action != "cut":
        raise ValueError(f"action must be drop or cut, not {action!r}")
    words = F.regexp_extract_all("text", F.lit(MIXED_WORD), F.lit(0))
    gaps = F.split("text", MIXED_WORD, -1)
    gone = lambda i: F.exists("hits", lambda x: (x["pos"] <= i) & (i < x["pos"] + x["size"]))
    cut = let(words, lambda w: let(gaps, lambda g: F.array_join(F.transform(g, lambda gap, i: F.concat(gap, F.when((i >= F.size(w)) | gone(i), F.lit("")).otherwise(F.get(w, i)))), "")))
    left = F.when(F.col("contaminated"), cut).otherwise(F.col("text"))
    return marked.select(*[left.alias(c) if c.lower() == "text" else value for c, value in zip(docs.columns, unpacked(docs), strict=True)])


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    marked = mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP2_SQL = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS n
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM bw) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (gram, n)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
