"""Document fingerprints from closed syncmers, in SQL functions only.

A k-mer of words is a closed syncmer when the smallest of its inner s-mers lies at its first or last
place. The choice looks at nothing but the k-mer, so an edit disturbs only the k-mers that it
touches, and equal passages give equal anchors wherever they stand. With k = 5 and s = 1 two k-mers
in five are anchors. The fingerprint of a text is the list of its distinct anchors in reading order;
likeness is the Jaccard index of two lists. Anchors keep their places, so that texts can be matched
by position: in_place compares anchors at the same places, passages finds runs of anchors that two
texts share at one offset.

Cases: a null text is an empty one; a text without words has the empty fingerprint, which is like
another empty one (1.0) and unlike all others (0.0); a text of fewer than k words is one anchor over
all of its words; very long texts are fingerprinted whole. Words are runs without white space, cut
after 32 characters, and single characters in scripts that are written without spaces. Repeated rows
are kept, extra columns too, whatever their names; input columns named like the added ones are
replaced. An empty table gives an empty one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import Ranges, fresh, id_key, let, long_array, packed, quoted

K, S = 5, 1
#: Thai, kana and Han characters stand alone.
_SOLID = r"\u0E00-\u0E7F\u3040-\u30FF\u3400-\u9FFF"
TOKEN = rf"[{_SOLID}]|[^\x20\x09-\x0D{_SOLID}]{{1,32}}"
#: An anchor and its place share a bigint: the place above, 32 bits of hash below.
_LOW = (1 << 32) - 1


def _anchors(h: Column, k: int, s: int) -> Column:
    """Closed syncmers of an array of word hashes."""
    n = F.size(h)
    spots = k - s + 1
    low = lambda hashed: hashed.cast("bigint").bitwiseAND(F.lit(_LOW))
    value = lambda i: F.shiftleft(i.cast("bigint"), 32).bitwiseOR(low(F.hash(*[F.get(h, i + j) for j in range(k)])))
    whole = low(F.aggregate(h, F.lit(0), lambda acc, x: F.hash(acc, x)))

    def chosen(inner: Column) -> Column:
        smallest = lambda i: F.least(*[F.get(inner, i + j) for j in range(spots)])
        at_edge = lambda i: let(
            smallest(i), lambda m: (F.get(inner, i) == m) | (F.get(inner, i + spots - 1) == m)
        )
        return F.transform(F.filter(F.sequence(F.lit(0), n - k), at_edge), value)

    if s == 1:
        found = chosen(h)
    else:
        found = let(F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)])), chosen)
    return F.when(n >= k, found).when(n > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>"))


def placed_anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of a text, in reading order: bigints of place and hash."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: _anchors(h, k, s))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Closed syncmers of a text: array of (pos, anchor), pos counting words from 0."""
    split = lambda x: F.struct(F.shiftright(x, 32).cast("int").alias("pos"), x.bitwiseAND(F.lit(_LOW)).alias("anchor"))
    return F.transform(placed_anchors(text, k, s), split)


def distinct(placed: Column) -> Column:
    """The distinct hashes of placed anchors, in reading order."""
    return F.array_distinct(F.transform(placed, lambda x: x.bitwiseAND(F.lit(_LOW))))


def as_string(found: Column) -> Column:
    """Eight hex digits an anchor, in reading order."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.lower(F.hex(a)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two lists of distinct anchors; 1.0 for two empty ones."""
    shared = let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared).cast("double")


def in_place(a: Column, b: Column) -> Column:
    """Share of the placed anchors of the first text that stand at the same places in the second."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a)).cast("double")


def fingerprints(docs: DataFrame, k: int = K, s: int = S, text: str = "text") -> DataFrame:
    """docs with `anchors` (every syncmer and its position) and `fingerprint` (distinct, as text)."""
    docs = fresh(docs, "anchors", "fingerprint")
    return docs.withColumn("anchors", anchors(F.col(text), k, s)).withColumn(
        "fingerprint", as_string(F.array_distinct(F.transform("anchors", lambda x: x["anchor"])))
    )


def passages(docs: DataFrame, queries: DataFrame, k: int = K, s: int = S, least: int = 3) -> DataFrame:
    """Positional matches of queries in docs: doc_id, query_id, shift, n_anchors, first, last.

    A row is one offset (place in the document less that in the query) at which at least `least`
    anchors agree; first and last are the places of the outer ones in the document. Every document
    is looked at; queries are the rows that are asked for, each with its doc_id.
    """

    def spread(df: DataFrame, name: str, place: str) -> DataFrame:
        rows = df.select(F.col("doc_id").alias(name), F.explode(placed_anchors(F.col("text"), k, s)).alias("x"))
        return rows.select(name, F.shiftright("x", 32).alias(place), F.col("x").bitwiseAND(F.lit(_LOW)).alias("anchor"))

    met = spread(docs, "doc_id", "at").join(spread(queries, "query_id", "asked"), "anchor")
    rows = met.groupBy("doc_id", "query_id", (F.col("at") - F.col("asked")).alias("shift"))
    return rows.agg(F.count("*").alias("n_anchors"), F.min("at").alias("first"), F.max("at").alias("last")).filter(F.col("n_anchors") >= least)


def with_next(docs: DataFrame, value: dict, rows_per_range: int = 200, first: str = "text") -> DataFrame:
    """The rows as structs `row`, with values `made` of each and `next` of the row after it.

    Rows are in order of descending doc_id, and the first follows the last. value gives an expression
    for each name in the structs made and next, from a function that gives the input's columns.
    Ranges of ids are dealt out whole; the first row of a range also closes the range before it, so
    that no window spans all rows and nothing but the cut points, 10,000 at most, reaches the driver.
    Rows of a range pass through a sort that spills. Rows of one doc_id follow each other by a hash
    of their text.
    """
    keyed = docs.select(packed(docs), id_key(F.col("doc_id")).alias("_id"), F.xxhash64(F.col(first)).alias("tie"))
    ids = keyed.select("_id")
    ranges = Ranges(ids, ids.count() // rows_per_range, finer=False)
    mine, last = ranges.index(F.col("_id")), len(ranges) - 1
    spot = lambda at, turn: F.array(F.struct(at.cast("int").alias("at"), F.lit(turn).alias("turn")))
    none = F.array().cast("array<struct<at:int,turn:int>>")
    closes = spot(mine, 0)
    if ranges.cuts:
        is_cut = let(mine, lambda b: F.when(F.get(long_array(ranges.cuts), b - 1) == F.col("_id"), spot(b - 1, 1)).otherwise(none))
        closes = F.concat(closes, F.when(mine > 0, is_cut).otherwise(none))
    if ranges.top is not None:
        closes = F.concat(closes, F.when(F.col("_id") == F.lit(ranges.top), spot(F.lit(last), 2)).otherwise(none))
    dealt = keyed.withColumn("place", F.explode(closes)).repartition(F.col("place.at"))
    column = lambda name: F.col(f"row.{quoted(name)}")
    dealt = dealt.withColumn("made", F.struct(*[make(column).alias(n) for n, make in value.items()]))
    order = Window.partitionBy("place.at").orderBy("place.turn", F.desc("_id"), "tie")
    return dealt.withColumn("next", F.lead("made").over(order)).filter("place.turn = 0").select("row", "made", "next")


def edited_text(text: Column, following: Column) -> Column:
    """The last third (rounded down) of the code points replaced by the first as many of another."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))


def fingerprint_pairs(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to each other and the next."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = with_next(base, {"text": lambda c: c("text"), "at": lambda c: placed_anchors(c("text"), k, s)})
    both = both.select("row.doc_id", "made.text", "made.at", F.col("next.at").alias("next_at"), edited_text(F.col("made.text"), F.col("next.text")).alias("edited"))
    both = both.withColumn("edited_at", placed_anchors(F.col("edited"), k, s))
    both = both.withColumns({"fp": distinct(F.col("at")), "next_fp": distinct(F.col("next_at")), "edited_fp": distinct(F.col("edited_at"))})
    return both.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("fp")).alias("fingerprint"),
        as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        in_place(F.col("at"), F.col("edited_at")).alias("edited_in_place"),
    )


def op1_syncmers(spark, sf_dir: str) -> DataFrame:
    from ._common import table

    return fingerprint_pairs(table(spark, sf_dir, "documents"))
