"""Small helpers that several operators share."""
from __future__ import annotations

import gc
import json
import math
import tempfile
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a word after A-Z have been lower-cased: digits, a-z and everything beyond ASCII.
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text whose case is untouched.
MIXED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words between white space.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only where none is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="voltframe-")
        spark.sparkContext.setCheckpointDir(found)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files, broadcasts and compiled classes of what has been checkpointed.

    Its cleaner waits for the driver's garbage collection, which a heap with room puts off: without this,
    the files of all steps lie on disk together. The second turn finds what events still held in the first.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times.

    A column that another projection refers to once may be inlined by the optimizer, into the
    body of a lambda too, where it would be evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts without other characters take the fast built-in."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def folded_words(text: Column) -> Column:
    return F.regexp_extract_all(fold_ascii(F.coalesce(text, F.lit(""))), F.lit(FOLDED_WORD), F.lit(0))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two longs that name a row by its content; equal rows share them, null ids have one too."""
    return [F.xxhash64(doc_id, text).alias("_k1"), F.xxhash64(F.lit("row"), text, doc_id).alias("_k2")]


def packed(docs: DataFrame, name: str = "row") -> Column:
    """All columns of the input as one struct: inside it, no name can meet one that an operator uses."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unpacked(docs: DataFrame, name: str = "row", without: Sequence[str] = ()) -> list[Column]:
    """The columns of the input out of their struct, without those that an operator replaces."""
    gone = {n.lower() for n in without}
    return [F.col(f"{name}.{quoted(c)}").alias(c) for c in docs.columns if c.lower() not in gone]


def partitions(spark: SparkSession, volume: int, each: int = 32 << 20) -> int | None:
    """Partitions for a shuffle of so many bytes, where the session's own number would make them too large.

    None leaves the number to the session, and adaptive execution free to join small ones.
    """
    wanted = -(-int(volume) // each)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions", "200")) else None


def dealt(df: DataFrame, number: int | None, *columns) -> DataFrame:
    return df.repartition(number, *columns) if number else df.repartition(*columns)


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of the input that clash with the columns an operator adds."""
    clash = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in clash])


def long_array(values: Sequence[int], kind: str = "bigint") -> Column:
    """A literal array that stays one literal in the plan, however long it is."""
    return F.from_json(F.lit(json.dumps([int(v) for v in values])), f"array<{kind}>")


class Ranges:
    """Ranges of descending doc_id with about equal row counts.

    Up to `most` of them are cut at ids that are quantiles of the ids of all rows; `most` bounds what
    the driver holds. Where more are wanted, each is cut further, into `finer` parts of equal width.
    `index` gives the range of an id by a two-level search, 0 being the range of the largest ids.
    """

    def __init__(self, ids: DataFrame, wanted: int, most: int = 10_000, finer: bool = True):
        n = max(1, min(int(wanted), most))
        ends = ids.agg(F.max("_id").alias("top"), F.min("_id").alias("low")).first()
        self.top, self.low = ends["top"], ends["low"]
        cuts = []
        if n > 1 and self.top is not None:
            shares = [i / n for i in range(1, n)]
            row = ids.select(F.percentile_approx("_id", shares, max(10_000, 4 * n)).alias("p")).first()
            cuts = sorted({int(v) for v in (row["p"] or [])}, reverse=True)
        self.cuts = [c for c in cuts if c < self.top]
        self.finer = -(-int(wanted) // most) if finer and wanted > most else 1

    def __len__(self) -> int:
        return (len(self.cuts) + 1) * self.finer

    def index(self, key: Column) -> Column:
        if self.top is None:
            return F.lit(0)
        if self.finer == 1:
            return self._coarse(key)

        # ids of range i lie above cut i and up to cut i - 1; offsets are taken as doubles, which
        # neither overflow nor change the order
        upper, lower = long_array([self.top, *self.cuts], "double"), long_array([*self.cuts, self.low - 1], "double")

        def inside(i: Column) -> Column:
            top, low = F.get(upper, i), F.get(lower, i)
            part = F.floor((top - key.cast("double")) / F.greatest(top - low, F.lit(1.0)) * self.finer)
            return (i * self.finer + F.least(F.greatest(part, F.lit(0)), F.lit(self.finer - 1))).cast("int")

        return let(self._coarse(key), inside)

    def _coarse(self, key: Column) -> Column:
        if not self.cuts:
            return F.lit(0)
        step = max(1, math.isqrt(len(self.cuts)))
        fine, coarse = long_array(self.cuts), long_array(self.cuts[step - 1 :: step])

        def inside(c: Column) -> Column:
            part = F.slice(fine, c * step + 1, F.lit(step))
            return (c * step + F.size(F.filter(part, lambda x: x >= key))).cast("int")

        return let(F.size(F.filter(coarse, lambda x: x >= key)), inside)


def id_key(doc_id: Column) -> Column:
    """doc_id as a bigint; null sorts below all others."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(-(2**63)).cast("bigint"))
