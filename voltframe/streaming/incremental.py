"""Structured Streaming over a landing folder of JSON lines.

Every file is validated by the same rules as in a batch run. Accepted rows of a micro-batch are
reduced to the last of each key and written as a part of Silver of their own; a batch costs what it
holds, not what Silver does. Readers take the last of each key over all parts (silver), so that late
and repeated records resolve as they would in one batch: the greatest sequence wins, whenever it
arrives. compact joins parts into one.
"""
from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import Source
from ..functions.json import NOT_BLANK, parse_strict
from ..operators.dedup import keep_last
from ..plans import layers
from ..plans.publish import published, version
from ..storage import Storage, below, uri

_ORDER = ["ingestion_sequence", "source_file", "source_row_number"]


def landed(spark: SparkSession, folder: str, source: Source, ingested_at: str, files_a_batch: int = 100) -> DataFrame:
    """Bronze rows as a stream: whole files, so that line numbers are those of the file."""
    files = spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    lines = files.select("source_file", F.posexplode(F.split("value", "\r\n|\r|\n", -1)).alias("at", "raw_line")).filter(F.col("raw_line").rlike(NOT_BLANK))
    return lines.select(F.lit(source.source_id).alias("source_id"), "source_file", (F.col("at") + 1).cast("bigint").alias("source_row_number"), "raw_line", parse_strict(F.col("raw_line")).alias("raw_record"), F.lit(ingested_at).alias("_ingested_at"))


def _add(batch: DataFrame, batch_id: int, source: Source, output: str) -> None:
    """A part of quarantine and of Silver; the same batch again replaces its own."""
    accepted, rejected = layers.refine(batch, source)
    rejected.write.mode("overwrite").parquet(below(output, "quarantine", f"batch={batch_id}"))
    keep_last(accepted, source.key_columns, _ORDER).write.mode("overwrite").parquet(below(output, "parts", f"batch={batch_id}"))


def _parts(spark: SparkSession, output: str | Path) -> list[str]:
    """The folders that make up Silver: what compact has joined, and the parts since."""
    store = Storage(spark)
    base = published(spark, below(output, "base"))
    done = int(store.read(below(base, "_upto")).decode()) if base else -1
    numbers = [int(n.partition("=")[2]) for n in store.names(below(output, "parts")) if n.startswith("batch=")]
    return [*([below(base, "rows")] if base else []), *[below(output, "parts", f"batch={n}") for n in sorted(numbers) if n > done]]


def silver(spark: SparkSession, output: str | Path, source: Source) -> DataFrame:
    """The last row of each key over all that has been processed."""
    rows = spark.read.parquet(*_parts(spark, output))
    return keep_last(rows, source.key_columns, _ORDER)


def compact(spark: SparkSession, output: str | Path, source: Source) -> None:
    """Join all parts into one table; parts that it holds are removed."""
    parts = _parts(spark, output)
    numbers = [int(p.rpartition("=")[2]) for p in parts if "batch=" in p.rpartition("/")[2]]
    if not numbers:
        return
    with version(spark, below(output, "base")) as folder:
        silver(spark, output, source).write.parquet(below(folder, "rows"))
        Storage(spark).write(below(folder, "_upto"), str(max(numbers)).encode())
    for n in numbers:
        Storage(spark).remove(below(output, "parts", f"batch={n}"))


def start_refinement(spark: SparkSession, folder: str, source: Source, output: str | Path, checkpoint: str, ingested_at: str) -> StreamingQuery:
    """Process what has landed and stop; started again, only what is new. A replayed batch changes nothing."""
    place = uri(output)
    stream = landed(spark, folder, source, ingested_at)
    return stream.writeStream.foreachBatch(lambda df, i: _add(df, i, source, place)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
