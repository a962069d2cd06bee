"""Lines of text files with their physical line numbers, for files of any size."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contract import Source
from ..functions.json import NOT_BLANK
from ..storage import Storage, uri

#: Larger files are read in splits.
WHOLE_FILE_BYTES = 32 << 20


def numbered_lines(spark: SparkSession, path: str, whole: bool | None = None) -> DataFrame:
    """Every line that is not blank: file, source_row_number (from 1, blank lines counted), raw_line.

    Small files are read whole. Large ones are read in splits, whose lines are counted first; a line's
    number is its place in the split plus the lines of the splits before, so no file passes through
    one task. A byte-order mark stays in the first line, whatever the size: the split reader drops it,
    so it is put back where a file begins with one.
    """
    if whole is None:
        sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()
        whole = (sizes[0] or 0) <= WHOLE_FILE_BYTES
    if whole:
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
        lines = files.select("file", F.posexplode(F.split("value", "\r\n|\r|\n", -1)).alias("at", "raw_line")).withColumn("source_row_number", F.col("at").cast("bigint") + 1)
    else:
        raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw_line"))
        counts = raw.groupBy("file", "block").agg(F.count("*").alias("lines"))
        earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("file", "block", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
        inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
        lines = raw.join(offsets, ["file", "block"]).withColumn("source_row_number", (F.col("before") + inside).cast("bigint"))
        marked = Storage(spark).marked(path)  # names of files that begin with a mark
        first = (F.col("source_row_number") == 1) & F.element_at(F.split("file", "/"), -1).isin(*marked)
        lines = lines.withColumn("raw_line", F.when(first, F.concat(F.lit("\ufeff"), "raw_line")).otherwise(F.col("raw_line"))) if marked else lines
    return lines.filter(F.col("raw_line").rlike(NOT_BLANK)).select("file", "source_row_number", "raw_line")


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    if not Storage(spark).exists(source.path):
        raise FileNotFoundError(source.path)
    lines = numbered_lines(spark, uri(source.path))
    return lines.select("source_row_number", "raw_line", F.lit(source.fixture_path).alias("source_file"))
