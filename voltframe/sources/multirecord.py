"""Multi-record CSV in ZIP archives: header rows (I) name the columns of the data rows (D) after them.

Only unzipping and CSV quoting are Python, a file a task; all that follows is declarative.
"""
from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The format's report names and limits.
PRICE, DEMAND = "PRICE", "REGIONSUM"
MOST_MEMBER_BYTES = 50_000_000
MEMBER_SUFFIXES = (".CSV", ".CSV.TXT")
RECORD_SCHEMA = "source_file string, line bigint, fields array<string>"


class ArchiveError(RuntimeError):
    pass


def member_records(payload: bytes) -> Iterator[tuple[int, list[str]]]:
    """Numbered CSV records of the first member that is a CSV file."""
    with zipfile.ZipFile(io.BytesIO(payload)) as z:
        chosen = next((i for i in z.infolist() if i.filename.upper().endswith(MEMBER_SUFFIXES)), None)
        if chosen is None:
            raise ArchiveError("NEMWEB_ARCHIVE_HAS_NO_CSV")
        if chosen.file_size > MOST_MEMBER_BYTES:
            raise ArchiveError("NEMWEB_ARCHIVE_MEMBER_TOO_LARGE")
        with z.open(chosen) as member:
            yield from enumerate(csv.reader(io.TextIOWrapper(member, "latin-1", newline="")), 1)


def _unzip(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            lines, fields = [], []
            for number, record in member_records(content.as_py()):
                if len(record) >= 5:
                    lines.append(number)
                    fields.append(record)
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.int64()), pa.array(fields, pa.list_(pa.string()))], names=["source_file", "line", "fields"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """source_file, line, fields of every record of five fields or more."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_unzip, RECORD_SCHEMA)


def carry_headers(records: DataFrame) -> DataFrame:
    """Data rows as maps: source_file, line, report, version, values.

    The header in force is the last before the row of the same report and version. Rows without one
    are dropped, surplus names or fields cut, and of equal names the last counts.
    """
    kind = F.get("fields", F.lit(0))
    rows = records.filter(kind.isin("I", "D")).select("source_file", "line", kind.alias("kind"), F.get("fields", F.lit(2)).alias("report"), F.get("fields", F.lit(3)).alias("version"), F.slice("fields", 5, 1 << 20).alias("cells"))
    seen = Window.partitionBy("source_file", "report", "version").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("header", F.last(F.when(F.col("kind") == "I", F.col("cells")), ignorenulls=True).over(seen))
    width = F.least(F.size("header"), F.size("cells"))
    pairs = F.map_from_arrays(F.slice("header", F.lit(1), width), F.slice("cells", F.lit(1), width))
    return rows.filter((F.col("kind") == "D") & F.col("header").isNotNull()).select("source_file", "line", "report", "version", pairs.alias("values"))


def _optional_number(text):
    return F.nullif(text, F.lit("")).try_cast("double")


def join_reports(data: DataFrame) -> DataFrame:
    """One row a settlement, region and intervention that both reports have; of equal keys the last row counts.

    A single aggregation: each side is the latest row of its report that has a measure.
    """
    v = lambda k: F.try_element_at("values", F.lit(k))
    keyed = data.filter(F.col("report").isin(PRICE, DEMAND)).select(
        "source_file",
        "line",
        "report",
        v("SETTLEMENTDATE").alias("settlement"),
        v("REGIONID").alias("region"),
        F.when(F.map_contains_key("values", F.lit("INTERVENTION")), v("INTERVENTION")).otherwise(F.lit("0")).alias("intervention"),
        F.nullif(F.when(F.col("report") == PRICE, v("RRP")).otherwise(v("TOTALDEMAND")), F.lit("")).alias("measure"),
        F.coalesce(F.nullif(v("DISPATCHINTERVAL"), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint")).alias("sequence"),
    )
    keyed = keyed.filter((F.col("settlement") != "") & (F.col("region") != "") & F.col("measure").isNotNull())
    row = F.struct("line", "measure", "sequence")
    latest = lambda report: F.max(F.when(F.col("report") == report, row))
    both = keyed.groupBy("source_file", "settlement", "region", "intervention").agg(latest(PRICE).alias("price"), latest(DEMAND).alias("demand"))
    both = both.filter(F.col("price").isNotNull() & F.col("demand").isNotNull())
    return both.select(
        "region",
        F.regexp_replace(F.translate("settlement", "/", "-"), r"^([^ ]*) ", "$1T").alias("interval_datetime"),
        _optional_number(F.col("demand.measure")).alias("demand_mw"),
        _optional_number(F.col("price.measure")).alias("price_per_mwh"),
        F.greatest("price.sequence", "demand.sequence").alias("ingestion_sequence"),
        F.array(F.lit(PRICE), F.lit(DEMAND)).alias("source_record_types"),
        F.array("price.line", "demand.line").alias("source_line_numbers"),
        "source_file",
        "settlement",
        "intervention",
    )


def parse_archives(spark: SparkSession, path: str) -> DataFrame:
    """Canonical market rows of all archives under a path."""
    return join_reports(carry_headers(read_records(spark, path)))
