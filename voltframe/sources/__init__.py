"""Readers of raw sources. Each adapter gives the same columns: line number, raw line and file."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..contract import ContractError, Source
from . import jsonl, live

Adapter = Callable[[SparkSession, Source], DataFrame]

#: By extraction mode, or by the parser_key of a definition where it has one.
ADAPTERS: dict[str, Adapter] = {"fixture": jsonl.read_source, "live": live.read_source, "jsonl": jsonl.read_source, "dispatchis_zip": live.read_source}


def register(name: str, adapter: Adapter) -> None:
    """Make another reader known; definitions select it with parser_key."""
    ADAPTERS[name] = adapter


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """source_row_number, raw_line, source_file."""
    name = source.definition.get("parser_key") or source.mode
    if name not in ADAPTERS:
        raise ContractError(f"UNKNOWN_PARSER_KEY:{name}")
    return ADAPTERS[name](spark, source)
