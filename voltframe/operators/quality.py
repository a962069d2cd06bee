"""Row validation: an ordered table of rules becomes one array of reason codes a row.

Rules are data. A further rule of a contract's `quality_checks` is read by a small grammar and only
when a run asks for it.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import ContractError, Source
from ..functions.json import Field, is_object
from ..functions.time import local_to_utc, parse_local


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Column


def reasons(rules: list[Rule]) -> Column:
    """The codes of all broken rules, in the order of the table."""
    return F.array_compact(F.array(*[F.when(r.broken, F.lit(r.code)) for r in rules]))


def structural_rules(record: Column, source: Source) -> list[Rule]:
    """What every record needs, and the measures of its class. Null fields count as they are."""
    known = F.when(is_object(record), record)  # a value of another shape has no fields
    region, sequence, event = Field(known, "region"), Field(known, "ingestion_sequence"), Field(known, source.event_timestamp_field)
    order = sequence.whole(0)
    rules = [
        Rule("INVALID_JSON:malformed", record.isNull()),
        Rule("INVALID_RECORD_SHAPE", ~is_object(record)),
        Rule("MISSING_REGION", ~region.truthy),
        Rule("INVALID_REGION", region.truthy & ~region.is_string),
        Rule("INVALID_INGESTION_SEQUENCE", F.coalesce(order < 0, F.lit(True))),
    ]
    if source.is_market:
        demand, price = Field(known, "demand_mw"), Field(known, "price_per_mwh")
        rules += [Rule("INVALID_DEMAND", ~(demand.finite & F.coalesce(demand.number >= 0, F.lit(False)))), Rule("MISSING_PRICE", ~price.finite)]
    else:
        rules += [Rule("MISSING_TEMPERATURE", ~Field(known, "temperature_c").finite)]
    return [*rules, Rule("MISSING_EVENT_TIMESTAMP", ~event.truthy)]


def time_rules(event: Field, wall: Column, has_offset: Column, utc: Column) -> list[Rule]:
    """Of a record that is sound otherwise: at most one of these holds."""
    unreadable = ~event.is_string | wall.isNull()
    return [
        Rule("OFFSET_NOT_ALLOWED", ~unreadable & has_offset),
        Rule("NONEXISTENT_OR_AMBIGUOUS_LOCAL_TIME", ~unreadable & ~has_offset & utc.isNull()),
        Rule("INVALID_EVENT_TIMESTAMP", unreadable),
    ]


_CHECK = re.compile(r"\s*([A-Za-z_][A-Za-z0-9_]*)\s+(?:is\s+(not\s+)?null|(>=|<=|>|<|=)\s*(-?\d+(?:\.\d+)?))\s*", re.IGNORECASE)


def declared_rule(text: str, record: Column) -> Rule:
    """A rule from `<field> (>=|>|<=|<|=) <number>` or `<field> is [not] null`."""
    m = _CHECK.fullmatch(text)
    if m is None:
        raise ContractError(f"UNSUPPORTED_QUALITY_CHECK:{text}")
    name, negated, operator, number = m.groups()
    f = Field(record, name)
    empty = f.missing | F.coalesce(f.kind == "VOID", F.lit(False))
    if operator is None:
        holds = ~empty if negated else empty
    else:
        x, y = f.number, F.lit(float(number))
        holds = {">=": x >= y, ">": x > y, "<=": x <= y, "<": x < y, "=": x == y}[operator]
    return Rule(f"CHECK_FAILED:{text.strip()}", ~F.coalesce(holds, F.lit(False)))


def validate(bronze: DataFrame, source: Source, with_declared: bool = False) -> DataFrame:
    """bronze with reason_codes and, for accepted rows, the normalised columns.

    One projection over the parsed record: no rule needs another pass.
    """
    record = F.col("raw_record")
    known = F.when(is_object(record), record)
    rules = structural_rules(record, source)
    if with_declared:
        rules += [declared_rule(t, known) for t in source.definition.get("quality_checks") or ()]
    event = Field(known, source.event_timestamp_field)
    parsed = parse_local(event.as_type("string"))
    staged = bronze.withColumns({"_structural": reasons(rules), "_wall": parsed.wall, "_offset": parsed.has_offset})
    staged = staged.withColumn("_utc", local_to_utc(F.col("_wall"), source.source_timezone))
    late = reasons(time_rules(event, F.col("_wall"), F.col("_offset"), F.col("_utc")))
    staged = staged.withColumn("reason_codes", F.when(F.size("_structural") == 0, late).otherwise(F.col("_structural")))
    measures = {m: Field(known, m).number for m in source.measures}
    return staged.withColumns(
        {"region": Field(known, "region").as_type("string"), "interval_utc": F.col("_utc"), "ingestion_sequence": Field(known, "ingestion_sequence").whole(0), **measures}
    ).drop("_structural", "_wall", "_offset", "_utc")


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows: exhaustive and disjoint, as reason_codes is never null."""
    return validated.filter(F.size("reason_codes") == 0), validated.filter(F.size("reason_codes") > 0)
