"""Local wall-clock time to UTC, with the exact rule for gaps and folds.

Everything runs in a UTC session. A wall clock is held as a TIMESTAMP that reads the same in UTC.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Compact dates and times, week dates, and a comma before the fraction are brought into the long form first.
COMPACT_DATE, COMPACT_TIME = r"^([0-9]{4})([0-9]{2})([0-9]{2})([T ])", r"^([^T ]*[T ][0-9]{2})([0-9]{2})([0-9]{2})?(?=$|[.,Z+-])"
WEEK_DATE = r"^([0-9]{4})-?W([0-9]{2})-?([1-7])(?=[T ])"
#: Date, then time to the hour at least, then a fraction and an offset. Group 1 is without the offset.
ISO = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,})?)?)?)(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?$"


def let(value: Column, body) -> Column:
    """Evaluate value once and use it many times, where the optimizer would write it out at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@dataclass
class Parsed:
    wall: Column  # null if it is no time
    has_offset: Column


def _from_week(text: Column) -> Column:
    """A week date as a calendar date, null if the year has no such week; the time behind it stays."""
    part = lambda i: F.regexp_extract(text, WEEK_DATE, i)
    week, day = part(2).try_cast("int"), part(3).try_cast("int")
    # week 1 holds January 4th; a year has a week 53 only if that still holds one of its Thursdays
    monday = lambda fourth: F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    date = lambda m: F.when((week >= 1) & (F.year(F.date_add(m, 3)) == part(1).try_cast("int")), F.date_format(F.date_add(m, day - 1), "yyyy-MM-dd"))
    found = let(F.concat(part(1), F.lit("-01-04")).try_cast("date"), lambda f: let(monday(f), date))
    return F.concat(found, F.regexp_replace(text, WEEK_DATE, ""))


def long_form(text: Column) -> Column:
    """Compact dates and times, week dates and decimal commas in the form that ISO describes; other texts as they are."""
    dated = let(text, lambda t: F.when(t.rlike(WEEK_DATE), _from_week(t)).otherwise(F.regexp_replace(t, COMPACT_DATE, "$1-$2-$3$4")))
    timed = F.regexp_replace(F.regexp_replace(dated, COMPACT_TIME, "$1:$2:$3"), r"([0-9]):(?=$|[.,Z+-])", "$1")
    return F.when(text.rlike(r"^[0-9]{4}([0-9]{4}|-?W)|[T ][0-9]{4}|,"), F.regexp_replace(timed, ",([0-9]+)", ".$1")).otherwise(text)


def parse_local(text: Column) -> Parsed:
    """A wall clock from ISO text with a time of day; more than six digits of a fraction are cut."""
    def wall(t: Column) -> Column:
        clock = F.regexp_extract(t, ISO, 1)
        padded = F.when(F.length(clock) == 13, F.concat(clock, F.lit(":00"))).otherwise(clock)
        cut = F.regexp_replace(padded, r"([.][0-9]{6})[0-9]+$", "$1")
        return F.when((clock != "") & ~clock.startswith("0000"), cut.try_cast("timestamp_ntz").cast("timestamp"))

    found = let(long_form(text), lambda t: F.struct(wall(t).alias("wall"), (F.regexp_extract(t, ISO, 2) != "").alias("offset")))
    return Parsed(found["wall"], F.coalesce(found["offset"] & found["wall"].isNotNull(), F.lit(False)))


def utc_candidates(wall: Column, zone: str | Column) -> Column:
    """The instants whose local time in the zone is the wall clock: one, or none in a gap, two in a fold.

    The offsets 36 hours before and after are the only ones that can hold, as zones change once in
    such a time at most.
    """
    zone = F.lit(zone) if isinstance(zone, str) else zone

    def with_offset_at(probe: Column) -> Column:
        return let(probe, lambda p: F.timestamp_micros(F.unix_micros(wall) - (F.unix_micros(F.from_utc_timestamp(p, zone)) - F.unix_micros(p))))

    away = F.expr("INTERVAL 36 HOURS")
    both = F.array(with_offset_at(wall - away), with_offset_at(wall + away))
    return F.filter(F.array_distinct(both), lambda u: F.from_utc_timestamp(u, zone) == wall)


def local_to_utc(wall: Column, zone: str | Column) -> Column:
    """The one instant of a wall clock; null in gaps and folds."""
    return the_one(utc_candidates(wall, zone))


def the_one(candidates: Column) -> Column:
    """The candidate, if there is exactly one."""
    return let(candidates, lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def utc_text(instant: Column) -> Column:
    """ISO text with Z, and microseconds only where there are some."""
    fraction = F.when(F.unix_micros(instant) % 1_000_000 != 0, F.date_format(instant, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def business_day(instant: Column, zone: str | Column) -> Column:
    """The date on the wall of the zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))
