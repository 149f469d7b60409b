"""Dates and times as documents write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veriloom.functions.text import _col


def previous_month(today: Column) -> tuple[Column, Column]:
    """First and last day of the month before a day's."""
    first = F.trunc(F.add_months(today, -1), "MM")
    return first, F.last_day(first)


def display(c: Column | str) -> Column:
    """2026-11-04 as Nov 4, 2026; anything else, and a month beyond 12, as it is. The day isn't tested."""
    c = _col(c)
    months = F.array(*[F.lit(m) for m in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()])
    month = F.regexp_extract(c, r"^\d{4}-(\d{2})-\d{2}$", 1).try_cast("int")
    name = F.when(month.between(1, 12), F.element_at(months, F.when(month.between(1, 12), month).otherwise(1)))
    return F.coalesce(F.concat(name, F.lit(" "), F.regexp_extract(c, r"-(\d{2})$", 1).try_cast("int").cast("string"), F.lit(", "), F.substring(c, 1, 4)), c)


def tolerant_date(c: Column | str) -> Column:
    """An ISO date, or null."""
    return F.when(_col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(_col(c), "yyyy-MM-dd"))


def stamp(c: Column | str) -> Column:
    """A UTC stamp like 2026-10-06T031500Z as a timestamp, or null."""
    return F.try_to_timestamp(_col(c), F.lit("yyyy-MM-dd'T'HHmmss'Z'"))


def assembled(header: Column | str) -> Column:
    """The assembly date in the first 4000 characters of a capture's header, in either spelling; null if absent."""
    return F.nullif(F.regexp_extract(F.substring(_col(header), 1, 4000), r"(?mi)^\s*(?:ASSEMBLED|ASSEMBLY DATE)\s*:?\s*(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
