"""Dates written for people, relative to a given day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def parse_relative_date(raw: Column, as_of: Column) -> Column:
    """First rule that applies wins; ``as_of`` is an argument so that reruns agree.

    hours/minutes -> that day; weekday name -> latest such day; N weeks / N months (30 days);
    d-m-yyyy; anything else null.
    """
    text = F.lower(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""))
    weeks = F.regexp_extract(text, r"(\d+)\s*week", 1).try_cast("int")
    months = F.regexp_extract(text, r"(\d+)\s*month", 1).try_cast("int")
    day_no = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), text).cast("int") - 1
    back = F.pmod(F.weekday(as_of) - day_no, F.lit(7))
    written = F.when(text.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_timestamp(text, F.lit("d-M-yyyy")))
    return (
        F.when(text.rlike(r"\d+\s*(hour|minute|min)"), as_of)
        .when(day_no >= 0, F.date_sub(as_of, back))
        .when(weeks.isNotNull(), F.date_sub(as_of, weeks * 7))
        .when(months.isNotNull(), F.date_sub(as_of, months * 30))
        .otherwise(written.cast("date"))
    )


def on_or_after(day: Column, cutoff: str = "2015-01-01") -> Column:
    """Keeps undated rows: only a known earlier date is dropped."""
    return day.isNull() | (day >= F.lit(cutoff).cast("date"))
