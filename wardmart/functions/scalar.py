"""Column expressions whose results differ between SQL engines by default.

All of them are built-in JVM expressions. None depends on the session time
zone: the source times carry no zone, so they are never turned into instants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half(x: Column, places: int) -> Column:
    """Round a double by scaling it, so 1.005 gives 1.0 and not 1.01.

    ``F.round(x, n)`` rounds the printed decimal instead.
    """
    scale = F.lit(float(10**places))
    return F.round(x.cast("double") * scale, 0) / scale


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole`` in double arithmetic; NULL for a zero whole."""
    ratio = part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0)).cast("double")
    return round_half(ratio, places)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Exact seconds between two zone-less timestamps, as decimal(20,6)."""
    return (end - start).cast(T.DayTimeIntervalType(3, 3)).cast("decimal(20,6)")


def hours_between(start: Column, end: Column) -> Column:
    """Hours to two places. Seconds are first kept to the millisecond."""
    seconds = elapsed_seconds(start, end).cast("decimal(18,3)").cast("double")
    return round_half(seconds / F.lit(3600.0), 2)


def time_of_day(ts: Column) -> Column:
    """``HH:mm:ss`` of a zone-less timestamp, with a fraction only when there is one."""
    return F.split_part(ts.cast("string"), F.lit(" "), F.lit(2))


def date_or_null(x: Column) -> Column:
    """Parse year-month-day text; anything less than a full date gives NULL.

    A bare Spark cast would read '2024' as 2024-01-01.
    """
    text = F.translate(F.trim(x.cast("string")), "/", "-")
    text = F.regexp_replace(text, r"^(\d{1,3}-)", "000$1")
    return F.when(text.rlike(r"^-?\d{4,}-\d{1,2}-\d{1,2}"), text.try_cast("date"))


def int_or_null(x: Column) -> Column:
    """Parse an integer; text such as '1.7' or '1e3' is read as a number and rounded."""
    return F.round(x.try_cast("double"), 0).try_cast("int")


def money_or_null(x: Column) -> Column:
    return x.try_cast("decimal(15,2)")


def month_number(year: Column, month: Column) -> Column:
    """Year and month as one sortable integer, 2026-08 as 202608."""
    return year * 100 + month


def month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def months_before(as_of: Column, months: int) -> Column:
    return F.add_months(as_of, -months)


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """How many rows meet the condition, 0 for none (NULL counts as not met)."""
    return F.count(F.when(condition, F.lit(1)))


def nulls_last(*cols: Column) -> list[Column]:
    """Struct fields that make MIN order NULL after every value, as ORDER BY does here."""
    return [field for c in cols for field in (c.isNull(), c)]
