"""Pacific-time months and period labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def pacific_date(column: Column | str) -> Column:
    """Pacific calendar date of a UTC timestamp without zone.

    In a UTC session the older shift function gives the same date at half the
    cost: it looks the zone up once, not for each row.
    """
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return F.to_date(F.from_utc_timestamp(_col(column).cast("timestamp"), PACIFIC))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), _col(column)))


def month_of(column: Column | str) -> Column:
    return F.to_date(F.trunc(_col(column), "month"))


def pacific_midnight_utc(day: dt.date) -> Column:
    """UTC instant of Pacific midnight; a foldable literal, so the scan can use it."""
    midnight = F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
    return F.convert_timezone(F.lit(PACIFIC), F.lit("UTC"), midnight)


def in_pacific_months(column: Column | str, start: dt.date, end: dt.date) -> Column:
    """Pacific-month range as bounds on the untouched UTC column."""
    c = _col(column)
    return (c >= pacific_midnight_utc(start)) & (c < pacific_midnight_utc(end))


def month_label(column: Column | str) -> Column:
    return F.date_format(_col(column), "yyyy-MM")


def quarter_start(column: Column | str) -> Column:
    return F.to_date(F.trunc(_col(column), "quarter"))


def half_start(column: Column | str) -> Column:
    c = _col(column)
    return F.make_date(F.year(c), F.when(F.month(c) <= 6, 1).otherwise(7), F.lit(1))


def quarter_name(start: dt.date) -> str:
    return f"{start.year}-Q{(start.month - 1) // 3 + 1}"


def half_name(start: dt.date) -> str:
    return f"{start.year}{'上半年' if start.month == 1 else '下半年'}"


def period_end(month: Column | str, today: Column | dt.date) -> Column:
    """Last day of the month, or today while the month is running."""
    day = F.lit(today) if isinstance(today, dt.date) else today
    return F.least(F.last_day(_col(month)), day)
