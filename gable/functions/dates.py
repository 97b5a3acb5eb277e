"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Months that count as peak season, and the season of each month.
PEAK_MONTHS = (6, 7, 8, 11, 12)
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}


def epoch_ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.floor(ms / F.lit(1000.0)))


def event_date(*ms: Column, zone: str) -> Column:
    """Local calendar date of the first non-zero epoch-ms column, else today."""
    first = F.coalesce(*[F.when(c.cast("long") != 0, c.cast("long")) for c in ms])
    local = F.to_date(F.from_utc_timestamp(F.timestamp_millis(first), zone))
    today = F.to_date(F.from_utc_timestamp(F.current_timestamp(), zone))
    return F.coalesce(local, today)


def day_key(date: Column) -> Column:
    """``yyyymmdd`` as int."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_start_key(date: Column) -> Column:
    """``yyyymm01`` as int."""
    return (F.year(date) * 10000 + F.month(date) * 100 + 1).cast("int")


def month_text(date: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(date, "yyyy-MM")


def month_number(year: Column, month: Column) -> Column:
    """``yyyymm`` as int."""
    return (year * 100 + month).cast("int")


def previous_month_number(year: Column, month: Column) -> Column:
    """``yyyymm`` of the month before, with year wrap."""
    return F.when(month == 1, (year - 1) * 100 + 12).otherwise(year * 100 + month - 1).cast("int")


def season(date: Column) -> Column:
    month = F.month(date)
    chain = F
    for label, months in SEASONS.items():
        chain = chain.when(month.isin(*months), label)
    return chain.otherwise("Fall")


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7).cast("int")


def is_peak_season(date: Column) -> Column:
    return F.month(date).isin(*PEAK_MONTHS).cast("int")


def calendar_columns(date: Column) -> dict[str, Column]:
    """Attributes of one calendar day, in table order."""
    return {
        "time_key": day_key(date),
        "date": date,
        "year": F.year(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "quarter": F.quarter(date),
        "week": F.weekofyear(date),
        "day_of_week": F.dayofweek(date),
        "day_name": F.date_format(date, "EEEE"),
        "day_of_month": F.dayofmonth(date),
        "is_weekend": is_weekend(date),
        "season": season(date),
    }
