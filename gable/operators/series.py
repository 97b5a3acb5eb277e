"""Windows over ordered series: lags, growth, rolling frames, leads.

All of them run on aggregates with one row per entity and period, so a
partition holds at most as many rows as there are periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gable.functions import scores
from gable.runtime import zip_groups


def lag_growth(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    measures: Mapping[str, str],
    *,
    growth_for: Sequence[str] | None = None,
    previous: str = "prev_{}",
) -> DataFrame:
    """Previous observed value, change and growth of each measure.

    ``measures`` maps a column to the stem of its ``<stem>_change`` and
    ``<stem>_growth_rate`` columns. Growth is null unless the previous value
    is positive. ``by`` may be empty for a single short series.
    """
    window = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_first())
    lagged = df.withColumns({previous.format(c): F.lag(c).over(window) for c in measures})
    changes = {}
    for column, stem in measures.items():
        before = F.col(previous.format(column))
        changes[f"{stem}_change"] = F.col(column) - before
        if growth_for is None or column in growth_for:
            changes[f"{stem}_growth_rate"] = scores.growth(F.col(column), before)
    return lagged.withColumns(changes)


def previous_period(
    df: DataFrame, keys: Sequence[str], period: str, previous_period_key: str, measures: Mapping[str, str]
) -> DataFrame:
    """Attach the measures of the calendar period before; a gap gives nulls.

    ``measures`` maps a column to the name it gets as a previous value. The
    input is unique on ``keys`` and ``period``.
    """
    earlier = df.select(
        *keys, F.col(period).alias(previous_period_key), *[F.col(c).alias(n) for c, n in measures.items()]
    )
    return zip_groups(df, earlier, [*keys, previous_period_key])


def rolling(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    column: str,
    stem: str,
    *,
    lags: Sequence[int] = (),
    means: Sequence[int] = (),
    extremes: Sequence[int] = (),
    change: bool = False,
    versus: int | None = None,
) -> DataFrame:
    """Lags, trailing means / max / min, change from lag 1 and ratio to a trailing mean.

    Frames count observed rows and include the current one.
    """
    series = Window.partitionBy(*by).orderBy(order)
    added = {f"{stem}_lag_{k}": F.lag(column, k).over(series) for k in lags}
    for n in means:
        added[f"{stem}_rolling_avg_{n}"] = F.avg(column).over(series.rowsBetween(1 - n, 0))
    for n in extremes:
        frame = series.rowsBetween(1 - n, 0)
        added[f"{stem}_rolling_max_{n}"] = F.max(column).over(frame)
        added[f"{stem}_rolling_min_{n}"] = F.min(column).over(frame)
    if change:
        added[f"{stem}_change_from_lag_1"] = F.col(column) - F.lag(column, 1).over(series)
    if versus:
        trailing = F.avg(column).over(series.rowsBetween(1 - versus, 0))
        added[f"{stem}_vs_rolling_avg_{versus}"] = F.col(column) / F.nullif(trailing, F.lit(0.0))
    return df.withColumns(added)


def lead_target(df: DataFrame, by: Sequence[str], order: str, column: str, name: str) -> DataFrame:
    """Value of the next observed period."""
    return df.withColumn(name, F.lead(column).over(Window.partitionBy(*by).orderBy(order)))


def first_of_month(calendar: DataFrame, date: str = "date", key: str = "time_key") -> DataFrame:
    """Key of the first calendar day of each month."""
    return calendar.groupBy(F.trunc(date, "month").alias("year_month")).agg(F.min_by(key, date).alias(key))
