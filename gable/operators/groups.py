"""Grouped aggregates and what is computed from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gable.functions import scores
from gable.operators.ordered import group_quantiles, quantile_scalar
from gable.runtime import attach, stage, zip_groups


def conditional_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """``count_if`` per name; a null condition does not count."""
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]


def multi_distinct(df: DataFrame, by: Sequence[str], columns: Mapping[str, str], *, approx: bool = False) -> DataFrame:
    """Distinct counts of several columns in one pass; sketches when ``approx``."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*by).agg(*[count(c).alias(name) for name, c in columns.items()])


def value_counts(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def distinct_dim(df: DataFrame, columns: Sequence[str], required: str) -> DataFrame:
    """Distinct combinations whose ``required`` column is present."""
    return df.filter(F.col(required).isNotNull()).select(*columns).distinct()


def price_stats(
    df: DataFrame, by: Sequence[str], value: str, prefix: str, *, exact: bool = True, digits: int | None = None
) -> DataFrame:
    """avg / sample stddev / median / min / max / count per group of the positive values."""
    positive = df.filter(F.col(value) > 0)
    plain = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    moments = positive.groupBy(*by).agg(
        plain(F.avg(value)).alias(f"{prefix}avg"),
        F.stddev(value).alias(f"{prefix}std"),
        plain(F.min(value)).alias(f"{prefix}min"),
        plain(F.max(value)).alias(f"{prefix}max"),
        F.count("*").alias("listing_count"),
    )
    medians = group_quantiles(positive, by, value, {f"{prefix}median": 0.5}, exact=exact)
    medians = medians.withColumn(f"{prefix}median", plain(F.col(f"{prefix}median").cast("double")))
    return zip_groups(moments, medians, by)


def _quartiles(df: DataFrame, by: Sequence[str], value: str, k: float, exact: bool) -> DataFrame:
    """Quartiles and outlier bounds of each group with a full key."""
    known = df.na.drop(subset=list(by))
    quartiles = group_quantiles(known, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, exact=exact)
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumns({"lower_bound": F.col("q1") - k * spread, "upper_bound": F.col("q3") + k * spread})


def iqr_bounds(df: DataFrame, by: Sequence[str], value: str, k: float = 1.5, *, exact: bool = True) -> DataFrame:
    """Quartiles, outlier bounds, size, extremes and mean of each group."""
    extremes = df.na.drop(subset=[*by, value]).groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.avg(value).alias("mean"),
    )
    return zip_groups(extremes, _quartiles(df, by, value, k, exact), by)


def remove_iqr_outliers(df: DataFrame, by: Sequence[str], value: str, k: float = 1.5, *, exact: bool = True) -> DataFrame:
    """Drop rows outside their group's bounds; null values and groups are kept."""
    bounds = _quartiles(df, by, value, k, exact).select(*by, "lower_bound", "upper_bound")
    joined = attach(df, bounds, by)
    outside = (F.col(value) < F.col("lower_bound")) | (F.col(value) > F.col("upper_bound"))
    return joined.filter(~F.coalesce(outside, F.lit(False))).drop("lower_bound", "upper_bound")


def tier_vs_median(df: DataFrame, by: str, value: str, name: str, *, high: float = 1.5, low: float = 0.7, exact: bool = True) -> DataFrame:
    """Tier of each group's average against the overall median, as (by, name)."""
    priced = df.filter(F.col(value).isNotNull())
    middle = quantile_scalar(priced, value, 0.5, exact=exact)
    averages = priced.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("__avg"))
    return averages.select(by, scores.tier(F.col("__avg"), middle, high, low).alias(name))


def volume_tier(df: DataFrame, by: str, name: str = "tier", *, exact: bool = True) -> DataFrame:
    """High / Medium / Low-Volume by the 75th and 50th percentile of group sizes."""
    volumes = stage(df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("__n")), "volumes")
    upper = quantile_scalar(volumes, "__n", 0.75, exact=exact)
    middle = quantile_scalar(volumes, "__n", 0.5, exact=exact)
    label = (
        F.when(F.col("__n") >= upper, "High-Volume").when(F.col("__n") >= middle, "Medium-Volume").otherwise("Low-Volume")
    )
    return volumes.select(by, F.col("__n").alias("listing_count"), label.alias(name))


def group_premium(df: DataFrame, by: str, value: str) -> DataFrame:
    """Group averages and their premium over the overall average in percent."""
    overall = df.agg(F.avg(value)).scalar()
    grouped = df.groupBy(by).agg(F.count("*").alias("row_count"), F.round(F.avg(value), 0).alias("avg_price"))
    premium = (F.col("avg_price") - overall) / F.nullif(overall, F.lit(0.0)) * 100
    return grouped.withColumn("price_premium_pct", F.round(premium, 1))


def ratio_of_sums(numerators: Mapping[str, str], denominator: str) -> list[Column]:
    """``sum(a) / sum(b)`` per name, null for a zero denominator."""
    bottom = F.sum(denominator).cast("double")
    return [(F.sum(c).cast("double") / F.nullif(bottom, F.lit(0.0))).alias(n) for n, c in numerators.items()]
