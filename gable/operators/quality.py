"""Filters, imputation and stage counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from gable.operators.ordered import number_rows, quantile_scalar
from gable.runtime import stage


def drop_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column that exists is present."""
    present = [c for c in columns if c in df.columns]
    return df.na.drop(how="any", subset=present) if present else df


def keep_complete(df: DataFrame, column: str = "ispartial") -> DataFrame:
    """Keep finished periods: the partial flag is false as boolean or text; null is dropped."""
    return df.filter(F.lower(F.col(column).cast("string")) == "false")


def size_deviation(width: Column, length: Column, size: Column) -> Column:
    """Relative gap between width x length and size; null when it cannot be told."""
    return F.when(size > 0, F.abs(width * length - size) / F.nullif(size, F.lit(0.0)))


def drop_inconsistent(df: DataFrame, width: str = "width", length: str = "length", size: str = "size", tolerance: float = 0.10) -> DataFrame:
    """Drop rows whose size disagrees with width x length; unknown ones stay."""
    gap = size_deviation(F.col(width), F.col(length), F.col(size))
    return df.filter(F.coalesce(gap, F.lit(0.0)) <= tolerance)


def not_in_or_null(column: Column, values: Sequence[object]) -> Column:
    """Membership test that keeps null on the outside."""
    return ~column.isin(*values) | column.isNull()


def impute_median(df: DataFrame, column: str, *, exact: bool = True, accuracy: int = 10_000, of: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the global median, of the rows of ``of`` if given; an all-null column stays as it is."""
    middle = quantile_scalar(df if of is None else of, column, 0.5, exact=exact, accuracy=accuracy)
    return df.withColumn(column, F.coalesce(F.col(column), middle.cast("double")))


def labels_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Labels that occur together, written, so that several columns' labels are found in one scan of the rows."""
    return stage(df.select(*columns).distinct(), "labels")


def label_map(df: DataFrame, column: str) -> DataFrame:
    """(label, code) with codes 0..n-1 in label order."""
    labels = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    return number_rows(labels, ["label"], "code", start=0).withColumn("code", F.col("code").cast("int"))


def extend_label_map(known: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Known codes plus codes after the highest one for labels seen first in ``df``."""
    fresh = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    fresh = number_rows(fresh.join(known, "label", "left_anti"), ["label"], "code", start=0)
    base = known.agg(F.coalesce(F.max("code"), F.lit(-1)) + 1).scalar()
    return known.unionByName(fresh.withColumn("code", (F.col("code") + base).cast("int")))


def observe_stage(df: DataFrame, name: str, conditions: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Count rows (and rows meeting each condition) while the plan runs; no extra job."""
    seen = Observation(name)
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (conditions or {}).items()]
    return df.observe(seen, *counters), seen
