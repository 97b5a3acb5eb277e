"""Global order without a single-task window: numbering, running sums, ranks,
exact quantiles.

A window with no partition key, or over a key that holds a third of the rows,
puts everything in one task. The operators here range-partition instead, work
inside each range, and carry the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gable.runtime import attach, stage

# monotonically_increasing_id keeps the partition in the high bits and the
# position in the low 33 bits.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_number", start: int = 1) -> DataFrame:
    """Dense numbering along ``order`` (ascending, nulls first).

    One range shuffle; then each range numbers its own rows and adds the rows
    of the ranges before it. The only table that meets in one place has one
    row per range partition.
    """
    ranged = stage(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbering",
    )
    part = F.shiftright("__at", _POSITION_BITS)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    position = F.col("__at").bitwiseAND((1 << _POSITION_BITS) - 1)
    return (
        ranged.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, (position + F.col("__offset") + start).cast("long"))
        .drop("__at", "__part", "__offset")
    )


def dense_key(df: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """Surrogate key 1..n over the distinct natural keys, in their sort order."""
    return number_rows(df.select(*natural).distinct(), natural, name)


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measure: str,
    name: str,
    total: str | None = None,
) -> DataFrame:
    """Running sum of ``measure`` inside each group along ``order``, own row included.

    ``df`` should be pre-aggregated (one row per group and order value). A
    group may be spread over any number of range partitions. ``total`` also
    adds the sum of the whole group.
    """
    by, order = list(by), list(order)
    ranged = stage(
        df.repartitionByRange(*[F.col(c) for c in by + order]).withColumn("__part", F.spark_partition_id()),
        "running",
    )
    pieces = ranged.groupBy("__part", *by).agg(F.sum(measure).alias("__piece"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        "__part",
        *by,
        F.coalesce(F.sum("__piece").over(earlier), F.lit(0)).alias("__carry"),
        F.sum("__piece").over(group).alias("__total"),
    )
    inside = Window.partitionBy("__part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("__local", F.sum(measure).over(inside))
    joined = attach(local, carried, ["__part", *by], null_safe=True, spread_by=[*by, *order])
    joined = joined.withColumn(name, F.col("__local") + F.col("__carry"))
    if total:
        joined = joined.withColumn(total, F.col("__total"))
    return joined.drop("__part", "__local", "__carry", "__total")


def rank_share(
    histogram: DataFrame, by: Sequence[str], value: str, rows: str, name: str, scale: float = 100.0, digits: int = 1
) -> DataFrame:
    """``percent_rank`` of each distinct value from a (group, value, rows) histogram.

    Null values hold the lowest ranks of their group and get no row.
    """
    by = list(by)
    ranked = running_sum(histogram, by, [value], rows, "__upto", total="__group")
    below, others = F.col("__upto") - F.col(rows), F.col("__group") - 1
    share = F.coalesce(below / F.nullif(others, F.lit(0)), F.lit(0.0))
    return ranked.filter(F.col(value).isNotNull()).select(*by, value, F.round(share * scale, digits).alias(name))


def percent_rank_in(
    df: DataFrame, by: Sequence[str], value: str, name: str, *, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Add the ``percent_rank`` of ``value`` inside each group in percent, one decimal.

    Works on the (group, value) histogram, so only distinct values are sorted.
    """
    histogram = df.groupBy(*by, value).agg(F.count("*").alias("__rows"))
    ranked = rank_share(histogram, by, value, "__rows", name)
    return attach(df, ranked, [*by, value], null_safe=True, spread_by=spread_by)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact discrete quantiles per group: the smallest value whose cumulative share reaches p.

    Memory stays flat for any group size, unlike the built-in exact
    percentile, which keeps every distinct value of a group in one task.
    """
    by = list(by)
    histogram = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__rows"))
    ranked = running_sum(histogram, by, [value], "__rows", "__upto", total="__group")
    picks = [
        F.min(F.when(F.col("__upto") >= F.col("__group") * p, F.col(value))).alias(name) for name, p in probs.items()
    ]
    return ranked.groupBy(*by).agg(*picks)


def group_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], *, exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Quantiles per group: exact, or from a mergeable sketch of bounded size."""
    if exact:
        return exact_quantiles(df, by, value, probs)
    sketch = F.percentile_approx(value, [float(p) for p in probs.values()], accuracy)
    found = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(sketch.alias("__q"))
    return found.select(*by, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)])


def quantile_scalar(df: DataFrame, value: str, p: float, *, exact: bool = True, accuracy: int = 10_000):
    """One global quantile as a scalar column (a scalar subquery, no collect)."""
    return group_quantiles(df, [], value, {"__p": p}, exact=exact, accuracy=accuracy).scalar()
