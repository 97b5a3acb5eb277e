"""Mergeable day states: quantiles and distinct counts of any period without its rows.

A state is one row for each key and day: row count, a KLL sketch of a measure and an HLL
sketch of an id. States of finished days are stored once and never computed again; those of
any period and any coarser key are merged, which costs the number of states, not of rows.
Sketches are bounded by their parameters, so no group is ever gathered, however large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gable.sources.sinks import append_new

#: Size parameters: of the quantile sketch, and log2 of the distinct sketch's registers.
QUANTILE_K, DISTINCT_LG = 400, 12


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a KLL sketch of size ``k``, not exceeded with 99 % confidence (published formula)."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of an HLL sketch of 2^lg registers (published formula)."""
    return 0.8326 / 2 ** (lg / 2)


def day_states(df: DataFrame, keys: Sequence[str], day: str, measure: str, identity: str) -> DataFrame:
    """One state for each key and day. Null measures and ids are counted in ``row_count`` alone."""
    value = F.col(measure).cast("double")
    return df.groupBy(*keys, day).agg(
        F.count("*").alias("row_count"),
        F.count(value).alias("value_count"),
        F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_sketch_agg(F.col(identity).cast("string"), F.lit(DISTINCT_LG)).alias("ids"),
    )


def add_days(states: DataFrame, table: str, keys: Sequence[str], day: str, path: str | None = None) -> int:
    """Stores states of days that have none yet; a repeated run adds nothing."""
    return append_new(states, table, [*keys, day], path=path)


def merged(states: DataFrame, keys: Sequence[str], within: Column | None = None) -> DataFrame:
    """One state for each of ``keys``, from those where ``within`` holds."""
    chosen = states if within is None else states.where(within)
    return chosen.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("value_count").alias("value_count"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_union_agg("ids").alias("ids"),
    )


def figures(states: DataFrame, shares: Mapping[str, float], distinct: str) -> DataFrame:
    """The asked quantiles and the estimated number of ids of each state, in place of its sketches; no values, no quantile."""
    some = F.col("value_count") > 0
    found = {name: F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))) for name, p in shares.items()}
    return states.withColumns({**found, distinct: F.hll_sketch_estimate("ids")}).drop("quantiles", "ids")
