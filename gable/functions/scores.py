"""Flags, bands, scores and ratios as pure column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

#: Metres per degree and the value of pi used by the published distances.
METRES_PER_DEGREE = 111_000
PI = 3.14159


def flag(condition: Column) -> Column:
    """1 when true, 0 when false *or null*."""
    return F.when(condition, 1).otherwise(0).cast("int")


def listed_flags(value: Column, listed: Sequence[str]) -> tuple[Column, Column]:
    """(listed, not listed); null is not listed."""
    return flag(value.isin(*listed)), flag(~F.coalesce(value.isin(*listed), F.lit(False)))


def first_true(cases: Mapping[str, Column], default: str | None) -> Column:
    """Label of the first condition that holds."""
    chain = F
    for label, condition in cases.items():
        chain = chain.when(condition, label)
    return chain.otherwise(default)


def band(value: Column, edges: Sequence[float], labels: Sequence[object], *, inclusive: bool = False) -> Column:
    """Label of the first edge above ``value``; the last label takes the rest and nulls."""
    chain = F
    for edge, label in zip(edges, labels):
        chain = chain.when(value <= edge if inclusive else value < edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def step_score(value: Column, steps: Sequence[tuple[float, float]], positive: float | None = None) -> Column:
    """Score of the highest threshold reached; ``positive`` scores any value above zero."""
    chain = F
    for threshold, score in steps:
        chain = chain.when(value >= threshold, F.lit(score))
    if positive is not None:
        chain = chain.when(value > 0, F.lit(positive))
    return chain.otherwise(F.lit(0.0))


def weighted_flags(weights: Mapping[str, float], *extra: Column, cap: float = 100.0) -> Column:
    """Weights of the flag columns that are 1, plus further points, limited to ``cap``."""
    parts = [F.when(F.col(name) == 1, float(w)).otherwise(0.0) for name, w in weights.items()]
    return F.least(reduce(lambda a, b: a + b, [*parts, *extra]), F.lit(float(cap)))


def image_points(images: Column, many: float, few: float) -> Column:
    """``many`` from five images, ``few`` from one, else 0."""
    return F.when(images >= 5, float(many)).when(images >= 1, float(few)).otherwise(0.0)


def image_richness(images: Column) -> Column:
    """0 / 1 / 3 / 5 / 7 / 10 by image count; null scores 0."""
    count = F.coalesce(images, F.lit(0))
    return (
        F.when(count == 0, 0)
        .when(count < 1, 1)
        .when(count < 3, 3)
        .when(count < 5, 5)
        .when(count < 10, 7)
        .otherwise(10)
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double when the denominator is positive, else null."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def growth(current: Column, previous: Column) -> Column:
    """Relative change against a positive previous value."""
    return safe_ratio(current - previous, previous)


def dominant(counts: Mapping[str, Column], default: str) -> Column:
    """Label of the largest count; earlier labels win ties, nulls give ``default``."""
    best = reduce(lambda a, b: F.when(a.isNull() | b.isNull(), None).otherwise(F.greatest(a, b)), counts.values())
    chain = F
    for label, count in counts.items():
        chain = chain.when(count == best, label)
    return chain.otherwise(default)


def largest(counts: Mapping[str, Column], default: Column) -> Column:
    """Largest count, ``default`` when one of them is null."""
    anything_null = reduce(lambda a, b: a | b, [c.isNull() for c in counts.values()])
    return F.when(anything_null, default).otherwise(F.greatest(*counts.values()))


def sign_pair_label(first: Column, second: Column, labels: Mapping[tuple[int, int], str], default: str) -> Column:
    """Label by the signs of two changes; a zero or null change gives ``default``."""
    signs = {label: (F.signum(first) == a) & (F.signum(second) == b) for (a, b), label in labels.items()}
    return first_true(signs, default)


def saturation(count: Column, deviation: Column, mean: Column) -> Column:
    """0..100 from competition and relative price spread, one decimal."""
    score = count / 100 * 50 + deviation / F.nullif(mean, F.lit(0.0)) * 50
    return F.when((mean > 0) & deviation.isNotNull() & count.isNotNull(), F.round(F.least(score, F.lit(100.0)), 1))


def zscore(value: Column, mean: Column, deviation: Column) -> Column:
    """Standard score with two decimals; null without a positive deviation."""
    return F.when(deviation > 0, F.round((value - mean) / F.nullif(deviation, F.lit(0.0)), 2))


def price_per_unit(price: Column, size: Column) -> Column:
    return F.when((size > 0) & price.isNotNull(), price / F.nullif(size, F.lit(0.0)))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat-earth distance in whole metres between two points given in degrees."""
    north = (lat1 - lat2) * METRES_PER_DEGREE
    east = (lon1 - lon2) * METRES_PER_DEGREE * F.cos(lat1 * (PI / 180))
    return F.round(F.sqrt(north * north + east * east), 0)


def rooms_band(rooms: Column, has_rooms: Column) -> Column:
    """Room band; a listing without rooms is land."""
    sized = band(rooms, (1, 2, 3, 4, 5), ("Studio", "1BR", "2BR", "3BR", "4BR", "5BR_Plus"))
    return (
        F.when(has_rooms == 0, "No_Rooms_Land")
        .when(F.coalesce(rooms, F.lit(0)) == 0, "Unknown_Rooms")
        .when(rooms > 0, sized)
        .otherwise("Unknown")
    )


def tier(value: Column, middle: Column, high: float = 1.5, low: float = 0.7) -> Column:
    """Premium / Developing / Standard against a middle value."""
    return F.when(value > middle * high, "Premium").when(value < middle * low, "Developing").otherwise("Standard")
