"""The analyst questions: short reports over the views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

DAILY, AREA = "vw_market_overview_daily_analysis", "vw_area_market_analysis"
TREND, HOTSPOT, METRO = "vw_market_trend_analysis", "vw_hotspot_analysis", "vw_metro_impact_analysis_detail"

# Columns that make each view's row order total.
UNIQUE = {
    DAILY: ["snapshot_date"],
    AREA: ["location_key"],
    TREND: ["snapshot_date", "location_key"],
    HOTSPOT: ["month_key", "location_key", "property_type"],
    METRO: ["area_name", "ward_name", "metro_proximity_category", "station_id"],
}
PLACE = ["area_name", "ward_name", "street_name"]


@dataclass(frozen=True)
class Question:
    """One report: what to read, keep, sort and show.

    ``order`` items are expressions, with a leading ``-`` for descending.
    ``show`` items are column names or ``expression AS name``.
    """

    title: str
    view: str
    show: Sequence[str] = ("*",)
    where: str | None = None
    group: Sequence[str] = ()
    order: Sequence[str] = ()
    limit: int | None = None

    def run(self, views: Mapping[str, DataFrame]) -> DataFrame:
        rows = views[self.view]
        if self.where:
            rows = rows.filter(self.where)
        if self.group:
            totals = [F.expr(s) for s in self.show if s not in self.group]
            rows = rows.groupBy(*self.group).agg(*totals).select(*self.group, *[_name(s) for s in self.show if s not in self.group])
            ties = list(self.group)
        else:
            ties = UNIQUE[self.view]
        keys = [_sort_key(o) for o in self.order] + [F.col(c).asc_nulls_last() for c in ties]
        rows = rows.orderBy(*keys)
        if self.limit:
            rows = rows.limit(self.limit)
        return rows if self.group else rows.selectExpr(*self.show)


def _name(item: str) -> str:
    return item.rsplit(" AS ", 1)[-1]


def _sort_key(item: str):
    return F.expr(item[1:]).desc_nulls_last() if item.startswith("-") else F.expr(item).asc_nulls_last()


_TYPES = ("apt", "house", "land")
_LABELS = ("Can ho / Chung cu", "Nha o", "Dat")


def _best_change() -> str:
    """Largest of the three type changes, 0 when one is unknown."""
    changes = ", ".join(f"{k}_change" for k in _TYPES)
    unknown = " OR ".join(f"{k}_change IS NULL" for k in _TYPES)
    return f"CASE WHEN {unknown} THEN 0 ELSE greatest({changes}) END"


def _best_type() -> str:
    """Label of the type that grew most; the first of equals."""
    unknown = " OR ".join(f"{k}_change IS NULL" for k in _TYPES)
    top = "greatest(" + ", ".join(f"{k}_change" for k in _TYPES) + ")"
    arms = " ".join(f"WHEN {k}_change = {top} THEN '{label}'" for k, label in zip(_TYPES, _LABELS))
    return f"CASE WHEN {unknown} THEN 'Khong xac dinh' {arms} END AS fastest_growing_property_type"


_GROWN = "prev_listing_count IS NOT NULL"
_PRICED = "prev_price_per_m2_avg IS NOT NULL"
_SUPPLY = ["snapshot_date", *PLACE, "listing_count", "prev_listing_count", "listing_change", "listing_growth_rate"]
_PRICE = ["price_per_m2_avg", "prev_price_per_m2_avg", "price_per_m2_change", "price_per_m2_growth_rate"]
_TYPE_HISTORY = [f"{p}{k}_{s}" for k in _TYPES for p, s in (("", "count"), ("prev_", "count"), ("", "change"))]
_TYPE_SHARE_AREA = {k: [*PLACE, "listing_count", f"{k}_count", f"{k}_ratio", "price_per_m2_avg"] for k in _TYPES}
_TYPE_SHARE_DAY = {k: ["snapshot_date", f"{k}_count", f"{k}_ratio", "listing_count"] for k in _TYPES}
_LEVEL = ["hotspot_score", "hotspot_level"]
_METRO_TOTALS = ["count(*) AS area_count", "CAST(sum(listing_count) AS BIGINT) AS total_listing_count"]
_LAG = "lag(unique_seller_count) OVER (ORDER BY snapshot_date)"

QUESTIONS: dict[str, Question] = {
    "q01": Question(
        "Busiest days",
        DAILY,
        ["snapshot_date", "listing_count", "unique_seller_count", "price_avg", "price_per_m2_avg", "size_avg",
         "dominant_property_type", "dominant_property_ratio"],
        order=["-listing_count"], limit=10,
    ),
    "q02": Question("Whole daily series", DAILY),
    "q03": Question(
        "Supply and sellers per day", DAILY,
        ["snapshot_date", "listing_count", "unique_seller_count", "price_per_m2_avg", "dominant_property_type"],
    ),
    "q04": Question("Listings per day", DAILY, ["snapshot_date", "listing_count"]),
    "q05": Question("Days with most listings", DAILY, ["snapshot_date", "listing_count"], order=["-listing_count"], limit=10),
    "q06": Question(
        "Days with the highest unit price", DAILY, ["snapshot_date", "price_avg", "price_per_m2_avg"],
        order=["-price_per_m2_avg"], limit=10,
    ),
    "q07": Question("Dominant type per day", DAILY, ["snapshot_date", "dominant_property_type", "dominant_property_ratio"]),
    "q08": Question("Days by apartment share", DAILY, _TYPE_SHARE_DAY["apt"], order=["-apt_ratio"], limit=10),
    "q09": Question("Days by house share", DAILY, _TYPE_SHARE_DAY["house"], order=["-house_ratio"], limit=10),
    "q10": Question("Days by land share", DAILY, _TYPE_SHARE_DAY["land"], order=["-land_ratio"], limit=10),
    "q11": Question(
        "Sellers against the day before", DAILY,
        ["snapshot_date", "unique_seller_count", f"{_LAG} AS prev_day_unique_seller_count",
         f"unique_seller_count - {_LAG} AS seller_change",
         f"CAST(unique_seller_count - {_LAG} AS DOUBLE) / nullif(CAST({_LAG} AS DOUBLE), 0) AS seller_growth_rate"],
    ),
    "q12": Question(
        "Places with most listings", AREA,
        [*PLACE, "listing_count", "unique_seller_count", "price_per_m2_avg", "dominant_property_type"],
        order=["-listing_count"], limit=20,
    ),
    "q13": Question(
        "Places with the highest unit price", AREA,
        [*PLACE, "listing_count", "price_avg", "price_per_m2_avg", "size_avg", "dominant_property_type"],
        where="listing_count >= 5", order=["-price_per_m2_avg"], limit=20,
    ),
    "q14": Question(
        "Places with most sellers", AREA,
        [*PLACE, "listing_count", "unique_seller_count", "price_per_m2_avg", "dominant_property_type"],
        order=["-unique_seller_count"], limit=20,
    ),
    "q15": Question("Apartment places", AREA, _TYPE_SHARE_AREA["apt"], "listing_count >= 5", order=["-apt_count"], limit=20),
    "q16": Question("House places", AREA, _TYPE_SHARE_AREA["house"], "listing_count >= 5", order=["-house_count"], limit=20),
    "q17": Question("Land places", AREA, _TYPE_SHARE_AREA["land"], "listing_count >= 5", order=["-land_count"], limit=20),
    "q18": Question(
        "Dominant type of the largest places", AREA,
        [*PLACE, "listing_count", "dominant_property_type", "dominant_property_ratio", "apt_ratio", "house_ratio", "land_ratio"],
        "listing_count >= 5", order=["-listing_count"], limit=30,
    ),
    "q19": Question(
        "Places by quality", AREA,
        [*PLACE, "listing_count", "quality_score_avg", "good_quality_ratio", "risk_quality_ratio", "fully_legal_ratio",
         "risk_legal_ratio", "price_per_m2_avg"],
        "listing_count >= 5", order=["-quality_score_avg"], limit=20,
    ),
    "q20": Question(
        "Places by quality and volume", AREA,
        [*PLACE, "listing_count", "unique_seller_count", "quality_score_avg", "good_quality_ratio", "fully_legal_ratio",
         "price_per_m2_avg", "dominant_property_type"],
        "listing_count >= 5", order=["-quality_score_avg", "-listing_count"], limit=20,
    ),
    "q21": Question("Supply change per place", TREND, _SUPPLY, _GROWN, order=["snapshot_date", "-listing_growth_rate"]),
    "q22": Question(
        "Fastest supply growth", TREND, _SUPPLY, "prev_listing_count >= 3", order=["-listing_growth_rate"], limit=20,
    ),
    "q23": Question(
        "Unit price change per place", TREND, ["snapshot_date", *PLACE, *_PRICE], _PRICED,
        order=["snapshot_date", "-price_per_m2_growth_rate"],
    ),
    "q24": Question(
        "Fastest unit price growth", TREND, ["snapshot_date", *PLACE, "listing_count", *_PRICE],
        f"{_PRICED} AND prev_listing_count >= 3 AND listing_count >= 3", order=["-price_per_m2_growth_rate"], limit=20,
    ),
    "q25": Question(
        "Places growing in supply and price", TREND,
        ["snapshot_date", *PLACE, "listing_count", "prev_listing_count", "listing_growth_rate", "price_per_m2_avg",
         "prev_price_per_m2_avg", "price_per_m2_growth_rate", "unique_seller_count", "seller_growth_rate",
         "supply_price_trend_type"],
        "prev_listing_count >= 3 AND listing_count >= 3 AND listing_growth_rate > 0 AND price_per_m2_growth_rate > 0",
        order=["-listing_growth_rate", "-price_per_m2_growth_rate"], limit=20,
    ),
    "q26": Question(
        "Fastest growing type per place", TREND, ["snapshot_date", *PLACE, *_TYPE_HISTORY, _best_type()], _GROWN,
        order=["snapshot_date", *PLACE],
    ),
    "q27": Question(
        "Strongest type growth", TREND,
        ["snapshot_date", *PLACE, "apt_change", "house_change", "land_change", _best_type()],
        _GROWN, order=[f"-{_best_change()}"], limit=20,
    ),
    "q28": Question(
        "Direction of supply and price", TREND,
        ["snapshot_date", *PLACE, "listing_change", "listing_growth_rate", "price_per_m2_change",
         "price_per_m2_growth_rate", "supply_price_trend_type"],
        f"{_GROWN} AND {_PRICED}", order=["snapshot_date", *PLACE],
    ),
    "q29": Question(
        "Places per trend type", TREND, ["snapshot_date", "supply_price_trend_type", "count(*) AS area_count"],
        f"{_GROWN} AND {_PRICED}", group=["snapshot_date", "supply_price_trend_type"],
        order=["snapshot_date", "-area_count"],
    ),
    "q30": Question(
        "Hotspots by listings", HOTSPOT,
        ["month_key", *PLACE, "listing_count", "unique_seller_count", "price_per_m2_avg", *_LEVEL],
        order=["-listing_count"], limit=20,
    ),
    "q31": Question(
        "Hotspots by supply growth", HOTSPOT,
        ["month_key", *PLACE, "prev_listing_count", "listing_count", "listing_change", "listing_growth_rate", *_LEVEL],
        "listing_growth_rate > 0", order=["-listing_growth_rate"], limit=20,
    ),
    "q32": Question(
        "Hotspots by price growth", HOTSPOT, ["month_key", *PLACE, *_PRICE, "listing_count", *_LEVEL],
        "price_per_m2_growth_rate > 0", order=["-price_per_m2_growth_rate"], limit=20,
    ),
    "q33": Question(
        "Hotspots by sellers", HOTSPOT,
        ["month_key", *PLACE, "listing_count", "unique_seller_count", "unique_seller_growth_rate", "price_per_m2_avg", *_LEVEL],
        order=["-unique_seller_count"], limit=20,
    ),
    "q34": Question(
        "Hotspots growing in supply and price", HOTSPOT,
        ["month_key", *PLACE, "prev_listing_count", "listing_count", "listing_change", "listing_growth_rate", *_PRICE,
         "unique_seller_count", "supply_price_trend_type", *_LEVEL],
        "listing_change > 0 AND price_per_m2_change > 0",
        order=["-hotspot_score", "-listing_growth_rate", "-price_per_m2_growth_rate"], limit=20,
    ),
    "q35": Question(
        "Prices by metro group", METRO,
        ["metro_group", *_METRO_TOTALS, "avg(price_per_m2_avg) AS avg_price_per_m2", "avg(price_avg) AS avg_price",
         "avg(size_avg) AS avg_size"],
        group=["metro_group"], order=["-avg_price_per_m2"],
    ),
    "q36": Question(
        "Supply by metro group", METRO, ["metro_group", *_METRO_TOTALS, "avg(listing_count) AS avg_listing_per_area"],
        group=["metro_group"], order=["-total_listing_count"],
    ),
    "q37": Question(
        "Type mix by metro group", METRO,
        ["metro_group",
         *[f"CAST(sum({k}_count) AS BIGINT) AS total_{k}_count" for k in _TYPES],
         "CAST(sum(listing_count) AS BIGINT) AS total_listing_count",
         *[f"CAST(sum({k}_count) AS DOUBLE) / CAST(sum(listing_count) AS DOUBLE) AS {k}_ratio" for k in _TYPES]],
        group=["metro_group"], order=["-total_listing_count"],
    ),
    "q38": Question(
        "Places near the metro", METRO,
        ["area_name", "ward_name", "station_name", "nearest_metro_distance_m", "listing_count", "price_per_m2_avg",
         "apt_count", "house_count", "land_count", "dominant_property_type"],
        "metro_group = 'Gan metro'", order=["-listing_count", "-price_per_m2_avg"], limit=20,
    ),
    "q39": Question(
        "Price and supply by proximity", METRO,
        ["metro_proximity_category", "metro_group", *_METRO_TOTALS, "avg(listing_count) AS avg_listing_per_area",
         "avg(price_avg) AS avg_price", "avg(price_per_m2_avg) AS avg_price_per_m2", "avg(size_avg) AS avg_size"],
        group=["metro_proximity_category", "metro_group"], order=["-avg_price_per_m2"],
    ),
}
