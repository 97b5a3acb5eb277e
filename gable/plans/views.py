"""The catalogue of reporting views over the gold tables.

Facts are aggregated on their keys first; names from the dimensions are joined
to the aggregate, which is orders of magnitude smaller than the fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gable.functions import dates, scores
from gable.operators import groups, quality, series
from gable.plans import vocab

Tables = Mapping[str, DataFrame]

_TYPE_FLAGS = {"apt_count": "is_apt", "house_count": "is_house", "land_count": "is_land"}


def _means(columns: Mapping[str, str]) -> list[Column]:
    return [F.avg(F.col(c).cast("double")).alias(name) for name, c in columns.items()]


def _flag_counts(flags: Mapping[str, str]) -> list[Column]:
    return groups.conditional_counts({name: F.col(c) == 1 for name, c in flags.items()})


def _supply() -> list[Column]:
    return [
        F.count_distinct("list_id").alias("listing_count"),
        F.count_distinct("account_id").alias("unique_seller_count"),
        *_means({"price_avg": "price", "price_per_m2_avg": "price_per_m2", "size_avg": "size"}),
    ]


def _unknown_type() -> Column:
    return groups.conditional_counts(
        {"unknown_property_count": (F.col("is_apt") == 0) & (F.col("is_house") == 0) & (F.col("is_land") == 0)}
    )[0]


def _ratios(names: Mapping[str, str], base: str = "listing_count") -> dict[str, Column]:
    return {ratio: scores.safe_ratio(F.col(c), F.col(base)) for ratio, c in names.items()}


def _type_counts(last_label: str | None = None, last: str | None = None) -> dict[str, Column]:
    counts = {
        vocab.TYPE_APARTMENT: F.col("apt_count"),
        vocab.TYPE_HOUSE: F.col("house_count"),
        vocab.TYPE_LAND: F.col("land_count"),
    }
    return {**counts, last_label: F.col(last)} if last else counts


def _dominant_columns() -> dict[str, Column]:
    counts = _type_counts(vocab.TYPE_UNKNOWN, "unknown_property_count")
    top = scores.largest(counts, F.col("unknown_property_count"))
    return {
        "dominant_property_type": scores.dominant(counts, vocab.TYPE_UNKNOWN),
        "dominant_property_ratio": scores.safe_ratio(top, F.col("listing_count")),
    }


_TYPE_RATIOS = {"apt_ratio": "apt_count", "house_ratio": "house_count", "land_ratio": "land_count"}


def market_overview_daily(t: Tables) -> DataFrame:
    """Supply, prices and type mix per day."""
    dated = t["fact_properties"].filter(F.col("snapshot_date").isNotNull())
    return dated.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), *_supply(), *_flag_counts(_TYPE_FLAGS), _unknown_type()
    )


def market_overview_daily_analysis(t: Tables) -> DataFrame:
    """Daily overview with type ratios and the dominant type."""
    daily = t["vw_market_overview_daily"].filter(F.col("listing_count") > 0)
    ratios = {**_TYPE_RATIOS, "unknown_property_ratio": "unknown_property_count"}
    return daily.withColumns(_ratios(ratios)).withColumns(_dominant_columns())


def market_trend_base(t: Tables) -> DataFrame:
    """Daily overview per location."""
    dated = t["fact_properties"].filter(F.col("snapshot_date").isNotNull())
    daily = dated.groupBy("snapshot_date", "location_key").agg(
        F.count("*").alias("row_count"),
        *_supply(),
        *_flag_counts(_TYPE_FLAGS),
        *_means({"quality_score_avg": "quality_score"}),
    )
    names = t["dim_location"].select("location_key", "area_name", "ward_name", "street_name")
    named = daily.join(names, "location_key", "left")
    lead = ["snapshot_date", "location_key", "area_name", "ward_name", "street_name"]
    return named.select(*lead, *[c for c in daily.columns if c not in lead])


def market_trend_analysis(t: Tables) -> DataFrame:
    """Change and growth of each location against its previous observed day."""
    base = t["vw_market_trend_analysis_base"].filter(F.col("listing_count") > 0).drop("row_count")
    measures = {
        "listing_count": "listing",
        "price_per_m2_avg": "price_per_m2",
        "unique_seller_count": "seller",
        "apt_count": "apt",
        "house_count": "house",
        "land_count": "land",
    }
    grown = series.lag_growth(base, ["location_key"], "snapshot_date", measures, growth_for=list(measures)[:3])
    return grown.withColumn("supply_price_trend_type", _trend_type("listing_change", "price_per_m2_change"))


def _trend_type(supply: str, price: str) -> Column:
    return scores.sign_pair_label(F.col(supply), F.col(price), vocab.TRENDS, vocab.TREND_UNCLEAR)


def _calendar(t: Tables) -> DataFrame:
    """Year and month by time key; bounded by the calendar, so safe to broadcast."""
    days = t["dim_time"].select("time_key", F.col("year").alias("year_value"), F.col("month").alias("month_value"))
    return F.broadcast(days)


def market_trend_monthly_base(t: Tables) -> DataFrame:
    """Supply and prices per month, location and property."""
    priced = t["fact_properties"].filter(F.col("list_id").isNotNull() & (F.col("price_per_m2") > 0))
    monthly = (
        priced.join(_calendar(t), "time_key")
        .groupBy("year_value", "month_value", "location_key", "property_key")
        .agg(
            *_supply(),
            F.min("price_per_m2").alias("price_per_m2_min"),
            F.max("price_per_m2").alias("price_per_m2_max"),
            *_means({"quality_score_avg": "quality_score"}),
        )
    )
    places = t["dim_location"].filter(F.col("area_name").isNotNull())
    kinds = t["dim_property"].filter(F.col("category_name").isNotNull())
    named = monthly.join(places.select("location_key", "area_name", "ward_name", "street_name"), "location_key").join(
        kinds.select("property_key", F.col("category_name").alias("property_type")), "property_key"
    )
    named = named.withColumn("month_key", dates.month_number(F.col("year_value"), F.col("month_value")))
    return named.select(
        "year_value", "month_value", "month_key", "location_key", "area_name", "ward_name", "street_name",
        "property_key", "property_type", "listing_count", "unique_seller_count", "price_avg", "price_per_m2_avg",
        "size_avg", "price_per_m2_min", "price_per_m2_max", "quality_score_avg",
    )


def market_trend_monthly_analysis(t: Tables) -> DataFrame:
    """Month over month growth per location and property; gap months give nulls."""
    base = t["vw_market_trend_monthly_base"]
    current = base.filter(F.col("listing_count") > 0).withColumn(
        "prev_month_key", dates.previous_month_number(F.col("year_value"), F.col("month_value"))
    )
    measures = {c: f"prev_{c}" for c in ("listing_count", "unique_seller_count", "price_per_m2_avg")}
    keys = ["location_key", "property_key"]
    earlier = base.select(*keys, F.col("month_key").alias("prev_month_key"), *[F.col(c).alias(n) for c, n in measures.items()])
    joined = current.join(earlier, [*keys, "prev_month_key"], "left").drop("prev_month_key")
    return joined.withColumns(_month_changes({"listing_count": "listing", "unique_seller_count": "seller", "price_per_m2_avg": "price_per_m2"}))


def _month_changes(stems: Mapping[str, str]) -> dict[str, Column]:
    changes = {}
    for column, stem in stems.items():
        now, before = F.col(column), F.col(f"prev_{column}")
        changes[f"{stem}_change"] = now - before
        changes[f"{stem}_growth_rate"] = scores.growth(now, before)
    return changes


def metro_impact(t: Tables) -> DataFrame:
    """Supply and prices by proximity class, area, ward and station."""
    kinds = {"apt_count": vocab.APARTMENT, "house_count": vocab.HOUSE, "land_count": vocab.LAND}
    category = F.col("category_name")
    counts = groups.conditional_counts(
        {
            **{n: category == v for n, v in kinds.items()},
            "other_property_count": quality.not_in_or_null(category, list(kinds.values())),
        }
    )
    near = t["fact_metro_analysis"].filter(F.col("metro_proximity_category").isNotNull())
    grouped = near.groupBy("metro_proximity_category", "area_name", "ward_name", "station_id").agg(
        F.min(F.col("distance_to_metro_m").cast("double")).alias("nearest_metro_distance_m"),
        F.count("*").alias("row_count"),
        F.count_distinct("list_id").alias("listing_count"),
        *_means({"price_avg": "price", "price_per_m2_avg": "price_per_m2", "size_avg": "size"}),
        *counts,
    )
    stations = t["dim_metro_station"].groupBy("station_id").agg(F.max("station_name").alias("station_name"))
    group = scores.first_true(
        {
            vocab.METRO_NEAR: F.col("metro_proximity_category") == vocab.METRO_LABELS[1],
            vocab.METRO_NOT_NEAR: F.col("metro_proximity_category") == vocab.NO_METRO,
        },
        vocab.METRO_OTHER,
    )
    return grouped.join(stations, "station_id", "left").withColumn("metro_group", group)


def metro_impact_detail(t: Tables) -> DataFrame:
    """Metro impact with type ratios and the dominant type."""
    base = t["vw_metro_impact_analysis"].filter(F.col("listing_count") > 0)
    ratios = {**_TYPE_RATIOS, "other_property_ratio": "other_property_count"}
    dominant = scores.dominant(_type_counts(vocab.TYPE_OTHER, "other_property_count"), vocab.TYPE_OTHER)
    return base.withColumns(_ratios(ratios)).withColumn("dominant_property_type", dominant)


_AREA_FLAGS = {
    **_TYPE_FLAGS,
    "good_quality_count": "good_quality",
    "risk_quality_count": "risk_quality",
    "low_quality_count": "low_quality",
    "fully_legal_count": "fully_legal",
    "risk_legal_count": "risk_legal",
    "company_seller_count": "is_company_ad",
}
_SCORE_MEANS = {
    "quality_score_avg": "quality_score",
    "market_saturation_score_avg": "market_saturation_score",
    "seller_credibility_score_avg": "seller_credibility_score",
}


def area_market_base(t: Tables) -> DataFrame:
    """Supply, prices, scores and counts per location."""
    placed = t["fact_properties"].filter(F.col("location_key").isNotNull())
    grouped = placed.groupBy("location_key").agg(
        F.count("*").alias("row_count"), *_supply(), *_means(_SCORE_MEANS), *_flag_counts(_AREA_FLAGS), _unknown_type()
    )
    names = t["dim_location"].select("location_key", "area_name", "ward_name", "street_name", "location_tier")
    return grouped.join(names, "location_key", "left")


def area_market_analysis(t: Tables) -> DataFrame:
    """Location report with ratios and the dominant type."""
    base = t["vw_area_market_analysis_base"].filter(F.col("listing_count") > 0)
    ratios = {
        **_TYPE_RATIOS,
        "unknown_property_ratio": "unknown_property_count",
        "good_quality_ratio": "good_quality_count",
        "risk_quality_ratio": "risk_quality_count",
        "low_quality_ratio": "low_quality_count",
        "fully_legal_ratio": "fully_legal_count",
        "risk_legal_ratio": "risk_legal_count",
        "company_seller_ratio": "company_seller_count",
    }
    return base.withColumns(_ratios(ratios)).withColumns(_dominant_columns())


def hotspot_monthly_base(t: Tables) -> DataFrame:
    """Monthly location and type aggregates that feed the hotspot scores."""
    kind = scores.first_true(
        {
            vocab.TYPE_APARTMENT: F.col("is_apt") == 1,
            vocab.TYPE_HOUSE: F.col("is_house") == 1,
            vocab.TYPE_LAND: F.col("is_land") == 1,
        },
        vocab.TYPE_UNKNOWN,
    )
    priced = t["fact_properties"].filter(F.col("location_key").isNotNull() & F.col("price_per_m2").isNotNull())
    flags = {
        **_TYPE_FLAGS,
        "listings_with_images_count": "has_images",
        "listings_with_multiple_images_count": "has_multiple_images",
        "fully_legal_count": "fully_legal",
        "risk_legal_count": "risk_legal",
        "good_quality_count": "good_quality",
        "risk_quality_count": "risk_quality",
        "company_seller_listing_count": "is_company_ad",
    }
    means = {
        **_SCORE_MEANS,
        "area_popularity_avg": "area_popularity",
        "number_of_images_avg": "number_of_images",
        "listing_age_days_avg": "listing_age_days",
    }
    monthly = (
        priced.join(_calendar(t), "time_key")
        .groupBy("year_value", "month_value", "location_key", kind.alias("property_type"))
        .agg(
            *_supply(),
            F.min("price_per_m2").alias("price_per_m2_min"),
            F.max("price_per_m2").alias("price_per_m2_max"),
            *_flag_counts(flags),
            *_means(means),
        )
    )
    places = t["dim_location"].filter(F.col("area_name").isNotNull())
    places = places.select("location_key", "area_name", "ward_name", "street_name", "location_tier")
    year, month = F.col("year_value"), F.col("month_value")
    return monthly.join(places, "location_key").withColumns(
        {
            "month_order": dates.month_number(year, month),
            "month_key": F.format_string("%d-%02d", year, month),
        }
    )


def hotspot_analysis(t: Tables) -> DataFrame:
    """Hotspot score, level and indicators per month, location and type."""
    base = t["vw_hotspot_monthly_base"]
    current = base.withColumn("prev_month_order", dates.previous_month_number(F.col("year_value"), F.col("month_value")))
    keys = ["location_key", "property_type"]
    measures = ("listing_count", "unique_seller_count", "price_per_m2_avg")
    earlier = base.select(
        *keys, F.col("month_order").alias("prev_month_order"), *[F.col(c).alias(f"prev_{c}") for c in measures]
    )
    joined = current.filter(F.col("listing_count") >= 3).join(earlier, [*keys, "prev_month_order"], "left")
    stems = {"listing_count": "listing", "unique_seller_count": "unique_seller", "price_per_m2_avg": "price_per_m2"}
    grown = joined.withColumns(_month_changes(stems))
    ratios = {
        **_TYPE_RATIOS,
        "fully_legal_ratio": "fully_legal_count",
        "risk_legal_ratio": "risk_legal_count",
        "good_quality_ratio": "good_quality_count",
        "risk_quality_ratio": "risk_quality_count",
        "company_seller_ratio": "company_seller_listing_count",
    }
    top = scores.largest(_type_counts(), F.lit(None))
    scored = grown.withColumns(_ratios(ratios)).withColumns(
        {
            "dominant_property_type": scores.dominant(_type_counts(), vocab.TYPE_UNKNOWN),
            "dominant_property_ratio": scores.safe_ratio(top, F.col("listing_count")),
            "supply_price_trend_type": _trend_type("listing_change", "price_per_m2_change"),
            **hotspot_step_scores(),
        }
    )
    scored = scored.withColumn("hotspot_score", hotspot_score())
    hidden = (
        "prev_month_order", "listings_with_images_count", "listings_with_multiple_images_count", "fully_legal_count",
        "risk_legal_count", "good_quality_count", "risk_quality_count", "company_seller_listing_count",
    )
    return scored.withColumns(hotspot_levels()).drop(*hidden)


def hotspot_step_scores() -> dict[str, Column]:
    positive = vocab.POSITIVE_SCORE
    return {
        "listing_volume_score": scores.step_score(F.col("listing_count"), vocab.VOLUME_STEPS),
        "listing_growth_score": scores.step_score(F.col("listing_growth_rate"), vocab.LISTING_GROWTH_STEPS, positive),
        "price_growth_score": scores.step_score(F.col("price_per_m2_growth_rate"), vocab.PRICE_GROWTH_STEPS, positive),
        "seller_score": scores.step_score(F.col("unique_seller_count"), vocab.SELLER_STEPS),
        "quality_score_norm": scores.step_score(F.col("quality_score_avg"), vocab.QUALITY_STEPS, positive),
    }


def hotspot_score() -> Column:
    terms = [F.col(c) * w for c, w in vocab.HOTSPOT_WEIGHTS.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def hotspot_levels() -> dict[str, Column]:
    """Level and 0/1 indicators; comparisons with null count as false."""
    supply_up = F.col("listing_growth_rate") > 0
    price_up = F.col("price_per_m2_growth_rate") > 0
    many, some = F.col("listing_count") >= 5, F.col("listing_count") >= 3
    level = {
        "High": (F.col("hotspot_score") >= 0.75) & many & supply_up & price_up,
        "Medium": (F.col("hotspot_score") >= 0.50) & some,
    }
    return {
        "hotspot_level": scores.first_true(level, "Low"),
        "is_supply_and_price_increase": scores.flag(supply_up & price_up),
        "is_potential_hotspot": scores.flag(many & supply_up & price_up & (F.col("unique_seller_count") >= 3)),
        "has_high_listing_volume": scores.flag(many),
        "has_listing_growth": scores.flag(supply_up),
        "has_price_growth": scores.flag(price_up),
        "has_seller_growth": scores.flag(F.col("unique_seller_growth_rate") > 0),
    }


#: Views in dependency order: a view may read the gold tables and earlier views.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_market_overview_daily": market_overview_daily,
    "vw_market_overview_daily_analysis": market_overview_daily_analysis,
    "vw_market_trend_analysis_base": market_trend_base,
    "vw_market_trend_analysis": market_trend_analysis,
    "vw_market_trend_monthly_base": market_trend_monthly_base,
    "vw_market_trend_monthly_analysis": market_trend_monthly_analysis,
    "vw_metro_impact_analysis": metro_impact,
    "vw_metro_impact_analysis_detail": metro_impact_detail,
    "vw_area_market_analysis_base": area_market_base,
    "vw_area_market_analysis": area_market_analysis,
    "vw_hotspot_monthly_base": hotspot_monthly_base,
    "vw_hotspot_analysis": hotspot_analysis,
}


def build_views(tables: Tables) -> dict[str, DataFrame]:
    """All views over the given gold tables, by name."""
    known = dict(tables)
    for name, view in VIEWS.items():
        known[name] = view(known)
    return {name: known[name] for name in VIEWS}


def register_views(spark: SparkSession, tables: Tables) -> None:
    """Make gold tables and views available to ``spark.sql`` by name."""
    for name, frame in {**tables, **build_views(tables)}.items():
        frame.createOrReplaceTempView(name)
