"""Silver to gold: dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gable.functions import dates, scores
from gable.operators import dedup, groups, joins, ordered, series, shape
from gable.plans import vocab
from gable.runtime import attach, stage, zip_groups

# Natural keys of the location and property dimensions.
LOCATION_NATURAL = ["area_name", "ward_name", "street_name", "latitude", "longitude"]
PROPERTY_NATURAL = ["category_name", "is_land", "is_apt", "is_house", "rooms", "has_rooms"]
#: Listing identity, unique per row; spreads hot keys in salted joins.
LISTING_ID = ["ad_id", "list_id", "snapshot_date"]

# Column order of the gold tables.
FACT_COLUMNS = [
    "location_key", "time_key", "property_key", "seller_key", "ad_id", "list_id", "account_id",
    "price", "price_per_m2", "price_z_score", "price_percentile_in_area", "size",
    "quality_score", "legal_risk_level", "property_quality_tier",
    "number_of_images", "image_richness_score", "has_images", "has_multiple_images",
    "listing_age_days", "listing_age_bucket",
    "location_tier", "area_popularity", "market_saturation_score",
    "seller_type", "seller_credibility_score",
    "month_of_year", "day_of_week", "is_weekend", "is_peak_season",
    "rooms", "is_company_ad", "is_furnishing", "is_not_furnishing", "fully_legal", "semi_legal", "risk_legal",
    "good_quality", "low_quality", "risk_quality", "is_land", "is_apt", "is_house", "category_name",
    "snapshot_date", "crawled_at_ts", "_ingest_ts",
]
METRO_FACT_COLUMNS = [
    "location_key", "property_key", "time_key", "station_key", "ad_id", "list_id", "area_name", "ward_name",
    "latitude", "longitude", "price", "price_per_m2", "size", "category_name", "rooms", "is_company_ad",
    "station_id", "distance_to_metro_m", "metro_proximity_category", "snapshot_date",
]
STATION_DIM_COLUMNS = [
    "station_id", "station_code", "station_name", "station_type", "station_status", "area_name_encoded",
    "ward_name_encoded", "area_name", "ward_name", "latitude", "longitude",
]


def date_spine(spark: SparkSession, start: str | Column, end: str | Column, source: DataFrame | None = None) -> DataFrame:
    """One row per day. ``source`` may be a one-row frame the bounds refer to."""
    low = F.lit(start).cast("date") if isinstance(start, str) else start
    high = F.lit(end).cast("date") if isinstance(end, str) else end
    return (source if source is not None else spark.range(1)).select(F.explode(F.sequence(low, high)).alias("date"))


def dim_time(spark: SparkSession, start: str = vocab.CALENDAR_START, end: str = vocab.CALENDAR_END) -> DataFrame:
    days = date_spine(spark, start, end)
    return days.select(*[c.alias(n) for n, c in dates.calendar_columns(F.col("date")).items()])


def dim_location(silver: DataFrame, *, exact: bool = True) -> DataFrame:
    """Distinct places in name order; the tier comes from the area's average price."""
    codes = [c for c in ("area_name_encoded", "ward_name_encoded") if c in silver.columns]
    natural = groups.distinct_dim(silver, LOCATION_NATURAL + codes, "area_name")
    keyed = ordered.number_rows(natural, LOCATION_NATURAL, "location_key")
    tiers = groups.tier_vs_median(silver, "area_name", "price", "location_tier", exact=exact)
    return attach(keyed, tiers, ["area_name"]).fillna("Unknown", ["location_tier"])


def dim_property(silver: DataFrame) -> DataFrame:
    keyed = ordered.dense_key(silver.filter(F.col("category_name").isNotNull()), PROPERTY_NATURAL, "property_key")
    return keyed.withColumn("rooms_category", scores.rooms_band(F.col("rooms"), F.col("has_rooms")))


def dim_seller(silver: DataFrame, *, exact: bool = True) -> DataFrame:
    """One row per account with its newest attributes and a volume tier."""
    newest = [F.col("snapshot_date").desc_nulls_last(), F.col("ad_id").desc(), F.col("list_id").desc()]
    known = silver.filter(F.col("account_id").isNotNull())
    columns = ["account_id", "account_name", "is_company_ad", "is_personal_ad"]
    latest = dedup.latest_by(known.select(*columns, "snapshot_date", "ad_id", "list_id"), ["account_id"], newest)
    keyed = ordered.number_rows(latest.select(*columns), ["account_id"], "seller_key")
    tiers = groups.volume_tier(silver, "account_id", "seller_tier", exact=exact).drop("listing_count")
    return attach(keyed, tiers, ["account_id"]).fillna("Unknown", ["seller_tier"])


def dim_station(stations: DataFrame) -> DataFrame:
    rows = shape.project_existing(stations.filter(F.col("station_id").isNotNull()), STATION_DIM_COLUMNS).distinct()
    return ordered.number_rows(rows, ["station_id"], "station_key")


def dim_search_category(spark: SparkSession) -> DataFrame:
    schema = "category_key long, category_name string, category_description string"
    return spark.createDataFrame(vocab.SEARCH_CATEGORIES, schema)


def quality_score() -> Column:
    """0..100 from legal state, traits, images and furnishing (fixed values)."""
    weights = {"fully_legal": 35, "semi_legal": 15, "good_quality": 30, "is_furnishing": 5}
    return scores.weighted_flags(weights, scores.image_points(F.col("number_of_images"), 15, 5))


def seller_credibility() -> Column:
    """0..100 from seller kind, traits, legal state and images (fixed values)."""
    weights = {"is_company_ad": 30, "good_quality": 25, "fully_legal": 25}
    return scores.weighted_flags(weights, scores.image_points(F.col("number_of_images"), 20, 10))


def legal_risk_level() -> Column:
    cases = {"Low": F.col("fully_legal") == 1, "Medium": F.col("semi_legal") == 1, "High": F.col("risk_legal") == 1}
    return scores.first_true(cases, "Unknown")


def quality_tier() -> Column:
    cases = {"Good": F.col("good_quality") == 1, "Neutral": F.col("low_quality") == 1, "Risk": F.col("risk_quality") == 1}
    return scores.first_true(cases, "Unknown")


def seller_type() -> Column:
    cases = {"Company": F.col("is_company_ad") == 1, "Personal": F.col("is_personal_ad") == 1}
    return scores.first_true(cases, "Unknown")


def listing_features() -> dict[str, Column]:
    """Features that need only the listing's own row."""
    snapshot, images = F.col("snapshot_date"), F.col("number_of_images")
    age = F.datediff(snapshot, F.col("crawled_at_ts"))
    return {
        "price_per_m2": scores.price_per_unit(F.col("price"), F.col("size")),
        "quality_score": quality_score(),
        "legal_risk_level": legal_risk_level(),
        "property_quality_tier": quality_tier(),
        "image_richness_score": scores.image_richness(images),
        "has_images": scores.flag(images > 0),
        "has_multiple_images": scores.flag(images >= 3),
        "listing_age_days": age,
        "listing_age_bucket": scores.band(age, vocab.AGE_EDGES, vocab.AGE_LABELS, inclusive=True),
        "seller_type": seller_type(),
        "seller_credibility_score": seller_credibility(),
        "month_of_year": F.month(snapshot),
        "day_of_week": F.dayofweek(snapshot),
        "is_weekend": dates.is_weekend(snapshot),
        "is_peak_season": dates.is_peak_season(snapshot),
        "time_key": dates.day_key(snapshot),
    }


def fact_properties(
    silver: DataFrame, locations: DataFrame, properties: DataFrame, sellers: DataFrame, *, exact: bool = True
) -> DataFrame:
    """Listing-grain fact with engineered features and dimension keys."""
    market = ["area_name", "category_name"]
    stats = groups.price_stats(silver, market, "price", "area_price_", exact=exact)
    stats = stage(stats.withColumnRenamed("listing_count", "area_popularity"), "area-stats")
    # The middle of the area averages is taken over listings, so weight the
    # few averages by their listings rather than sorting the listings.
    weights = silver.groupBy(*market).agg(F.count("*").alias("__rows"))
    averages = weights.join(stats.select(*market, "area_price_avg"), market)
    averages = averages.groupBy("area_price_avg").agg(F.sum("__rows").alias("__rows"))
    ranked = ordered.running_sum(averages, [], ["area_price_avg"], "__rows", "__upto", total="__all")
    half = F.col("__upto") >= F.col("__all") * 0.5
    middle = F.coalesce(ranked.agg(F.min(F.when(half, F.col("area_price_avg")))).scalar(), F.lit(0.0))

    featured = silver.withColumns(listing_features())
    featured = attach(featured, stats, market, staged=True, spread_by=LISTING_ID)
    average, deviation = F.col("area_price_avg"), F.col("area_price_std")
    featured = featured.withColumns(
        {
            "price_z_score": scores.zscore(F.col("price"), average, deviation),
            "location_tier": F.when(average.isNull(), "Unknown").otherwise(scores.tier(average, middle)),
            "market_saturation_score": scores.saturation(F.col("area_popularity"), deviation, average),
        }
    )
    ranks = price_ranks(silver)
    featured = attach(featured, ranks, [*market, "price"], null_safe=True, spread_by=LISTING_ID)
    keyed = joins.lookup_key(featured, locations, LOCATION_NATURAL, "location_key", spread_by=LISTING_ID)
    keyed = joins.lookup_key(keyed, properties, PROPERTY_NATURAL, "property_key", spread_by=LISTING_ID)
    keyed = joins.lookup_key(keyed, sellers, ["account_id"], "seller_key", spread_by=LISTING_ID)
    return shape.project_existing(keyed, FACT_COLUMNS)


def price_ranks(silver: DataFrame) -> DataFrame:
    """Percentile of every distinct (area, category, price)."""
    prices = silver.groupBy("area_name", "category_name", "price").agg(F.count("*").alias("__rows"))
    return ordered.rank_share(prices, ["area_name", "category_name"], "price", "__rows", "price_percentile_in_area")


def fact_price_area_time(silver: DataFrame, locations: DataFrame, properties: DataFrame, *, exact: bool = True) -> DataFrame:
    """Prices per area, category and month; keys are the first of the coarser grain."""
    monthly = silver.withColumn("time_key", dates.month_start_key(F.col("snapshot_date")))
    fact = groups.price_stats(monthly, ["area_name", "category_name", "time_key"], "price", "price_", exact=exact, digits=0)
    fact = conform_key(fact, locations, "area_name", "location_key")
    fact = conform_key(fact, properties, "category_name", "property_key")
    return fact.select(
        "location_key", "property_key", "time_key", "area_name", "category_name",
        "price_avg", "price_median", "price_min", "price_max", "listing_count", "price_std",
    )


def conform_key(fact: DataFrame, dim: DataFrame, grain: str, key: str) -> DataFrame:
    """Lowest dimension key per value of ``grain``, so the fact keeps its row count."""
    return attach(fact, dim.groupBy(grain).agg(F.min(key).alias(key)), [grain])


def fact_seller_time(silver: DataFrame, sellers: DataFrame, *, exact: bool = True) -> DataFrame:
    """Listings, prices and quality per seller and month."""
    known = silver.filter(F.col("account_id").isNotNull()).withColumns(
        {
            "time_key": dates.month_start_key(F.col("snapshot_date")),
            "seller_type": scores.first_true({"Company": F.col("is_company_ad") == 1}, "Personal"),
        }
    )
    grain = ["account_id", "account_name", "seller_type", "time_key"]
    counts = groups.conditional_counts(
        {"legal_listings_count": F.col("fully_legal") == 1, "quality_listings_count": F.col("good_quality") == 1}
    )
    totals = known.groupBy(*grain).agg(
        F.count("*").alias("listing_count"),
        F.round(F.avg("price"), 0).alias("price_avg"),
        F.round(F.avg("number_of_images"), 1).alias("images_avg"),
        *counts,
    )
    medians = ordered.group_quantiles(known, grain, "price", {"price_median": 0.5}, exact=exact)
    fact = zip_groups(totals, medians.withColumn("price_median", F.round("price_median", 0)), grain)
    fact = joins.lookup_key(fact, sellers, ["account_id"], "seller_key")
    return fact.select(
        "seller_key", "time_key", "account_id", "account_name", "seller_type", "listing_count",
        "price_avg", "price_median", "images_avg", "legal_listings_count", "quality_listings_count",
    )


def proximity_class(distance: Column) -> Column:
    banded = scores.band(distance, vocab.METRO_EDGES, vocab.METRO_LABELS)
    return F.when(distance.isNull(), vocab.NO_METRO).otherwise(banded)


def fact_metro_analysis(silver: DataFrame, locations: DataFrame, properties: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest station of the same ward for every priced listing with coordinates."""
    located = silver.filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("price") > 0)
    )
    near = joins.nearest(
        located, stations, ["area_name", "ward_name"], "station_id", ["station_key"],
        distance="distance_to_metro_m",
    )
    near = near.withColumns(
        {
            "metro_proximity_category": proximity_class(F.col("distance_to_metro_m")),
            "price_per_m2": F.round(scores.price_per_unit(F.col("price"), F.col("size")), 0),
            "time_key": dates.day_key(F.col("snapshot_date")),
        }
    )
    keyed = joins.lookup_key(near, locations, LOCATION_NATURAL, "location_key", spread_by=LISTING_ID)
    keyed = joins.lookup_key(keyed, properties, PROPERTY_NATURAL, "property_key", spread_by=LISTING_ID)
    return keyed.select(*METRO_FACT_COLUMNS)


def search_volumes(trends: DataFrame) -> DataFrame:
    """Daily keyword columns to (date, category, volume); a null part makes a null sum."""
    measures = {
        vocab.APARTMENT: F.col("chung_cu") + F.col("can_ho"),
        vocab.HOUSE: F.col("mua_nha"),
        vocab.LAND: F.col("dat_nen"),
        vocab.SEARCH_CATEGORIES[3][1]: F.col("bat_dong_san"),
    }
    return shape.unpivot_measures(trends, ["date"], measures, "category_name", "search_volume")


def fact_search_trends_monthly(trends: DataFrame, calendar: DataFrame, categories: DataFrame) -> DataFrame:
    """Search volume per month and category."""
    named = shape.conform_names(trends, vocab.LEGACY_KEYWORD_COLUMNS).withColumn("date", F.to_date("date"))
    volumes = search_volumes(named).withColumn("year_month", F.trunc("date", "month"))
    volume = F.col("search_volume")
    monthly = volumes.groupBy("year_month", "category_name").agg(
        F.sum(volume).alias("search_volume_sum"),
        F.round(F.avg(volume), 0).alias("search_volume_avg"),
        F.min(volume).alias("search_volume_min"),
        F.max(volume).alias("search_volume_max"),
    )
    # Both sides are bounded by definition: the months of the calendar and the
    # four search categories.
    first_days = F.broadcast(series.first_of_month(calendar))
    keyed = monthly.join(first_days, "year_month", "left")
    keyed = keyed.join(F.broadcast(categories.select("category_key", "category_name")), "category_name", "left")
    return keyed.select(
        "time_key", "category_key", "year_month", "category_name",
        "search_volume_sum", "search_volume_avg", "search_volume_min", "search_volume_max",
    )
