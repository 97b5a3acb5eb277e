"""Row-level rules: flags, bands, scores, text, dates, filters, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.catalog import reference_sql as ref
from gable.catalog.registry import query
from gable.functions import dates, scores, text
from gable.operators import groups, joins, quality, shape
from gable.plans import gold, silver, vocab
from gable.plans.adapter import listings, stations, table, trends
from gable.plans.warehouse import warehouse

ID = ["list_id", "ad_id"]


def flagged(spark, folder):
    """Whole listings with every row-level flag."""
    return silver.classify(listings(spark, folder))


# The same flags for SQL, over all listings.
_FLAGGED = f"""(SELECT * REPLACE (coalesce(rooms, 0.0e0) AS rooms), {ref.TYPE_FLAGS}, {ref.FURNISHING_FLAGS}, {ref.TRAIT_FLAGS},
  {ref.ADVERTISER_FLAGS}, {ref.LEGAL_FLAGS} FROM listings)"""


@query("type_flags", f"SELECT list_id, ad_id, coalesce(rooms, 0.0e0) AS rooms, {ref.TYPE_FLAGS} FROM listings")
def _(spark, folder):
    rows = listings(spark, folder)
    return rows.select(*ID, F.coalesce("rooms", F.lit(0.0)).alias("rooms"), *_named(silver.type_flags(F.col("category_name"))))


def _named(columns):
    return [c.alias(n) for n, c in columns.items()]


@query("furnishing_flags", f"SELECT list_id, ad_id, {ref.FURNISHING_FLAGS} FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, *_named(silver.furnishing_flags(F.col("param_furnishing_sell"))))


@query("keyword_quality_flags", f"SELECT list_id, ad_id, {ref.TRAIT_FLAGS} FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, *_named(silver.trait_flags(F.col("param_pty_characteristics"))))


@query("advertiser_flags", f"SELECT list_id, ad_id, {ref.ADVERTISER_FLAGS} FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, *_named(silver.advertiser_flags(F.col("company_ad"))))


@query("legal_flags", f"SELECT list_id, ad_id, {ref.LEGAL_FLAGS} FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, *_named(silver.legal_flags(F.col("param_property_legal_document"))))


@query("one_hot", f"SELECT list_id, ad_id, {ref.ONE_HOT} FROM listings")
def _(spark, folder):
    coded = shape.one_hot(listings(spark, folder).select(*ID, "category_name"), "category_name", text.slug_label)
    return coded.drop("category_name")


@query("legal_risk_level", f"SELECT list_id, ad_id, {ref.LEGAL_RISK} AS legal_risk_level FROM {_FLAGGED}")
def _(spark, folder):
    return flagged(spark, folder).select(*ID, gold.legal_risk_level().alias("legal_risk_level"))


@query("quality_tier", f"SELECT list_id, ad_id, {ref.QUALITY_TIER} AS property_quality_tier FROM {_FLAGGED}")
def _(spark, folder):
    return flagged(spark, folder).select(*ID, gold.quality_tier().alias("property_quality_tier"))


@query("quality_score", f"SELECT list_id, ad_id, {ref.QUALITY_SCORE} AS quality_score FROM {_FLAGGED}")
def _(spark, folder):
    return flagged(spark, folder).select(*ID, gold.quality_score().alias("quality_score"))


@query("seller_credibility", f"SELECT list_id, ad_id, {ref.CREDIBILITY} AS seller_credibility_score FROM {_FLAGGED}")
def _(spark, folder):
    return flagged(spark, folder).select(*ID, gold.seller_credibility().alias("seller_credibility_score"))


@query(
    "seller_type",
    f"""SELECT list_id, ad_id, {ref.SELLER_TYPE} AS seller_type,
    CASE WHEN is_company_ad = 1 THEN 'Company' ELSE 'Personal' END AS seller_type_two_way FROM {_FLAGGED}""",
)
def _(spark, folder):
    two_way = scores.first_true({"Company": F.col("is_company_ad") == 1}, "Personal")
    return flagged(spark, folder).select(*ID, gold.seller_type().alias("seller_type"), two_way.alias("seller_type_two_way"))


@query(
    "image_features",
    f"""SELECT list_id, ad_id, {ref.RICHNESS} AS image_richness_score,
    CAST(CASE WHEN number_of_images > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_images,
    CAST(CASE WHEN number_of_images >= 3 THEN 1 ELSE 0 END AS INTEGER) AS has_multiple_images FROM listings""",
)
def _(spark, folder):
    images = F.col("number_of_images")
    return listings(spark, folder).select(
        *ID,
        scores.image_richness(images).alias("image_richness_score"),
        scores.flag(images > 0).alias("has_images"),
        scores.flag(images >= 3).alias("has_multiple_images"),
    )


@query("listing_age", f"SELECT list_id, ad_id, {ref.AGE} AS listing_age_days FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, F.datediff("snapshot_date", "crawled_at_ts").alias("listing_age_days"))


@query("age_bucket", f"SELECT list_id, ad_id, {ref.AGE_BUCKET} AS listing_age_bucket FROM listings")
def _(spark, folder):
    age = F.datediff("snapshot_date", "crawled_at_ts")
    bucket = scores.band(age, vocab.AGE_EDGES, vocab.AGE_LABELS, inclusive=True)
    return listings(spark, folder).select(*ID, bucket.alias("listing_age_bucket"))


@query(
    "rooms_band",
    f"""SELECT list_id, ad_id, CASE WHEN has_rooms = 0 THEN 'No_Rooms_Land' WHEN rooms IS NULL OR rooms = 0 THEN 'Unknown_Rooms'
    WHEN rooms > 0 AND rooms < 1 THEN 'Studio' WHEN rooms >= 5 THEN '5BR_Plus' WHEN rooms >= 1 THEN CAST(CAST(floor(rooms) AS INTEGER) AS VARCHAR) || 'BR'
    ELSE 'Unknown' END AS rooms_category FROM (SELECT *, {ref.TYPE_FLAGS} FROM listings)""",
)
def _(spark, folder):
    rows = listings(spark, folder).withColumns(silver.type_flags(F.col("category_name")))
    return rows.select(*ID, scores.rooms_band(F.col("rooms"), F.col("has_rooms")).alias("rooms_category"))


@query(
    "safe_ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0 THEN CAST(l_extendedprice AS DOUBLE) / l_tax END AS price_to_tax FROM lineitem""",
)
def _(spark, folder):
    ratio = scores.safe_ratio(F.col("l_extendedprice"), F.col("l_tax"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("price_to_tax"))


@query(
    "price_per_unit",
    "SELECT list_id, ad_id, CASE WHEN size > 0 AND price IS NOT NULL THEN price / size END AS price_per_m2 FROM listings",
)
def _(spark, folder):
    return listings(spark, folder).select(*ID, scores.price_per_unit(F.col("price"), F.col("size")).alias("price_per_m2"))


# Every listing against the mean position of the stations.
@query(
    "distance_m",
    f"""SELECT list_id, ad_id, {ref.DISTANCE} AS distance_m FROM listings s
    CROSS JOIN (SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM stations_raw) m""",
)
def _(spark, folder):
    centre = stations(spark, folder)
    lat = centre.agg(F.round(F.avg("latitude"), 6)).scalar()
    lon = centre.agg(F.round(F.avg("longitude"), 6)).scalar()
    here = scores.distance_m(F.col("latitude"), F.col("longitude"), lat, lon)
    return listings(spark, folder).select(*ID, here.alias("distance_m"))


@query(
    "proximity_class",
    f"""SELECT list_id, ad_id, {ref.PROXIMITY} AS metro_proximity_category,
    CASE {ref.PROXIMITY} WHEN 'Close_To_Metro' THEN 'Gan metro' WHEN 'No_Metro_In_Ward' THEN 'Khong gan metro' ELSE 'Khac' END AS metro_group
    FROM (SELECT *, CASE WHEN l_partkey % 5 > 0 THEN l_extendedprice / 20 END AS distance_to_metro_m, l_orderkey * 10 + l_linenumber AS list_id,
      l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS ad_id FROM lineitem)""",
)
def _(spark, folder):
    line = table(spark, folder, "lineitem")
    distance = F.when(F.col("l_partkey") % 5 > 0, F.col("l_extendedprice") / 20)
    kind = gold.proximity_class(distance)
    group = {vocab.METRO_NEAR: kind == vocab.METRO_LABELS[1], vocab.METRO_NOT_NEAR: kind == vocab.NO_METRO}
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("list_id"),
        (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("ad_id"),
        kind.alias("metro_proximity_category"),
        scores.first_true(group, vocab.METRO_OTHER).alias("metro_group"),
    )


# Step scores and labels over per-part aggregates of the whole line table.
_PARTS = """(SELECT l_partkey, CAST(count(*) AS BIGINT) AS listing_count, CAST(count(DISTINCT l_suppkey) AS BIGINT) AS unique_seller_count,
  (sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) - sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)) / CAST(count(*) AS DOUBLE) AS listing_growth_rate,
  (sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) - sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)) / CAST(count(*) AS DOUBLE) AS price_per_m2_growth_rate,
  sum(CASE WHEN l_linestatus = 'F' THEN 100 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS quality_score_avg
  FROM lineitem GROUP BY 1)"""


def _parts(spark, folder):
    def share(positive, negative):
        return (F.count_if(positive) - F.count_if(negative)) / F.count("*").cast("double")

    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("listing_count"),
        F.count_distinct("l_suppkey").alias("unique_seller_count"),
        share(flag == "A", flag == "N").alias("listing_growth_rate"),
        share(status == "F", status == "O").alias("price_per_m2_growth_rate"),
        (F.count_if(status == "F") * 100 / F.count("*").cast("double")).alias("quality_score_avg"),
    )


@query("step_scores", f"SELECT l_partkey, {ref.STEP_SCORES} FROM {_PARTS}")
def _(spark, folder):
    from gable.plans.views import hotspot_step_scores

    return _parts(spark, folder).select("l_partkey", *_named(hotspot_step_scores()))


@query(
    "hotspot_scores",
    f"""SELECT l_partkey, hotspot_score,
    CASE WHEN hotspot_score >= 0.75e0 AND listing_count >= 5 AND listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 THEN 'High'
      WHEN hotspot_score >= 0.50e0 AND listing_count >= 3 THEN 'Medium' ELSE 'Low' END AS hotspot_level,
    CAST(CASE WHEN listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 THEN 1 ELSE 0 END AS INTEGER) AS is_supply_and_price_increase,
    CAST(CASE WHEN listing_count >= 5 AND listing_growth_rate > 0 AND price_per_m2_growth_rate > 0 AND unique_seller_count >= 3 THEN 1 ELSE 0 END AS INTEGER) AS is_potential_hotspot
    FROM (SELECT *, listing_volume_score * 0.25e0 + listing_growth_score * 0.25e0 + price_growth_score * 0.20e0 + seller_score * 0.20e0 + quality_score_norm * 0.10e0 AS hotspot_score
      FROM (SELECT *, {ref.STEP_SCORES} FROM {_PARTS}))""",
)
def _(spark, folder):
    from gable.plans import views

    scored = _parts(spark, folder).withColumns(views.hotspot_step_scores()).withColumn("hotspot_score", views.hotspot_score())
    scored = scored.withColumn("unique_seller_growth_rate", F.lit(None).cast("double")).withColumns(views.hotspot_levels())
    return scored.select("l_partkey", "hotspot_score", "hotspot_level", "is_supply_and_price_increase", "is_potential_hotspot")


@query(
    "supply_price_trend",
    f"SELECT l_partkey, {ref.TREND_TYPE.format(a='listing_growth_rate', b='price_per_m2_growth_rate')} AS supply_price_trend_type FROM {_PARTS}",
)
def _(spark, folder):
    label = scores.sign_pair_label(
        F.col("listing_growth_rate"), F.col("price_per_m2_growth_rate"), vocab.TRENDS, vocab.TREND_UNCLEAR
    )
    return _parts(spark, folder).select("l_partkey", label.alias("supply_price_trend_type"))


_FLAG_COUNTS = """(SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS apt_count,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS house_count, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS land_count
  FROM lineitem GROUP BY 1)"""


def _flag_counts(spark, folder):
    counts = {"apt_count": "A", "house_count": "N", "land_count": "R"}
    conditions = {n: F.col("l_returnflag") == v for n, v in counts.items()}
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(*groups.conditional_counts(conditions))


@query(
    "dominant_category",
    f"""SELECT l_suppkey, apt_count, house_count, land_count, CASE WHEN apt_count >= house_count AND apt_count >= land_count THEN 'Can ho / Chung cu'
    WHEN house_count >= apt_count AND house_count >= land_count THEN 'Nha o' WHEN land_count >= apt_count AND land_count >= house_count THEN 'Dat'
    ELSE 'Khong xac dinh' END AS dominant_property_type,
    greatest(apt_count, house_count, land_count) / CAST(apt_count + house_count + land_count AS DOUBLE) AS dominant_property_ratio FROM {_FLAG_COUNTS}""",
)
def _(spark, folder):
    counts = dict(zip((vocab.TYPE_APARTMENT, vocab.TYPE_HOUSE, vocab.TYPE_LAND), map(F.col, ("apt_count", "house_count", "land_count"))))
    whole = F.col("apt_count") + F.col("house_count") + F.col("land_count")
    return _flag_counts(spark, folder).withColumns(
        {
            "dominant_property_type": scores.dominant(counts, vocab.TYPE_UNKNOWN),
            "dominant_property_ratio": scores.safe_ratio(scores.largest(counts, F.lit(None)), whole),
        }
    )


_MONTH_FLAGS = """(SELECT l_suppkey, CAST(year(CAST(l_shipdate AS DATE)) * 100 + month(CAST(l_shipdate AS DATE)) AS INTEGER) AS month_key,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS apt_count, CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS house_count,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS land_count FROM lineitem GROUP BY 1, 2)"""


@query(
    "fastest_growing",
    f"""SELECT l_suppkey, month_key, apt_change, house_change, land_change, CASE WHEN apt_change >= house_change AND apt_change >= land_change THEN 'Can ho / Chung cu'
    WHEN house_change >= apt_change AND house_change >= land_change THEN 'Nha o' WHEN land_change >= apt_change AND land_change >= house_change THEN 'Dat'
    ELSE 'Khong xac dinh' END AS fastest_growing_property_type, CASE WHEN apt_change IS NULL THEN 0 ELSE greatest(apt_change, house_change, land_change) END AS best_change
    FROM (SELECT l_suppkey, month_key, apt_count - lag(apt_count) OVER w AS apt_change, house_count - lag(house_count) OVER w AS house_change,
      land_count - lag(land_count) OVER w AS land_change FROM {_MONTH_FLAGS} WINDOW w AS (PARTITION BY l_suppkey ORDER BY month_key))""",
)
def _(spark, folder):
    from gable.operators.series import lag_growth

    day = F.col("l_shipdate").cast("date")
    flags = {n: F.col("l_returnflag") == v for n, v in {"apt_count": "A", "house_count": "N", "land_count": "R"}.items()}
    months = table(spark, folder, "lineitem").groupBy("l_suppkey", dates.month_number(F.year(day), F.month(day)).alias("month_key"))
    stems = {"apt_count": "apt", "house_count": "house", "land_count": "land"}
    moved = lag_growth(months.agg(*groups.conditional_counts(flags)), ["l_suppkey"], "month_key", stems, growth_for=())
    changes = dict(zip((vocab.TYPE_APARTMENT, vocab.TYPE_HOUSE, vocab.TYPE_LAND), [F.col(f"{s}_change") for s in stems.values()]))
    return moved.select(
        "l_suppkey", "month_key", "apt_change", "house_change", "land_change",
        scores.dominant(changes, vocab.TYPE_UNKNOWN).alias("fastest_growing_property_type"),
        scores.largest(changes, F.lit(0).cast("long")).alias("best_change"),
    )


@query(
    "market_saturation",
    f"SELECT area_name, category_name, {ref.SATURATION} AS market_saturation_score FROM area_stats",
)
def _(spark, folder):
    stats = warehouse(spark, folder)["silver_listings"].filter(F.col("price") > 0).groupBy("area_name", "category_name")
    stats = stats.agg(F.avg("price").alias("m"), F.stddev("price").alias("sd"), F.count("*").alias("n"))
    score = scores.saturation(F.col("n"), F.col("sd"), F.col("m"))
    return stats.select("area_name", "category_name", score.alias("market_saturation_score"))


# --- dates -----------------------------------------------------------------

@query(
    "time_keys",
    f"SELECT list_id, ad_id, {ref.DAY_KEY} AS day_key, {ref.MONTH_KEY} AS month_start_key FROM listings",
)
def _(spark, folder):
    day = F.col("snapshot_date")
    return listings(spark, folder).select(
        *ID, dates.day_key(day).alias("day_key"), dates.month_start_key(day).alias("month_start_key")
    )


@query(
    "temporal_features",
    """SELECT list_id, ad_id, CAST(month(snapshot_date) AS INTEGER) AS month_of_year, CAST(dayofweek(snapshot_date) + 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN dayofweek(snapshot_date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(CASE WHEN month(snapshot_date) IN (6, 7, 8, 11, 12) THEN 1 ELSE 0 END AS INTEGER) AS is_peak_season FROM listings""",
)
def _(spark, folder):
    day = F.col("snapshot_date")
    return listings(spark, folder).select(
        *ID, F.month(day).alias("month_of_year"), F.dayofweek(day).alias("day_of_week"),
        dates.is_weekend(day).alias("is_weekend"), dates.is_peak_season(day).alias("is_peak_season"),
    )


@query(
    "month_keys",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_key, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_order FROM orders""",
)
def _(spark, folder):
    day = F.col("o_orderdate").cast("date")
    number = dates.month_number(F.year(day), F.month(day))
    return table(spark, folder, "orders").select(
        "o_orderkey", dates.month_text(day).alias("month_key"), number.alias("month_order")
    )


@query(
    "prev_month_key",
    """SELECT o_orderkey, CAST(strftime(CAST(date_trunc('month', o_orderdate) AS DATE) - INTERVAL 1 DAY, '%Y%m') AS INTEGER) AS prev_month_order FROM orders""",
)
def _(spark, folder):
    day = F.col("o_orderdate").cast("date")
    before = dates.previous_month_number(F.year(day), F.month(day))
    return table(spark, folder, "orders").select("o_orderkey", before.alias("prev_month_order"))


@query(
    "epoch_ms_to_ts",
    "SELECT event_id, date_trunc('second', ts) AS at FROM events",
)
def _(spark, folder):
    events = table(spark, folder, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return events.select("event_id", dates.epoch_ms_to_ts(F.col("ms")).cast("timestamp_ntz").alias("at"))


@query(
    "event_date_tz",
    """SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END + INTERVAL 7 HOUR AS DATE) AS event_date FROM events""",
)
def _(spark, folder):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, 0).otherwise(ms).alias("crawled_at"),
        (ms - 3 * 86_400_000).alias("ingested_at"),
    )
    day = dates.event_date(F.col("crawled_at"), F.col("ingested_at"), zone="Asia/Ho_Chi_Minh")
    return events.select("event_id", day.alias("event_date"))


# --- text ------------------------------------------------------------------

@query(
    "slugify",
    """SELECT list_id, ad_id, trim(regexp_replace(regexp_replace(strip_accents(replace(lower(category_name), 'đ', '/')), '[^a-z0-9]+', '_', 'g'), '_+', '_', 'g'), '_') AS slug FROM listings""",
)
def _(spark, folder):
    return listings(spark, folder).select(*ID, text.slug(F.col("category_name")).alias("slug"))


@query("extract_number", f"SELECT list_id, ad_id, {ref.NUMBER} AS price_m2 FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, text.extract_number(F.col("param_price_m2")).alias("price_m2"))


@query("strip_parenthetical", f"SELECT list_id, ad_id, {ref.WARD} AS ward_name FROM listings")
def _(spark, folder):
    ward = text.strip_pattern(F.col("ward_name"), vocab.OLD_DISTRICT_SUFFIX)
    return listings(spark, folder).select(*ID, ward.alias("ward_name"))


@query(
    "content_fingerprint",
    """SELECT list_id, ad_id, sha256(concat_ws('||', subject, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), CAST(size AS VARCHAR),
    CAST(account_id AS VARCHAR))) AS content_fp FROM listings""",
)
def _(spark, folder):
    return silver.with_fingerprint(listings(spark, folder)).select(*ID, "content_fp")


@query(
    "date_from_path",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS snapshot_date FROM orders""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    mark = F.when(F.col("o_orderkey") % 10 > 0, "date=").otherwise("day=")
    path = F.concat(F.lit("bronze/listings/"), mark, F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/part-0.jsonl"))
    return orders.select("o_orderkey", text.date_from_path(path).alias("snapshot_date"))


@query(
    "first_non_empty_id",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 > 0 THEN CAST(l_partkey % 3 AS VARCHAR) WHEN l_suppkey % 4 > 0 THEN CAST(l_suppkey AS VARCHAR)
    WHEN l_linenumber > 2 THEN CAST(l_orderkey AS VARCHAR) END AS record_id FROM lineitem WHERE TRUE""",
)
def _(spark, folder):
    line = table(spark, folder, "lineitem")
    chosen = text.first_non_empty(
        F.col("l_partkey") % 3,
        F.when(F.col("l_suppkey") % 4 > 0, F.col("l_suppkey").cast("string")).otherwise(""),
        F.when(F.col("l_linenumber") > 2, F.col("l_orderkey")),
    )
    return line.select("l_orderkey", "l_linenumber", "l_partkey", chosen.alias("record_id"))


@query(
    "bool_strings_to_int",
    "SELECT station_id, amenity_atm, amenity_elevator FROM stations",
)
def _(spark, folder):
    return stations(spark, folder).select(
        "station_id", *[text.bool_to_int(F.col(c)).alias(c) for c in ("amenity_atm", "amenity_elevator")]
    )


@query("round_measure", "SELECT list_id, ad_id, round(length, 2) AS length FROM listings")
def _(spark, folder):
    return listings(spark, folder).select(*ID, F.round("length", 2).alias("length"))


# --- filters and imputation ------------------------------------------------

@query(
    "filter_any_null",
    "SELECT list_id, ad_id, ward_name FROM listings WHERE region_name IS NOT NULL AND area_name IS NOT NULL AND street_name IS NOT NULL AND ward_name IS NOT NULL",
)
def _(spark, folder):
    return quality.drop_any_null(listings(spark, folder), silver.ADDRESS_COLUMNS).select(*ID, "ward_name")


@query(
    "filter_complete_periods",
    "SELECT event_id, event_type FROM events WHERE user_id % 3 = 0 OR user_id % 3 = 1 AND event_id % 2 = 0",
)
def _(spark, folder):
    # The flag comes as text in mixed case, and is missing for some rows.
    partial = F.when(F.col("user_id") % 3 == 0, "False").when((F.col("user_id") % 3 == 1) & (F.col("event_id") % 2 == 0), "false")
    partial = partial.when(F.col("user_id") % 3 == 1, "true")
    events = table(spark, folder, "events").withColumn("ispartial", partial)
    return quality.keep_complete(events).select("event_id", "event_type")


@query(
    "size_consistency",
    """SELECT list_id, ad_id, size, width, length FROM listings
    WHERE coalesce(CASE WHEN size > 0 THEN abs(width * length - size) / size END, 0) <= 0.10e0""",
)
def _(spark, folder):
    return quality.drop_inconsistent(listings(spark, folder)).select(*ID, "size", "width", "length")


@query("filter_positive", "SELECT list_id, ad_id, price FROM listings WHERE price > 0")
def _(spark, folder):
    return listings(spark, folder).filter(F.col("price") > 0).select(*ID, "price")


@query(
    "not_in_or_null",
    """SELECT list_id, ad_id, param_furnishing_sell FROM listings WHERE param_furnishing_sell NOT IN ('Nội thất đầy đủ') OR param_furnishing_sell IS NULL""",
)
def _(spark, folder):
    rows = listings(spark, folder)
    return rows.filter(quality.not_in_or_null(F.col("param_furnishing_sell"), ["Nội thất đầy đủ"])).select(*ID, "param_furnishing_sell")


@query(
    "impute_median",
    """SELECT list_id, ad_id, coalesce(number_of_images, (SELECT quantile_disc(number_of_images, 0.5) FROM listings)) AS number_of_images FROM listings""",
)
def _(spark, folder):
    rows = listings(spark, folder).select(*ID, "number_of_images")
    return quality.impute_median(rows, "number_of_images")


_LABELS = f"(SELECT DISTINCT ward_name AS label FROM listings WHERE ward_name IS NOT NULL)"


@query("label_map", f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM {_LABELS}")
def _(spark, folder):
    return quality.label_map(listings(spark, folder), "ward_name")


@query(
    "label_encode_shared",
    f"""SELECT 'listing' AS kind, ad_id AS id, coalesce(code, -1) AS ward_name_encoded FROM listings LEFT JOIN
      (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM {_LABELS}) m ON m.label = ward_name
    UNION ALL SELECT 'station', station_id, coalesce(code, -1) FROM stations_raw LEFT JOIN
      (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM {_LABELS}) m ON m.label = ward_name""",
)
def _(spark, folder):
    from gable.runtime import stage

    rows, points = listings(spark, folder), stations(spark, folder)
    codes = stage(quality.label_map(rows, "ward_name"), "codes")
    left = rows.select(F.lit("listing").alias("kind"), F.col("ad_id").alias("id"), "ward_name")
    right = points.select(F.lit("station").alias("kind"), F.col("station_id").alias("id"), "ward_name")
    coded = [joins.encode_labels(d, "ward_name", codes, "ward_name_encoded").drop("ward_name") for d in (left, right)]
    return coded[0].unionByName(coded[1])


# --- schema shaping --------------------------------------------------------

@query("ensure_columns", "SELECT p_partkey, p_name, CAST(NULL AS DOUBLE) AS width, CAST(NULL AS VARCHAR) AS note FROM part")
def _(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return shape.ensure_columns(part, {"p_name": "string", "width": "double", "note": "string"})


@query("with_defaults", "SELECT date, keyword_group, 'VN' AS geo, 'Vietnam' AS target_region FROM trends")
def _(spark, folder):
    rows = trends(spark, folder).select("date", "keyword_group")
    return shape.with_defaults(rows, {"geo": "VN", "target_region": "Vietnam", "keyword_group": "unused"})


@query(
    "coalesce_columns",
    "SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN epoch_us(ts) // 1000 END, user_id) AS crawled_at_unix FROM events",
)
def _(spark, folder):
    ms = F.when(F.col("event_id") % 3 > 0, F.unix_millis(F.col("ts").cast("timestamp")))
    events = table(spark, folder, "events").select("event_id", ms.alias("crawled_at"), "user_id")
    return shape.coalesce_columns(events, "crawled_at_unix", ["crawled_at", "absent", "user_id"]).select("event_id", "crawled_at_unix")


@query(
    "normalize_names",
    'SELECT date, keyword_group, bat_dong_san AS "bat_ong_san", mua_nha, can_ho AS "canho", 1 AS "_source" FROM trends',
)
def _(spark, folder):
    raw = trends(spark, folder).select(
        F.col("date").alias("Date"), "keyword_group", F.col("bat_dong_san").alias("Bất_x20động_x20sản"),
        F.col("mua_nha").alias("muax20nhà"), F.col("can_ho").alias("căn hộ"), F.lit(1).alias("_source"),
    )
    return shape.normalize_names(raw, text.slug_name)


@query(
    "conform_legacy_names",
    "SELECT date, keyword_group, bat_dong_san, mua_nha, can_ho FROM trends",
)
def _(spark, folder):
    raw = trends(spark, folder).select(
        "date", "keyword_group", "bat_dong_san", F.col("chung_cu").alias("batongsan"),
        F.col("mua_nha").alias("muanhatphcm"), F.col("can_ho").alias("can_ho_tp_hcm"),
    )
    return shape.conform_names(raw, vocab.LEGACY_KEYWORD_COLUMNS)


@query(
    "cast_columns",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) END AS date,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS DOUBLE) END AS volume FROM orders""",
)
def _(spark, folder):
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon").alias("date"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey").cast("string")).otherwise("n/a").alias("volume"),
    )
    return shape.cast_columns(raw, {"date": "date", "volume": "double", "absent": "int"})


@query("project_existing", "SELECT p_name, p_partkey, CAST(p_size AS INTEGER) AS cat_size FROM part")
def _(spark, folder):
    part = table(spark, folder, "part").withColumnRenamed("p_size", "cat_size")
    return shape.project_existing(part, ["p_name", "absent", "p_partkey"], ["cat_"])


@query("drop_null_typed", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).alias("never_seen"))
    return shape.drop_null_typed(orders)


@query(
    "sanitize_floats",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > 1 THEN l_extendedprice END AS price,
    CASE WHEN l_linenumber > 2 THEN l_tax END AS nested_tax, CASE WHEN l_linenumber > 3 THEN l_discount END AS first_item FROM lineitem""",
)
def _(spark, folder):
    number = F.col("l_linenumber")
    broken = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(number == 1, float("nan")).otherwise(F.col("l_extendedprice")).alias("price"),
        F.struct(F.when(number <= 2, float("inf")).otherwise(F.col("l_tax")).alias("tax")).alias("nested"),
        F.array(F.when(number <= 3, float("-inf")).otherwise(F.col("l_discount"))).alias("items"),
    )
    clean = shape.sanitize_floats(broken)
    return clean.select(
        "l_orderkey", "l_linenumber", "l_partkey", "price", F.col("nested.tax").alias("nested_tax"), F.col("items")[0].alias("first_item")
    )


@query(
    "unpivot_series",
    "SELECT date, category_name, search_volume FROM volumes",
)
def _(spark, folder):
    return gold.search_volumes(trends(spark, folder))


@query(
    "pivot_series",
    """SELECT CAST(ts AS DATE) AS day, CAST(sum(CASE WHEN event_type = 'view' THEN 1 END) AS BIGINT) AS "view",
    CAST(sum(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS click, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS purchase,
    CAST(sum(CASE WHEN event_type = 'signup' THEN 1 END) AS BIGINT) AS signup, CAST(sum(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS error
    FROM events GROUP BY 1""",
)
def _(spark, folder):
    events = table(spark, folder, "events").select(F.col("ts").cast("date").alias("day"), "event_type")
    return shape.pivot_measures(events, ["day"], "event_type", ["view", "click", "purchase", "signup", "error"], F.count(F.lit(1)))


@query(
    "union_by_name",
    """SELECT CAST(ts AS DATE) AS day, user_id, CAST(NULL AS VARCHAR) AS event_type, 'a' AS part FROM events WHERE event_type = 'view'
    UNION ALL SELECT CAST(ts AS DATE), user_id, event_type, 'b' FROM events WHERE event_type <> 'view'""",
)
def _(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    views = events.filter("event_type = 'view'").select("day", "user_id", F.lit("a").alias("part"))
    rest = events.filter("event_type <> 'view'").select("user_id", "event_type", F.lit("b").alias("part"), "day")
    return shape.union_by_name(views, rest)


@query(
    "widen_map",
    """SELECT event_id, CAST(user_id AS DOUBLE) AS bat_dong_san, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) END AS mua_nha, CAST(NULL AS DOUBLE) AS can_ho,
    CAST(NULL AS DOUBLE) AS chung_cu, CAST(NULL AS DOUBLE) AS dat_nen FROM events""",
)
def _(spark, folder):
    packed = F.map_from_arrays(
        F.when(F.col("event_id") % 2 == 0, F.array(F.lit("bất động sản"), F.lit("mua nhà"))).otherwise(F.array(F.lit("bất động sản"))),
        F.when(F.col("event_id") % 2 == 0, F.array("user_id", "event_id")).otherwise(F.array("user_id")),
    )
    return shape.widen_map(table(spark, folder, "events").select("event_id", packed.alias("values")), "values", vocab.KEYWORDS)


@query(
    "pack_values_map",
    """SELECT date, keyword_group, FALSE AS is_partial, CAST(bat_dong_san AS INTEGER) AS v_all, CAST(coalesce(CASE WHEN mua_nha % 2 = 0 THEN mua_nha END, 0) AS INTEGER) AS v_buy, 2 AS entries FROM trends""",
)
def _(spark, folder):
    rows = trends(spark, folder)
    values = shape.pack_map({"bất động sản": F.col("bat_dong_san"), "mua nhà": F.when(F.col("mua_nha") % 2 == 0, F.col("mua_nha"))})
    records = rows.select("date", "keyword_group", values.alias("values"), F.coalesce(F.lit(None).cast("boolean"), F.lit(False)).alias("is_partial"))
    return records.select(
        "date", "keyword_group", "is_partial", F.col("values")["bất động sản"].alias("v_all"),
        F.col("values")["mua nhà"].alias("v_buy"), F.size("values").alias("entries"),
    )
