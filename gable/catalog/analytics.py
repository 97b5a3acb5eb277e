"""Windows, keys, aggregates and joins on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.catalog import reference_sql as ref
from gable.catalog.registry import query
from gable.functions import dates, scores
from gable.operators import dedup, groups, joins, ordered, quality, series, sketches
from gable.plans import gold, silver
from gable.plans.adapter import listings, table
from gable.plans.warehouse import warehouse
from gable.runtime import attach, scratch_path, stage, zip_groups
from gable.sources import sinks

ID = ["list_id", "ad_id"]

_NEWEST = "crawled_at_ts DESC NULLS LAST, ad_id ASC, account_id ASC, list_id ASC"


def _latest_sql(source: str, keys: str, order: str) -> str:
    return f"SELECT list_id, ad_id, account_id FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"


@query("dedup_latest_by_id", _latest_sql("listings", "list_id", "list_time DESC NULLS LAST, ad_id ASC, account_id ASC"))
def _(spark, folder):
    return silver.dedup_by_id(listings(spark, folder)).select(*ID, "account_id")


@query(
    "dedup_by_fingerprint",
    _latest_sql("listings", "subject, latitude, longitude, size, account_id", _NEWEST),
)
def _(spark, folder):
    return silver.dedup_by_content(silver.with_fingerprint(listings(spark, folder))).select(*ID, "account_id")


@query("dedup_by_geo", _latest_sql("listings", "round(latitude, 5), round(longitude, 5), price, size", _NEWEST))
def _(spark, folder):
    return silver.dedup_by_place(listings(spark, folder)).select(*ID, "account_id")


_GROUPS = "SELECT round(latitude, 5) AS lat, round(longitude, 5) AS lon, price, size"


@query(
    "duplicate_groups",
    f"""{_GROUPS}, CAST(count(*) AS BIGINT) AS row_count, min(list_id) AS list_id_min, max(list_id) AS list_id_max, min(ad_id) AS ad_id_min, max(ad_id) AS ad_id_max
    FROM listings GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
)
def _(spark, folder):
    lat, lon = dedup.geo_keys()
    return dedup.duplicate_groups(listings(spark, folder), [lat.alias("lat"), lon.alias("lon"), "price", "size"], ID)


@query(
    "duplicate_members",
    """SELECT latitude, longitude, price, size, list_id, ad_id, account_id, row_count FROM (
      SELECT *, CAST(count(*) OVER (PARTITION BY latitude, longitude, price, size) AS BIGINT) AS row_count FROM listings) WHERE row_count > 1""",
)
def _(spark, folder):
    return dedup.duplicate_members(listings(spark, folder), ["latitude", "longitude", "price", "size"], [*ID, "account_id"])


@query(
    "dense_surrogate_key",
    """SELECT *, CAST(row_number() OVER (ORDER BY area_name NULLS FIRST, ward_name NULLS FIRST, street_name NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS BIGINT) AS location_key
    FROM (SELECT DISTINCT area_name, ward_name, street_name, latitude, longitude FROM listings)""",
)
def _(spark, folder):
    return ordered.dense_key(listings(spark, folder), gold.LOCATION_NATURAL, "location_key")


@query(
    "percent_rank_in_group",
    """SELECT list_id, ad_id, CASE WHEN price IS NOT NULL THEN round(percent_rank() OVER (PARTITION BY area_name, category_name ORDER BY price NULLS FIRST) * 100, 1) END
    AS price_percentile_in_area FROM listings""",
)
def _(spark, folder):
    rows = listings(spark, folder).select(*ID, "area_name", "category_name", "price")
    ranked = ordered.percent_rank_in(rows, ["area_name", "category_name"], "price", "price_percentile_in_area", spread_by=ID)
    return ranked.select(*ID, "price_percentile_in_area")


_DAILY = """(SELECT area_name, snapshot_date, CAST(count(*) AS BIGINT) AS listing_count, sum(price) AS volume FROM listings GROUP BY 1, 2)"""


def _daily(spark, folder):
    rows = listings(spark, folder)
    return rows.groupBy("area_name", "snapshot_date").agg(F.count("*").alias("listing_count"), F.sum("price").alias("volume"))


@query(
    "lag_growth",
    f"""SELECT area_name, snapshot_date, listing_count, volume, prev_listing_count, listing_count - prev_listing_count AS listing_change,
    CASE WHEN prev_listing_count > 0 THEN CAST(listing_count - prev_listing_count AS DOUBLE) / prev_listing_count END AS listing_growth_rate,
    prev_volume, volume - prev_volume AS volume_change, CASE WHEN prev_volume > 0 THEN (volume - prev_volume) / prev_volume END AS volume_growth_rate
    FROM (SELECT *, lag(listing_count) OVER w AS prev_listing_count, lag(volume) OVER w AS prev_volume FROM {_DAILY}
      WINDOW w AS (PARTITION BY area_name ORDER BY snapshot_date))""",
)
def _(spark, folder):
    return series.lag_growth(_daily(spark, folder), ["area_name"], "snapshot_date", {"listing_count": "listing", "volume": "volume"})


@query(
    "global_lag",
    """SELECT snapshot_date, n, prev_n, n - prev_n AS n_change, CASE WHEN prev_n > 0 THEN CAST(n - prev_n AS DOUBLE) / prev_n END AS n_growth_rate FROM (
      SELECT *, lag(n) OVER (ORDER BY snapshot_date) AS prev_n FROM (SELECT snapshot_date, CAST(count(DISTINCT account_id) AS BIGINT) AS n FROM listings GROUP BY 1))""",
)
def _(spark, folder):
    daily = listings(spark, folder).groupBy("snapshot_date").agg(F.count_distinct("account_id").alias("n"))
    return series.lag_growth(daily, [], "snapshot_date", {"n": "n"})


@query(
    "first_day_of_month",
    """SELECT year_month, c.time_key, o.order_count FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month, CAST(count(*) AS BIGINT) AS order_count,
      CAST(strftime(date_trunc('month', min(o_orderdate)), '%Y%m%d') AS INTEGER) AS time_key FROM orders GROUP BY 1) o
    JOIN (SELECT DISTINCT CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS time_key FROM orders) c USING (time_key)""",
)
def _(spark, folder):
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    bounds = days.agg(F.trunc(F.min("date"), "month").alias("low"), F.max("date").alias("high"))
    spine = gold.date_spine(spark, F.col("low"), F.col("high"), bounds).withColumn("time_key", dates.day_key(F.col("date")))
    counts = days.groupBy(F.trunc("date", "month").alias("year_month")).agg(F.count("*").alias("order_count"))
    return series.first_of_month(spine).join(counts, "year_month")


@query(
    "rolling_features",
    f"""SELECT area_name, snapshot_date, listing_count, lag(listing_count, 1) OVER w AS n_lag_1, lag(listing_count, 2) OVER w AS n_lag_2, lag(listing_count, 3) OVER w AS n_lag_3,
    avg(listing_count) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n_rolling_avg_3, avg(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n_rolling_avg_7,
    max(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n_rolling_max_7, min(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n_rolling_min_7,
    listing_count - lag(listing_count, 1) OVER w AS n_change_from_lag_1,
    listing_count / avg(listing_count) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS n_vs_rolling_avg_7
    FROM {_DAILY} WINDOW w AS (PARTITION BY area_name ORDER BY snapshot_date)""",
)
def _(spark, folder):
    daily = _daily(spark, folder).drop("volume")
    return series.rolling(
        daily, ["area_name"], "snapshot_date", "listing_count", "n", lags=(1, 2, 3), means=(3, 7), extremes=(7,), change=True, versus=7
    )


@query(
    "lead_target",
    f"""SELECT area_name, snapshot_date, listing_count, lead(listing_count) OVER (PARTITION BY area_name ORDER BY snapshot_date) AS target_next_listing_count FROM {_DAILY}""",
)
def _(spark, folder):
    daily = _daily(spark, folder).drop("volume")
    return series.lead_target(daily, ["area_name"], "snapshot_date", "listing_count", "target_next_listing_count")


# --- aggregates ------------------------------------------------------------

_STATS = """(SELECT area_name, category_name, avg(price) AS m, stddev_samp(price) AS sd, quantile_disc(price, 0.5) AS med, min(price) AS lo, max(price) AS hi, count(*) AS n
  FROM listings WHERE price > 0 GROUP BY 1, 2)"""


@query(
    "group_stats_zscore",
    f"""SELECT list_id, ad_id, m AS price_avg, sd AS price_std, med AS price_median, lo AS price_min, hi AS price_max, CAST(n AS BIGINT) AS listing_count,
    CASE WHEN sd > 0 THEN round((price - m) / sd, 2) END AS price_z_score FROM listings LEFT JOIN {_STATS} USING (area_name, category_name)""",
    rounded=["price_avg", "price_std"],
)
def _(spark, folder):
    market = ["area_name", "category_name"]
    rows = listings(spark, folder).select(*ID, *market, "price")
    stats = groups.price_stats(rows, market, "price", "price_")
    joined = attach(rows, stats, market, spread_by=ID)
    z = scores.zscore(F.col("price"), F.col("price_avg"), F.col("price_std"))
    return joined.withColumn("price_z_score", z).drop(*market, "price")


@query(
    "join_group_stats",
    """SELECT list_id, ad_id, size, mean_size, CAST(n AS BIGINT) AS n FROM listings LEFT JOIN (SELECT account_id, avg(size) AS mean_size, count(*) AS n FROM listings GROUP BY 1) USING (account_id)""",
    rounded=["mean_size"],
)
def _(spark, folder):
    rows = listings(spark, folder).select(*ID, "account_id", "size")
    stats = rows.groupBy("account_id").agg(F.avg("size").alias("mean_size"), F.count("*").alias("n"))
    return attach(rows, stats, ["account_id"], spread_by=ID).drop("account_id")


@query(
    "global_percentile",
    "SELECT quantile_disc(price, 0.5) AS median, quantile_disc(price, 0.75) AS upper FROM listings",
)
def _(spark, folder):
    return ordered.exact_quantiles(listings(spark, folder).select("price"), [], "price", {"median": 0.5, "upper": 0.75})


@query(
    "group_quantiles",
    """SELECT area_name, quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.5) AS median, quantile_disc(price, 0.75) AS q3, CAST(count(*) AS BIGINT) AS row_count,
    min(price) AS low, max(price) AS high, avg(price) AS mean, quantile_disc(price, 0.25) - 1.5e0 * (quantile_disc(price, 0.75) - quantile_disc(price, 0.25)) AS lower_bound,
    quantile_disc(price, 0.75) + 1.5e0 * (quantile_disc(price, 0.75) - quantile_disc(price, 0.25)) AS upper_bound FROM listings WHERE price IS NOT NULL GROUP BY 1""",
    rounded=["mean"],
)
def _(spark, folder):
    return groups.iqr_bounds(listings(spark, folder), ["area_name"], "price")


@query(
    "iqr_outliers",
    f"""SELECT list_id, ad_id, param_price_m2 FROM (SELECT list_id, ad_id, area_name, {ref.NUMBER} AS param_price_m2 FROM listings) LEFT JOIN
    (SELECT area_name, quantile_disc({ref.NUMBER}, 0.25) AS q1, quantile_disc({ref.NUMBER}, 0.75) AS q3 FROM listings WHERE {ref.NUMBER} IS NOT NULL GROUP BY 1) USING (area_name)
    WHERE NOT coalesce(param_price_m2 < q1 - 1.5e0 * (q3 - q1) OR param_price_m2 > q3 + 1.5e0 * (q3 - q1), FALSE)""",
)
def _(spark, folder):
    from gable.functions.text import extract_number

    rows = listings(spark, folder).select(*ID, "area_name", extract_number(F.col("param_price_m2")).alias("param_price_m2"))
    return groups.remove_iqr_outliers(rows, ["area_name"], "param_price_m2").drop("area_name")


@query(
    "conditional_counts",
    """SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS returned, CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted,
    CAST(count(*) AS BIGINT) AS row_count FROM lineitem GROUP BY 1""",
)
def _(spark, folder):
    counts = groups.conditional_counts({"returned": F.col("l_returnflag") == "A", "discounted": F.col("l_discount") > 0.05})
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(*counts, F.count("*").alias("row_count"))


@query(
    "multi_count_distinct",
    """SELECT snapshot_date, CAST(count(DISTINCT list_id) AS BIGINT) AS listing_count, CAST(count(DISTINCT account_id) AS BIGINT) AS unique_seller_count FROM listings GROUP BY 1""",
)
def _(spark, folder):
    return groups.multi_distinct(listings(spark, folder), ["snapshot_date"], {"listing_count": "list_id", "unique_seller_count": "account_id"})


@query("value_counts", "SELECT category_name, CAST(count(*) AS BIGINT) AS row_count FROM listings GROUP BY 1")
def _(spark, folder):
    return groups.value_counts(listings(spark, folder), "category_name")


@query("distinct_dim", "SELECT DISTINCT account_id, account_name, company_ad FROM listings WHERE account_id IS NOT NULL")
def _(spark, folder):
    return groups.distinct_dim(listings(spark, folder), ["account_id", "account_name", "company_ad"], "account_id")


@query(
    "location_tier",
    """SELECT area_name, CASE WHEN a > m * 1.5e0 THEN 'Premium' WHEN a < m * 0.7e0 THEN 'Developing' ELSE 'Standard' END AS location_tier
    FROM (SELECT area_name, avg(price) AS a FROM listings WHERE price IS NOT NULL GROUP BY 1), (SELECT quantile_disc(price, 0.5) AS m FROM listings)""",
)
def _(spark, folder):
    return groups.tier_vs_median(listings(spark, folder), "area_name", "price", "location_tier")


@query(
    "seller_tier",
    """SELECT account_id, n AS listing_count, CASE WHEN n >= (SELECT quantile_disc(n, 0.75) FROM v) THEN 'High-Volume' WHEN n >= (SELECT quantile_disc(n, 0.5) FROM v) THEN 'Medium-Volume'
    ELSE 'Low-Volume' END AS seller_tier FROM v""".replace(
        "FROM v", "FROM (SELECT account_id, CAST(count(*) AS BIGINT) AS n FROM listings WHERE account_id IS NOT NULL GROUP BY 1) v"
    ),
)
def _(spark, folder):
    return groups.volume_tier(listings(spark, folder), "account_id", "seller_tier")


@query(
    "proximity_premium",
    """SELECT metro_proximity_category, row_count, avg_price, round((avg_price - m) / m * 100, 1) AS price_premium_pct FROM (
      SELECT metro_proximity_category, CAST(count(*) AS BIGINT) AS row_count, round(avg(price), 0) AS avg_price FROM fact_metro_analysis GROUP BY 1),
      (SELECT avg(price) AS m FROM fact_metro_analysis)""",
)
def _(spark, folder):
    return groups.group_premium(warehouse(spark, folder)["fact_metro_analysis"], "metro_proximity_category", "price")


@query(
    "ratio_of_sums",
    """SELECT area_name, sum(price) / nullif(sum(size), 0) AS unit_price, sum(size) / nullif(sum(size), 0) AS one FROM listings GROUP BY 1""",
    rounded=["unit_price"],
)
def _(spark, folder):
    return listings(spark, folder).groupBy("area_name").agg(*groups.ratio_of_sums({"unit_price": "price", "one": "size"}, "size"))


@query(
    "stage_counters",
    """SELECT 'address' AS stage, CAST(count(*) AS BIGINT) AS rows_in, CAST(sum(CASE WHEN ward_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_wards,
    CAST(sum(CASE WHEN ward_name IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_out FROM listings""",
)
def _(spark, folder):
    watched, before = quality.observe_stage(listings(spark, folder), "address_in", {"null_wards": F.col("ward_name").isNull()})
    kept, after = quality.observe_stage(quality.drop_any_null(watched, silver.ADDRESS_COLUMNS), "address_out")
    stage(kept.select(*ID, "ward_name"), "observed")  # the one action that fills both observations
    row = ("address", before.get["rows"], before.get["null_wards"], after.get["rows"])
    return spark.createDataFrame([row], "stage string, rows_in long, null_wards long, rows_out long")


# --- joins -----------------------------------------------------------------

@query("nearest_station", "SELECT ad_id, list_id, station_id, distance_to_metro_m FROM fact_metro_analysis")
def _(spark, folder):
    t = warehouse(spark, folder)
    located = t["silver_listings"].filter((F.col("price") > 0) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    near = joins.nearest(
        located.select(*gold.LISTING_ID, "area_name", "ward_name", "latitude", "longitude"), t["dim_metro_station"],
        ["area_name", "ward_name"], "station_id", distance="distance_to_metro_m",
    )
    return near.select("ad_id", "list_id", "station_id", "distance_to_metro_m")


# Two wards with half of all customers each as stations, a third without any; listings repeat their id.
_DENSE_LISTINGS = """(SELECT o_custkey AS list_id, o_orderkey % 3 AS ward, (o_orderkey % 1000) / 10e0 AS latitude, (o_custkey % 500) / 10e0 AS longitude FROM orders)"""
_DENSE_STATIONS = """(SELECT c_custkey AS station_id, c_custkey % 2 AS ward, (c_custkey * 37 % 1000) / 10e0 AS latitude, (c_custkey * 61 % 500) / 10e0 AS longitude FROM customer)"""


@query(
    "nearest_station_dense",
    f"""SELECT list_id, ward, latitude, longitude, best.station_id AS station_id, best.distance_m AS distance_m FROM (
      SELECT s.list_id, s.ward, s.latitude, s.longitude, s.n, min(CASE WHEN m.station_id IS NOT NULL THEN
        {{'distance_m': {ref.DISTANCE}, 'station_id': m.station_id}} END) AS best
      FROM (SELECT *, row_number() OVER () AS n FROM {_DENSE_LISTINGS}) s LEFT JOIN {_DENSE_STATIONS} m ON s.ward = m.ward GROUP BY ALL)""",
)
def _(spark, folder):
    def placed(frame, ident, ward, north, east, name):
        return frame.select(ident.alias(name), ward.alias("ward"), (north / F.lit(10.0)).alias("latitude"), (east / F.lit(10.0)).alias("longitude"))

    order, customer = F.col("o_orderkey"), F.col("c_custkey")
    left = placed(table(spark, folder, "orders"), F.col("o_custkey"), order % 3, order % 1000, F.col("o_custkey") % 500, "list_id")
    points = placed(table(spark, folder, "customer"), customer, customer % 2, customer * 37 % 1000, customer * 61 % 500, "station_id")
    return joins.nearest(left, points, ["ward"], "station_id").select("list_id", "ward", "latitude", "longitude", "station_id", "distance_m")


@query(
    "fact_key_lookup",
    """SELECT l.list_id, l.ad_id, k.location_key FROM listings l LEFT JOIN (
      SELECT *, CAST(row_number() OVER (ORDER BY area_name NULLS FIRST, ward_name NULLS FIRST, street_name NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS BIGINT) AS location_key
      FROM (SELECT DISTINCT area_name, ward_name, street_name, latitude, longitude FROM listings)) k
    ON l.area_name = k.area_name AND l.ward_name IS NOT DISTINCT FROM k.ward_name AND l.street_name = k.street_name AND l.latitude = k.latitude AND l.longitude = k.longitude""",
)
def _(spark, folder):
    rows = listings(spark, folder).select(*ID, *gold.LOCATION_NATURAL)
    dim = ordered.dense_key(rows, gold.LOCATION_NATURAL, "location_key")
    return joins.lookup_key(rows, dim, gold.LOCATION_NATURAL, "location_key", spread_by=ID).select(*ID, "location_key")


@query(
    "stored_key_lookup",
    """SELECT l.list_id, l.ad_id, k.location_key, NOT EXISTS (SELECT 1 FROM listings o WHERE o.snapshot_date < DATE '2024-02-01' AND o.area_name = l.area_name AND o.ward_name IS NOT DISTINCT FROM l.ward_name
      AND o.street_name = l.street_name AND o.latitude = l.latitude AND o.longitude = l.longitude) AS is_new FROM listings l LEFT JOIN (
      SELECT *, CAST(row_number() OVER (ORDER BY area_name NULLS FIRST, ward_name NULLS FIRST, street_name NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS BIGINT) AS location_key
      FROM (SELECT DISTINCT area_name, ward_name, street_name, latitude, longitude FROM listings WHERE snapshot_date < DATE '2024-02-01')) k
    ON l.area_name = k.area_name AND l.ward_name IS NOT DISTINCT FROM k.ward_name AND l.street_name = k.street_name AND l.latitude = k.latitude AND l.longitude = k.longitude""",
)
def _(spark, folder):
    # The dimension of the first weeks is stored in buckets; lookup and anti join leave it where it lies.
    rows = listings(spark, folder).select(*ID, "snapshot_date", *gold.LOCATION_NATURAL)
    dim = ordered.dense_key(rows.where("snapshot_date < '2024-02-01'").select(*gold.LOCATION_NATURAL), gold.LOCATION_NATURAL, "location_key")
    path = scratch_path(spark, "stored-dim")
    name = "dim_" + path.rsplit("/", 1)[-1].replace("-", "_") + spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    sinks.store_bucketed(dim, name, gold.LOCATION_NATURAL, int(spark.conf.get("spark.sql.shuffle.partitions")), path=path)
    found = joins.join_stored(rows, name, gold.LOCATION_NATURAL, "left", ["location_key"]).select(*ID, "location_key", F.lit(False).alias("is_new")).where("location_key IS NOT NULL")
    fresh = joins.join_stored(rows, name, gold.LOCATION_NATURAL, "left_anti").select(*ID, F.lit(None).cast("long").alias("location_key"), F.lit(True).alias("is_new"))
    return found.unionByName(fresh)


@query(
    "salted_key_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS customer FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
)
def _(spark, folder):
    # The same lookup with the broadcast ruled out; orders of more than five lines are salted.
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"))
    return attach(line, orders, ["l_orderkey"], spread_by=["l_linenumber", "l_partkey"], broadcast_rows=0, hot_rows=5)


@query(
    "anti_join_new_rows",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)
def _(spark, folder):
    stored = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.new_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), stored, ["o_orderkey"])


_MONTHS = """(SELECT account_id, subject, CAST(year(snapshot_date) * 100 + month(snapshot_date) AS INTEGER) AS month_key, CAST(year(snapshot_date) AS INTEGER) AS y,
  CAST(month(snapshot_date) AS INTEGER) AS m, CAST(count(*) AS BIGINT) AS listing_count FROM listings GROUP BY ALL)"""


# Few listings share an account and a subject, so many months are missing.
@query(
    "month_over_month",
    f"""SELECT c.account_id, c.subject, c.month_key, c.listing_count, p.listing_count AS prev_listing_count, c.listing_count - p.listing_count AS listing_change
    FROM {_MONTHS} c LEFT JOIN {_MONTHS} p ON c.account_id = p.account_id AND c.subject = p.subject
      AND p.month_key = CASE WHEN c.m = 1 THEN (c.y - 1) * 100 + 12 ELSE c.month_key - 1 END""",
)
def _(spark, folder):
    day = F.col("snapshot_date")
    monthly = listings(spark, folder).groupBy(
        "account_id", "subject", dates.month_number(F.year(day), F.month(day)).alias("month_key"),
        dates.previous_month_number(F.year(day), F.month(day)).alias("prev_month_key"),
    ).agg(F.count("*").alias("listing_count"))
    keys = ["account_id", "subject"]
    joined = series.previous_period(monthly, keys, "month_key", "prev_month_key", {"listing_count": "prev_listing_count"})
    return joined.withColumn("listing_change", F.col("listing_count") - F.col("prev_listing_count")).drop("prev_month_key")


@query(
    "star_join",
    """SELECT ad_id, list_id, year, area_name, rooms_category FROM fact_properties f JOIN dim_time USING (time_key) JOIN dim_location USING (location_key)
    JOIN (SELECT property_key, rooms_category FROM dim_property) USING (property_key)""",
)
def _(spark, folder):
    t = warehouse(spark, folder)
    dims = {
        "time_key": t["dim_time"].select("time_key", "year"),
        "location_key": t["dim_location"].select("location_key", "area_name"),
        "property_key": t["dim_property"].select("property_key", "rooms_category"),
    }
    fact = t["fact_properties"].select("ad_id", "list_id", *dims)
    joined = joins.star_join(fact, dims, ["year", "area_name", "rooms_category"])
    return joined.select("ad_id", "list_id", "year", "area_name", "rooms_category")


@query(
    "conform_agg_keys",
    """SELECT area_name, CAST(count(*) AS BIGINT) AS listing_count, any_value(location_key) AS location_key FROM silver
    JOIN (SELECT area_name, min(location_key) AS location_key FROM dim_location GROUP BY 1) USING (area_name) GROUP BY 1""",
)
def _(spark, folder):
    t = warehouse(spark, folder)
    grouped = t["silver_listings"].groupBy("area_name").agg(F.count("*").alias("listing_count"))
    return gold.conform_key(grouped, t["dim_location"], "area_name", "location_key")


@query(
    "topk",
    "SELECT list_id, ad_id, price FROM listings ORDER BY price DESC NULLS LAST, list_id, ad_id LIMIT 20",
)
def _(spark, folder):
    rows = listings(spark, folder).select(*ID, "price")
    return rows.orderBy(F.col("price").desc_nulls_last(), *ID).limit(20)


# --- stored sketches -------------------------------------------------------

_SHARES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_PERIOD = "snapshot_date BETWEEN DATE '2024-01-15' AND DATE '2024-03-31'"


def _stored_states(spark, folder):
    """States of each area, category and day, stored in two loads that share days."""
    path = scratch_path(spark, "states")
    name = "states_" + path.rsplit("/", 1)[-1].replace("-", "_") + spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    keys = ["area_name", "category_name"]
    rows = listings(spark, folder).select(*keys, "snapshot_date", "price", "account_id")
    for load in (rows.where("snapshot_date < '2024-03-01'"), rows):
        sketches.add_days(sketches.day_states(load, keys, "snapshot_date", "price", "account_id"), name, keys, "snapshot_date", path)
    return spark.table(name)


# Sketches are no exact numbers, so the counts are compared and the error is judged on the rows themselves.
@query(
    "stored_quantiles",
    f"""SELECT area_name, CAST(count(*) AS BIGINT) AS row_count, CAST(count(price) AS BIGINT) AS value_count, true AS q1_within, true AS median_within, true AS q3_within
    FROM listings WHERE {_PERIOD} GROUP BY 1""",
)
def _(spark, folder):
    merged = sketches.figures(sketches.merged(_stored_states(spark, folder), ["area_name"], F.expr(_PERIOD)), _SHARES, "sellers")
    rows = listings(spark, folder).where(_PERIOD).select("area_name", "price")
    # ranks of the sketch's values among all values of the group
    ranks = attach(rows, merged, ["area_name"], null_safe=True).groupBy("area_name", "row_count", "value_count")
    slack = 2 * sketches.rank_error()
    within = [
        ((F.count_if(F.col("price") <= F.col(q)) >= (p - slack) * F.first("value_count")) & (F.count_if(F.col("price") < F.col(q)) <= (p + slack) * F.first("value_count"))).alias(f"{q}_within")
        for q, p in _SHARES.items()
    ]
    return ranks.agg(*within)


@query(
    "stored_sellers",
    f"""SELECT category_name, CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT account_id) AS BIGINT) AS exact_sellers, true AS within
    FROM listings WHERE {_PERIOD} GROUP BY 1""",
)
def _(spark, folder):
    merged = sketches.figures(sketches.merged(_stored_states(spark, folder), ["category_name"], F.expr(_PERIOD)), {}, "sellers")
    exact = listings(spark, folder).where(_PERIOD).groupBy("category_name").agg(F.count_distinct("account_id").alias("exact_sellers"))
    joined = zip_groups(merged, exact, ["category_name"])
    off = F.abs(F.col("sellers") - F.col("exact_sellers")) <= 4 * sketches.distinct_error() * F.col("exact_sellers")
    return joined.select("category_name", "row_count", "exact_sellers", off.alias("within"))
