"""Sources, sinks and streams, fed with records derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gable.catalog.registry import query
from gable.operators import dedup, shape
from gable.plans import gold, silver, vocab
from gable.plans.adapter import listings, stations, table, trends
from gable.runtime import scratch_path, stage
from gable.sources import readers, sinks
from gable.streaming import bronze
from gable.streaming.ledger import IdLedger

ID = ["list_id", "ad_id"]
RECORD_SCHEMA = """record_id STRING, source STRING, crawled_at BIGINT, ingested_at BIGINT,
  list STRUCT<list_id: BIGINT, subject: STRING, price: DOUBLE, size: DOUBLE, area_name: STRING, account_id: BIGINT>,
  detail STRUCT<list_id: BIGINT, price: DOUBLE, account_name: STRING, parameters: ARRAY<STRING>,
    ad: STRUCT<ad_id: BIGINT, subject: STRING, ward_name: STRING, params: STRING>,
    ad_params: STRUCT<furnishing_sell: STRUCT<value: STRING>, property_legal_document: STRUCT<value: STRING>,
      price_m2: STRUCT<value: STRING>, pty_characteristics: STRUCT<value: STRING>>>"""

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, folder: str, label: str, write) -> str:
    """Path of files written once per application and data folder."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def nested_records(spark: SparkSession, folder: str) -> DataFrame:
    """Listings as nested crawl records; some carry their id only in ``list``."""
    rows = listings(spark, folder)
    stamp = F.unix_millis(F.col("crawled_at_ts").cast("timestamp")) + (F.col("list_id") % 24) * 3_600_000
    value = lambda c: F.struct(F.col(c).alias("value"))
    return rows.select(
        F.when(F.col("list_id") % 2 == 0, F.col("list_id").cast("string")).alias("record_id"),
        F.when(F.col("list_id") % 3 == 0, "listings").alias("source"),
        F.when(F.col("ad_id") % 5 > 0, stamp).otherwise(0).alias("crawled_at"),
        stamp.alias("ingested_at"),
        F.struct("list_id", "subject", "price", "size", "area_name", "account_id").alias("list"),
        F.struct(
            "list_id",
            F.lit(-1.0).alias("price"),
            "account_name",
            F.array("category_name").alias("parameters"),
            F.struct("ad_id", F.lit("hidden").alias("subject"), "ward_name", F.lit("{}").alias("params")).alias("ad"),
            F.struct(
                value("param_furnishing_sell").alias("furnishing_sell"),
                value("param_property_legal_document").alias("property_legal_document"),
                value("param_price_m2").alias("price_m2"),
                value("param_pty_characteristics").alias("pty_characteristics"),
            ).alias("ad_params"),
        ).alias("detail"),
        F.col("snapshot_date").alias("date"),
    )


#: Whole tables as JSON lines are several times their input, so they are compressed and not dealt by date.
BULK = {"compression": "gzip", "rebalance": False}


def _bronze(spark: SparkSession, folder: str) -> str:
    return once(spark, folder, "bronze", lambda path: sinks.write_jsonl(nested_records(spark, folder), path, **BULK))


def _read_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_jsonl_glob(spark, _bronze(spark, folder), schema=RECORD_SCHEMA)


# --- scans -----------------------------------------------------------------

@query(
    "scan_jsonl_permissive",
    """SELECT CASE WHEN l_linenumber <> 5 THEN l_orderkey END AS l_orderkey, CASE WHEN l_linenumber <> 5 THEN l_partkey END AS l_partkey,
    CASE WHEN l_linenumber <> 5 THEN l_tax END AS l_tax, CASE WHEN l_linenumber = 5 THEN 'broken ' || CAST(l_orderkey AS VARCHAR) END AS corrupt FROM lineitem""",
)
def _(spark, folder):
    line = table(spark, folder, "lineitem")
    text = F.when(F.col("l_linenumber") == 5, F.concat(F.lit("broken "), F.col("l_orderkey"))).otherwise(
        F.to_json(F.struct("l_orderkey", "l_partkey", "l_tax"))
    )
    path = once(spark, folder, "lines", lambda p: line.select(text.alias("value")).write.text(p))
    read = readers.read_jsonl(spark, path, "l_orderkey BIGINT, l_partkey BIGINT, l_tax DOUBLE")
    return read.withColumnRenamed(readers.CORRUPT, "corrupt")


@query(
    "scan_partition_prune",
    "SELECT list_id, ad_id, price FROM listings WHERE snapshot_date = DATE '2024-02-01'",
)
def _(spark, folder):
    def write(path):
        rows = listings(spark, folder).select(*ID, "price", F.col("snapshot_date").alias("date"))
        rows.hint("rebalance", "date").write.partitionBy("date").parquet(path)

    stored = spark.read.parquet(once(spark, folder, "by-date", write))
    return readers.select_partition(stored, "2024-02-01").drop("date")


@query(
    "scan_with_lineage",
    "SELECT list_id, ad_id, strftime(snapshot_date, '%Y-%m-%d') AS path_date, TRUE AS stamped FROM listings",
)
def _(spark, folder):
    from gable.functions.text import date_from_path

    rows = readers.with_lineage(_read_bronze(spark, folder))
    return rows.select(
        F.col("list.list_id").alias("list_id"), F.col("detail.ad.ad_id").alias("ad_id"),
        date_from_path(F.col("_source_path")).alias("path_date"), F.col("_ingest_ts").isNotNull().alias("stamped"),
    )


TREND_SCHEMA = "load_type STRING, date STRING, keyword_group STRING, values MAP<STRING, INT>, isPartial BOOLEAN, collected_at_ms BIGINT"


def trend_records_path(spark: SparkSession, folder: str) -> str:
    """Search-interest records stored under the day they were collected, not their own date."""
    def write(path):
        rows = trends(spark, folder).withColumns(
            {"load_type": F.lit("daily"), "date": F.col("date").cast("string"), "isPartial": F.dayofmonth("date") == 30}
        )
        records = readers.to_series_records(rows, vocab.KEYWORDS)
        records.withColumn("collected_at_ms", F.lit(1_714_600_000_000)).write.json(f"{path}/date=2024-05-02")

    return once(spark, folder, "interest", write)


def _trend_records(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_jsonl_glob(spark, trend_records_path(spark, folder), schema=TREND_SCHEMA)


@query(
    "scan_glob",
    """SELECT strftime(date, '%Y-%m-%d') AS date, keyword_group, CAST(bat_dong_san AS INTEGER) AS v_all, CAST(dat_nen AS INTEGER) AS v_land, day(date) = 30 AS is_partial FROM trends""",
)
def _(spark, folder):
    return _trend_records(spark, folder).select(
        "date", "keyword_group", F.col("values")["bất động sản"].alias("v_all"), F.col("values")["đất nền"].alias("v_land"),
        F.col("isPartial").alias("is_partial"),
    )


@query(
    "silver_trends_from_records",
    """SELECT date, keyword_group, CAST(bat_dong_san AS DOUBLE) AS bat_dong_san, CAST(mua_nha AS DOUBLE) AS mua_nha, CAST(can_ho AS DOUBLE) AS can_ho,
    CAST(chung_cu AS DOUBLE) AS chung_cu, CAST(dat_nen AS DOUBLE) AS dat_nen, FALSE AS ispartial, 'VN' AS geo, TIMESTAMP '2024-05-01 21:46:40' AS collected_at_ts
    FROM trends WHERE day(date) <> 30""",
)
def _(spark, folder):
    clean = silver.clean_trends(_trend_records(spark, folder))
    return clean.withColumn("collected_at_ts", F.col("collected_at_ts").cast("timestamp_ntz")).drop(
        "load_type", "collected_at_ms", "target_region"
    )


@query(
    "scan_csv",
    """SELECT station_id, station_code, latitude, longitude, station_name || ', "gate"' || chr(10) || 'level ' || CAST(station_id AS VARCHAR) AS address,
    CASE amenity_atm WHEN 'TRUE' THEN TRUE WHEN 'FALSE' THEN FALSE END AS amenity_atm FROM stations_raw""",
)
def _(spark, folder):
    def write(path):
        quoted = F.concat(F.col("station_name"), F.lit(', "gate"\nlevel '), F.col("station_id"))
        rows = stations(spark, folder).select(
            "station_id", "station_code", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), quoted.alias("address"), "amenity_atm"
        )
        rows.write.option("header", True).option("escape", '"').csv(path)

    schema = "station_id BIGINT, station_code STRING, lat DOUBLE, lng DOUBLE, address STRING, amenity_atm BOOLEAN"
    read = readers.read_csv(spark, once(spark, folder, "stations-csv", write), schema)
    return read.withColumnsRenamed({"lat": "latitude", "lng": "longitude"})


def _stored_table(spark: SparkSession, folder: str, label: str, frame: DataFrame) -> str:
    """Name of a fresh table with the rows of ``frame``."""
    path = scratch_path(spark, label)
    name = "gable_" + path.rsplit("/", 2)[-2].replace("-", "_").replace(".", "_") + "_" + path.rsplit("/", 1)[-1].replace("-", "_")
    sinks.replace_table(frame, name, {"primaryKey": "o_orderkey"}, path=path)
    return name


@query("table_probe", "SELECT TRUE AS present, FALSE AS absent, CAST(count(*) AS BIGINT) AS row_count FROM orders")
def _(spark, folder):
    name = _stored_table(spark, folder, "probe", table(spark, folder, "orders"))
    here, there = readers.table_exists(spark, name), readers.table_exists(spark, f"{name}_absent")
    return spark.table(name).agg(F.count("*").alias("row_count")).select(F.lit(here).alias("present"), F.lit(there).alias("absent"), "row_count")


@query("scan_fallback", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, folder):
    name = _stored_table(spark, folder, "fallback", table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"))
    return readers.read_first_existing(spark, [f"{name}_current", name])


@query(
    "literal_relation",
    """SELECT category_key, c.category_name, category_description, CAST(count(list_id) AS BIGINT) AS listing_count
    FROM dim_search_category c LEFT JOIN listings l ON c.category_name = l.category_name GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    counts = listings(spark, folder).groupBy("category_name").agg(F.count("*").alias("listing_count"))
    return gold.dim_search_category(spark).join(counts, "category_name", "left").fillna(0, ["listing_count"])


@query(
    "dim_search_category",
    "SELECT c.*, CAST(f.months AS BIGINT) AS months FROM dim_search_category c LEFT JOIN (SELECT category_key, count(*) AS months FROM fact_search_trends_monthly GROUP BY 1) f USING (category_key)",
)
def _(spark, folder):
    from gable.plans.warehouse import warehouse

    t = warehouse(spark, folder)
    months = t["fact_search_trends_monthly"].groupBy("category_key").agg(F.count("*").alias("months"))
    return t["dim_search_category"].join(months, "category_key", "left")


@query(
    "date_spine",
    """SELECT d AS date, CAST(count(o_orderkey) AS BIGINT) AS order_count FROM
    (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY 1""",
)
def _(spark, folder):
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    bounds = days.agg(F.min("date").alias("low"), F.max("date").alias("high"))
    counts = days.groupBy("date").agg(F.count("*").alias("order_count"))
    spine = gold.date_spine(spark, F.col("low"), F.col("high"), bounds)
    return spine.join(counts, "date", "left").fillna(0, ["order_count"])


@query(
    "dim_time",
    """SELECT t.*, CAST(count(l.list_id) AS BIGINT) AS listing_count FROM dim_time t LEFT JOIN listings l ON t.date = l.snapshot_date GROUP BY ALL""",
)
def _(spark, folder):
    counts = listings(spark, folder).groupBy(F.col("snapshot_date").alias("date")).agg(F.count("*").alias("listing_count"))
    return gold.dim_time(spark).join(counts, "date", "left").fillna(0, ["listing_count"])


@query(
    "plan_load_windows",
    """SELECT window_start, least(window_start + 7, high) AS window_end, CAST(count(*) AS BIGINT) AS event_count FROM (
      SELECT low + CAST(floor(date_diff('day', low, day) / 7) * 7 AS INTEGER) AS window_start, high FROM
        (SELECT CAST(ts AS DATE) AS day FROM events), (SELECT min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) + 1 AS high FROM events)) GROUP BY 1, 2""",
)
def _(spark, folder):
    days = table(spark, folder, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    bounds = days.agg(F.min("day").alias("low"), F.date_add(F.max("day"), 1).alias("high"))
    windows = readers.plan_windows(bounds, F.col("low"), F.col("high"), 7)
    low = bounds.select("low").scalar()
    start = F.date_add(low, (F.floor(F.datediff("day", low) / 7) * 7).cast("int"))
    counts = days.groupBy(start.alias("window_start")).agg(F.sum("n").alias("event_count"))
    return windows.join(counts, "window_start")


@query(
    "merge_overlapping_windows",
    """SELECT date, keyword_group, CASE WHEN date >= DATE '2024-02-10' THEN bat_dong_san ELSE bat_dong_san + 1000 END AS bat_dong_san,
    CASE WHEN date >= DATE '2024-02-10' THEN DATE '2024-04-30' ELSE DATE '2024-02-20' END AS timeframe_end FROM trends""",
)
def _(spark, folder):
    rows = trends(spark, folder).select("date", "keyword_group", "bat_dong_san")
    early = rows.filter("date < '2024-02-20'").withColumns(
        {"bat_dong_san": F.col("bat_dong_san") + 1000, "timeframe_end": F.lit("2024-02-20").cast("date")}
    )
    late = rows.filter("date >= '2024-02-10'").withColumn("timeframe_end", F.lit("2024-04-30").cast("date"))
    return readers.merge_windows(shape.union_by_name(early, late), ["date", "keyword_group"], "timeframe_end")


# --- nested records --------------------------------------------------------

@query(
    "flatten_struct",
    "SELECT list_id, subject, price, size, area_name, account_id FROM listings",
)
def _(spark, folder):
    flat = shape.flatten_struct(_read_bronze(spark, folder), "list")
    return flat.select("list_id", "subject", "price", "size", "area_name", "account_id")


@query(
    "flatten_struct_skip",
    "SELECT list_id, price, account_name, FALSE AS nested_left FROM listings",
)
def _(spark, folder):
    flat = shape.flatten_struct(_read_bronze(spark, folder), "list")
    flat = shape.flatten_struct(flat, "detail", skip=("ad", "parameters", "ad_params"))
    nested = any(c in flat.columns for c in ("ad", "parameters", "ad_params"))
    return flat.select("list_id", "price", "account_name", F.lit(nested).alias("nested_left"))


@query(
    "flatten_prefixed",
    "SELECT list_id, subject, ad_id AS ad_ad_id, ward_name AS ad_ward_name, FALSE AS extra FROM listings",
)
def _(spark, folder):
    flat = shape.flatten_struct(_read_bronze(spark, folder), "list")
    flat = shape.flatten_struct(flat, "detail.ad", prefix="ad_", skip=("params",))
    extra = "ad_subject" in flat.columns or "ad_params" in flat.columns
    return flat.select("list_id", "subject", "ad_ad_id", "ad_ward_name", F.lit(extra).alias("extra"))


_PARAMS = "param_furnishing_sell, param_property_legal_document, param_price_m2, param_pty_characteristics"


@query("json_path_params", f"SELECT list_id, ad_id, {_PARAMS} FROM listings")
def _(spark, folder):
    # One pass with the struct schema, one from plain JSON text.
    rows = _read_bronze(spark, folder)
    typed = shape.extract_json_paths(rows, "detail", dict(list(vocab.PARAM_PATHS.items())[:2]))
    as_text = typed.withColumn("detail_text", F.to_json("detail"))
    full = shape.extract_json_paths(as_text, "detail_text", vocab.PARAM_PATHS)
    return full.select(F.col("list.list_id").alias("list_id"), F.col("detail.ad.ad_id").alias("ad_id"), *vocab.PARAM_PATHS)


@query(
    "event_props_json",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return shape.extract_json_paths(events, "props", {"k": "$.k"}).drop("props")


@query(
    "enrich_metadata",
    """SELECT list_id, ad_id, 'listings' AS source, 'market_listings' AS category, 'market_listing' AS entity, 'stream_to_bronze' AS ingestion_type, 'records_to_bronze' AS pipeline_name,
    CAST(NULL AS VARCHAR) AS upstream_metadata FROM listings""",
)
def _(spark, folder):
    rows = nested_records(spark, folder).drop("date")
    rich = bronze.enrich(rows, DEFAULTS, ingestion_type="stream_to_bronze", pipeline_name="records_to_bronze")
    return rich.select(
        F.col("list.list_id").alias("list_id"), F.col("detail.ad.ad_id").alias("ad_id"),
        *DEFAULTS, "ingestion_type", "pipeline_name", "upstream_metadata",
    )


DEFAULTS = {"source": "listings", "category": "market_listings", "entity": "market_listing"}


@query("batch_dedup_ids", "SELECT CAST(user_id AS VARCHAR) AS record_id, min(event_id) AS event_id FROM events WHERE user_id > 0 GROUP BY 1")
def _(spark, folder):
    ids = table(spark, folder, "events").select(F.when(F.col("user_id") > 0, F.col("user_id").cast("string")).alias("record_id"), "event_id")
    return dedup.drop_duplicate_ids(ids, "record_id", [F.col("event_id").asc()]).select("record_id", "event_id")


# --- sinks -----------------------------------------------------------------

@query("sink_replace", "SELECT o_orderkey, o_orderpriority, o_custkey FROM orders")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    name = _stored_table(spark, folder, "replace", orders.select("o_orderkey"))
    sinks.replace_table(orders.select("o_orderkey", "o_orderpriority", "o_custkey"), name, {"format-version": "2", "primaryKey": "o_orderkey"})
    return spark.table(name)


def _fresh_name(spark: SparkSession, label: str) -> tuple[str, str]:
    path = scratch_path(spark, label)
    app = spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    return f"gable_{app}_{path.rsplit('/', 1)[-1].replace('-', '_')}", path


@query(
    "append_if_new_fp",
    """SELECT DISTINCT sha256(concat_ws('||', subject, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), CAST(size AS VARCHAR), CAST(account_id AS VARCHAR))) AS content_fp,
    subject, account_id FROM listings""",
)
def _(spark, folder):
    rows = silver.packed_fingerprint(silver.with_fingerprint(listings(spark, folder)).select("content_fp", "subject", "account_id", "ad_id"))
    rows = stage(rows, "fp-rows")
    name, path = _fresh_name(spark, "append-fp")
    batches = [rows.filter(F.col("ad_id") % 2 == 0), rows, rows]  # overlapping, then repeated
    for batch in batches:
        sinks.append_new(batch, name, ["content_fp"], path=path)
    return silver.spelled_fingerprint(spark.table(name).select("content_fp", "subject", "account_id"))


@query(
    "append_if_new_key",
    """SELECT date, keyword_group, bat_dong_san + CASE WHEN day(date) % 2 = 0 THEN 0 ELSE 1000 END AS bat_dong_san FROM trends""",
)
def _(spark, folder):
    rows = trends(spark, folder).select("date", "keyword_group", "bat_dong_san")
    revised = rows.withColumn("bat_dong_san", F.col("bat_dong_san") + 1000)
    name, path = _fresh_name(spark, "append-key")
    sinks.append_new(rows.filter(F.dayofmonth("date") % 2 == 0), name, ["date", "keyword_group"], path=path)
    sinks.append_new(shape.union_by_name(revised, revised), name, ["date", "keyword_group"], path=path)
    return spark.table(name)


@query("refresh_dim_dedup", "SELECT station_id, station_code, station_name, area_name FROM stations_raw")
def _(spark, folder):
    points = stations(spark, folder).select("station_id", "station_code", "station_name", "area_name")
    repeated = shape.union_by_name(points, points.withColumn("station_code", F.concat("station_code", F.lit("~"))))
    single = dedup.latest_by(repeated, ["station_id"], [F.col("station_code").asc()])
    name, path = _fresh_name(spark, "dim")
    sinks.replace_table(single, name, {"primaryKey": "station_id"}, path=path)
    return spark.table(name)


@query(
    "kafka_payload",
    """SELECT CAST(list_id AS VARCHAR) AS key, CAST(json_object('list_id', list_id, 'ad_id', ad_id, 'category_name', category_name) AS VARCHAR) AS value FROM listings""",
)
def _(spark, folder):
    return sinks.kafka_payload(listings(spark, folder).select(*ID, "category_name"), "list_id")


@query("sink_jsonl_partitioned", "SELECT list_id, ad_id, price, category_name, snapshot_date AS date FROM listings")
def _(spark, folder):
    path = scratch_path(spark, "jsonl")
    rows = listings(spark, folder).select(*ID, "price", "category_name", F.col("snapshot_date").alias("date"))
    sinks.write_jsonl(rows, path)
    return spark.read.schema("list_id BIGINT, ad_id BIGINT, price DOUBLE, category_name STRING, date DATE").json(path)


@query(
    "batch_manifest",
    """SELECT 'interest' AS source, 'daily' AS load_type, min(date) AS min_record_date, max(date) AS max_record_date, CAST(count(*) AS BIGINT) AS record_count FROM trends""",
)
def _(spark, folder):
    return sinks.batch_manifest(trends(spark, folder), "date", {"source": "interest", "load_type": "daily"}).drop("saved_at")


# --- streams ---------------------------------------------------------------

def _finish(started) -> None:
    started.awaitTermination()


def _event_files(spark: SparkSession, folder: str) -> str:
    """Events in several files in time order, as a stream would deliver them."""
    def write(path):
        table(spark, folder, "events").repartitionByRange(6, "ts").write.parquet(path)

    return once(spark, folder, "event-files", write)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = _event_files(spark, folder)
    stream = readers.read_stream(spark, "parquet", {"path": path, "maxFilesPerTrigger": "2"}, spark.read.parquet(path).schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(stream: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Run a stream to the end of its input into files and read them."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    _finish(
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_source", "SELECT event_id, event_type, value FROM events")
def _(spark, folder):
    return _drain(event_stream(spark, folder).select("event_id", "event_type", "value"), spark, "source")


@query("broker_decode", "SELECT event_id, event_type, CASE WHEN event_id % 10 <> 3 THEN value END AS value FROM events WHERE event_id % 10 <> 7 UNION ALL SELECT NULL, NULL, NULL FROM events WHERE event_id % 10 = 7")
def _(spark, folder):
    # Messages as a broker gives them: some without a field, some that are no record.
    events = table(spark, folder, "events")
    fields = F.struct("event_id", "event_type", F.when(F.col("event_id") % 10 != 3, F.col("value")).alias("value"))
    value = F.when(F.col("event_id") % 10 == 7, "not a record").otherwise(F.to_json(fields))
    messages = events.select(F.col("user_id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"))
    return readers.decode_records(messages, "event_id BIGINT, event_type STRING, value DOUBLE")


@query(
    "stream_dedup",
    """SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) || event_type AS record_id, CAST(NULL AS BIGINT) AS event_id FROM events WHERE user_id > 5
    UNION ALL SELECT CAST(ts AS DATE), NULL, event_id FROM events WHERE user_id <= 5""",
)
def _(spark, folder):
    keyed = event_stream(spark, folder).withColumns(
        {
            "date": F.to_date("ts"),
            "record_id": F.when(F.col("user_id") > 5, F.concat(F.col("user_id").cast("string"), "event_type")),
        }
    )
    # The files may be picked up in any order, so the horizon covers the whole month.
    unique = bronze.dedup_stream(keyed, "ts", ["date", "record_id"], "record_id", horizon="40 days")
    kept = F.when(F.col("record_id").isNull(), F.col("event_id")).alias("event_id")
    return _drain(unique.select("date", "record_id", kept), spark, "dedup")


#: Records of a compressed file of the stream's input, which one task reads.
FILE_RECORDS = 100_000


def _record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records in files in time order, four at least; a batch takes half of them."""
    files = max(4, table(spark, folder, "lineitem").count() // FILE_RECORDS)

    def write(path):
        ordered = nested_records(spark, folder).drop("date").repartitionByRange(files, "ingested_at")
        ordered.write.option("compression", BULK["compression"]).json(path)

    path = once(spark, folder, "records", write)
    from pyspark.sql.types import StructType

    return readers.read_stream(spark, "json", {"path": path, "maxFilesPerTrigger": str(files // 2)}, StructType.fromDDL(RECORD_SCHEMA))


_EVENT_DATE = "CAST(crawled_at_ts + INTERVAL 7 HOUR + INTERVAL 1 HOUR * CAST(list_id % 24 AS INTEGER) AS DATE)"


def _stream_records(spark: SparkSession, folder: str, label: str, **options) -> str:
    target = scratch_path(spark, label)
    if "late" in options:
        options["late"] = f"{target}-late"
    _finish(
        bronze.bronze_stream(
            _record_stream(spark, folder), target, f"{target}-checkpoint", defaults=DEFAULTS, trigger={"availableNow": True},
            compression=BULK["compression"], **options
        )
    )
    return target


@query(
    "stream_to_bronze",
    f"SELECT DISTINCT {_EVENT_DATE} AS date, CAST(list_id AS VARCHAR) AS record_id, 'listings' AS source, 'market_listing' AS entity FROM listings",
)
def _(spark, folder):
    target = _stream_records(spark, folder, "bronze-stream")
    return spark.read.schema("record_id STRING, source STRING, entity STRING, date DATE").json(target)


# On time or late depends on how the source is cut into batches, so only the
# union has an SQL twin; it must be whole and free of repeats.
@query("stream_late_rows", f"SELECT DISTINCT {_EVENT_DATE} AS date, CAST(list_id AS VARCHAR) AS record_id FROM listings")
def _(spark, folder):
    target = _stream_records(spark, folder, "late-stream", late=True, horizon_days=30)
    parts = [spark.read.schema("record_id STRING, date DATE").json(target)]
    if bronze.has_files(spark, f"{target}-late"):
        parts.append(spark.read.schema("record_id STRING, date DATE").json(f"{target}-late"))
    return shape.union_by_name(*parts)


@query("ledger_stored_ids", "SELECT DISTINCT snapshot_date AS date, CAST(list_id AS VARCHAR) AS record_id FROM listings")
def _(spark, folder):
    # Every id comes in batches that share some; folded twice, so dates have several files and buckets.
    ids = listings(spark, folder).select(F.col("snapshot_date").alias("date"), F.col("list_id").cast("string").alias("record_id"))
    ids = stage(ids.withColumn("batch", F.pmod(F.xxhash64("record_id", "date"), F.lit(5))), "ledger-ids")
    ledger = IdLedger(spark, scratch_path(spark, "ledger"), bucket_ids=500, max_recent=2, max_files=2)
    for n in range(5):
        ledger.add(ids.where(F.col("batch").isin(n, (n + 1) % 5)))
    return ledger.may_hold(ids).distinct()


@query(
    "overview_tumbling",
    """SELECT CAST(ts AS DATE) AS snapshot_date, CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT user_id) AS BIGINT) AS unique_seller_count, avg(value) AS value_avg FROM events GROUP BY 1""",
    rounded=["value_avg"],
)
def _(spark, folder):
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return bronze.overview(events, "ts", "user_id", "value")


@query(
    "overview_stream",
    "SELECT CAST(ts AS DATE) AS snapshot_date, CAST(count(*) AS BIGINT) AS row_count, avg(value) AS value_avg FROM events GROUP BY 1",
    rounded=["value_avg"],
)
def _(spark, folder):
    # The running overview; each batch replaces the days it changed. Sellers are approximate there and left out.
    running = bronze.overview(event_stream(spark, folder), "ts", "user_id", "value", approx=True)
    out, checkpoint = scratch_path(spark, "overview"), scratch_path(spark, "overview-checkpoint")
    writer = running.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    _finish(writer.foreachBatch(lambda batch, _: sinks.replace_partitions(batch, out, "snapshot_date")).start())
    return spark.read.schema(running.schema).parquet(out).drop("unique_seller_count")
