"""The two batch jobs end to end: files to silver tables, silver to gold tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from gable.operators import quality
from gable.plans import silver, vocab
from gable.plans.warehouse import Warehouse
from gable.runtime import row_count, stage, temporary
from gable.sources import readers, sinks

# Keys and references of the gold tables; metadata only.
PROPERTIES: dict[str, dict[str, str]] = {
    "dim_time": {"primaryKey": "time_key"},
    "dim_location": {"primaryKey": "location_key"},
    "dim_property": {"primaryKey": "property_key"},
    "dim_seller": {"primaryKey": "seller_key"},
    "dim_metro_station": {"primaryKey": "station_key"},
    "dim_search_category": {"primaryKey": "category_key"},
    "fact_properties": {
        "fk_location_key": "dim_location.location_key",
        "fk_property_key": "dim_property.property_key",
        "fk_seller_key": "dim_seller.seller_key",
        "fk_time_key": "dim_time.time_key",
    },
    "fact_price_area_time": {},
    "fact_seller_time": {},
    "fact_metro_analysis": {
        "fk_location_key": "dim_location.location_key",
        "fk_property_key": "dim_property.property_key",
        "fk_time_key": "dim_time.time_key",
        "fk_station_key": "dim_metro_station.station_key",
    },
    "fact_search_trends_monthly": {"fk_time_key": "dim_time.time_key", "fk_category_key": "dim_search_category.category_key"},
}


class Catalog:
    """Names and places of the tables of one namespace.

    ``root`` puts the files below a folder; without it the catalog decides.
    """

    def __init__(self, spark: SparkSession, namespace: str, *, fmt: str = "parquet", root: str | None = None):
        self.spark, self.namespace, self.fmt, self.root = spark, namespace, fmt, root
        sinks.ensure_namespace(spark, namespace)

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def path(self, table: str) -> str | None:
        return f"{self.root.rstrip('/')}/{table}" if self.root else None

    def exists(self, table: str) -> bool:
        return readers.table_exists(self.spark, self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def replace(self, df: DataFrame, table: str, properties: Mapping[str, str] | None = None) -> DataFrame:
        sinks.replace_table(df, self.name(table), properties, fmt=self.fmt, path=self.path(table))
        return self.read(table)

    def append_new(self, df: DataFrame, table: str, keys: list[str]) -> int:
        return sinks.append_new(df, self.name(table), keys, fmt=self.fmt, path=self.path(table))


class Report:
    """Rows after each step of a job, counted while its plans run; no extra scan."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[str]]] = {}

    def watch(self, rows: DataFrame, step: str, conditions: Mapping[str, Column] | None = None) -> DataFrame:
        watched, seen = quality.observe_stage(rows, f"{step}-{len(self._seen)}", conditions)
        self._seen[step] = (seen, list(conditions or {}))
        return watched

    def table(self, spark: SparkSession) -> DataFrame:
        """``step, rows_in, rows_out, removed, flags``: one row for each step, in order; ask after the job."""
        out, before = [], None
        for step, (seen, flags) in self._seen.items():
            found = seen.get
            rows = found["rows"]
            out.append((step, rows if before is None else before, rows, (before or rows) - rows, {f: found[f] for f in flags}))
            before = rows
        return spark.createDataFrame(out, "step string, rows_in long, rows_out long, removed long, flags map<string, bigint>")


def listings_to_silver(
    catalog: Catalog,
    path: str,
    schema: StructType | str | None = None,
    *,
    date: str | None = None,
    exact: bool = False,
    report: Report | None = None,
) -> int:
    """Clean the listing records below ``path`` (all dates or one) and add the new ones.

    Returns the number of rows added; no input is not an error. Medians and
    outlier bounds come from mergeable sketches unless ``exact``. ``report``
    gets the rows after each step and the lines that did not parse.
    """
    raw = readers.read_jsonl_glob(catalog.spark, path, date, schema)
    if raw is None or raw.isEmpty():
        return 0
    report = report or Report()
    raw = report.watch(raw, "read", {"unparsed": F.col(readers.CORRUPT).isNotNull()} if readers.CORRUPT in raw.columns else None)
    flat = silver.flatten_records(readers.with_lineage(raw)).drop(readers.CORRUPT)
    with temporary(catalog.spark):
        # Work on copies of the stored codes: a table cannot be replaced while it is read.
        known = {t: stage(catalog.read(t), t) if catalog.exists(t) else None for t in ("area_codes", "ward_codes")}
        rows, areas, wards = silver.clean_listings(flat, **known, exact=exact, watch=report.watch)
        # Codes first: a run that stops here leaves no row with an unknown code.
        catalog.replace(areas, "area_codes")
        catalog.replace(wards, "ward_codes")
        return catalog.append_new(rows, "listings", ["content_fp"])


def stations_to_silver(catalog: Catalog, path: str, schema: StructType | str) -> DataFrame:
    """Full refresh of the stations with the codes of the listings."""
    raw = readers.read_csv(catalog.spark, path, schema)
    clean = silver.clean_stations(raw, catalog.read("area_codes"), catalog.read("ward_codes"))
    return catalog.replace(clean, "metro_stations", {"primaryKey": "station_id"})


def trends_to_silver(catalog: Catalog, path: str, schema: StructType | str, *, date: str | None = None) -> int:
    """Add search-interest rows whose date and keyword group are new."""
    raw = readers.read_jsonl_glob(catalog.spark, path, date, schema)
    if raw is None or raw.isEmpty():
        return 0
    clean = silver.clean_trends(readers.with_lineage(raw))
    return catalog.append_new(clean, "trends_daily", ["date", "keyword_group"])


def plan_trends(catalog: Catalog, groups: Sequence[str], today: str, *, initial: str, window_days: int, lookback_days: int) -> DataFrame:
    """``keyword_group, load_type, window_start, window_end``: what the next ingestion asks for.

    A group without a mark starts at ``initial``; others go back ``lookback_days``, or to
    their mark if that is older, so days on which no job ran are not left out.
    """
    plan = catalog.spark.createDataFrame([(g,) for g in groups], "keyword_group string")
    known = catalog.exists("trend_marks")
    plan = plan.join(catalog.read("trend_marks"), "keyword_group", "left") if known else plan.withColumn("high_water", F.lit(None).cast("date"))
    mark, day = F.col("high_water"), F.lit(today).cast("date")
    start = F.when(mark.isNull(), F.lit(initial).cast("date")).otherwise(F.least(F.date_sub(day, lookback_days), mark))
    plan = plan.withColumns({"load_type": F.when(mark.isNull(), "initial").otherwise("daily"), "start": start})
    return readers.plan_windows(plan, F.col("start"), F.date_add(day, 1), window_days, ["keyword_group", "load_type"])


def ingest_trends(
    catalog: Catalog,
    path: str,
    extract: Callable[[DataFrame], DataFrame],
    groups: Sequence[str],
    today: str,
    schema: StructType | str,
    *,
    initial: str,
    window_days: int = 30,
    lookback_days: int = 7,
    meta: Mapping[str, str] | None = None,
) -> int:
    """Search interest from its source to silver: plan, extract, merge, records, manifest, silver, marks.

    ``extract`` gives, for planned windows, wide rows with ``date``, ``keyword_group`` and
    the bounds of their window. A run is named by its day and windows; its records are
    a folder of that name, its manifest a row with that key, silver adds only new rows, and
    the marks move last. A run that stopped anywhere is repeated under the same name and
    adds nothing twice. Returns the number of rows added to silver.
    """
    spark = catalog.spark
    with temporary(spark):
        windows = stage(plan_trends(catalog, groups, today, initial=initial, window_days=window_days, lookback_days=lookback_days), "windows")
        asked = sorted(map(tuple, windows.select("keyword_group", "load_type", F.col("window_start").cast("string"), F.col("window_end").cast("string")).collect()))
        batch = hashlib.sha256(repr((today, asked)).encode()).hexdigest()[:16]
        found = readers.merge_windows(extract(windows), ["date", "keyword_group"], "window_end")
        found = found.withColumnsRenamed({"window_start": "timeframe_start", "window_end": "timeframe_end"})
        rows = stage(readers.to_series_records(found.withColumn("batch_id", F.lit(batch)), vocab.KEYWORDS), "interest")
        if row_count(rows) == 0:
            return 0
        folder = f"{path}/date={today}/interest_{batch}.jsonl"
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(folder)
        manifest = sinks.batch_manifest(rows, "date", {"batch_id": batch, "load_types": ",".join(sorted({a[1] for a in asked})), **(meta or {})})
        catalog.append_new(manifest, "trend_batches", ["batch_id"])
        added = trends_to_silver(catalog, folder, schema)
        marks = rows.groupBy("keyword_group").agg(F.max("date").alias("high_water"))
        if catalog.exists("trend_marks"):
            marks = marks.unionByName(catalog.read("trend_marks")).groupBy("keyword_group").agg(F.max("high_water").alias("high_water"))
        catalog.replace(stage(marks, "marks"), "trend_marks", {"primaryKey": "keyword_group"})
        return added


def silver_to_gold(source: Catalog, target: Catalog, *, exact: bool = False) -> Warehouse:
    """Build every gold table from the silver tables, dimensions first.

    Tables of stations or search interest are left out where their silver table
    does not exist; ``register`` then leaves out the views on them as well.
    """
    given = {"silver_listings": source.read("listings")}
    optional = {"silver_stations": "metro_stations", "silver_trends": "trends_daily", "area_codes": "area_codes", "ward_codes": "ward_codes"}
    given |= {name: source.read(t) for name, t in optional.items() if source.exists(t)}
    gold = Warehouse(
        source.spark, exact=exact, given=given, store=lambda df, name: target.replace(df, name, PROPERTIES.get(name))
    )
    for name in PROPERTIES:
        needs = {"dim_metro_station": "silver_stations", "fact_metro_analysis": "silver_stations", "fact_search_trends_monthly": "silver_trends"}
        if needs.get(name, "silver_listings") in given:
            gold[name]
    return gold
