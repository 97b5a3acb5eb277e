"""Silver and gold tables, views, analyst questions and the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from gable.catalog.registry import query, register
from gable.operators import joins
from gable.plans import gold, hotspot_model
from gable.plans.adapter import listings
from gable.plans.questions import QUESTIONS, UNIQUE, Question
from gable.plans.views import VIEWS
from gable.plans.warehouse import warehouse


def _table(name: str):
    return lambda spark, folder: warehouse(spark, folder)[name]


# Table in the warehouse, its SQL twin, and the columns that are sums of doubles.
_TABLES = {
    "silver_listings": ("silver_listings", "silver", []),
    "silver_stations": ("silver_stations", "stations", []),
    "dim_location": ("dim_location", "dim_location", []),
    "dim_property": ("dim_property", "dim_property", []),
    "dim_seller": ("dim_seller", "dim_seller", []),
    "dim_station": ("dim_metro_station", "dim_metro_station", []),
    "fact_properties": ("fact_properties", "fact_properties", []),
    "fact_price_area_time": ("fact_price_area_time", "fact_price_area_time", ["price_std"]),
    "fact_seller_time": ("fact_seller_time", "fact_seller_time", []),
    "fact_metro_analysis": ("fact_metro_analysis", "fact_metro_analysis", []),
    "fact_search_trends_monthly": ("fact_search_trends_monthly", "fact_search_trends_monthly", []),
}
for _key, (_name, _cte, _rounded) in _TABLES.items():
    register(_key, _table(_name), f"SELECT * FROM {_cte}", _rounded)


@query(
    "silver_trends",
    """SELECT date, keyword_group, CAST(bat_dong_san AS DOUBLE) AS bat_dong_san, CAST(mua_nha AS DOUBLE) AS mua_nha, CAST(can_ho AS DOUBLE) AS can_ho,
    CAST(chung_cu AS DOUBLE) AS chung_cu, CAST(dat_nen AS DOUBLE) AS dat_nen, 'VN' AS geo, 'Vietnam' AS target_region FROM trends""",
)
def _(spark, folder):
    return warehouse(spark, folder)["silver_trends"]


_SUPPLY = ["price_avg", "price_per_m2_avg", "size_avg"]
_GROWTH = ["prev_price_per_m2_avg", "price_per_m2_change", "price_per_m2_growth_rate"]
_SCORES = ["quality_score_avg", "market_saturation_score_avg", "seller_credibility_score_avg"]
_HOT = [*_SUPPLY, *_SCORES, "area_popularity_avg", "number_of_images_avg", "listing_age_days_avg"]
VIEW_KEYS = {
    "v_market_overview_daily": ("vw_market_overview_daily", _SUPPLY),
    "v_market_overview_analysis": ("vw_market_overview_daily_analysis", _SUPPLY),
    "v_market_trend_base": ("vw_market_trend_analysis_base", [*_SUPPLY, "quality_score_avg"]),
    "v_market_trend_analysis": ("vw_market_trend_analysis", [*_SUPPLY, "quality_score_avg", *_GROWTH]),
    "v_monthly_base": ("vw_market_trend_monthly_base", [*_SUPPLY, "quality_score_avg"]),
    "v_monthly_analysis": ("vw_market_trend_monthly_analysis", [*_SUPPLY, "quality_score_avg", *_GROWTH]),
    "v_metro_impact": ("vw_metro_impact_analysis", _SUPPLY),
    "v_metro_impact_detail": ("vw_metro_impact_analysis_detail", _SUPPLY),
    "v_area_market_base": ("vw_area_market_analysis_base", [*_SUPPLY, *_SCORES]),
    "v_area_market_analysis": ("vw_area_market_analysis", [*_SUPPLY, *_SCORES]),
    "v_hotspot_monthly_base": ("vw_hotspot_monthly_base", _HOT),
    "v_hotspot_analysis": ("vw_hotspot_analysis", [*_HOT, *_GROWTH]),
    "v_ml_dataset": (
        "vw_ml_hotspot_dataset",
        [*_SUPPLY, *_SCORES, "area_popularity_avg", "listing_age_days_avg", "latitude", "longitude",
         "listing_count_rolling_avg_3", "listing_count_rolling_avg_7", "listing_count_vs_rolling_avg_7",
         "price_per_m2_lag_1", "price_per_m2_rolling_avg_7", "price_per_m2_change_from_lag_1",
         "unique_seller_count_rolling_avg_7", "market_saturation_score_lag_1", "market_saturation_score_rolling_avg_7"],
    ),
}
for _key, (_name, _rounded) in VIEW_KEYS.items():
    register(_key, _table(_name), f"SELECT * FROM {_name}", _rounded)

assert {name for name, _ in VIEW_KEYS.values()} == {*VIEWS, "vw_ml_hotspot_dataset"}

# Doubles in the reports whose last bits depend on the order of addition.
_LOOSE = {
    *_SUPPLY, *_SCORES, *_GROWTH, "avg_price_per_m2", "avg_price", "avg_size", "avg_listing_per_area",
}


def question_sql(question: Question) -> str:
    """The report as DuckDB SQL, with a total order so that limits are stable."""
    def sort(item: str) -> str:
        return f"{item[1:]} DESC NULLS LAST" if item.startswith("-") else f"{item} ASC NULLS LAST"

    where = f" WHERE {question.where}" if question.where else ""
    if question.group:
        body = f"SELECT {', '.join(question.show)} FROM {question.view}{where} GROUP BY {', '.join(question.group)}"
    else:
        ties = [f"{c} ASC NULLS LAST" for c in UNIQUE[question.view]]
        order = ", ".join([*map(sort, question.order), *ties])
        limit = f" LIMIT {question.limit}" if question.limit else ""
        inner = f"SELECT * FROM {question.view}{where} ORDER BY {order}{limit}"
        body = f"SELECT {', '.join(question.show)} FROM ({inner})"
    return body


def _rounded_in(question: Question) -> list[str]:
    if list(question.show) == ["*"]:
        return _SUPPLY
    names = [s.rsplit(" AS ", 1)[-1] for s in question.show]
    return [n for n in names if n in _LOOSE]


def _ask(question: Question):
    return lambda spark, folder: question.run(warehouse(spark, folder))


for _key, _question in QUESTIONS.items():
    register(_key, _ask(_question), question_sql(_question), _rounded_in(_question))


# --- integrity -------------------------------------------------------------

@query(
    "fk_violations",
    """SELECT 'location_key' AS key_name, CAST(0 AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS fact_rows FROM fact_properties
    UNION ALL SELECT 'property_key', 0, CAST(count(*) AS BIGINT) FROM fact_properties UNION ALL SELECT 'seller_key', 0, CAST(count(*) AS BIGINT) FROM fact_properties
    UNION ALL SELECT 'time_key', 0, CAST(count(*) AS BIGINT) FROM fact_properties""",
)
def _(spark, folder):
    t = warehouse(spark, folder)
    dims = {"location_key": "dim_location", "property_key": "dim_property", "seller_key": "dim_seller", "time_key": "dim_time"}
    return joins.fk_report(t["fact_properties"], {key: t[name] for key, name in dims.items()})


@query(
    "pk_violations",
    "SELECT list_id, CAST(count(*) AS BIGINT) AS row_count FROM listings GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, folder):
    return joins.pk_violations(listings(spark, folder), "list_id")


# --- model -----------------------------------------------------------------

TRAIN_UNTIL, VALID_UNTIL = "2024-03-15", "2024-04-07"
# Fixed prediction: yesterday's count against the trailing mean.
_PREDICTED = """CASE WHEN listing_count / listing_count_rolling_avg_7 >= 1.5e0 THEN 'High' WHEN listing_count / listing_count_rolling_avg_7 >= 1.0e0 THEN 'Medium'
  WHEN listing_count IS NOT NULL THEN 'Low' END"""
_NAIVE = f"""(SELECT target_hotspot_level AS actual, {_PREDICTED} AS predicted FROM vw_ml_hotspot_dataset WHERE target_hotspot_level IS NOT NULL)"""


def _naive(spark, folder):
    rows = hotspot_model.training_rows(warehouse(spark, folder)["vw_ml_hotspot_dataset"])
    guess = hotspot_model.level_of(F.col("listing_count"), F.col("listing_count_rolling_avg_7"))
    return rows.withColumn("predicted", guess)


@query(
    "time_split",
    f"""SELECT CASE WHEN snapshot_date <= DATE '{TRAIN_UNTIL}' THEN 'train' WHEN snapshot_date <= DATE '{VALID_UNTIL}' THEN 'valid' ELSE 'test' END AS split,
    CAST(count(*) AS BIGINT) AS row_count, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day
    FROM vw_ml_hotspot_dataset WHERE target_hotspot_level IS NOT NULL GROUP BY 1""",
)
def _(spark, folder):
    rows = hotspot_model.training_rows(warehouse(spark, folder)["vw_ml_hotspot_dataset"])
    split = hotspot_model.time_split(rows, TRAIN_UNTIL, VALID_UNTIL)
    return split.groupBy("split").agg(
        F.count("*").alias("row_count"), F.min("snapshot_date").alias("first_day"), F.max("snapshot_date").alias("last_day")
    )


@query("confusion_matrix", f"SELECT actual, predicted, CAST(count(*) AS BIGINT) AS row_count FROM {_NAIVE} GROUP BY 1, 2")
def _(spark, folder):
    return hotspot_model.confusion_matrix(_naive(spark, folder), "target_hotspot_level", "predicted")


@query(
    "macro_f1",
    f"""SELECT (SELECT avg(CASE WHEN actual = predicted THEN 1.0e0 ELSE 0.0e0 END) FROM n) AS accuracy, avg(f1) AS macro_f1 FROM (
      SELECT label, 2.0e0 * sum(tp) / (2 * sum(tp) + sum(fn) + sum(fp)) AS f1 FROM (
        SELECT actual AS label, CASE WHEN actual = predicted THEN 1 ELSE 0 END AS tp, CASE WHEN actual <> predicted THEN 1 ELSE 0 END AS fn, 0 AS fp FROM n
        UNION ALL SELECT predicted, 0, 0, CASE WHEN actual <> predicted THEN 1 ELSE 0 END FROM n) GROUP BY 1)""".replace(" n)", f" {_NAIVE} AS n)").replace(" n\n", f" {_NAIVE} AS n\n"),
    rounded=["accuracy", "macro_f1"],
    digits=6,
)
def _(spark, folder):
    return hotspot_model.macro_f1(hotspot_model.confusion_matrix(_naive(spark, folder), "target_hotspot_level", "predicted"))


def _statistics_sql() -> str:
    """Every statistic recomputed row by row from the rows of earlier days."""
    learnt = f"e.snapshot_date < d.snapshot_date AND e.snapshot_date <= DATE '{TRAIN_UNTIL}'"
    known = "(SELECT * FROM vw_ml_hotspot_dataset WHERE target_hotspot_level IS NOT NULL)"
    parts = []
    for c in hotspot_model.CATEGORICAL:
        shares = [
            f"(count(*) FILTER (e.target_hotspot_level = '{level}') + 1.0e0) / (count(e.snapshot_date) + 3.0e0) AS {hotspot_model.target_name(c, level)}" for level in hotspot_model.LEVELS
        ]
        names = f"(SELECT DISTINCT snapshot_date, {c} FROM {known})"
        parts.append(f"(SELECT d.snapshot_date, d.{c}, {', '.join(shares)} FROM {names} d LEFT JOIN {known} e ON d.{c} IS NOT DISTINCT FROM e.{c} AND {learnt} GROUP BY ALL)")
    joins_ = " ".join(f"JOIN {part} t{i} ON t{i}.snapshot_date = r.snapshot_date AND t{i}.{c} IS NOT DISTINCT FROM r.{c}" for i, (part, c) in enumerate(zip(parts, hotspot_model.CATEGORICAL, strict=True)))
    return f"SELECT r.snapshot_date, r.area_name, r.ward_name, r.street_name, {', '.join(hotspot_model.ENCODED)} FROM {known} r {joins_}"


@query("target_statistics", _statistics_sql(), rounded=hotspot_model.ENCODED, digits=9)
def _(spark, folder):
    rows = hotspot_model.model_rows(warehouse(spark, folder)["vw_ml_hotspot_dataset"], TRAIN_UNTIL, VALID_UNTIL)
    return rows.select("snapshot_date", *hotspot_model.PLACE, *hotspot_model.ENCODED)


_FITTED = f"""SELECT CASE WHEN snapshot_date <= DATE '{TRAIN_UNTIL}' THEN 'train' WHEN snapshot_date <= DATE '{VALID_UNTIL}' THEN 'valid' ELSE 'test' END AS split,
    CAST(count(*) AS BIGINT) AS row_count, true AS metrics_in_range, {len(hotspot_model.NUMERIC + hotspot_model.CATEGORICAL)} AS feature_count, true AS importances_sum_to_one
    FROM vw_ml_hotspot_dataset WHERE target_hotspot_level IS NOT NULL GROUP BY 1"""


def _fitted(spark, folder, **options):
    dataset = warehouse(spark, folder)["vw_ml_hotspot_dataset"]
    scored, weights = hotspot_model.train_and_score(dataset, TRAIN_UNTIL, VALID_UNTIL, **options)
    whole = weights.agg(F.count_distinct("feature").cast("int").alias("feature_count"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("importances_sum_to_one"))
    in_range = F.col("accuracy").between(0, 1) & F.col("macro_f1").between(0, 1)
    return scored.select("split", "row_count", in_range.alias("metrics_in_range")).join(F.broadcast(whole))


@query("hotspot_model_fit", _FITTED)
def _(spark, folder):
    return _fitted(spark, folder, trees=20, depth=6)


@query("hotspot_boosted_fit", _FITTED)
def _(spark, folder):
    return _fitted(spark, folder, boosted=True, trees=12, depth=4)
