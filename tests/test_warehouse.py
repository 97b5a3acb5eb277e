"""Whole jobs: integrity, plans, contract, SQL twins."""

import pytest
from pyspark.sql import functions as F

from support import SF, rows
from gable.operators import joins
from gable.plans import hotspot_model
from gable.plans.questions import QUESTIONS
from gable.plans.views import VIEWS


def test_keys_are_dense_and_unique(tables):
    for name, key in {"dim_location": "location_key", "dim_property": "property_key", "dim_seller": "seller_key", "dim_metro_station": "station_key"}.items():
        dim = tables[name]
        low, high, n, distinct = dim.agg(F.min(key), F.max(key), F.count("*"), F.count_distinct(key)).first()
        assert (low, high) == (1, n) and distinct == n
        assert joins.pk_violations(dim, key).isEmpty()


def test_facts_keep_their_grain_and_their_keys(tables):
    silver_rows = tables["silver_listings"].count()
    fact = tables["fact_properties"]
    assert fact.count() == silver_rows > 0
    for key, dim in {"location_key": "dim_location", "property_key": "dim_property", "seller_key": "dim_seller", "time_key": "dim_time"}.items():
        assert joins.fk_violations(fact, tables[dim], key).isEmpty()
        assert fact.filter(F.col(key).isNull()).isEmpty()
    metro = tables["fact_metro_analysis"]
    assert metro.groupBy("ad_id", "list_id", "snapshot_date").count().filter("count > 1").isEmpty()
    monthly = tables["fact_price_area_time"]
    assert monthly.groupBy("area_name", "category_name", "time_key").count().filter("count > 1").isEmpty()


def test_approximate_mode_builds_the_same_shape(spark):
    from gable.plans import adapter
    from gable.plans.warehouse import Warehouse

    quick = Warehouse(spark, adapter.listings(spark, SF), adapter.stations(spark, SF), adapter.trends(spark, SF), exact=False)
    assert quick["fact_properties"].count() == quick["silver_listings"].count() > 0


def test_views_register_for_sql(spark, tables):
    tables.register()
    assert spark.sql("SELECT * FROM vw_market_overview_daily_analysis ORDER BY listing_count DESC LIMIT 10").count() == 10
    assert spark.sql("SELECT count(*) FROM vw_hotspot_analysis WHERE hotspot_level = 'High'").first()[0] >= 0
    assert set(VIEWS) <= {t.name for t in spark.catalog.listTables()}


def test_ratio_definition_may_exceed_one(tables):
    """Type counts are rows, the base is distinct listings; the ratio follows the definition."""
    daily = tables["vw_market_overview_daily_analysis"]
    wrong = daily.filter(F.abs(F.col("apt_ratio") - F.col("apt_count") / F.col("listing_count")) > 1e-12)
    assert wrong.isEmpty()


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in VIEWS])
def test_view_plans_stay_native(tables, name):
    plan = _plan(tables[name])
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Exchange SinglePartition" not in plan


def test_fact_scan_reads_only_needed_columns(tables):
    plan = _plan(tables["vw_market_overview_daily"])
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "quality_score" not in schema and "list_id" in schema


def test_all_questions_answer(tables):
    assert len(QUESTIONS) == 39
    for key in ("q11", "q20", "q26", "q29", "q37", "q38"):
        answer = QUESTIONS[key].run(tables)
        assert answer.columns


def test_macro_f1_by_hand(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    frame = spark.createDataFrame(pairs, "actual string, predicted string")
    got = hotspot_model.macro_f1(hotspot_model.confusion_matrix(frame, "actual", "predicted")).first()
    f1 = [2 * 3 / (2 * 3 + 1 + 1), 2 * 2 / (2 * 2 + 0 + 1), 0.0]
    assert got["accuracy"] == pytest.approx(5 / 7) and got["macro_f1"] == pytest.approx(sum(f1) / 3)


def test_target_statistics_know_only_earlier_days(spark):
    days = [(d, name, level) for d, name, level in [(1, "x", "Low"), (1, "x", "High"), (2, "x", "High"), (4, "x", "Low"), (2, None, "Low"), (3, None, "High"), (1, "y", "High"), (9, "x", "High")]]
    frame = spark.createDataFrame(days, "d int, name string, level string").withColumn("day", F.expr("date_add(DATE '2024-01-01', d)"))
    got = hotspot_model.target_statistics(frame, F.col("d") < 4, ["name"], "level", ["Low", "High"], "day", prior_rows=2.0)
    for r in got.collect():
        earlier = [level for d, name, level in days if name == r.name and d < r.d and d < 4]
        assert r["name__low"] == pytest.approx((earlier.count("Low") + 1) / (len(earlier) + 2))
        assert r["name__high"] == pytest.approx((earlier.count("High") + 1) / (len(earlier) + 2))
    assert got.count() == len(days)


def test_statistics_of_a_day_do_not_depend_on_its_targets(spark, tables):
    rows_ = hotspot_model.model_rows(tables["vw_ml_hotspot_dataset"], "2024-03-15", "2024-04-07")
    last = rows_.agg(F.max("snapshot_date")).first()[0]
    plain = rows_.drop(*hotspot_model.ENCODED)
    turned = plain.withColumn("target_hotspot_level", F.when(F.col("snapshot_date") == last, "High").otherwise(F.col("target_hotspot_level")))
    again = hotspot_model.target_statistics(turned, F.lit(True))
    first = hotspot_model.target_statistics(plain, F.lit(True))
    assert rows(again, *hotspot_model.PLACE, "snapshot_date", *hotspot_model.ENCODED) == rows(first, *hotspot_model.PLACE, "snapshot_date", *hotspot_model.ENCODED)


@pytest.mark.parametrize("options", [{"trees": 5, "depth": 3}, {"boosted": True, "trees": 2, "depth": 2}])
def test_model_fits_and_ranks_features(tables, options):
    rows_ = hotspot_model.model_rows(tables["vw_ml_hotspot_dataset"], "2024-03-15", "2024-04-07")
    model = hotspot_model.fit(rows_.filter("split = 'train'"), **options)
    ranked = hotspot_model.importances(model)
    assert len(ranked) == 52 and ranked[0][1] > 0 and sum(w for _, w in ranked) == pytest.approx(1)
    scored = hotspot_model.predict(model, rows_.filter("split = 'test'"))
    assert {r[0] for r in scored.select("predicted_level").distinct().collect()} <= set(hotspot_model.LEVELS)


@pytest.mark.parametrize("case", ["no training rows", "columns without values", "two rows of one level"])
def test_model_of_a_poor_training_period(spark, tables, case):
    dataset = tables["vw_ml_hotspot_dataset"]
    early = F.col("snapshot_date") <= F.lit("2024-03-15").cast("date")
    if case == "no training rows":
        dataset = dataset.where(~early)
    elif case == "columns without values":
        dataset = dataset.withColumns({c: F.when(~early, F.col(c)) for c in ("price_per_m2_lag_1", "nearest_metro_distance_m")})
    else:
        few = dataset.where(early & (F.col("target_hotspot_level") == "Low")).orderBy("snapshot_date", *hotspot_model.PLACE).limit(2)
        dataset = dataset.where(~early).unionByName(few)
    scored, weights = hotspot_model.train_and_score(dataset, "2024-03-15", "2024-04-07", boosted=True, trees=2, depth=2)
    expected = hotspot_model.time_split(hotspot_model.training_rows(dataset), "2024-03-15", "2024-04-07").groupBy("split").count()
    assert rows(scored, "split", "row_count") == rows(expected)
    assert all(0 <= r.accuracy <= 1 and 0 <= r.macro_f1 <= 1 for r in scored.collect())
    found = [r.importance for r in weights.collect()]
    assert len(found) == 52 and sum(found) == pytest.approx(1)


def test_model_job_stores_scores_and_weights(spark, tables):
    dataset = tables["vw_ml_hotspot_dataset"]
    hotspot_model.job_hotspot_model(dataset, "2024-03-15", "2024-04-07", "model_scores", "model_weights", trees=2, depth=2)
    assert {r.split for r in spark.table("model_scores").collect()} <= {"train", "valid", "test"}
    assert spark.table("model_weights").count() == 52
    for name in ("model_scores", "model_weights"):
        spark.sql(f"DROP TABLE {name}")


def test_contract_and_flagship(spark):
    import __spark_entry__ as entry

    built, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(built)
    ours = {name for name in built if not name.startswith("op") and name != "pipeline"}
    assert ours <= set(sql)
    assert entry.entry(spark).count() == 10


SAMPLED = [
    "type_flags", "extract_number", "dedup_latest_by_id", "percent_rank_in_group", "iqr_outliers", "silver_listings", "fact_properties",
    "fact_metro_analysis", "v_market_trend_analysis", "v_hotspot_analysis", "v_ml_dataset", "salted_key_lookup", "append_if_new_fp",
    "stream_to_bronze", "q01", "q27", "q34", "q39",
]


@pytest.mark.parametrize("name", SAMPLED)
def test_sql_twin(spark, name):
    """Spark and DuckDB agree; ``tools/compare.py`` runs every query."""
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
    from compare import compare, connect

    import __spark_entry__ as entry

    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]).startswith("ok")


def test_silver_job_is_incremental_and_quiet_without_input(spark, tmp_path):
    from gable.catalog.jobs import _records
    from gable.plans import jobs
    from gable.sources import sinks

    records = _records(spark, SF)
    schema = records.drop("date").schema
    path = str(tmp_path / "bronze")
    sinks.write_jsonl(records, path)
    catalog = jobs.Catalog(spark, "gable_incremental", root=str(tmp_path / "silver"))
    assert jobs.listings_to_silver(catalog, str(tmp_path / "absent"), schema) == 0
    first = jobs.listings_to_silver(catalog, path, schema, date="2024-02-01")
    codes = {r["label"]: r["code"] for r in catalog.read("area_codes").collect()}
    assert first == catalog.read("listings").count() > 0
    second = jobs.listings_to_silver(catalog, path, schema)
    stored = catalog.read("listings")
    assert stored.count() == first + second
    assert stored.groupBy("content_fp").count().filter("count > 1").isEmpty()
    grown = {r["label"]: r["code"] for r in catalog.read("area_codes").collect()}
    assert all(grown[label] == code for label, code in codes.items()) and len(grown) >= len(codes)
    assert jobs.listings_to_silver(catalog, path, schema) == 0


def test_cleaning_moves_and_stores_fingerprints_as_bytes(spark, monkeypatch):
    from gable.plans import silver
    from gable.plans.adapter import listings

    staged, plain = {}, silver.stage
    monkeypatch.setattr(silver, "stage", lambda df, label: staged.setdefault(label, df.schema["content_fp"].dataType.simpleString()) and plain(df, label))
    clean = silver.clean_listings(listings(spark, SF))[0]
    assert staged == {"unique": "binary"}
    assert clean.schema["content_fp"].dataType.simpleString() == "string"
    expected = {r.list_id: r.content_fp for r in silver.with_fingerprint(silver.dedup_by_id(listings(spark, SF))).select("list_id", "content_fp").collect()}
    stored = clean.select("list_id", "content_fp").collect()
    assert stored and all(expected[r.list_id] == r.content_fp for r in stored)


def test_dedup_by_place_does_not_find_outliers_again(spark, monkeypatch):
    """Rows within the bounds are marked before the dedup reads them, and labels are read once."""
    from gable.operators import quality
    from gable.plans import silver
    from gable.plans.adapter import listings

    read, plain, labels, mapped = [], silver.dedup_by_place, [], quality.label_map
    monkeypatch.setattr(silver, "dedup_by_place", lambda df, *a, **o: read.append(df) or plain(df, *a, **o))
    monkeypatch.setattr(quality, "label_map", lambda df, column: labels.append(df) or mapped(df, column))
    silver.clean_listings(listings(spark, SF))
    plan = read[0]._jdf.queryExecution().analyzed().toString()
    assert "upper_bound" not in plan and "__kept" in plan
    assert len(labels) == 2 and all(df.columns == ["area_name", "ward_name", "category_name"] for df in labels)


def test_records_of_the_silver_job_are_compressed(spark, monkeypatch):
    from gable.catalog import feeds, jobs as job_queries
    from gable.sources import sinks

    written = []
    monkeypatch.setattr(feeds, "_written", {})
    plain = sinks.write_jsonl
    monkeypatch.setattr(sinks, "write_jsonl", lambda df, path, **options: written.append(path) or plain(df, path, **options))
    job_queries._silver(spark, SF)
    files = spark.read.text(f"{written[0]}/date=*").inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


def _scratch(spark):
    from pathlib import Path

    from gable.runtime import shared_dir

    folder = Path(shared_dir(spark)) / f"gable-{spark.sparkContext.applicationId}"
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


@pytest.mark.parametrize("absent", [["company_ad"], ["rooms"], ["width"], ["number_of_images"], ["company_ad", "rooms", "width", "number_of_images", "category_name", "latitude"]])
def test_silver_job_with_absent_fields(spark, tmp_path, absent):
    from pyspark.sql import functions as F

    from gable.catalog.jobs import _records
    from gable.plans import jobs
    from gable.sources import sinks

    records = _records(spark, SF).limit(200)
    records = records.withColumn("list", F.col("list").dropFields(*absent))
    sinks.write_jsonl(records, str(tmp_path / "bronze"))
    catalog = jobs.Catalog(spark, f"gable_absent_{len(absent)}_{absent[0]}", root=str(tmp_path / "silver"))
    before = _scratch(spark)
    assert jobs.listings_to_silver(catalog, str(tmp_path / "bronze"), records.drop("date").schema) > 0
    assert _scratch(spark) <= before
    stored = catalog.read("listings")
    if "company_ad" in absent:
        assert stored.where("is_company_ad = 1 OR is_personal_ad = 1").isEmpty()
    if "rooms" in absent:
        assert stored.where("rooms <> 0").isEmpty()
    gold = jobs.silver_to_gold(catalog, jobs.Catalog(spark, f"{catalog.namespace}_gold", root=str(tmp_path / "gold"))) if absent == ["width"] else None
    if gold is not None:  # neither stations nor search interest are there
        gold.register()
        assert spark.sql("SELECT count(*) AS n FROM vw_hotspot_analysis").first()["n"] >= 0
        assert "vw_metro_impact_analysis" not in list(gold) and "fact_properties" in list(gold)
