"""Trend ingestion: windows from stored marks, restart after a stop at every step."""

import datetime

import pytest
from pyspark.sql import functions as F
from support import SF, rows

from gable.catalog.jobs import INTEREST_SCHEMA, interest_source
from gable.plans import jobs
from gable.runtime import scratch_path


@pytest.fixture
def catalog(spark):
    root = scratch_path(spark, "trend-test")
    name = root.rsplit("/", 1)[-1].replace("-", "_") + spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    return jobs.Catalog(spark, f"gable_{name}", root=root)


def _run(catalog, today, groups=("hcm_real_estate",)):
    source = interest_source(catalog.spark, SF, today)
    return jobs.ingest_trends(catalog, f"{catalog.root}-records", source, groups, today, INTEREST_SCHEMA, initial="2024-01-05", window_days=10)


def _plan(catalog, today, groups):
    return rows(jobs.plan_trends(catalog, groups, today, initial="2024-01-05", window_days=10, lookback_days=7).select("keyword_group", "load_type", F.col("window_start").cast("string"), F.col("window_end").cast("string")))


def test_windows_follow_the_marks_of_each_group(spark, catalog):
    assert _plan(catalog, "2024-01-20", ["a"]) == [("a", "initial", "2024-01-05", "2024-01-15"), ("a", "initial", "2024-01-15", "2024-01-21")]
    marks = spark.createDataFrame([("a", datetime.date(2024, 1, 19)), ("b", datetime.date(2024, 1, 3))], "keyword_group string, high_water date")
    catalog.replace(marks, "trend_marks")
    got = _plan(catalog, "2024-01-20", ["a", "b", "new"])
    assert [r[:3] for r in got if r[0] == "a"] == [("a", "daily", "2024-01-13")]
    assert [r[2] for r in got if r[0] == "b"] == ["2024-01-03", "2024-01-13"]  # no day since the mark is left out
    assert [r[1:3] for r in got if r[0] == "new"] == [("initial", "2024-01-05"), ("initial", "2024-01-15")]


@pytest.mark.parametrize("stop", ["trend_batches", "trends_daily", "trend_marks"])
def test_a_stopped_run_is_repeated_without_repeats(catalog, monkeypatch, stop):
    assert _run(catalog, "2024-01-20") == 15  # the last day is not complete
    plain = {name: getattr(jobs.Catalog, name) for name in ("append_new", "replace")}

    def broken(name):
        def step(self, df, table, *args, **kwargs):
            if table == stop:
                raise OSError("stopped")
            return plain[name](self, df, table, *args, **kwargs)

        return step

    for name in plain:
        monkeypatch.setattr(jobs.Catalog, name, broken(name))
    with pytest.raises(OSError):
        _run(catalog, "2024-01-24")
    monkeypatch.undo()
    _run(catalog, "2024-01-24")
    stored = catalog.read("trends_daily")
    assert rows(stored.groupBy("date").count().where("count > 1")) == [] and stored.count() == 19
    batches = catalog.read("trend_batches")
    assert batches.count() == batches.select("batch_id").distinct().count() == 2
    assert rows(catalog.read("trend_marks").select(F.col("high_water").cast("string"))) == [("2024-01-24",)]


def test_a_group_without_rows_changes_nothing(catalog):
    assert _run(catalog, "2024-01-20", ["unknown"]) == 0
    assert not catalog.exists("trend_marks") and not catalog.exists("trends_daily")
