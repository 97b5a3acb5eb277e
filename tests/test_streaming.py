"""Streams: equal to their batch twin, restartable, whole when rows are late."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from support import SF, rows
from gable.sources import readers, sinks
from gable.streaming import bronze
from gable.streaming.ledger import IdLedger

SCHEMA = "record_id STRING, id STRING, crawled_at BIGINT, list STRUCT<list_id: BIGINT>, detail STRUCT<ad_id: BIGINT>"
DAY = 86_400_000
DEFAULTS = {"source": "listings", "category": "market_listings", "entity": "market_listing"}


def _put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n", encoding="utf-8")


def _run(spark, source, target, checkpoint, **options):
    stream = readers.read_stream(spark, "json", {"path": str(source), "maxFilesPerTrigger": "1"}, StructType.fromDDL(SCHEMA))
    started = bronze.bronze_stream(
        stream, str(target), str(checkpoint), defaults=DEFAULTS, zone="UTC", trigger={"availableNow": True}, **options
    )
    started.awaitTermination()


def _stored(spark, target):
    return spark.read.schema("record_id STRING, source STRING, pipeline_name STRING, date DATE").json(str(target))


def test_bronze_dedups_restarts_and_keeps_late_rows(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    _put(source, "a.json", [
        {"record_id": "1", "crawled_at": 10 * DAY}, {"record_id": "1", "crawled_at": 10 * DAY + 5},
        {"crawled_at": 10 * DAY}, {"crawled_at": 10 * DAY}, {"list": {"list_id": 7}, "crawled_at": 10 * DAY},
    ])
    _put(source, "b.json", [{"record_id": "1", "crawled_at": 10 * DAY + 9}, {"record_id": "1", "crawled_at": 12 * DAY}])
    _run(spark, source, target, checkpoint)
    first = rows(_stored(spark, target).select("record_id", F.col("date").cast("string")))
    assert first == [("1", "1970-01-11"), ("1", "1970-01-13"), ("7", "1970-01-11"), (None, "1970-01-11"), (None, "1970-01-11")]

    _run(spark, source, target, checkpoint)  # nothing new
    assert rows(_stored(spark, target).select("record_id", F.col("date").cast("string"))) == first

    _put(source, "c.json", [  # repeats, an older day, and id precedence
        {"record_id": "1", "crawled_at": 10 * DAY}, {"record_id": "late", "crawled_at": 1 * DAY},
        {"record_id": "", "list": {"list_id": 0}, "detail": {"ad_id": 5}, "id": "x", "crawled_at": 12 * DAY},
    ])
    _run(spark, source, target, checkpoint)
    added = rows(_stored(spark, target).select("record_id", F.col("date").cast("string")))
    assert len(added) == len(first) + 2
    assert ("late", "1970-01-02") in added and ("5", "1970-01-13") in added
    stamped = _stored(spark, target).select("source", "pipeline_name").distinct().collect()
    assert [tuple(r) for r in stamped] == [("listings", "records_to_bronze")]


def test_late_rows_go_to_their_own_folder_once(spark, tmp_path):
    source, target, late = tmp_path / "in", tmp_path / "out", tmp_path / "late"
    _put(source, "a.json", [{"record_id": "new", "crawled_at": 100 * DAY}])
    _run(spark, source, target, tmp_path / "cp", late=str(late), horizon_days=3)
    for name in ("b.json", "c.json"):
        _put(source, name, [{"record_id": "old", "crawled_at": 5 * DAY}, {"record_id": "near", "crawled_at": 98 * DAY}])
    _run(spark, source, target, tmp_path / "cp", late=str(late), horizon_days=3)
    assert rows(_stored(spark, target), "record_id") == [("near",), ("new",)]
    assert rows(_stored(spark, late), "record_id") == [("old",)]


def test_stream_writes_compressed_files(spark, tmp_path):
    source, target, late = tmp_path / "in", tmp_path / "out", tmp_path / "late"
    _put(source, "a.json", [{"record_id": "new", "crawled_at": 100 * DAY}])
    _run(spark, source, target, tmp_path / "cp", late=str(late), compression="gzip")
    _put(source, "b.json", [{"record_id": "old", "crawled_at": 5 * DAY}, {"record_id": "new", "crawled_at": 100 * DAY}])
    _run(spark, source, target, tmp_path / "cp", late=str(late), compression="gzip")
    assert rows(_stored(spark, target), "record_id") == [("new",)] and rows(_stored(spark, late), "record_id") == [("old",)]
    assert not list(target.glob("date=*/*.json")) and not list(late.glob("date=*/*.json"))


def test_stream_input_is_read_in_two_batches_of_files_of_bounded_size(spark, monkeypatch, tmp_path):
    from gable.catalog import feeds

    monkeypatch.setattr(feeds, "FILE_RECORDS", 1000)
    monkeypatch.setattr(feeds, "_written", {})
    stream = feeds._record_stream(spark, SF)
    batches = []
    started = stream.writeStream.foreachBatch(lambda batch, _: batches.append(batch.count()))
    started.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    files = len(spark.read.text(next(iter(feeds._written.values()))).inputFiles())
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert files == lines // 1000 and len([b for b in batches if b]) in (2, 3) and sum(batches) == feeds.nested_records(spark, SF).count()


def test_replayed_batch_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([("1", 5), ("2", 5)], "record_id string, crawled_at long").withColumn("date", F.lit("2024-01-01").cast("date"))
    target = str(tmp_path / "out")
    bronze.append_batch(batch, target)
    bronze.append_batch(batch, target)
    assert _stored(spark, target).count() == 2


def test_micro_batches_leave_nothing_staged(spark, tmp_path):
    from pathlib import Path

    from gable.runtime import shared_dir

    staged = Path(shared_dir(spark)) / f"gable-{spark.sparkContext.applicationId}"
    before = {p.name for p in staged.iterdir()} if staged.exists() else set()
    source, target = tmp_path / "in", tmp_path / "out"
    for i in range(20):
        _put(source, f"{i:02d}.json", [{"record_id": f"r{i % 7}", "crawled_at": DAY}, {"record_id": f"n{i}", "crawled_at": 2 * DAY}])
    _run(spark, source, target, tmp_path / "cp")
    assert _stored(spark, target).count() == 27
    assert {p.name for p in staged.iterdir()} <= before


def _events(spark, tmp_path):
    source = tmp_path / "events"
    base = spark.createDataFrame(
        [(i, i * 3600, f"u{i % 5}", float(i)) for i in range(24 * 6)], "id long, sec long, user string, value double"
    ).select("id", F.timestamp_seconds("sec").alias("ts"), "user", "value")
    for day in range(6):
        base.filter(F.floor(F.unix_timestamp("ts") / 86400) == day).coalesce(1).write.mode("append").parquet(str(source))
    return base, readers.read_stream(spark, "parquet", {"path": str(source), "maxFilesPerTrigger": "1"}, base.schema)


def _drain(spark, frame, tmp_path, name):
    out = str(tmp_path / name)
    started = (
        frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-cp")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(frame.schema).parquet(out)


def test_overview_stream_equals_batch_for_closed_days(spark, tmp_path):
    base, stream = _events(spark, tmp_path)
    got = rows(_drain(spark, bronze.overview_stream(stream, "ts", "user", "value"), tmp_path, "o"))
    expected = rows(bronze.overview(base, "ts", "user", "value"))
    assert got and got == expected[: len(got)] and len(got) >= len(expected) - 1


def test_overview_in_update_mode_rewrites_only_changed_days(spark, tmp_path):
    base, stream = _events(spark, tmp_path)
    out, written = str(tmp_path / "running"), []

    def write(batch, _):
        written.append(batch.count())
        sinks.replace_partitions(batch, out, "snapshot_date")

    running = bronze.overview(stream, "ts", "user", "value", approx=True)
    running.writeStream.outputMode("update").option("checkpointLocation", f"{out}-cp").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    assert sum(written) == 6  # each day once, and not all days so far in each of six batches
    got = spark.read.schema(running.schema).parquet(out)
    assert rows(got, "snapshot_date", "row_count", "value_avg") == rows(bronze.overview(base, "ts", "user", "value"), "snapshot_date", "row_count", "value_avg")


def test_stateful_dedup_keeps_rows_without_id(spark, tmp_path):
    _, stream = _events(spark, tmp_path)
    keyed = stream.withColumns({"date": F.to_date("ts"), "record_id": F.when(F.col("user") != "u0", F.col("user"))})
    got = _drain(spark, bronze.dedup_stream(keyed, "ts", ["date", "record_id"], "record_id"), tmp_path, "d")
    counted = got.groupBy("record_id").count()
    per_id = {r["record_id"]: r["count"] for r in counted.collect()}
    assert per_id[None] == 29 and all(per_id[f"u{i}"] == 6 for i in range(1, 5))


def _batch(spark, ids, day="2024-01-01"):
    return spark.createDataFrame([(str(i),) for i in ids], "record_id string").withColumn("date", F.lit(day).cast("date"))


def _pairs(frame):
    return [] if frame is None else sorted({(str(r.date), r.record_id) for r in frame.collect()})


def test_ledger_bounds_files_and_bytes_over_many_batches(spark, tmp_path):
    ledger = IdLedger(spark, str(tmp_path / "ids"), bucket_ids=100, max_recent=4, max_files=3)
    sizes = []
    for n in range(50):
        batch = _batch(spark, range(n * 40, n * 40 + 60)).coalesce(1)  # 20 of them are in the next batch too
        if n % 7 == 0:
            read, held = set(ledger.buckets_of(_batch(spark, [n * 40]))), ledger.dates(["2024-01-01"])["2024-01-01"]
            sizes.append((sum(b.size for b in held if b.path in read), sum(b.size for b in held)))
        ledger.add(batch)
        assert len(ledger.recent()) <= 4
        assert all(b.files <= 3 for b in ledger.dates(["2024-01-01"])["2024-01-01"])
    held = ledger.dates(["2024-01-01"])["2024-01-01"]
    assert len({b.generation for b in held}) == 1 and {b.of for b in held} == {32} and len(held) <= 32
    # what one id reads does not grow with the ids of its date
    assert all(a <= 10_000 for a, _ in sizes) and sizes[-1][0] < sizes[-1][1] / 10
    everything = _batch(spark, range(49 * 40 + 60))
    assert _pairs(ledger.may_hold(everything)) == sorted(("2024-01-01", str(i)) for i in range(49 * 40 + 60))


def test_ledger_reads_only_dates_and_buckets_of_the_batch(spark, tmp_path):
    ledger = IdLedger(spark, str(tmp_path / "ids"), bucket_ids=10, max_recent=0)
    for day in ("2024-01-01", "2024-01-02"):
        ledger.add(_batch(spark, range(80), day))
    assert not ledger.recent()
    one = _batch(spark, [5])
    assert len(ledger.buckets_of(one)) == 1 and "date=2024-01-01" in ledger.buckets_of(one)[0]
    assert ("2024-01-01", "5") in _pairs(ledger.may_hold(one))
    assert ledger.buckets_of(_batch(spark, [5], "2024-03-01")) == []
    assert ledger.may_hold(_batch(spark, [None])) is None or _pairs(ledger.may_hold(one.limit(0))) == []


def test_ledger_makes_and_lists_few_folders_of_small_buckets(spark, tmp_path, monkeypatch):
    from gable.streaming import ledger as module

    days = [f"2024-01-0{n}" for n in range(1, 5)]
    batch = spark.range(400).select(F.col("id").cast("string").alias("record_id"), F.explode(F.array(*[F.lit(day).cast("date") for day in days])).alias("date"))
    ledger = IdLedger(spark, str(tmp_path / "ids"), bucket_ids=1, max_recent=0)
    ledger.add(batch.where("CAST(record_id AS INT) < 350"))
    ledger.add(batch.where("CAST(record_id AS INT) >= 300"))
    calls = []
    real = module.file_system
    monkeypatch.setattr(module, "file_system", lambda *args: (calls.append(args), real(*args))[1])
    held = ledger.dates([*days, "2024-03-01"])
    assert [len(held[day]) for day in days] == [32] * 4 and held["2024-03-01"] == []
    assert sum(b.files for b in held[days[0]]) <= 64 and all(b.size > 0 for b in held[days[0]])
    assert _pairs(ledger.may_hold(batch)) == sorted((day, str(i)) for day in days for i in range(400))
    assert len(calls) <= 4  # folders are not listed one by one
    assert ledger.buckets_for(100 << 16) == 128 and ledger.buckets_for(1 << 30) == 256


def test_ledger_survives_a_crash_within_maintenance(spark, tmp_path, monkeypatch):
    ledger = IdLedger(spark, str(tmp_path / "ids"), bucket_ids=20, max_recent=1, max_files=1)
    ledger.add(_batch(spark, range(10)))
    ledger.add(_batch(spark, range(10, 20)))  # folded
    ledger.add(_batch(spark, range(15, 60)))
    from gable.streaming import ledger as module

    def broken(spark, path):  # the new files are written, nothing old is deleted
        system, at = real(spark, path)
        if broken.armed and "/recent/" in path:
            raise OSError("lost")
        return system, at

    real, broken.armed = module.file_system, True
    monkeypatch.setattr(module, "file_system", broken)
    try:
        ledger.fold()
    except OSError:
        pass
    broken.armed = False
    want = [("2024-01-01", str(i)) for i in range(60)]
    assert _pairs(ledger.may_hold(_batch(spark, range(60)))) == sorted(want)
    ledger.fold()
    held = ledger.dates(["2024-01-01"])["2024-01-01"]
    assert not ledger.recent() and len({b.generation for b in held}) == 1 and {b.of for b in held} <= {4, 8}
    assert _pairs(ledger.may_hold(_batch(spark, range(60)))) == sorted(want)


def test_batches_with_a_small_ledger_store_every_id_once(spark, tmp_path):
    target = str(tmp_path / "out")
    ledger = IdLedger(spark, f"{target}/{bronze.LEDGER}", bucket_ids=8, max_recent=1, max_files=2)
    for n in range(6):
        batch = spark.createDataFrame([(str(i % 40), i) for i in range(n * 9, n * 9 + 15)] + [(None, n)], "record_id string, crawled_at long")
        batch = batch.withColumn("date", F.expr("date_add(DATE '2024-01-01', CAST(crawled_at % 2 AS INT))"))
        for _ in range(2):  # a batch may be delivered again
            bronze.append_batch(batch, target, ledger=ledger, verify=False)
    stored = _stored(spark, target)
    ids = rows(stored.where("record_id IS NOT NULL").select(F.col("date").cast("string"), "record_id"))
    assert ids == sorted({(f"2024-01-0{1 + i % 2}", str(i % 40)) for n in range(6) for i in range(n * 9, n * 9 + 15)})
