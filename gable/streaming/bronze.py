"""Streams of listing records into the bronze layer.

The writer needs no state store: each micro-batch is reduced to one row per
(date, id) and compared with a ledger of the ids stored so far, so late and
out-of-order rows are never dropped and a replayed batch adds nothing.
:func:`dedup_stream` is the stateful alternative for rows that arrive in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from gable.functions import dates, text
from gable.runtime import file_system, fits_broadcast, stage, temporary
from gable.sources.readers import read_jsonl_glob
from gable.sources.sinks import write_jsonl
from gable.streaming.ledger import IdLedger

ZONE = "Asia/Ho_Chi_Minh"


def record_id(columns: Sequence[str]) -> Column:
    """Record id as text: top level, then ``list``, then ``detail``, then ``id``.

    ``columns`` are the dotted paths the record schema has.
    """
    order = ["record_id", "list.list_id", "detail.list_id", "detail.ad_id", "id"]
    return text.first_non_empty(*[F.col(c) for c in order if c in columns])


def dotted_columns(df: DataFrame) -> list[str]:
    """Top-level names plus the fields of top-level structs."""
    paths = list(df.columns)
    for field in df.schema.fields:
        if hasattr(field.dataType, "fields"):
            paths += [f"{field.name}.{f.name}" for f in field.dataType.fields]
    return paths


def with_identity(records: DataFrame, zone: str = ZONE) -> DataFrame:
    """Add the event ``date`` of the zone and the text ``record_id``."""
    stamps = [F.col(c) for c in ("crawled_at", "ingested_at") if c in records.columns]
    day = dates.event_date(*stamps, zone=zone)
    return records.withColumns({"date": day, "record_id": record_id(dotted_columns(records))})


def enrich(records: DataFrame, defaults: Mapping[str, str], *, ingestion_type: str, pipeline_name: str) -> DataFrame:
    """Fill source fields that are absent or null, stamp the step, keep earlier metadata nested."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in records.columns else F.lit(v) for c, v in defaults.items()
    }
    upstream = F.col("metadata") if "metadata" in records.columns else F.lit(None).cast("string")
    stamped = {"ingestion_type": F.lit(ingestion_type), "pipeline_name": F.lit(pipeline_name), "upstream_metadata": upstream}
    return records.withColumns({**filled, **stamped})


def numbered(batch: DataFrame) -> DataFrame:
    """Adds ``__row``, to name a row, and ``__tie``, a hash of its content."""
    content = [F.col(c) for c, kind in batch.dtypes if "map<" not in kind]
    return batch.withColumns({"__row": F.monotonically_increasing_id(), "__tie": F.xxhash64(*content)})


def repeats(rows: DataFrame, stamp: str = "crawled_at") -> DataFrame:
    """``date, record_id, __row, __rank`` of numbered rows with an id; all but rank 1 of a (date, id) repeat it.

    The earliest stamp is first. Only these columns are read and shuffled, however wide the records are.
    """
    stamps = [F.col(stamp).alias("__stamp")] if stamp in rows.columns else []
    narrow = rows.where(F.col("record_id").isNotNull()).select("date", "record_id", "__row", "__tie", *stamps)
    order = [*[F.col("__stamp").asc_nulls_last() for _ in stamps], F.col("__tie"), F.col("__row")]
    ranked = narrow.withColumn("__rank", F.row_number().over(Window.partitionBy("date", "record_id").orderBy(*order)))
    return ranked.select("date", "record_id", "__row", "__rank")


#: Folder of the ids written so far, hidden from readers of the records.
LEDGER = "_ids"


def append_batch(
    batch: DataFrame,
    target: str,
    *,
    max_records: int = 10_000,
    late: str | None = None,
    horizon_days: int = 1,
    verify: bool = True,
    ledger: IdLedger | None = None,
    compression: str | None = None,
) -> None:
    """Write the rows of one micro-batch that are not stored yet.

    Stored ids are read from a ledger below ``target``: of the dates of the batch, the
    buckets its ids fall into. The ledger is written after the records, so a crash in
    between leaves it short; with ``verify`` the records of those dates are
    read as well. With ``late`` set, rows of dates more than ``horizon_days``
    before the newest stored date go to that folder instead. ``compression`` is
    that of the files written. What the batch stages is deleted at its end.
    """
    ledger = ledger or IdLedger(batch.sparkSession, f"{target}/{LEDGER}")
    with temporary(batch.sparkSession):
        _append_batch(batch, target, max_records, late, horizon_days, verify, ledger, compression)


def _append_batch(
    batch: DataFrame, target: str, max_records: int, late: str | None, horizon_days: int, verify: bool, ledger: IdLedger, compression: str | None
) -> None:
    spark = batch.sparkSession
    rows = stage(numbered(batch), "micro-batch")
    ranked = stage(repeats(rows), "ranked")
    ids = ranked.where("__rank = 1").select("date", "record_id", "__row")
    out = ranked.where("__rank > 1").select("__row")
    pair = ["date", "record_id"]
    for stored in _stored(spark, target, late, ids, verify, ledger):
        if fits_broadcast(ranked):
            # stored ids are looked at where they lie; only those of the batch move on
            stored = stored.join(F.broadcast(ids.select(*pair)), pair, "left_semi")
        out = out.unionByName(ids.join(stored, pair, "left_semi").select("__row"))
    out = stage(out.distinct(), "known")
    side = F.broadcast(out) if fits_broadcast(out) else out
    fresh = rows.join(side, "__row", "left_anti").drop("__row", "__tie")
    newest = _newest_date(spark, target) if late else None
    if newest:
        is_late = F.coalesce(F.col("date") < F.date_sub(F.lit(newest).cast("date"), horizon_days), F.lit(False))
        write_jsonl(fresh.filter(is_late), late, max_records=max_records, compression=compression)
        fresh = fresh.filter(~is_late)
    write_jsonl(fresh, target, max_records=max_records, compression=compression)
    ledger.add(ids.join(side, "__row", "left_anti"))


def _stored(spark, target: str, late: str | None, ids: DataFrame, verify: bool, ledger: IdLedger) -> list[DataFrame]:
    """(date, record_id) frames that hold every stored pair of ``ids``."""
    known = ledger.may_hold(ids)
    frames = [known] if known is not None else []
    if verify:
        days = [r[0] for r in ids.select(F.col("date").cast("string")).distinct().collect()]
        kept = F.col("date").cast("string").isin(*days) & F.col("record_id").isNotNull()
        for folder in filter(None, (target, late)):
            if has_files(spark, folder):
                frames.append(spark.read.schema("record_id string, date date").json(folder).filter(kept).select("date", "record_id"))
    return frames


def has_files(spark, folder: str) -> bool:
    """True when the folder exists."""
    system, path = file_system(spark, folder)
    return system.exists(path)


def _newest_date(spark, folder: str) -> str | None:
    """Newest ``date=`` folder; a listing, no data is read."""
    system, path = file_system(spark, folder)
    if not system.exists(path):
        return None
    names = [s.getPath().getName() for s in system.listStatus(path)]
    days = [n.removeprefix("date=") for n in names if n.startswith("date=")]
    return max(days, default=None)


def bronze_stream(
    records: DataFrame,
    target: str,
    checkpoint: str,
    *,
    defaults: Mapping[str, str],
    zone: str = ZONE,
    late: str | None = None,
    horizon_days: int = 1,
    max_records: int = 10_000,
    trigger: Mapping[str, object] | None = None,
    compression: str | None = None,
) -> StreamingQuery:
    """Start the record stream into ``target`` below ``date=`` folders."""
    ready = enrich(
        with_identity(records, zone), defaults, ingestion_type="stream_to_bronze", pipeline_name="records_to_bronze"
    )

    verified = False

    def write(batch: DataFrame, _: int) -> None:
        nonlocal verified
        append_batch(
            batch, target, max_records=max_records, late=late, horizon_days=horizon_days, verify=not verified, compression=compression
        )
        verified = True

    return (
        ready.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def dedup_stream(df: DataFrame, stamp: str, keys: Sequence[str], id_column: str, horizon: str = "1 day") -> DataFrame:
    """Stateful dedup: a key is remembered for ``horizon`` of event time.

    Rows of one calendar date lie within a day of each other, so one day is
    exact for keys that include the date. Rows without an id pass. Rows older
    than the watermark are dropped by the state store; use the bronze writer
    where late rows matter.
    """
    marked = df.withWatermark(stamp, horizon)
    known = marked.filter(F.col(id_column).isNotNull()).dropDuplicatesWithinWatermark(list(keys))
    return known.unionByName(marked.filter(F.col(id_column).isNull()))


def overview(df: DataFrame, stamp: str, seller: str, value: str, *, approx: bool = False) -> DataFrame:
    """Daily rows, distinct sellers and mean value; streams need ``approx``."""
    distinct = F.approx_count_distinct(seller) if approx else F.count_distinct(seller)
    day = F.window(stamp, "1 day")
    grouped = df.groupBy(day).agg(
        F.count("*").alias("row_count"), distinct.alias("unique_seller_count"), F.avg(value).alias("value_avg")
    )
    return grouped.select(F.to_date("window.start").alias("snapshot_date"), "row_count", "unique_seller_count", "value_avg")


def overview_stream(df: DataFrame, stamp: str, seller: str, value: str, lateness: str = "2 hours") -> DataFrame:
    """The same overview kept current over a stream; a day closes after ``lateness``."""
    return overview(df.withWatermark(stamp, lateness), stamp, seller, value, approx=True)


def read_bronze(spark, target: str, date: str | None = None, schema=None) -> DataFrame | None:
    """Stored records of all dates or one."""
    return read_jsonl_glob(spark, target, date, schema)
