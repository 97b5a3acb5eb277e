"""Scans: JSON lines, CSV, catalog tables, streams, and incremental load plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from gable.operators import dedup, shape

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame | None:
    """One JSON object per line; lines that do not parse land in ``_corrupt_record``.

    With a schema the files are read once; without one Spark reads them twice
    to infer it. A path that does not exist gives ``None``.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        if CORRUPT not in fields.fieldNames():
            fields = fields.add(CORRUPT, StringType())
        reader = reader.schema(fields)
    try:
        return reader.json(path if isinstance(path, str) else list(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_jsonl_glob(spark: SparkSession, base: str, date: str | None = None, schema: StructType | str | None = None) -> DataFrame | None:
    """Leaf files of ``date=`` partitions, of all dates or one.

    Reads the leaf glob rather than the base folder: the records carry their
    own ``date``, which partition discovery would replace.
    """
    base = base.rstrip("/")
    path = base if base.endswith((".jsonl", ".json")) or "*" in base else f"{base}/date={date or '*'}/*.json*"
    return read_jsonl(spark, path, schema)


def select_partition(df: DataFrame, date: str | None) -> DataFrame:
    """Rows of one ``date`` partition (pruned at the scan), or all."""
    return df if date is None else df.filter(F.col("date") == F.lit(date).cast(df.schema["date"].dataType))


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ingest time and source file; call it directly on a file scan."""
    return df.select("*", F.current_timestamp().alias("_ingest_ts"), F.col("_metadata.file_path").alias("_source_path"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with quoted multi-line cells; a byte-order mark is skipped."""
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_first_existing(spark: SparkSession, names: Sequence[str]) -> DataFrame | None:
    """The first of the named tables that exists."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def decode_records(messages: DataFrame, schema: StructType | str) -> DataFrame:
    """Records of ``schema`` from broker messages (``key``, ``value``), batch or stream; a value that is no record gives nulls."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: StructType) -> DataFrame:
    """Unbounded records of ``schema``.

    From a broker the JSON value is decoded; file formats are read as they
    are. Start offsets and rate limits are options, progress lives in the
    query's checkpoint.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        raw = reader.option("startingOffsets", options.get("startingOffsets", "earliest")).load()
        return decode_records(raw, schema)
    return reader.schema(schema).load()


def load_bounds(spark: SparkSession, has_data: bool, today: str, *, initial: str, lookback_days: int = 7) -> tuple[str, str]:
    """First run: from ``initial``; later runs: the last ``lookback_days``."""
    if not has_data:
        return initial, today
    start = spark.range(1).select(F.date_sub(F.lit(today).cast("date"), lookback_days).cast("string")).first()[0]
    return start, today


def plan_windows(bounds: DataFrame, start: Column, end: Column, days: int, keep: Sequence[str] = ()) -> DataFrame:
    """Cut [start, end) into windows of ``days``; the last one is clipped. Columns in ``keep`` stay beside each."""
    starts = F.sequence(start, F.date_sub(end, 1), F.expr(f"interval {int(days)} days"))
    cut = bounds.select(*keep, F.explode(F.when(start < end, starts)).alias("window_start"), end.alias("__end"))
    return cut.select(*keep, "window_start", F.least(F.date_add("window_start", days), F.col("__end")).alias("window_end"))


def within_windows(series: DataFrame, windows: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Rows of a stored series that planned windows ask for, with the bounds of the window; a row is given for each of its windows.

    Windows are few (a plan is some per key), so they are sent to the rows.
    """
    inside = (F.col(date) >= F.col("window_start")) & (F.col(date) < F.col("window_end"))
    return series.join(F.broadcast(windows), list(keys)).where(inside)


def merge_windows(extracts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key from overlapping extracts; the extract with the latest ``order`` wins."""
    ties = [F.col(c).desc_nulls_last() for c in extracts.columns if c not in (*keys, order)]
    return dedup.latest_by(extracts, list(keys), [F.col(order).desc_nulls_last(), *ties])


def to_series_records(df: DataFrame, keywords: Mapping[str, str], partial: str = "isPartial") -> DataFrame:
    """Wide keyword columns to records with a ``values`` map and a partial flag."""
    values = shape.pack_map({k: F.col(c) for k, c in keywords.items()})
    flag = F.coalesce(F.col(partial), F.lit(False)) if partial in df.columns else F.lit(False)
    kept = [c for c in df.columns if c not in (*keywords.values(), partial)]
    return df.select(*kept, values.alias("values"), flag.alias(partial))
