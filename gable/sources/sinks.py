"""Writes: tables, idempotent appends, JSON lines, broker payloads, manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gable.operators import dedup
from gable.operators.shape import drop_null_typed, sanitize_floats
from gable.runtime import fits_broadcast, row_count, stage, staged_bytes

SESSION_CATALOG = "spark_catalog"


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def _in_session_catalog(spark: SparkSession, table: str) -> bool:
    parts = table.split(".")
    return len(parts) < 3 and spark.catalog.currentCatalog() == SESSION_CATALOG or parts[0] == SESSION_CATALOG


def replace_table(
    df: DataFrame, table: str, properties: Mapping[str, str] | None = None, *, fmt: str = "parquet", path: str | None = None
) -> None:
    """Create or replace a table; keys and format version are table properties.

    A catalog that supports it replaces atomically; the session catalog
    overwrites. Do not pass a frame that reads ``table`` itself.
    """
    spark = df.sparkSession
    properties = dict(properties or {})
    if _in_session_catalog(spark, table):
        writer = df.write.mode("overwrite").format(fmt)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        if properties:
            pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
        return
    writer = df.writeTo(table).using(fmt)
    for key, value in properties.items():
        writer = writer.tableProperty(key, value)
    writer.createOrReplace()


def _append(df: DataFrame, table: str, fmt: str) -> None:
    spark = df.sparkSession
    stored = spark.table(table).schema
    added = [f for f in df.schema.fields if f.name not in stored.fieldNames()]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    target = spark.table(table).schema
    aligned = df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )
    if _in_session_catalog(spark, table):
        aligned.write.mode("append").format(fmt).saveAsTable(table)
    else:
        aligned.writeTo(table).append()


def append_new(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    *,
    mode: str = "insert_only",
    version: str | None = None,
    properties: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
) -> int:
    """Append rows whose keys were never stored; return how many were added.

    The batch is reduced to one row per key first (``order``, then all other
    columns, decides). ``insert_only`` never touches stored keys. ``latest``
    also appends a row whose ``version`` is newer than the stored one; readers
    take the newest per key.

    A batch of few rows is broadcast, so the stored table is scanned once
    for its key columns and not shuffled. The rows of a larger one meet the stored keys
    in the shuffle that reduces them to one row per key, and are moved and written once.
    """
    spark = df.sparkSession
    typed = drop_null_typed(df)
    ties = [F.col(c).desc_nulls_last() for c, t in typed.dtypes if c not in keys and not t.startswith(("map", "variant"))]
    ranking = [*order, *ties]
    if not spark.catalog.tableExists(table):
        replace_table(dedup.latest_by(typed, list(keys), ranking), table, properties, fmt=fmt, path=path)
        return spark.table(table).count()
    names = [*keys, *([version] if mode == "latest" and version else [])]
    rows = df if staged_bytes(df) else stage(typed, "batch")
    small = fits_broadcast(rows)
    stored = spark.table(table).select(*names)
    if not small and names == list(keys) and stored.dtypes == rows.select(*keys).dtypes:
        # a stored key is the first row of its group
        both = rows.withColumn("__stored", F.lit(False)).unionByName(stored.withColumn("__stored", F.lit(True)), allowMissingColumns=True)
        first = dedup.latest_by(both, list(keys), [F.col("__stored").desc(), *ranking])
        seen = Observation()
        _append(first.where("NOT __stored").drop("__stored").observe(seen, F.count(F.lit(1)).alias("rows")), table, fmt)
        return seen.get["rows"]
    batch = stage(dedup.latest_by(rows, list(keys), ranking), "batch")
    stored = stored.withColumnsRenamed({c: f"__{c}" for c in names})
    match = _same_keys(keys)
    if small:
        stored = stored.join(F.broadcast(batch.select(*keys)), match, "left_semi")
    if mode == "latest" and version:
        match = match & (F.col(f"__{version}") >= F.col(version))
    fresh = stage(batch.join(stored, match, "left_anti"), "fresh")
    added = row_count(fresh)
    if added:
        _append(fresh, table, fmt)
    return added


def _same_keys(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}"))
    for key in keys[1:]:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return condition


def write_jsonl(
    df: DataFrame,
    path: str,
    *,
    partition: str = "date",
    max_records: int = 10_000,
    mode: str = "append",
    compression: str | None = None,
    rebalance: bool = True,
) -> None:
    """JSON lines below ``date=`` folders, at most ``max_records`` per file.

    Appending only adds part files, so an earlier file of the same date is
    never overwritten. Rows are rebalanced by date first: few files for small
    dates, several tasks for a large one. Without ``rebalance`` the rows stay in
    their tasks and nothing is shuffled; each task adds a file to each of its
    dates, which suits loads of many records a date. ``compression`` (such as
    gzip) names a codec of Spark's; a file is read by one task, and
    ``max_records`` bounds it. NaN and infinities become null.
    """
    clean = sanitize_floats(df)
    writer = (clean.hint("rebalance", partition) if rebalance else clean).write.mode(mode).partitionBy(partition)
    if compression:
        writer = writer.option("compression", compression)
    writer.option("maxRecordsPerFile", max_records).option("ignoreNullFields", False).json(path)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Writes rows so that only the partitions that ``df`` has rows of are replaced.

    As the sink of a stream in update mode it keeps an aggregate current: a batch carries the
    whole new rows of the keys it changed, and all other partitions keep their files. Writing
    a batch again gives the same files' content.
    """
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


#: Hash of the keys of a bucketed table; never null, so nulls in keys are found as well.
BUCKET_KEY = "_key"


def bucket_key(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]).alias(BUCKET_KEY)


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, *, mode: str = "overwrite", path: str | None = None) -> None:
    """Stores a table in ``buckets`` files by the hash of its keys, sorted by it.

    Lookups and anti joins on these keys read the buckets as they lie and shuffle the other side
    alone. Choose at least as many buckets as shuffle partitions. Rows are dealt to the buckets
    before the write, so each bucket is one file of a load.
    """
    dealt = df.withColumn(BUCKET_KEY, bucket_key(keys)).repartition(buckets, BUCKET_KEY)
    writer = dealt.write.mode(mode).format("parquet").bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def kafka_payload(df: DataFrame, key: str) -> DataFrame:
    """``key`` as text and the whole row as a JSON ``value``."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_kafka(df: DataFrame, key: str, topic: str, servers: str, checkpoint: str | None = None):
    """Send rows to a topic, as a batch or as a stream."""
    payload = kafka_payload(df, key)
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return payload.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    return payload.write.format("kafka").options(**options).save()


def batch_manifest(df: DataFrame, date: str, meta: Mapping[str, str]) -> DataFrame:
    """One row that describes a batch: its constants, date range, size and time."""
    return df.agg(
        *[F.lit(v).alias(k) for k, v in meta.items()],
        F.min(date).alias("min_record_date"),
        F.max(date).alias("max_record_date"),
        F.count("*").alias("record_count"),
        F.current_timestamp().alias("saved_at"),
    )
