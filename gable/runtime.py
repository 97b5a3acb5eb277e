"""Session helpers: shared scratch space, lineage cuts, size-checked joins.

Three rules live here so that every operator follows them:

* intermediate results that must be read twice are *written* to the folder the
  cluster names in ``spark.checkpoint.dir`` (it survives a lost executor);
* a side is broadcast only after its rows were counted and its stored bytes
  measured; beyond that Spark joins by shuffle and splits skewed partitions at
  run time, and keys that a count finds hot can be salted;
* salts come from row content, so a retried task sends its rows to the same
  place.
"""

from __future__ import annotations

import itertools
import tempfile
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

#: Largest row count and largest stored size that may be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20

#: Copies of a right row whose key is hot in a salted join; the key is spread
#: over as many tasks.
SALTS = 16

_counter = itertools.count()
_private: dict[str, str] = {}
_scopes = threading.local()


def build_session(name: str = "gable", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the jobs rely on (UTC, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A private folder is made only for a local master that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _private:
        _private[app] = tempfile.mkdtemp(prefix="gable-")
    return _private[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, unique in this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/gable-{app}/{next(_counter):05d}-{label}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Cuts the lineage, makes non-deterministic columns (positions, partition
    ids) stable, and gives Catalyst a true size for later joins. Rows are
    counted while they are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.__dict__["_staged_rows"] = seen.get["rows"]
    staged.__dict__["_staged_path"] = path
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.append(path)
    return staged


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after an error, what this thread staged inside; results must be stored by then."""
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for folder in scopes.pop():
            system, path = file_system(spark, folder)
            system.delete(path, True)


def file_system(spark: SparkSession, folder: str):
    """Hadoop file system of a folder, and the folder as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def staged_bytes(staged: DataFrame) -> int:
    """Stored size of a staged table; 0 for a table that was not staged here."""
    folder = staged.__dict__.get("_staged_path")
    if folder is None:
        return 0
    system, path = file_system(staged.sparkSession, folder)
    return system.getContentSummary(path).getLength()


def row_count(staged: DataFrame) -> int:
    """Rows of a staged table: remembered from its write, else from the footers."""
    known = staged.__dict__.get("_staged_rows")
    return staged.count() if known is None else known


def fits_broadcast(staged: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True when a *staged* table has at most ``limit`` rows and ``BROADCAST_BYTES`` of files."""
    return row_count(staged) <= limit and staged_bytes(staged) <= BROADCAST_BYTES


def zip_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two aggregates that are both unique on ``keys`` (nulls match).

    Neither side can be skewed, so Spark is free to choose the join.
    """
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}"))
    for key in keys[1:]:
        match = match & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(other, match, "left").drop(*[f"__{k}" for k in keys])


def release_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Call it when its results are stored."""
    system, path = file_system(spark, f"{shared_dir(spark)}/gable-{spark.sparkContext.applicationId}")
    system.delete(path, True)


def row_salt(columns: Sequence[str], salts: int = SALTS) -> Column:
    """Salt in ``0..salts-1`` computed from row content."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)).cast("int")


def attach(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    staged: bool = False,
    spread_by: Sequence[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join to a right side that is unique on ``keys``.

    ``right`` is staged, counted and measured. A small one is broadcast and the
    left side does not move at all. Beyond that it is a shuffle join, whose
    skewed partitions Spark splits while it runs. With ``hot_rows`` the left
    keys are counted first; those with more rows are salted by the hash of
    ``spread_by`` (default: all atomic columns) and only their right rows are
    copied. At most one key in ``hot_rows`` rows can be hot.
    """
    right = right if staged else stage(right, "attach")
    small = fits_broadcast(right, broadcast_rows)
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    salted = False
    if small:
        right = F.broadcast(right)
    elif hot_rows is not None:
        hot = stage(left.groupBy(*keys).agg(F.count("*").alias("__rows")).where(F.col("__rows") > hot_rows).drop("__rows"), "hot")
        salted = 0 < row_count(hot) and fits_broadcast(hot)
    if salted:
        salt = row_salt(list(spread_by or atomic_columns(left)), salts)
        marks = F.broadcast(hot.withColumn("__hot", F.lit(True)))
        left = _matched(left, marks, keys, "__l").withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(0)).drop("__hot")
        marks = F.broadcast(hot.withColumnsRenamed({k: f"__{k}" for k in keys}).withColumn("__hot", F.lit(True)))
        right = _matched(right, marks, [f"__{k}" for k in keys], "__r")
        copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn("__copy", F.explode(copies)).drop("__hot")
    condition = None
    for key in keys:
        here, there = F.col(key), F.col(f"__{key}")
        term = here.eqNullSafe(there) if null_safe else here == there
        condition = term if condition is None else condition & term
    if salted:
        condition = condition & (F.col("__salt") == F.col("__copy"))
    joined = left.join(right, condition, "left")
    return joined.drop(*[f"__{k}" for k in keys], "__salt", "__copy")


def _matched(df: DataFrame, marks: DataFrame, keys: Sequence[str], stem: str) -> DataFrame:
    """Left join to a few marked keys, nulls matching."""
    renamed = marks.withColumnsRenamed({k: f"{stem}{k}" for k in keys})
    condition = None
    for key in keys:
        term = F.col(key).eqNullSafe(F.col(f"{stem}{key}"))
        condition = term if condition is None else condition & term
    return df.join(renamed, condition, "left").drop(*[f"{stem}{k}" for k in keys])


def atomic_columns(df: DataFrame) -> list[str]:
    """Columns of non-nested type."""
    nested = ("struct", "array", "map", "variant")
    return [name for name, kind in df.dtypes if not kind.startswith(nested)]
