"""Ids a stream has stored, by event date: what a micro-batch compares itself with.

A micro-batch adds one *recent* segment, whatever its dates. Maintenance (``fold``) moves
recent segments into the folders of their dates, where ids lie in hash buckets; the number
of buckets of a date is a power of two that follows its ids, so a bucket has a bounded size
(``bucket_ids``, or ``FULL_IDS`` if that is more and the date has many buckets).
A batch therefore reads the few recent segments and, of its own dates, the buckets its ids
fall into; files are sorted by id, and the range of the batch's ids skips what lies outside.

Every step only adds before it deletes, and the ledger is a set: a crash in between leaves
ids twice at most, never too few. The next ``fold`` tidies up.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gable.runtime import file_system, stage, temporary

SCHEMA = "date date, record_id string"
#: Most buckets of a date; beyond that they hold more than ``bucket_ids``.
MAX_BUCKETS = 256
#: A date has more buckets than these only if each holds about ``FULL_IDS`` ids: what a file costs
#: to make and to list exceeds by far what reading a smaller one saves.
FEW_BUCKETS, FULL_IDS = 32, 1 << 16
#: Ids that a task of ``fold`` writes.
TASK_IDS = 1 << 21


@dataclass(frozen=True)
class Bucket:
    """One bucket folder of a date: its generation, how many buckets that has, and what it holds."""

    path: str
    generation: int
    of: int
    number: int
    files: int
    size: int

    @property
    def folder(self) -> str:
        """Folder of all buckets of its generation."""
        return self.path.rsplit("/", 1)[0]


@dataclass(frozen=True)
class IdLedger:
    """``(date, record_id)`` pairs below ``folder``."""

    spark: SparkSession
    folder: str
    bucket_ids: int = 1 << 20
    max_recent: int = 16
    max_files: int = 8

    def add(self, ids: DataFrame) -> None:
        """Stores ids as one recent segment; folds when there are too many of them."""
        ordered = ids.select("date", "record_id").hint("rebalance").sortWithinPartitions("date", "record_id")
        ordered.write.parquet(f"{self.folder}/recent/{uuid.uuid4().hex}")
        if len(self.recent()) > self.max_recent:
            self.fold()

    def may_hold(self, ids: DataFrame) -> DataFrame | None:
        """Stored pairs among which all of ``ids`` that are stored are found; None if there are none."""
        low, high = ids.agg(F.min("record_id"), F.max("record_id")).first()
        touched, held = self._touched(ids)
        # a generation that is read whole is named by its folder: Spark plans few folders faster
        of, read = Counter(b.folder for b in held), Counter(b.folder for b in touched)
        folders = sorted({b.folder if read[b.folder] == of[b.folder] else b.path for b in touched})
        parts = [self._read(paths) for paths in (self.recent(), folders) if paths]
        if low is None or not parts:
            return None
        return reduce(DataFrame.unionByName, parts).where(F.col("record_id").between(low, high))

    def _read(self, paths: list[str]) -> DataFrame:
        """Pairs in the given folders; the date of a bucket is in its path."""
        reader = self.spark.read.schema(SCHEMA)
        if "/dates/date=" in paths[0]:
            reader = reader.option("basePath", f"{self.folder}/dates")
        return reader.parquet(*paths).select("date", "record_id")

    def recent(self) -> list[str]:
        return [s.getPath().toString() for s in self._list(f"{self.folder}/recent")]

    def buckets_of(self, ids: DataFrame) -> list[str]:
        """Folders of the buckets that ``ids`` fall into; other dates are not even listed."""
        return [b.path for b in self._touched(ids)[0]]

    def _touched(self, ids: DataFrame) -> tuple[list[Bucket], list[Bucket]]:
        """Buckets that ``ids`` fall into, and all of their dates."""
        if not self._list(f"{self.folder}/dates"):
            return [], []
        touched: dict[str, set[int]] = defaultdict(set)
        slots = ids.where("record_id IS NOT NULL").select(F.col("date").cast("string").alias("day"), _bucket(F.lit(MAX_BUCKETS)).alias("slot"))
        for r in slots.distinct().collect():  # at most MAX_BUCKETS for each date of the batch
            touched[r.day].add(r.slot)
        held = self.dates(touched)
        found = [b for day in touched for b in held[day] if any(s % b.of == b.number for s in touched[day])]
        return found, [b for day in touched for b in held[day]]

    def dates(self, days: Iterable[str]) -> Mapping[str, list[Bucket]]:
        """Bucket folders of the given dates; Spark lists them in parallel."""
        found: dict[str, list[Bucket]] = {day: [] for day in days}
        stored = [s.getPath() for s in self._list(f"{self.folder}/dates")]
        folders = [at.toString() for at in stored if at.getName().removeprefix("date=") in found]
        if not folders:
            return found
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
        sizes: dict[str, list[int]] = defaultdict(list)
        for r in files.select("path", "length").collect():  # files of a few batches' dates; none is opened
            sizes[r.path.rsplit("/", 1)[0]].append(r.length)
        for at, held in sizes.items():
            day, generation, bucket = at.rsplit("/", 3)[1:]
            _, number, of = generation.split("-")
            found[day.removeprefix("date=")].append(Bucket(at, int(number), int(of), int(bucket.removeprefix("bucket=")), len(held), sum(held)))
        return found

    def buckets_for(self, n: int) -> int:
        """Buckets of a date of ``n`` ids: of ``bucket_ids``, but no more than few where they hold less than ``FULL_IDS``."""
        def doubled(ids: int) -> int:
            return 1 << max(0, (-(-n // ids) - 1).bit_length())

        return min(MAX_BUCKETS, doubled(self.bucket_ids), max(FEW_BUCKETS, doubled(FULL_IDS)))

    def fold(self) -> None:
        """Moves recent segments to their dates; dates with many files or large buckets are written anew."""
        recent = self.recent()
        if not recent:
            return
        with temporary(self.spark):
            fresh = stage(self._read(recent).dropna().distinct(), "recent-ids")
            counts = {str(r.date): r["count"] for r in fresh.groupBy("date").count().collect()}  # one row for each date of a few batches
            held = self.dates(counts)
            old = sorted({b.folder for day in counts for b in held[day]})
            if old:
                for r in self._read(old).groupBy("date").count().collect():
                    counts[str(r.date)] += r["count"]
            plans, outdated = [], set()
            for day, n in counts.items():
                generations = {b.generation for b in held[day]}
                of = max((b.of for b in held[day]), default=0)
                want = max(of, self.buckets_for(n))
                again = len(generations) > 1 or want > of or any(b.files >= self.max_files for b in held[day])
                number = max(generations, default=-1) + (1 if again else 0)
                plans.append((day, max(number, 0), want))
                if again:
                    outdated |= {b.folder for b in held[day]}
            # rows of this table are the dates of a few batches
            plan = self.spark.createDataFrame(plans, "day string, generation int, of int").withColumn("date", F.to_date("day")).drop("day")
            body = fresh
            if outdated:
                body = body.unionByName(self._read(sorted(outdated))).distinct()
            placed = body.join(F.broadcast(plan), "date").withColumns({"bucket": _bucket(F.col("of")), "buckets": F.format_string("g-%d-%d", "generation", "of")})
            # Hashes deal ids evenly, so buckets need no splitting; the many small files are written by all cores.
            tasks = max(2 * self.spark.sparkContext.defaultParallelism, sum(counts.values()) // TASK_IDS)
            placed = placed.select("date", "buckets", "bucket", "record_id").repartition(tasks, "date", "bucket")
            placed.sortWithinPartitions("date", "buckets", "bucket", "record_id").write.mode("append").partitionBy("date", "buckets", "bucket").parquet(f"{self.folder}/dates")
        for path in outdated | set(recent):
            system, at = file_system(self.spark, path)
            system.delete(at, True)

    def _list(self, folder: str) -> list:
        system, path = file_system(self.spark, folder)
        found = system.listStatus(path) if system.exists(path) else []
        return [s for s in found if not s.getPath().getName().startswith((".", "_"))]


def _bucket(of: Column) -> Column:
    return F.pmod(F.xxhash64("record_id"), of).cast("int")
