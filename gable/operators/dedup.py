"""Keep-latest deduplication and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gable.runtime import attach, fits_broadcast, stage

#: Number of a written row, by which it is marked.
ROW_NUMBER = "__row"
#: Slots that hashes of keys are dealt to; their marks take 16 MB at most.
SLOTS = 1 << 27
#: Most marked chunks that may be broadcast, of 512 bytes each.
CHUNKS = 100_000


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], *, k: int = 1) -> DataFrame:
    """First row of every key along ``order``, which must be a total order.

    ``row_number() <= k`` lets Spark add a partial limit before the shuffle:
    each task sends at most ``k`` rows per key, so a key with a third of all
    rows does not land whole in one task.
    """
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") <= k).drop("__rank")


def numbered(df: DataFrame) -> DataFrame:
    """Rows with numbers that hold once they are written (``runtime.stage``), for ``latest_marked``."""
    return df.withColumn(ROW_NUMBER, F.monotonically_increasing_id())


def marks(df: DataFrame, number: Column, *, scattered: bool = True) -> DataFrame:
    """A set of numbers as bits, written: ``__chunk`` of 4096 numbers and the 64 words of its ``__bits``.

    Numbers in no order are brought together by chunk first; those in the order of a written
    table make their bits where they lie.
    """
    parts = df.select(F.shiftright(number, 12).alias("__chunk"), number.bitwiseAND(4095).alias("__bit"))
    if scattered:
        parts = parts.repartition("__chunk")
    bitmaps = parts.groupBy("__chunk").agg(F.bitmap_construct_agg("__bit").alias("__bytes"))
    word = lambda i: F.conv(F.hex(F.substring("__bytes", i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    return stage(bitmaps.select("__chunk", F.transform(F.sequence(F.lit(0), F.lit(63)), word).alias("__bits")), "marks")


def with_mark(df: DataFrame, marked: DataFrame, number: Column, name: str) -> DataFrame:
    """Adds whether the row's number is in ``marked`` (``marks``). Marks that fit are broadcast, so rows do not move."""
    side = marked.select(F.col("__chunk").alias(f"{name}_chunk"), F.col("__bits").alias(f"{name}_bits"))
    side = F.broadcast(side) if fits_broadcast(marked, CHUNKS) else side
    joined = df.join(side, F.shiftright(number, 12) == F.col(f"{name}_chunk"), "left")
    place = number.bitwiseAND(4095).cast("int")
    word = F.get(f"{name}_bits", F.shiftright(place, 6))
    # of a word's eight bytes the first is the highest, of a byte's bits the first is the lowest
    found = F.coalesce(F.getbit(word, place.bitwiseAND(63).bitwiseXOR(56)) == 1, F.lit(False))
    return joined.withColumn(name, found).drop(f"{name}_chunk", f"{name}_bits")


def latest_marked(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], *, of: DataFrame | None = None) -> DataFrame:
    """``latest_by`` for wide rows that are ``numbered`` and written: only keys and ``order`` are shuffled.

    Slots that a key hash of two or more rows falls into are marked. A row of any other slot is the
    only one of its key; rows of marked slots are ranked as in ``latest_by``. What stays is marked by its number.
    ``of`` are the rows to take it from instead of ``df``, with the same numbers: ``df`` before costly filters.
    """
    number, digested = F.col(ROW_NUMBER), df.withColumn("__digest", F.xxhash64(*keys))
    shared = digested.groupBy("__digest").agg(F.count("*").alias("__rows")).where("__rows > 1")
    shared = marks(shared, F.pmod("__digest", F.lit(SLOTS)))
    slotted = df.withColumn("__slot", F.pmod(F.xxhash64(*keys), F.lit(SLOTS)))
    seen = with_mark(slotted, shared, F.col("__slot"), "__shared").drop("__slot")
    first = marks(latest_by(seen.where("__shared").drop("__shared"), keys, order), number)
    kept = with_mark(seen, first, number, "__first").where("NOT __shared OR __first").drop("__shared", "__first")
    return still_in(df if of is None else of, kept)


def still_in(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``df``, which are ``numbered`` and written, whose numbers ``kept`` has; what made ``kept`` is then not made again."""
    number = F.col(ROW_NUMBER)
    return with_mark(df, marks(kept, number, scattered=False), number, "__kept").where("__kept").drop("__kept")


def drop_duplicate_ids(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per id; rows without an id are left out."""
    return latest_by(df.filter(F.col(key).isNotNull()), [key], order)


def geo_keys(lat: str = "latitude", lon: str = "longitude", digits: int = 5) -> list[Column]:
    """Coordinates rounded for use as grouping keys (no helper columns leak)."""
    return [F.round(F.col(lat), digits), F.round(F.col(lon), digits)]


def duplicate_groups(df: DataFrame, keys: Sequence[Column | str], ids: Sequence[str]) -> DataFrame:
    """Key groups with more than one row: size, distinct and lowest / highest id.

    Aggregates only, so a group of any size is reported without gathering its
    members. Use :func:`duplicate_members` for the members themselves.
    """
    summary = [F.count("*").alias("row_count")]
    for name in ids:
        summary += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    return df.groupBy(*keys).agg(*summary).filter(F.col("row_count") > 1)


def duplicate_members(df: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Every row of the duplicate groups in long form, with the size of its group."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
    return attach(df.select(*keys, *ids), sizes, keys, null_safe=True).filter(F.col("row_count").isNotNull())
