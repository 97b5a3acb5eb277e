"""Dimension lookups, anti joins, nearest neighbour, integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gable.functions import scores
from gable.runtime import attach, fits_broadcast, row_count, stage
from gable.sources.sinks import BUCKET_KEY, bucket_key


def lookup_key(fact: DataFrame, dim: DataFrame, natural: Sequence[str], key: str, *, spread_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    """Surrogate key of the matching dimension row; nulls in natural keys match."""
    return attach(fact, dim.select(*natural, key), natural, null_safe=True, spread_by=spread_by, staged=staged)


def encode_labels(df: DataFrame, column: str, codes: DataFrame, name: str, default: int = -1, *, staged: bool = False) -> DataFrame:
    """Code of each label from a (label, code) table; unknown and null give ``default``."""
    table = codes.select(F.col("label").alias(column), F.col("code").alias(name))
    joined = attach(df, table, [column], staged=staged)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)).cast("int"))


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not stored yet."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def join_stored(left: DataFrame, table: str, keys: Sequence[str], how: str, columns: Sequence[str] = ()) -> DataFrame:
    """Joins to a table stored by ``sinks.store_bucketed`` on its keys, nulls matching; ``how`` is left, left_anti or left_semi.

    The stored side is not moved: its buckets are the partitions of the join. ``columns`` come along.
    """
    stored = left.sparkSession.table(table).select(BUCKET_KEY, *[F.col(k).alias(f"__{k}") for k in keys], *columns)
    given = left.withColumn("__given", bucket_key(keys))
    match = F.col("__given") == F.col(BUCKET_KEY)
    for k in keys:  # no equality of Spark's own, which would ask for a partitioning by all of them
        here, there = F.col(k), F.col(f"__{k}")
        match = match & F.coalesce(here == there, here.isNull() & there.isNull())
    return given.join(stored, match, how).drop("__given", BUCKET_KEY, *[f"__{k}" for k in keys])


def nearest(
    left: DataFrame,
    points: DataFrame,
    bucket: Sequence[str],
    point_id: str,
    carry: Sequence[str] = (),
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    distance: str = "distance_m",
    chunk: int = 64,
) -> DataFrame:
    """Nearest point of the same bucket for each left row; none gives nulls. Ties go to the lower point id.

    Buckets of at most ``chunk`` points are arrays, compared inside the row. The points of
    larger ones are indexed by the cells of a grid (``point_cells``); of points at one place only
    the lowest id can be found and the others are left out first. The distinct places
    of their left rows look for points cell by cell (``nearest_in_grid``), so a place meets
    the points around it and not those of the whole bucket. Results come back by place.
    Coordinates that are null, infinite or not numbers have no distance.
    """
    bucket = list(bucket)
    finite = (F.abs(F.col(lat)) < _FAR) & (F.abs(F.col(lon)) < _FAR)
    named = points.select(*bucket, point_id, lat, lon, *carry).na.drop(subset=bucket).where(finite)
    held = stage(lowest_at(named, [*bucket, lat, lon], [point_id, *carry]), "points")
    crowded = None
    if row_count(held) > chunk:
        middle = [F.percentile_approx(F.col(c).cast("double"), [0.02, 0.98], 1000).alias(f"__{c}") for c in (lat, lon)]
        crowded = stage(held.groupBy(*bucket).agg(F.count("*").alias("__n"), *middle).where(F.col("__n") > chunk), "crowded")
        crowded = None if row_count(crowded) == 0 else crowded
    fields = F.struct(F.col(point_id), F.col(lat), F.col(lon), *carry)
    few = held if crowded is None else sized(held, crowded.select(*bucket), bucket, "left_anti")
    arrays = few.groupBy(*bucket).agg(F.collect_list(fields).alias("__points"))
    best = _best_point(lat, lon, distance, point_id, carry)
    met = left.join(F.broadcast(arrays) if fits_broadcast(held) else arrays, bucket, "left").withColumn("__best", best).drop("__points")
    if crowded is not None:
        grid = point_cells(held, crowded, bucket, fields, lat, lon, max(1, chunk // 8))
        # written once, with the marks of rows that go to the grid
        met = stage(sized(met, crowded.select(*bucket, F.lit(True).alias("__grid")), bucket, "left"), "met")
        rows = met.where("__grid").drop("__grid", "__best")
        places = rows.where(finite).select(*bucket, lat, lon, F.lit(None).cast(met.schema["__best"].dataType).alias("__best")).distinct()
        found = nearest_in_grid(places, grid, bucket, best, lat, lon, distance)
        rows = attach(rows, found, [*bucket, lat, lon])
        met = met.where("__grid IS NULL").drop("__grid").select(*left.columns, "__best").unionByName(rows.select(*left.columns, "__best"))
    return met.withColumns({c: F.col("__best")[c] for c in [distance, point_id, *carry]}).drop("__best")


def lowest_at(points: DataFrame, place: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One point for each place, the lowest by ``order`` (nulls first)."""
    kept = [c for c in order if c not in place]
    lowest = points.groupBy(*place).agg(F.min(F.struct(*kept)).alias("__lowest"))
    return lowest.select(*place, *[F.col("__lowest")[c].alias(c) for c in kept]).select(*points.columns)


#: Beyond every finite coordinate.
_FAR = float("inf")


def sized(left: DataFrame, staged: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a staged side, broadcast if its rows and bytes allow."""
    return left.join(F.broadcast(staged) if fits_broadcast(staged) else staged, list(keys), how)


def _best_point(lat: str, lon: str, distance: str, point_id: str, carry: Sequence[str]) -> Column:
    """The nearest of the row's array ``__points`` as a struct that starts with distance and id."""
    candidate = F.transform(
        "__points",
        lambda p: F.struct(
            scores.distance_m(F.col(lat), F.col(lon), p[lat], p[lon]).alias(distance),
            p[point_id].alias(point_id),
            *[p[c].alias(c) for c in carry],
        ),
    )
    return F.array_min(F.filter(candidate, lambda c: c[distance] < _FAR))


def _grid(crowded: DataFrame, bucket: Sequence[str], lat: str, lon: str, cell_points: int) -> DataFrame:
    """Grid of each bucket: origin and step on both axes, and the levels above single cells.

    A grid has 2^levels cells on a side, about one for ``cell_points`` points. It spans the middle
    96 % of the points on each axis; its outer cells reach on without end, so it covers the plane.
    """
    levels = F.greatest(F.lit(0), F.ceil(F.log2(F.col("__n") / cell_points) / 2)).cast("int")
    out = crowded.select(*bucket, levels.alias("__levels"), *[f"__{c}" for c in (lat, lon)])
    for axis, c in (("y", lat), ("x", lon)):
        width = F.col(f"__{c}")[1] - F.col(f"__{c}")[0]
        out = out.withColumns({f"__{axis}0": F.col(f"__{c}")[0], f"__d{axis}": F.when(width > 0, width / _cells()).otherwise(1.0)})
    return out.drop(f"__{lat}", f"__{lon}")


def _cells() -> Column:
    """Cells along an axis."""
    return F.pow(F.lit(2.0), F.col("__levels")).cast("long")


def _cell(column: str, axis: str) -> Column:
    """Number of the cell along an axis."""
    place = F.floor((F.col(column).cast("double") - F.col(f"__{axis}0")) / F.col(f"__d{axis}"))
    last = _cells() - 1
    return F.greatest(F.lit(0).cast("long"), F.least(place.cast("long"), last))


def point_cells(held: DataFrame, crowded: DataFrame, bucket: Sequence[str], fields: Column, lat: str, lon: str, cell_points: int, array: int = 512) -> DataFrame:
    """Points of crowded buckets by grid cell: ``__points`` with the box around them, written.

    A cell in which points crowd is several rows of about ``array`` points.
    """
    grid = stage(_grid(crowded, bucket, lat, lon, cell_points), "grid")
    placed = sized(held, grid, bucket, "inner").withColumns({"__cy": _cell(lat, "y"), "__cx": _cell(lon, "x")})
    key = [*bucket, "__levels", "__y0", "__dy", "__x0", "__dx", "__cy", "__cx"]
    sizes = placed.groupBy(*bucket, "__cy", "__cx").agg(F.ceil(F.count("*") / array).cast("int").alias("__slots")).where("__slots > 1")
    placed = sized(placed, stage(sizes, "slots"), [*bucket, "__cy", "__cx"], "left")
    slot = F.pmod(F.xxhash64(fields), F.coalesce("__slots", F.lit(1)))
    box = [f(F.col(c).cast("double")).alias(f"__{n}_{c}") for n, f in (("low", F.min), ("high", F.max)) for c in (lat, lon)]
    cells = placed.groupBy(*key, slot.alias("__slot")).agg(F.collect_list(fields).alias("__points"), *box)
    return stage(cells.drop("__slot"), "cells")


def cells_around(places: DataFrame, grid: DataFrame, bucket: Sequence[str], level: int, lat: str, lon: str, distance: str) -> DataFrame:
    """Each place with the cells of the 3 x 3 blocks of 2^level cells around it that may hold a nearer point.

    Cells of the block of the level before are left out, and so are those whose box is farther than
    the best so far. Places keep a row without cell.
    """
    here = {c: F.shiftright(f"__p{c}", level) for c in ("y", "x")}
    last = F.shiftright(_cells() - 1, level)
    around = {c: F.sequence(F.greatest(F.lit(0).cast("long"), here[c] - 1), F.least(last, here[c] + 1)) for c in ("y", "x")}
    each = places.withColumn("__by", F.explode(around["y"])).withColumn("__bx", F.explode(around["x"]))
    boxes = [f"__{n}_{c}" for n in ("low", "high") for c in (lat, lon)]
    blocks = grid.select(
        *[F.col(b).alias(f"__k{i}") for i, b in enumerate(bucket)], F.shiftright("__cy", level).alias("__ky"), F.shiftright("__cx", level).alias("__kx"), "__cy", "__cx", "__points", *boxes
    )
    match = (F.col("__by") == F.col("__ky")) & (F.col("__bx") == F.col("__kx"))
    for i, b in enumerate(bucket):
        match = match & (F.col(b) == F.col(f"__k{i}"))
    if level:
        seen = [F.abs(F.shiftright(f"__c{c}", level - 1) - F.shiftright(f"__p{c}", level - 1)) <= 1 for c in ("y", "x")]
        match = match & ~(seen[0] & seen[1])
    # the nearest place of the box; distances are whole metres, so one metre is left for rounding
    y, x = (F.greatest(F.col(f"__low_{c}"), F.least(F.col(c).cast("double"), F.col(f"__high_{c}"))) for c in (lat, lon))
    least = scores.distance_m(F.col(lat).cast("double"), F.col(lon).cast("double"), y, x)
    match = match & (F.col("__best").isNull() | (least - 1 <= F.col("__best")[distance]))
    side = F.broadcast(blocks) if fits_broadcast(grid) else blocks
    return each.join(side, match, "left").select(*places.columns, "__points")


def nearest_in_grid(places: DataFrame, grid: DataFrame, bucket: Sequence[str], best: Column, lat: str, lon: str, distance: str) -> DataFrame:
    """``bucket, lat, lon, __best`` of distinct places, whose buckets are in ``grid``; ``__best`` comes in null.

    A place first meets the cell it lies in and the eight around it. It is done when its best
    point is nearer than anything outside of them; else it goes on with cells twice as wide, up
    to the whole grid. A round is one join and one grouping by place, of undecided places alone.
    """
    axes = stage(grid.select(*bucket, "__levels", "__y0", "__dy", "__x0", "__dx").distinct(), "axes")
    placed = sized(places, axes, bucket, "inner").withColumns({"__py": _cell(lat, "y"), "__px": _cell(lon, "x")})
    same = [c for c in placed.columns if c != "__best"]
    done, undecided, level = [], placed, 0
    while not done or undecided.limit(1).count():
        met = cells_around(undecided, grid, bucket, level, lat, lon, distance).withColumn("__new", best)
        met = met.groupBy(*same).agg(F.least(F.first("__best"), F.min("__new")).alias("__best"))
        border = _border(level, lat, lon)
        # distances are whole metres, and the border's own is rounded too
        met = stage(met.withColumn("__done", F.coalesce(border >= F.col("__best")[distance] + 2, border == _FAR)), "round")
        done.append(met.where("__done").select(*bucket, lat, lon, "__best"))
        undecided = met.where("NOT __done").drop("__done")
        level += 1
    return reduce(DataFrame.unionByName, done)


def _border(level: int, lat: str, lon: str) -> Column:
    """Metres from a place to the nearest border of its 3 x 3 block; infinite where the block has none."""
    sides = []
    for c, axis in ((lat, "y"), (lon, "x")):
        at, step = F.col(c).cast("double"), F.col(f"__d{axis}")
        here = F.shiftright(f"__p{axis}", level)
        count = F.shiftright(_cells(), level)
        width = step * float(1 << level)
        below, above = (F.col(f"__{axis}0") + width * k for k in (here - 1, here + 2))
        moved = lambda other, axis=axis: (other, F.col(lon).cast("double")) if axis == "y" else (F.col(lat).cast("double"), other)
        metres = lambda other, moved=moved: scores.distance_m(F.col(lat).cast("double"), F.col(lon).cast("double"), *moved(other))
        sides += [F.when(here - 1 > 0, metres(below)).otherwise(F.lit(_FAR)), F.when(here + 2 < count, metres(above)).otherwise(F.lit(_FAR))]
    return F.least(*sides)


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], required: Sequence[str] = ()) -> DataFrame:
    """Left joins by key name, then not-null filters that let Spark use inner joins."""
    joined = fact
    for key, dim in dims.items():
        joined = joined.join(dim, key, "left")
    for column in required:
        joined = joined.filter(F.col(column).isNotNull())
    return joined


def fk_violations(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a dimension row, with their number of fact rows."""
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return used.join(dim.select(key), key, "left_anti")


def fk_report(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``key_name, violations, fact_rows``: fact rows of each key whose value no dimension row has.

    The fact is read once and reduced to the count of each key value; null keys are no violation.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("value")) for k in dims]))
    used = fact.select(pairs.alias("p")).groupBy("p.key_name", "p.value").agg(F.count("*").alias("n"))
    known = None
    for key, dim in dims.items():
        part = dim.select(F.lit(key).alias("key_name"), F.col(key).cast("string").alias("value"), F.lit(True).alias("known")).distinct()
        known = part if known is None else known.unionByName(part)
    broken = F.when(F.col("known").isNull() & F.col("value").isNotNull(), F.col("n")).otherwise(0)
    joined = used.join(known, ["key_name", "value"], "left")
    return joined.groupBy("key_name").agg(F.sum(broken).alias("violations"), F.sum("n").alias("fact_rows"))


def pk_violations(dim: DataFrame, key: str) -> DataFrame:
    """Primary keys that are null or stored more than once."""
    counted = dim.groupBy(key).agg(F.count("*").alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | F.col(key).isNull())
