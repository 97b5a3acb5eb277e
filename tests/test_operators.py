"""Operators: small and large paths agree, skew and partitioning do not change results."""

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from support import rows
from gable.operators import dedup, groups, joins, ordered, quality, series, shape
from gable.plans import silver
from gable.runtime import attach, stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, nulls in keys and values, many ties."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if i % 17 == 0 else float(rng.randint(0, 60))
        data.append((i, group, value))
    return spark.createDataFrame(data, "id long, g string, v double").repartition(6)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_number_rows_is_dense_and_ordered(skewed, parts):
    distinct = skewed.select("g", "v").distinct().repartition(parts)
    got = ordered.number_rows(distinct, ["g", "v"], "k")
    expected = distinct.withColumn("k", F.row_number().over(Window.orderBy("g", "v")).cast("long"))
    assert rows(got, "g", "v", "k") == rows(expected, "g", "v", "k")


def test_running_sum_equals_window(skewed):
    histogram = skewed.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ordered.running_sum(histogram, ["g"], ["v"], "n", "upto", total="all")
    w = Window.partitionBy("g")
    expected = histogram.withColumns(
        {"upto": F.sum("n").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(w)}
    )
    assert rows(got, "g", "v", "upto", "all") == rows(expected, "g", "v", "upto", "all")


def test_running_sum_without_groups(skewed):
    histogram = skewed.groupBy("v").agg(F.count("*").alias("n"))
    got = ordered.running_sum(histogram, [], ["v"], "n", "upto")
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got, "v", "upto") == rows(histogram.withColumn("upto", F.sum("n").over(w)), "v", "upto")


def test_percent_rank_equals_window(skewed):
    got = ordered.percent_rank_in(skewed, ["g"], "v", "p")
    rank = F.percent_rank().over(Window.partitionBy("g").orderBy("v"))
    expected = skewed.withColumn("p", F.when(F.col("v").isNotNull(), F.round(rank * 100, 1)))
    assert rows(got, "id", "p") == rows(expected, "id", "p")


def test_percent_rank_single_row(spark):
    frame = spark.createDataFrame([("x", 5.0)], "g string, v double")
    assert ordered.percent_rank_in(frame, ["g"], "v", "p").first()["p"] == 0.0


def test_exact_quantiles_equal_builtin(spark, skewed):
    got = ordered.exact_quantiles(skewed, ["g"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    skewed.createOrReplaceTempView("skewed")
    parts = ", ".join(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v) AS q{i}" for i, p in enumerate((0.25, 0.5, 0.75), 1))
    expected = spark.sql(f"SELECT g, {parts} FROM skewed WHERE v IS NOT NULL GROUP BY g")
    assert rows(got, "g", "q1", "q2", "q3") == rows(expected, "g", "q1", "q2", "q3")


def test_sketch_quantiles_are_close(skewed):
    exact = {r["g"]: r["m"] for r in ordered.group_quantiles(skewed, ["g"], "v", {"m": 0.5}).collect()}
    sketch = {r["g"]: r["m"] for r in ordered.group_quantiles(skewed, ["g"], "v", {"m": 0.5}, exact=False).collect()}
    assert exact.keys() == sketch.keys()
    assert all(abs(exact[g] - sketch[g]) <= 1 for g in exact)


def test_attach_salted_equals_broadcast(skewed):
    dim = skewed.select("g").distinct().withColumn("size", F.length(F.coalesce("g", F.lit("null"))))
    small = attach(skewed, dim, ["g"], null_safe=True)
    salted = attach(skewed, dim, ["g"], null_safe=True, broadcast_rows=0, spread_by=["id"], hot_rows=800)
    plain = attach(skewed, dim, ["g"], null_safe=True, broadcast_rows=0)
    assert rows(small) == rows(salted) == rows(plain)
    assert salted.count() == skewed.count()


def test_attach_null_keys(skewed):
    dim = skewed.select("g").distinct().withColumn("hit", F.lit(1))
    strict = attach(skewed, dim, ["g"])
    assert strict.filter("g IS NULL AND hit IS NOT NULL").count() == 0
    assert strict.count() == skewed.count()


def test_salted_join_spreads_a_hot_key(skewed):
    dim = skewed.select("g").distinct().withColumn("hit", F.lit(1))
    plan = lambda **kw: attach(skewed, dim, ["g"], null_safe=True, broadcast_rows=0, spread_by=["id"], **kw)._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64(" in plan(hot_rows=800)
    # without a hot key nothing is copied
    assert "explode" not in plan(hot_rows=100_000) and "explode" not in plan()


def test_latest_by_is_idempotent_and_order_free(skewed):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    once = dedup.latest_by(skewed, ["g"], order)
    assert rows(dedup.latest_by(once, ["g"], order)) == rows(once)
    assert rows(dedup.latest_by(skewed.orderBy(F.rand(5)).repartition(3), ["g"], order)) == rows(once)


def test_latest_by_limits_before_the_shuffle(skewed):
    plan = dedup.latest_by(skewed, ["g"], [F.col("id").asc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_marked_keeps_the_rows_of_latest_by_and_ranks_only_shared_keys(spark, monkeypatch):
    odd = F.when(F.col("id") % 2 == 0, F.lit(-0.0)).when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(0.0)
    shared = F.when(F.col("id") % 7 != 0, F.greatest(F.col("id"), F.lit(9_000)))  # null, one hot key, single ones
    frame = spark.range(20_000).select("id", shared.alias("k"), odd.alias("z"), (F.col("id") * 7919 % 101).alias("v"), F.lit("wide").alias("w"))
    written, order = stage(dedup.numbered(frame.repartition(5)), "wide"), [F.col("v").desc_nulls_last(), F.col("id").asc()]
    ranked, plain = [], dedup.latest_by
    monkeypatch.setattr(dedup, "latest_by", lambda df, *a, **k: ranked.append(df.count()) or plain(df, *a, **k))
    for keys in (["k"], ["k", "z"], ["z"], ["id"], [F.round("z", 2), F.col("k")]):
        for of in (None, written):
            kept = dedup.latest_marked(written, keys, order, of=of)
            assert kept.columns == written.columns
            assert rows(kept, "id", "k", "w") == rows(plain(frame, keys, order), "id", "k", "w")
    several = sum(i % 7 == 0 or i <= 9_000 for i in range(20_000))  # rows of the null key and of the hot one
    assert several <= ranked[0] <= several + 10 and ranked[6] <= 10
    assert dedup.latest_marked(written.where("false"), ["k"], order).count() == 0


def test_marks_that_are_too_many_to_broadcast_are_joined(spark, monkeypatch):
    frame = stage(dedup.numbered(spark.range(30_000).withColumn("k", F.col("id") % 20_000)), "wide")
    monkeypatch.setattr(dedup, "CHUNKS", 0)
    assert rows(dedup.latest_marked(frame, ["k"], [F.col("id").desc()]), "id") == sorted(((i,) for i in range(10_000, 30_000)), key=lambda r: str(r[0]))


def test_duplicate_reports(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None)], "id long, k string")
    groups_found = dedup.duplicate_groups(frame, ["k"], ["id"])
    assert rows(groups_found, "k", "row_count", "id_min", "id_max") == [("x", 2, 1, 2), (None, 2, 4, 5)]
    assert rows(dedup.duplicate_members(frame, ["k"], ["id"]), "id", "row_count") == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_iqr_edges(spark):
    data = [("one", 7.0), ("same", 3.0), ("same", 3.0), ("wide", 1.0), ("wide", 2.0), ("wide", 3.0), ("wide", 2.0),
            ("wide", 500.0), ("wide", None), (None, 9999.0)]
    frame = spark.createDataFrame(data, "g string, v double")
    kept = groups.remove_iqr_outliers(frame, ["g"], "v")
    assert rows(kept, "g", "v") == sorted(
        [d for d in data if d[1] != 500.0], key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def test_impute_median(spark):
    frame = spark.createDataFrame([(1, None), (2, 3.0), (3, 9.0), (4, 4.0)], "id int, v double")
    assert [r["v"] for r in quality.impute_median(frame, "v").orderBy("id").collect()] == [4.0, 3.0, 9.0, 4.0]
    empty = spark.createDataFrame([(1, None)], "id int, v double")
    assert quality.impute_median(empty, "v").first()["v"] is None


def test_label_map_extends_without_renumbering(spark):
    first = quality.label_map(spark.createDataFrame([("b",), ("a",), (None,)], "v string"), "v")
    assert rows(first) == [("a", 0), ("b", 1)]
    more = quality.extend_label_map(first, spark.createDataFrame([("b",), ("0",), ("z",)], "v string"), "v")
    assert rows(more) == [("0", 2), ("a", 0), ("b", 1), ("z", 3)]
    coded = joins.encode_labels(spark.createDataFrame([("a",), ("?",), (None,)], "v string"), "v", more, "c")
    assert rows(coded, "c") == [(-1,), (-1,), (0,)]


@pytest.mark.parametrize("chunk", [1, 2, 512])
def test_nearest_ties_nulls_and_chunks(spark, chunk):
    points = spark.createDataFrame(
        [(1, "w", 10.0, 20.0), (2, "w", 10.0, 20.0), (3, "w", 10.5, 20.0), (4, "v", 0.0, 0.0), (5, "u", None, None)],
        "pid long, ward string, latitude double, longitude double",
    )
    left = spark.createDataFrame(
        [(1, "w", 10.0, 20.001), (2, "w", 10.49, 20.0), (3, "none", 1.0, 1.0), (4, "w", None, 20.0), (5, None, 1.0, 1.0), (6, "u", 1.0, 1.0)],
        "id long, ward string, latitude double, longitude double",
    )
    near = joins.nearest(left, points, ["ward"], "pid", chunk=chunk)
    assert rows(near, "id", "pid") == [(1, 1), (2, 3), (3, None), (4, None), (5, None), (6, None)]


@pytest.mark.parametrize("chunk", [1, 2, 512])
def test_nearest_keeps_repeated_rows_of_crowded_buckets(spark, chunk):
    points = spark.range(700).selectExpr("id AS pid", "CASE WHEN id < 600 THEN 'big' ELSE concat('s', id % 3) END AS ward", "id / 10 AS latitude", "0D AS longitude")
    left = spark.createDataFrame(
        [(1, "big", 3.33, 0.0), (1, "big", 59.96, 0.0), (1, "big", 3.33, 0.0), (2, "s0", 60.0, 0.0), (2, "none", 1.0, 1.0), (None, "big", 0.0, 0.0)],
        "id long, ward string, latitude double, longitude double",
    )
    near = joins.nearest(left, points, ["ward"], "pid", chunk=chunk)
    assert rows(near, "latitude", "pid") == [(0.0, 0), (1.0, None), (3.33, 33), (3.33, 33), (59.96, 599), (60.0, 600)]


def _plain_nearest(left, points):
    """Compares every row with every point of its bucket."""
    out = {}
    for ident, ward, north, east in left:
        found = []
        for pid, bucket, a, b in points:
            if bucket == ward and None not in (north, east, a, b) and not math.isnan(north):
                y, x = (north - a) * 111000, (east - b) * 111000 * math.cos(north * (3.14159 / 180))
                found.append((math.floor(math.sqrt(y * y + x * x) + 0.5), pid))
        out[ident] = min(found)[::-1] if found else (None, None)
    return out


def _counted_cells(monkeypatch):
    """Point pairs that the grid search compares, one number for each round."""
    pairs, plain = [], joins.cells_around

    def spy(*args, **kwargs):
        frame = plain(*args, **kwargs)
        pairs.append(frame.agg(F.coalesce(F.sum(F.size("__points")), F.lit(0))).first()[0])
        return frame

    monkeypatch.setattr(joins, "cells_around", spy)
    return pairs


POINTS = "pid long, ward string, latitude double, longitude double"
PLACES = "id long, ward string, latitude double, longitude double"


@pytest.mark.parametrize("chunk", [8, 64])
def test_nearest_compares_a_tenth_of_all_pairs(spark, monkeypatch, chunk):
    rng = random.Random(1)
    points = [(i, rng.choice("ab") if i % 5 else "few", rng.gauss(10, 0.05), rng.gauss(20, 0.05)) for i in range(2500)]
    points += [(9000 + i, "a", 10.0, 20.0) for i in range(600)] + [(9990, "b", 0.0, 0.0), (9991, "b", None, 1.0)]
    left = [(i, rng.choice(["a", "b", "few"]), rng.gauss(10, 0.06), rng.gauss(20, 0.06)) for i in range(500)]
    left += [(900, "a", 0.0, 0.0), (901, "b", 50.0, -20.0), (902, "a", 10.0, 20.0), (903, "b", 10.0, 20.0), (904, "a", None, 2.0)]
    left += [(905, "a", float("nan"), 2.0), (906, None, 1.0, 2.0), (907, "none", 1.0, 2.0)]
    pairs = _counted_cells(monkeypatch)
    near = joins.nearest(spark.createDataFrame(left, PLACES), spark.createDataFrame(points, POINTS), ["ward"], "pid", chunk=chunk)
    assert {r.id: (r.pid, r.distance_m) for r in near.collect()} == _plain_nearest(left, points)
    every = sum(1 for _, ward, *_ in left for _, bucket, *_ in points if ward == bucket)
    assert len(pairs) > 1 and 0 < sum(pairs) < every / 10


def test_nearest_is_exact_at_cell_borders(spark):
    # points and places on the lines of a lattice, so many are on borders and at equal distances
    points = [(y * 40 + x, "w", y / 8, x / 8) for y in range(40) for x in range(40)]
    left = [(y * 81 + x, "w", y / 16, x / 16) for y in range(0, 81, 4) for x in range(81)]
    near = joins.nearest(spark.createDataFrame(left, PLACES), spark.createDataFrame(points, POINTS), ["ward"], "pid", chunk=16)
    assert {r.id: (r.pid, r.distance_m) for r in near.collect()} == _plain_nearest(left, points)


def test_nearest_with_points_at_one_place(spark):
    points = [(i, "w", 1.0, 2.0) for i in range(1500)] + [(i, "line", 3.0, i / 100) for i in range(100)]
    left = [(1, "w", 1.0, 2.0), (2, "w", 7.0, 7.0), (3, "line", 3.0, 0.254), (4, "line", 9.0, 0.506)]
    near = joins.nearest(spark.createDataFrame(left, PLACES), spark.createDataFrame(points, POINTS), ["ward"], "pid", chunk=8)
    assert {r.id: (r.pid, r.distance_m) for r in near.collect()} == _plain_nearest(left, points)


def test_nearest_compares_one_point_of_a_place(spark, monkeypatch):
    # stations of an interchange: 400 points at each of 20 places, which no grid can part
    points = [(7 * i % 8000, "w", float(i % 20), float(i % 4)) for i in range(8000)]
    left = [(i, "w", i / 10, i % 9 / 2) for i in range(200)] + [(200, "w", None, 1.0)]
    pairs = _counted_cells(monkeypatch)
    near = joins.nearest(spark.createDataFrame(left, PLACES), spark.createDataFrame(points, POINTS), ["ward"], "pid", chunk=8)
    assert {r.id: (r.pid, r.distance_m) for r in near.collect()} == _plain_nearest(left, points)
    assert 0 < sum(pairs) <= 20 * 200


def test_lowest_at_keeps_the_lowest_id_and_its_fields(spark):
    points = spark.createDataFrame(
        [(2, "w", 1.0, 0.0, "b"), (1, "w", 1.0, -0.0, "z"), (1, "w", 1.0, 0.0, "a"), (3, "v", 1.0, 0.0, None), (None, "v", 1.0, 0.0, "n")],
        "pid long, ward string, latitude double, longitude double, name string",
    )
    found = joins.lowest_at(points, ["ward", "latitude", "longitude"], ["pid", "name"])
    assert found.columns == points.columns and rows(found, "ward", "pid", "name") == [("v", None, "n"), ("w", 1, "a")]


def test_month_over_month_gap_and_year_wrap(spark):
    months = spark.createDataFrame(
        [("x", 202512, 202511, 5), ("x", 202601, 202512, 8), ("x", 202603, 202602, 9)], "k string, m int, p int, n long"
    )
    got = series.previous_period(months, ["k"], "m", "p", {"n": "prev_n"})
    assert rows(got, "m", "prev_n") == [(202512, None), (202601, 5), (202603, None)]


def test_rolling_frames(spark):
    frame = spark.createDataFrame([("x", i, float(i)) for i in range(1, 10)], "k string, d int, v double")
    got = series.rolling(frame, ["k"], "d", "v", "v", lags=(1, 3), means=(3,), extremes=(7,), change=True, versus=3)
    last = got.orderBy(F.desc("d")).first()
    assert (last["v_lag_1"], last["v_lag_3"], last["v_rolling_avg_3"], last["v_rolling_max_7"], last["v_rolling_min_7"]) == (8.0, 6.0, 8.0, 9.0, 3.0)
    assert last["v_change_from_lag_1"] == 1.0 and last["v_vs_rolling_avg_3"] == 9.0 / 8.0


def test_flatten_precedence(spark):
    frame = spark.sql(
        "SELECT 'top' AS title, named_struct('title', 'l', 'price', 1) AS list, "
        "named_struct('price', 2, 'area', 'd', 'ad', named_struct('area', 'x', 'ward', 'w', 'params', 'p')) AS detail"
    )
    flat = shape.flatten_struct(frame, "list")
    flat = shape.flatten_struct(flat, "detail", skip=("ad",))
    flat = shape.flatten_struct(flat, "detail.ad", prefix="ad_", skip=("params",))
    assert flat.columns == ["title", "list", "detail", "price", "area", "ad_ward"]
    assert flat.first()["title"] == "top" and flat.first()["price"] == 1
    assert shape.flatten_struct(frame, "absent").columns == frame.columns


def test_conform_names_drops_surplus(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "canho int, can_ho int, muanha int")
    got = shape.conform_names(frame, {"canho": "can_ho", "muanha": "mua_nha"})
    assert got.columns == ["can_ho", "mua_nha"] and got.first()["can_ho"] == 2


def test_unpivot_null_addend(spark):
    frame = spark.createDataFrame([(1, 2, None)], "id int, a int, b int")
    got = shape.unpivot_measures(frame, ["id"], {"sum": F.col("a") + F.col("b"), "a": F.col("a")}, "k", "v")
    assert rows(got) == [(1, "a", 2), (1, "sum", None)]


@pytest.mark.parametrize("n", [3, 500, 501])
def test_one_hot_has_one_form_for_any_number_of_labels(spark, n):
    frame = spark.createDataFrame([(f"{i:03d}",) for i in range(n)] + [(None,)], "v string")
    got = shape.one_hot(frame, "v", str)
    assert got.columns == ["v", *[f"cat_{i:03d}" for i in range(n)]]
    row = got.where("v = '002'").first()
    assert row["cat_002"] == 1 and sum(row[1:]) == 1
    named = shape.one_hot(frame, "v", str, labels=["001", "absent"])
    assert named.columns == ["v", "cat_001", "cat_absent", "cat_other"]
    found = {r.v: (r.cat_001, r.cat_absent, r.cat_other) for r in named.where("v IN ('001', '002') OR v IS NULL").collect()}
    assert found == {"001": (1, 0, {}), "002": (0, 0, {"002": 1}), None: (0, 0, {})}


def test_one_hot_labels_of_one_name_share_a_flag(spark):
    frame = spark.createDataFrame([("a b",), ("a-b",), ("c",), (None,)], "v string")
    got = shape.one_hot(frame, "v", lambda v: v.replace("-", "_").replace(" ", "_"))
    assert rows(got, "v", "cat_a_b", "cat_c") == [("a b", 1, 0), ("a-b", 1, 0), ("c", 0, 1), (None, 0, 0)]


def test_sanitize_floats_leaves_what_holds_none(spark):
    frame = spark.sql("SELECT struct('a' AS t, struct(1 AS i) AS s) AS plain, map('k', 1) AS m, array(1) AS a, -double('inf') AS low, double('nan') AS no, float('inf') AS high, -1.5D AS x")
    clean = shape.sanitize_floats(frame.repartition(1))
    plan = clean._jdf.queryExecution().analyzed().toString()
    assert "isnan" not in plan.lower() and "transform" not in plan and "named_struct(t, plain" not in plan
    row = clean.first()
    assert (row.low, row.no, row.high, row.x) == (None, None, None, -1.5) and row.plain.s.i == 1 and (row.m, row.a) == ({"k": 1}, [1])


def test_sanitize_floats_nested(spark):
    frame = spark.sql(
        "SELECT double('NaN') AS a, array(double('Infinity'), 1D) AS b, map('k', double('-Infinity')) AS c, named_struct('d', float('NaN'), 'e', 2) AS s"
    )
    row = shape.sanitize_floats(frame).first()
    assert row["a"] is None and row["b"] == [None, 1.0] and row["c"] == {"k": None} and row["s"]["d"] is None and row["s"]["e"] == 2


def test_observed_counts(spark):
    frame = spark.createDataFrame([(1,), (None,)], "v int")
    watched, seen = quality.observe_stage(frame, "stage", {"nulls": F.col("v").isNull()})
    watched.collect()
    assert seen.get == {"rows": 2, "nulls": 1}


def test_keys_and_violations(spark):
    dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    fact = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert rows(joins.pk_violations(dim, "k")) == [(2, 2), (None, 1)]
    assert rows(joins.fk_violations(fact, dim, "k")) == [(3, 2)]


def test_dedup_chain_does_not_depend_on_partitions(spark):
    from support import SF
    from gable.plans.adapter import listings

    base = listings(spark, SF)
    results = []
    for parts in (1, 4, 16):
        kept = silver.dedup_by_place(silver.dedup_by_content(silver.with_fingerprint(silver.dedup_by_id(base.repartition(parts)))))
        results.append(rows(kept, "list_id", "ad_id"))
    assert results[0] == results[1] == results[2] and results[0]
