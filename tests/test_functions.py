"""Column rules on hand-made edge rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from gable.functions import dates, scores, text
from gable.operators import quality, shape
from gable.plans import gold, silver, vocab


def one(spark, value, kind, expression):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("85,5 triệu/m²", 85.5), ("1.2.3", None), ("", None), (None, None), ("12.", 12.0), ("abc", None), ("giá 7 tỷ 5", 7.0), (",", None)],
)
def test_extract_number(spark, value, expected):
    assert one(spark, value, "string", text.extract_number) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [(" Căn hộ/Chung cư ", "can_ho_chung_cu"), ("Đất", "at"), ("Nhà ở", "nha_o"), ("a__b--c", "a_b_c"), ("Ọ ỹ ừ", "o_y_u"), ("***", ""), (None, None)],
)
def test_slug(spark, value, expected):
    assert one(spark, value, "string", text.slug) == expected
    if value is not None:
        assert text.slug_label(value) == expected


@pytest.mark.parametrize(
    ("name", "expected"),
    [("bất_x20động_x20sản", "bat_ong_san"), ("muax20nhà", "mua_nha"), ("căn hộ", "canho"), ("isPartial", "ispartial"), ("__a__b_", "a_b")],
)
def test_slug_name(name, expected):
    assert text.slug_name(name) == expected


@pytest.mark.parametrize(("value", "expected"), [("TRUE", 1), ("true", 1), ("1", 1), ("False", 0), ("0", 0), ("", None), ("yes", None), (None, None)])
def test_bool_to_int(spark, value, expected):
    assert one(spark, value, "string", text.bool_to_int) == expected


def test_first_non_empty(spark):
    frame = spark.createDataFrame(
        [("r", 1, 2), ("", 1, 2), (None, 0, 2), ("0", None, 0), (None, None, None)], "a string, b long, c long"
    )
    got = [r[0] for r in frame.select(text.first_non_empty(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["r", "1", "2", None, None]


def test_date_from_path(spark):
    assert one(spark, "s3://b/date=2026-01-31/x.jsonl", "string", text.date_from_path) == "2026-01-31"
    assert one(spark, "s3://b/day=2026-01-31/x.jsonl", "string", text.date_from_path) is None


def test_event_date_crosses_midnight_and_falls_back(spark):
    ms = int(datetime.datetime(2026, 1, 31, 23, 30, tzinfo=datetime.timezone.utc).timestamp() * 1000)
    frame = spark.createDataFrame([(ms, None), (0, ms), (None, ms), (None, None)], "a long, b long")
    got = [r[0] for r in frame.select(dates.event_date(F.col("a"), F.col("b"), zone="Asia/Ho_Chi_Minh")).collect()]
    assert got[:3] == [datetime.date(2026, 2, 1)] * 3
    assert abs((got[3] - datetime.date.today()).days) <= 1


def test_epoch_drops_milliseconds(spark):
    got = one(spark, 1_700_000_000_999, "long", lambda c: dates.epoch_ms_to_ts(c).cast("long"))
    assert got == 1_700_000_000


def test_previous_month_wraps(spark):
    frame = spark.createDataFrame([(2026, 1), (2026, 12)], "y int, m int")
    got = [r[0] for r in frame.select(dates.previous_month_number(F.col("y"), F.col("m"))).collect()]
    assert got == [202512, 202611]


@pytest.mark.parametrize(
    ("text_value", "flags"),
    [
        ("Hẻm xe hơi", (1, 0, 0)), ("Chưa có thổ cư", (0, 1, 0)), ("MẶT TIỀN, Nhà chưa hoàn công", (0, 1, 0)),
        ("mặt TIỀN", (1, 0, 0)), ("yên tĩnh", (0, 0, 1)), (None, (0, 0, 1)),
    ],
)
def test_trait_flags(spark, text_value, flags):
    frame = spark.createDataFrame([(text_value,)], "v string")
    got = frame.select(*[c.alias(n) for n, c in silver.trait_flags(F.col("v")).items()]).first()
    assert tuple(got) == flags


def test_classify_looks_for_each_trait_word_once(spark):
    frame = spark.createDataFrame([("Hẻm xe hơi",), ("CHƯA CÓ THỔ CƯ, mặt tiền",), (None,)], "param_pty_characteristics string").coalesce(1)
    flagged = silver.classify(shape.ensure_columns(frame, silver.OPTIONAL_COLUMNS))
    got = flagged.select("good_quality", "risk_quality", "low_quality")
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") <= len(vocab.GOOD_TRAITS) + len(vocab.RISK_TRAITS) and not [c for c in flagged.columns if c.startswith("__")]



@pytest.mark.parametrize(
    ("document", "flags"),
    [("Đã có sổ", (1, 0, 0)), ("Hợp đồng mua bán", (0, 1, 0)), ("Không có sổ", (0, 0, 1)), ("1", (0, 0, 1)), (None, (0, 0, 1)), ("khác", (0, 0, 0))],
)
def test_legal_flags(spark, document, flags):
    frame = spark.createDataFrame([(document,)], "v string")
    assert tuple(frame.select(*silver.legal_flags(F.col("v")).values()).first()) == flags


@pytest.mark.parametrize(("value", "flags"), [("Nội thất đầy đủ", (1, 0)), ("Bàn giao thô", (0, 1)), (None, (0, 1)), ("lạ", (0, 1))])
def test_furnishing_flags(spark, value, flags):
    frame = spark.createDataFrame([(value,)], "v string")
    assert tuple(frame.select(*silver.furnishing_flags(F.col("v")).values()).first()) == flags


@pytest.mark.parametrize(("value", "flags"), [(1, (1, 0)), (0, (0, 1)), (None, (0, 0)), (2, (0, 0))])
def test_advertiser_flags(spark, value, flags):
    frame = spark.createDataFrame([(value,)], "v int")
    assert tuple(frame.select(*silver.advertiser_flags(F.col("v")).values()).first()) == flags


@pytest.mark.parametrize(("age", "label"), [(7, 0), (8, 1), (30, 1), (31, 2), (90, 2), (91, 3), (None, 3)])
def test_age_bucket(spark, age, label):
    bucket = one(spark, age, "int", lambda c: scores.band(c, vocab.AGE_EDGES, vocab.AGE_LABELS, inclusive=True))
    assert bucket == vocab.AGE_LABELS[label]


@pytest.mark.parametrize(
    ("distance", "label"),
    [(None, "No_Metro_In_Ward"), (0.0, "Near_Metro"), (499.0, "Near_Metro"), (500.0, "Close_To_Metro"), (1500.0, "Far_From_Metro")],
)
def test_proximity_class(spark, distance, label):
    assert one(spark, distance, "double", gold.proximity_class) == label


@pytest.mark.parametrize(
    ("images", "richness"), [(None, 0), (0.0, 0), (0.5, 1), (1.0, 3), (3.0, 5), (5.0, 7), (10.0, 10)]
)
def test_image_richness(spark, images, richness):
    assert one(spark, images, "double", scores.image_richness) == richness


@pytest.mark.parametrize(
    ("rooms", "has_rooms", "label"),
    [(3.0, 0, "No_Rooms_Land"), (None, 1, "Unknown_Rooms"), (0.0, 1, "Unknown_Rooms"), (0.5, 1, "Studio"), (1.0, 1, "1BR"),
     (4.9, 1, "4BR"), (5.0, 1, "5BR_Plus"), (-1.0, 1, "Unknown")],
)
def test_rooms_band(spark, rooms, has_rooms, label):
    frame = spark.createDataFrame([(rooms, has_rooms)], "r double, h int")
    assert frame.select(scores.rooms_band(F.col("r"), F.col("h"))).first()[0] == label


def test_dominant_ties_and_nulls(spark):
    frame = spark.createDataFrame([(2, 2, 2), (0, 0, 0), (1, 3, 3), (None, 5, 1)], "a long, h long, l long")
    counts = {"apt": F.col("a"), "house": F.col("h"), "land": F.col("l")}
    got = [tuple(r) for r in frame.select(scores.dominant(counts, "none"), scores.largest(counts, F.lit(0).cast("long"))).collect()]
    assert got == [("apt", 2), ("apt", 0), ("house", 3), ("none", 0)]


def test_sign_pair_label(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, -2.0), (-1.0, 2.0), (-1.0, -2.0), (0.0, 1.0), (None, 1.0)], "a double, b double")
    label = scores.sign_pair_label(F.col("a"), F.col("b"), vocab.TRENDS, vocab.TREND_UNCLEAR)
    got = [r[0] for r in frame.select(label).collect()]
    assert got == [*vocab.TRENDS.values(), vocab.TREND_UNCLEAR, vocab.TREND_UNCLEAR]


def test_guarded_arithmetic_never_throws(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in frame.select(scores.safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, None, 1.5]
    assert [r[0] for r in frame.select(scores.price_per_unit(F.col("a"), F.col("b"))).collect()] == [None, None, None, 1.5]
    assert frame.select(scores.saturation(F.lit(10), F.lit(1.0), F.lit(0.0))).first()[0] is None
    assert frame.select(scores.zscore(F.lit(1.0), F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_saturation_is_capped(spark):
    assert one(spark, 1000, "int", lambda c: scores.saturation(c, F.lit(5.0), F.lit(10.0))) == 100.0
    assert one(spark, 10, "int", lambda c: scores.saturation(c, F.lit(5.0), F.lit(10.0))) == 30.0


def test_size_consistency_edges(spark):
    frame = spark.createDataFrame(
        [(1, 11.0, 1.0, 10.0), (2, 11.1, 1.0, 10.0), (3, 5.0, 1.0, 0.0), (4, None, 1.0, 10.0), (5, 9.0, 1.0, 10.0)],
        "id int, width double, length double, size double",
    )
    assert [r[0] for r in quality.drop_inconsistent(frame).orderBy("id").collect()] == [1, 3, 4, 5]


def test_not_in_or_null(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r[0] for r in frame.filter(quality.not_in_or_null(F.col("v"), ["a"])).collect()] == ["b", None]


def test_keep_complete(spark):
    frame = spark.createDataFrame([("false",), ("False",), ("true",), (None,)], "ispartial string")
    assert quality.keep_complete(frame).count() == 2
    assert quality.keep_complete(spark.createDataFrame([(False,), (True,), (None,)], "ispartial boolean")).count() == 1


def test_scores_add_up(spark):
    columns = "fully_legal int, semi_legal int, good_quality int, is_furnishing int, is_company_ad int, number_of_images double"
    frame = spark.createDataFrame([(1, 1, 1, 1, 1, 9.0), (0, 1, 0, 0, 0, 1.0), (0, 0, 0, 0, 0, None)], columns)
    got = [tuple(r) for r in frame.select(gold.quality_score(), gold.seller_credibility()).collect()]
    assert got == [(100.0, 100.0), (20.0, 10.0), (0.0, 0.0)]
