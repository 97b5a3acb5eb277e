"""Listing-shaped inputs derived from the order tables.

Every row of the source tables is used; the arithmetic only spreads values so
that each cleaning rule has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gable.plans import vocab


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """One flat listing per order line."""
    line, order = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part, supplier = table(spark, folder, "part"), table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    joined = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    number, key = F.col("l_linenumber"), F.col("l_partkey")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    snapshot = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(days, F.lit(120)).cast("int"))
    crawled = F.date_sub(snapshot, ((F.col("l_quantity") * 3).cast("int") % 130)).cast("timestamp_ntz")
    kind = F.col("p_type")
    category = (
        F.when(kind.isin("SMALL", "MEDIUM"), vocab.APARTMENT)
        .when(kind == "LARGE", vocab.LAND)
        .when(kind == "PROMO", vocab.OFFICE)
        .otherwise(vocab.HOUSE)
    )
    first_word = F.split("p_name", " ")[0]
    return joined.select(
        (F.col("l_orderkey") * 10 + number).alias("list_id"),
        (F.col("l_orderkey") * 1000000 + key * 10 + number).alias("ad_id"),
        F.col("l_suppkey").alias("account_id"),
        F.col("s_name").alias("account_name"),
        F.col("p_name").alias("subject"),
        F.when(F.col("s_nationkey") % 3 != 2, F.col("s_nationkey") % 3).alias("company_ad"),
        F.when(key % 97 != 0, F.floor(F.col("l_extendedprice") / 5000) * F.lit(5000.0)).alias("price"),
        F.col("l_quantity").alias("size"),
        F.when(number != 7, number.cast("double")).alias("width"),
        (F.col("l_quantity") / number.cast("double") * F.when(key % 7 == 0, 1.25).otherwise(1.0)).alias("length"),
        F.when(~kind.isin("LARGE", "PROMO"), (F.col("p_size") % 6).cast("double")).alias("rooms"),
        category.alias("category_name"),
        F.lit("Region").alias("region_name"),
        F.col("n_name").alias("area_name"),
        F.when(
            key % 53 != 0,
            F.concat(
                F.lit("Phường "),
                (key % 3).cast("string"),
                F.when(key % 5 == 0, " (Quận 3 cũ)").otherwise(""),
            ),
        ).alias("ward_name"),
        F.col("o_orderstatus").alias("street_name"),
        (F.lit(10.7) + (F.col("l_suppkey") % 20).cast("double") / 100 + (key % 3).cast("double") / 1000).alias("latitude"),
        (F.lit(106.6) + (F.col("l_suppkey") % 10).cast("double") / 50).alias("longitude"),
        F.when(number != 7, (key % 12).cast("double")).alias("number_of_images"),
        F.when(F.col("l_linestatus") == "F", "Nội thất đầy đủ")
        .when(number % 2 == 0, "Bàn giao thô")
        .alias("param_furnishing_sell"),
        F.when(F.col("l_returnflag") == "A", "Đã có sổ")
        .when(F.col("l_returnflag") == "N", "Đang chờ sổ")
        .when(number % 2 == 0, "Không có sổ")
        .alias("param_property_legal_document"),
        F.when(key % 89 == 0, "liên hệ")
        .when(key % 83 == 0, "1.2.3")
        .otherwise(
            F.concat(F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("string"), F.lit(",5 triệu/m²"))
        )
        .alias("param_price_m2"),
        F.when(first_word == "red", "Hẻm xe hơi")
        .when(first_word == "hot", "MẶT TIỀN, Nở hậu")
        .when(first_word == "old", "Chưa có thổ cư")
        .when(first_word == "cold", "Mặt tiền, Nhà chưa hoàn công")
        .alias("param_pty_characteristics"),
        snapshot.alias("snapshot_date"),
        crawled.alias("crawled_at_ts"),
        F.col("l_shipdate").alias("list_time"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Two stations per supplier, in the supplier's area."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    k, key = F.col("k"), F.col("s_suppkey")
    placed = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    placed = placed.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    number = key * 2 + k + 1
    return placed.select(
        number.alias("station_id"),
        F.concat(F.lit("L1-"), number.cast("string")).alias("station_code"),
        F.concat("s_name", F.lit("/"), k.cast("string")).alias("station_name"),
        F.when(key % 2 == 0, "Elevated").otherwise("Underground").alias("station_type"),
        F.lit("Operating").alias("station_status"),
        F.col("n_name").alias("area_name"),
        F.concat(F.lit("Phường "), (key % 3).cast("string")).alias("ward_name"),
        (F.lit(10.7) + (key % 20).cast("double") / 100 + k.cast("double") * 0.004).alias("latitude"),
        (F.lit(106.6) + (key % 10).cast("double") / 50 + (key % 4).cast("double") * 0.003).alias("longitude"),
        F.element_at(F.array(F.lit("TRUE"), F.lit("FALSE"), F.lit("")), (number % 3 + 1).cast("int")).alias("amenity_atm"),
        F.when(key % 4 == 0, "1").when(key % 4 == 1, "False").alias("amenity_elevator"),
    )


def trends(spark: SparkSession, folder: str) -> DataFrame:
    """Daily keyword counts from the event stream, spread over three months."""
    # Which event type stands for which keyword.
    kinds = {"bat_dong_san": "view", "mua_nha": "click", "can_ho": "purchase", "chung_cu": "signup", "dat_nen": "error"}
    day = F.date_add(F.col("ts").cast("date"), ((F.col("user_id") % 3) * 31).cast("int"))
    counts = [F.count_if(F.col("event_type") == v).alias(k) for k, v in kinds.items()]
    return table(spark, folder, "events").groupBy(day.alias("date")).agg(F.lit("hcm_real_estate").alias("keyword_group"), *counts)
