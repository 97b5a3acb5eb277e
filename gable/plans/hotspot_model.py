"""Hotspot data set (place x day) and the level classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gable.functions import dates, scores
from gable.operators import groups, series
from gable.plans import gold, vocab
from gable.runtime import attach, stage
from gable.sources.sinks import replace_table

PLACE = ["area_name", "ward_name", "street_name"]

# Classes, categorical features and numeric features of the model.
LEVELS = ["Low", "Medium", "High"]
CATEGORICAL = ["area_name", "ward_name", "season", "location_tier", "metro_proximity_category"]
NUMERIC = [
    "year_value", "month_value", "quarter_value", "week_value", "day_of_week", "is_weekend",
    "area_name_encoded", "ward_name_encoded", "latitude", "longitude",
    "listing_count", "unique_seller_count", "price_avg", "price_per_m2_avg", "size_avg",
    "apt_count", "house_count", "land_count", "quality_score_avg", "market_saturation_score_avg",
    "seller_credibility_score_avg", "area_popularity_avg", "fully_legal_ratio", "risk_legal_ratio",
    "good_quality_ratio", "risk_quality_ratio", "company_seller_ratio", "listing_age_days_avg",
    "nearest_metro_distance_m", "metro_proximity_score", "search_volume_avg",
    "listing_count_lag_1", "listing_count_lag_2", "listing_count_lag_3",
    "listing_count_rolling_avg_3", "listing_count_rolling_avg_7",
    "listing_count_rolling_max_7", "listing_count_rolling_min_7",
    "listing_count_change_from_lag_1", "listing_count_vs_rolling_avg_7",
    "price_per_m2_lag_1", "price_per_m2_rolling_avg_7", "price_per_m2_change_from_lag_1",
    "unique_seller_count_lag_1", "unique_seller_count_rolling_avg_7",
    "market_saturation_score_lag_1", "market_saturation_score_rolling_avg_7",
]

#: Choices of this library: score of each proximity class, and how far the
#: next count must exceed the trailing mean for a level.
METRO_SCORES = {"Near_Metro": 1.0, "Close_To_Metro": 0.6, "Far_From_Metro": 0.2}
HIGH_RATIO, MEDIUM_RATIO = 1.5, 1.0


def level_of(count: Column, usual: Column, high: float = HIGH_RATIO, medium: float = MEDIUM_RATIO) -> Column:
    """Level of a count against its usual value; null without both."""
    ratio = count / F.nullif(usual, F.lit(0.0))
    return F.when(ratio >= high, "High").when(ratio >= medium, "Medium").when(ratio.isNotNull(), "Low")


def place_days(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per snapshot date and place with supply, price, quality, metro and search features."""
    names = t["dim_location"].select(
        "location_key", *PLACE, "area_name_encoded", "ward_name_encoded", "latitude", "longitude",
        F.col("location_tier").alias("place_tier"),
    )
    dated = t["fact_properties"].filter(F.col("snapshot_date").isNotNull())
    fact = attach(dated, names, ["location_key"], staged=True, spread_by=gold.LISTING_ID)
    fact = fact.filter(F.col("area_name").isNotNull())
    flags = {
        "apt_count": "is_apt", "house_count": "is_house", "land_count": "is_land",
        "fully_legal": "fully_legal", "risk_legal": "risk_legal",
        "good_quality": "good_quality", "risk_quality": "risk_quality", "company_seller": "is_company_ad",
    }
    means = {
        "price_avg": "price", "price_per_m2_avg": "price_per_m2", "size_avg": "size",
        "quality_score_avg": "quality_score", "market_saturation_score_avg": "market_saturation_score",
        "seller_credibility_score_avg": "seller_credibility_score", "area_popularity_avg": "area_popularity",
        "listing_age_days_avg": "listing_age_days", "latitude": "latitude", "longitude": "longitude",
    }
    counts = {n if n.endswith("_count") else f"__{n}": F.col(c) == 1 for n, c in flags.items()}
    days = fact.groupBy("snapshot_date", *PLACE).agg(
        F.max("area_name_encoded").alias("area_name_encoded"),
        F.max("ward_name_encoded").alias("ward_name_encoded"),
        F.max("place_tier").alias("location_tier"),
        F.count_distinct("list_id").alias("listing_count"),
        F.count_distinct("account_id").alias("unique_seller_count"),
        *[F.avg(F.col(c).cast("double")).alias(n) for n, c in means.items()],
        *groups.conditional_counts(counts),
    )
    shares = {n: f"__{n}" for n in flags if not n.endswith("_count")}
    days = days.withColumns({f"{n}_ratio": scores.safe_ratio(F.col(c), F.col("listing_count")) for n, c in shares.items()})
    days = days.drop(*shares.values())

    metro = (
        t["fact_metro_analysis"]
        .groupBy("snapshot_date", "location_key")
        .agg(F.min("distance_to_metro_m").alias("__near"))
        .join(names.select("location_key", *PLACE), "location_key")
        .groupBy("snapshot_date", *PLACE)
        .agg(F.min("__near").alias("nearest_metro_distance_m"))
    )
    days = days.join(metro, ["snapshot_date", *PLACE], "left")
    total = t["fact_search_trends_monthly"].filter(F.col("category_name") == vocab.SEARCH_CATEGORIES[3][1])
    searched = total.select(F.col("time_key").alias("__month"), "search_volume_avg")
    snapshot = F.col("snapshot_date")
    proximity = gold.proximity_class(F.col("nearest_metro_distance_m"))
    days = days.withColumns(
        {
            "__month": dates.month_start_key(snapshot),
            "year_value": F.year(snapshot),
            "month_value": F.month(snapshot),
            "quarter_value": F.quarter(snapshot),
            "week_value": F.weekofyear(snapshot),
            "day_of_week": F.dayofweek(snapshot),
            "is_weekend": dates.is_weekend(snapshot),
            "season": dates.season(snapshot),
            "metro_proximity_category": proximity,
            "metro_proximity_score": _class_score(proximity),
        }
    )
    # One row per calendar month, so the broadcast is bounded by the calendar.
    return days.join(F.broadcast(searched), "__month", "left").drop("__month")


def _class_score(proximity: Column) -> Column:
    chain = F
    for label, score in METRO_SCORES.items():
        chain = chain.when(proximity == label, score)
    return chain.otherwise(0.0)


def with_history(days: DataFrame) -> DataFrame:
    """Lags, rolling features and the two targets of each place."""
    def roll(df: DataFrame, column: str, stem: str, **what: object) -> DataFrame:
        return series.rolling(df, PLACE, "snapshot_date", column, stem, **what)

    rich = roll(days, "listing_count", "listing_count", lags=(1, 2, 3), means=(3, 7), extremes=(7,), change=True, versus=7)
    rich = roll(rich, "price_per_m2_avg", "price_per_m2", lags=(1,), means=(7,), change=True)
    rich = roll(rich, "unique_seller_count", "unique_seller_count", lags=(1,), means=(7,))
    rich = roll(rich, "market_saturation_score_avg", "market_saturation_score", lags=(1,), means=(7,))
    rich = series.lead_target(rich, PLACE, "snapshot_date", "listing_count", "target_next_listing_count")
    target = level_of(F.col("target_next_listing_count"), F.col("listing_count_rolling_avg_7"))
    return rich.withColumn("target_hotspot_level", target)


def hotspot_dataset(t: Mapping[str, DataFrame]) -> DataFrame:
    """Features and targets per snapshot date and place."""
    return with_history(place_days(t))


def training_rows(dataset: DataFrame) -> DataFrame:
    """Rows with targets and a full place."""
    needed = ["target_hotspot_level", "target_next_listing_count", "listing_count", "snapshot_date", *PLACE]
    return dataset.na.drop(subset=needed)


def time_split(df: DataFrame, train_until: str, valid_until: str, date: str = "snapshot_date") -> DataFrame:
    """Label rows train / valid / test by date, bounds included."""
    day = F.col(date)
    cases = {"train": day <= F.lit(train_until).cast("date"), "valid": day <= F.lit(valid_until).cast("date")}
    return df.withColumn("split", scores.first_true(cases, "test"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Row count per (actual, predicted)."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("row_count"))


def macro_f1(confusion: DataFrame) -> DataFrame:
    """Accuracy and unweighted mean F1 over the classes seen, as one row.

    The confusion table has at most classes x classes rows.
    """
    rows = F.col("row_count")
    hit = F.when(F.col("actual") == F.col("predicted"), rows).otherwise(0)
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), hit.alias("tp"), (rows - hit).alias("missed"), F.lit(0).cast("long").alias("wrong")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("missed"), (rows - hit).alias("wrong")),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "missed", "wrong")])
    base = 2 * F.col("tp") + F.col("missed") + F.col("wrong")
    f1 = F.when(base > 0, 2 * F.col("tp") / base.cast("double")).otherwise(0.0)
    hits, all_rows = F.sum("tp"), F.sum(F.col("tp") + F.col("missed"))
    return classes.agg(
        (hits.cast("double") / F.nullif(all_rows, F.lit(0))).alias("accuracy"), F.avg(f1).alias("macro_f1")
    )


def target_name(column: str, level: str) -> str:
    """Column of the statistic of a categorical column and a level."""
    return f"{column}__{level.lower()}"


#: Statistics of every categorical column, one for each level.
ENCODED = [target_name(c, level) for c in CATEGORICAL for level in LEVELS]

#: Rows that the even share of the levels counts for in a statistic.
PRIOR_ROWS = 3.0


def target_statistics(
    df: DataFrame,
    learn: Column,
    columns: Sequence[str] = CATEGORICAL,
    target: str = "target_hotspot_level",
    levels: Sequence[str] = LEVELS,
    date: str = "snapshot_date",
    prior_rows: float = PRIOR_ROWS,
) -> DataFrame:
    """Share of each level among the earlier rows of the same name, smoothed to an even share.

    A row's own day and later ones are never used, so a statistic knows nothing of the target it
    helps to predict; only rows where ``learn`` holds teach. Every name keeps its own statistic,
    however many there are; a null is a name. Rows are counted by name and day first, so the
    running sum of a name is over its days, and one row for each name and day is joined back.
    """
    for column in columns:
        hits = [F.count_if(learn & (F.col(target) == level)).alias(f"__{i}") for i, level in enumerate(levels)]
        daily = df.groupBy(column, date).agg(F.count_if(learn & F.col(target).isNotNull()).alias("__n"), *hits)
        before = Window.partitionBy(column).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
        seen = {c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("__n", *[f"__{i}" for i in range(len(levels))])}
        shares = [((seen[f"__{i}"] + prior_rows / len(levels)) / (seen["__n"] + prior_rows)).alias(target_name(column, level)) for i, level in enumerate(levels)]
        df = attach(df, daily.select(column, date, *shares), [column, date], null_safe=True)
    return df


def fit(train: DataFrame, *, boosted: bool = False, trees: int = 40, depth: int = 8, seed: int = 7):
    """A forest, or gradient-boosted trees of each level against the others, over rows with target statistics.

    Spark trains both in parallel; boosting runs ``trees`` rounds for each level. Names come in
    as their statistics (``target_statistics``), so neither the driver nor a tree node grows
    with the number of names. A null is filled with the median of its column; a column without
    any value in the training rows says nothing and is 0 throughout. Without training rows there
    is no model: ``None``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
    from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler

    train = _doubles(train)
    taught = train.filter(F.col("target_hotspot_level").isNotNull())
    rows, *valued = taught.agg(F.count("*"), *[F.count_if(F.col(c).isNotNull() & ~F.isnan(c)) for c in NUMERIC]).first()
    if rows == 0:
        return None
    filled = [f"{c}__filled" for c in NUMERIC]
    known = [c for c, n in zip(NUMERIC, valued, strict=True) if n]
    absent = ", ".join(f"0D AS `{c}__filled`" for c in NUMERIC if c not in known)
    if boosted:
        one = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.1, subsamplingRate=0.7)
        last = OneVsRest(classifier=one, parallelism=len(LEVELS))
    else:
        last = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
    stages = [
        StringIndexer(inputCol="target_hotspot_level", outputCol="label", handleInvalid="skip"),
        *([Imputer(inputCols=known, outputCols=[f"{c}__filled" for c in known], strategy="median")] if known else []),
        *([SQLTransformer(statement=f"SELECT *, {absent} FROM __THIS__")] if absent else []),
        VectorAssembler(inputCols=filled + ENCODED, outputCol="features", handleInvalid="keep"),
        last,
    ]
    return Pipeline(stages=stages).fit(taught)


def _doubles(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def predict(model, df: DataFrame) -> DataFrame:
    """Add ``predicted_level`` to every row with target statistics; without a model each level is as likely, and the first is named."""
    from pyspark.ml.feature import IndexToString

    if model is None:
        return df.withColumn("predicted_level", F.lit(LEVELS[0]))
    labels = model.stages[0].labels
    scored = _doubles(df)
    for step in model.stages[1:]:  # the first one codes levels, and would leave out rows of a level that it was not taught
        scored = step.transform(scored)
    return IndexToString(inputCol="prediction", outputCol="predicted_level", labels=labels).transform(scored)


def importances(model) -> list[tuple[str, float]]:
    """Feature importances, highest first; a categorical feature has the sum of its statistics.

    They sum to one: a level whose trees never split adds nothing, and where none split all features weigh the same.
    """
    models = [] if model is None else getattr(model.stages[-1], "models", [model.stages[-1]])
    weights = sum((m.featureImportances.toArray() for m in models), start=0.0)
    total = float(sum(weights)) if models else 0.0
    summed = dict.fromkeys(NUMERIC + CATEGORICAL, 0.0)
    if total == 0:
        return [(name, 1 / len(summed)) for name in summed]
    weights = weights / total
    for name, weight in zip(NUMERIC + ENCODED, map(float, weights), strict=True):
        summed[name if name in summed else name.rsplit("__", 1)[0]] += weight
    return sorted(summed.items(), key=lambda pair: -pair[1])


def model_rows(dataset: DataFrame, train_until: str, valid_until: str) -> DataFrame:
    """Rows with targets, their split, and target statistics learnt from the first one."""
    rows = time_split(training_rows(dataset), train_until, valid_until)
    return stage(target_statistics(rows, F.col("split") == "train"), "hotspot-rows")


def train_and_score(dataset: DataFrame, train_until: str, valid_until: str, **options: int) -> tuple[DataFrame, DataFrame]:
    """Fit on the first period; scores of each period and the weight of each feature.

    Scores are ``split, row_count, accuracy, macro_f1, naive_accuracy`` (of always
    guessing the most frequent level of the split), weights ``feature, importance``.
    """
    rows = model_rows(dataset, train_until, valid_until)
    model = fit(rows.filter(F.col("split") == "train"), **options)
    scored = stage(
        predict(model, rows).select("split", "target_hotspot_level", "predicted_level"), "hotspot-scored"
    )
    levels = scored.groupBy("split", "target_hotspot_level").agg(F.count("*").alias("n"))
    sizes = levels.groupBy("split").agg(F.sum("n").alias("row_count"), (F.max("n") / F.sum("n")).alias("naive_accuracy"))
    reports = [
        macro_f1(confusion_matrix(scored.filter(F.col("split") == s), "target_hotspot_level", "predicted_level")).select(
            F.lit(s).alias("split"), "accuracy", "macro_f1"
        )
        for s in ("train", "valid", "test")
    ]
    scores_ = reports[0].unionByName(reports[1]).unionByName(reports[2]).join(sizes, "split")
    weights = dataset.sparkSession.createDataFrame(importances(model), "feature string, importance double")
    return scores_, weights


def job_hotspot_model(dataset: DataFrame, train_until: str, valid_until: str, scores_table: str, weights_table: str, **options: int) -> None:
    """Trains the model and stores its scores by split and its feature weights as tables."""
    found = train_and_score(dataset, train_until, valid_until, **options)
    for frame, table in zip(found, (scores_table, weights_table), strict=True):
        replace_table(frame, table)
