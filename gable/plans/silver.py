"""Bronze to silver: listings, stations, search interest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gable.functions import dates, scores, text
from gable.operators import dedup, groups, joins, quality, shape
from gable.plans import vocab
from gable.runtime import stage

# Columns of the content fingerprint, those of them that nothing else reads, and columns of the silver table.
FINGERPRINT_COLUMNS = ["subject", "body", "price_string", "latitude", "longitude", "size", "account_id"]
PRINTED_ONLY = ["subject", "body", "price_string"]
ADDRESS_COLUMNS = ["region_name", "area_name", "street_name", "ward_name"]
SILVER_COLUMNS = [
    "snapshot_date", "crawled_at_ts", "ad_id", "list_id", "account_id", "account_name", "price", "size", "rooms",
    "category_name", "area_name", "ward_name", "street_name", "latitude", "longitude", "number_of_images",
    "param_furnishing_sell", "param_property_legal_document", "param_price_m2", "param_pty_characteristics",
    "is_land", "is_apt", "is_house", "has_rooms", "is_not_furnishing", "is_furnishing",
    "good_quality", "risk_quality", "low_quality", "is_company_ad", "is_personal_ad",
    "fully_legal", "semi_legal", "risk_legal", "_ingest_ts", "area_name_encoded", "ward_name_encoded", "content_fp",
]
STATION_COLUMNS = [
    "station_id", "station_code", "station_name", "slug", "station_type", "station_status", "latitude", "longitude",
    "address", "area_name", "area_name_encoded", "ward_name", "ward_name_encoded",
    "amenity_atm", "amenity_elevator", "amenity_parking", "amenity_wifi", "_ingest_ts",
]


def flatten_records(raw: DataFrame) -> DataFrame:
    """Nested records to flat listings; ``list`` beats ``detail`` beats ``detail.ad``."""
    flat = raw
    if "snapshot_date" not in raw.columns and "_source_path" in raw.columns:
        flat = flat.withColumn("snapshot_date", text.date_from_path(F.col("_source_path")).try_cast("date"))
    flat = shape.coalesce_columns(flat, "crawled_at_unix", ["crawled_at"])
    flat = shape.flatten_struct(flat, "list")
    flat = shape.flatten_struct(flat, "detail", skip=("ad", "parameters", "ad_params"))
    flat = shape.flatten_struct(flat, "detail.ad", prefix="ad_", skip=("params",))
    flat = shape.extract_json_paths(flat, "detail", vocab.PARAM_PATHS)
    if "crawled_at_ts" not in flat.columns and "crawled_at_unix" in flat.columns:
        flat = flat.withColumn("crawled_at_ts", dates.epoch_ms_to_ts(F.col("crawled_at_unix")))
    return flat


def type_flags(category: Column) -> dict[str, Column]:
    """Property type flags; offices count as land, homes have rooms."""
    homes = vocab.APARTMENT_CATEGORIES + vocab.HOUSE_CATEGORIES
    return {
        "is_land": scores.flag(category.isin(*vocab.LAND_CATEGORIES)),
        "is_apt": scores.flag(category.isin(*vocab.APARTMENT_CATEGORIES)),
        "is_house": scores.flag(category.isin(*vocab.HOUSE_CATEGORIES)),
        "has_rooms": scores.flag(category.isin(*homes)),
    }


def furnishing_flags(furnishing: Column) -> dict[str, Column]:
    furnished, bare = scores.listed_flags(furnishing, vocab.FURNISHED)
    return {"is_furnishing": furnished, "is_not_furnishing": bare}


def trait_flags(traits: Column) -> dict[str, Column]:
    """Risk words win over good words; neither is low."""
    return trait_classes(text.contains_any(traits, vocab.GOOD_TRAITS), text.contains_any(traits, vocab.RISK_TRAITS))


def trait_classes(good: Column, risk: Column) -> dict[str, Column]:
    return {
        "good_quality": scores.flag(good & ~risk),
        "risk_quality": scores.flag(risk),
        "low_quality": scores.flag(~good & ~risk),
    }


def advertiser_flags(company: Column) -> dict[str, Column]:
    return {"is_company_ad": scores.flag(company == 1), "is_personal_ad": scores.flag(company == 0)}


def legal_flags(document: Column) -> dict[str, Column]:
    """No document is a risk; an unlisted document is none of the three."""
    return {
        "fully_legal": scores.flag(document.isin(*vocab.FULLY_LEGAL)),
        "semi_legal": scores.flag(document.isin(*vocab.SEMI_LEGAL)),
        "risk_legal": scores.flag(document.isin(*vocab.RISK_LEGAL) | document.isNull()),
    }


def newest_first(df: DataFrame, preferred: str) -> list[Column]:
    """Newest row first, then ids so that the order is total."""
    by_time = [c for c in (preferred, "_ingest_ts") if c in df.columns]
    ids = [c for c in ("ad_id", "account_id", "list_id") if c in df.columns]
    return [F.col(c).desc_nulls_last() for c in by_time] + [F.col(c).asc_nulls_first() for c in ids]


def dedup_by_id(df: DataFrame, latest: Callable[..., DataFrame] = dedup.latest_by) -> DataFrame:
    return latest(df, ["list_id"], newest_first(df, "list_time"))


def with_fingerprint(df: DataFrame) -> DataFrame:
    present = [c for c in FINGERPRINT_COLUMNS if c in df.columns]
    return df.withColumn("content_fp", text.fingerprint(present) if present else F.lit(None).cast("string"))


def packed_fingerprint(df: DataFrame) -> DataFrame:
    """``content_fp`` as its bytes, half as long as its digits where rows are shuffled and stored."""
    return df.withColumn("content_fp", F.unhex("content_fp"))


def spelled_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn("content_fp", F.lower(F.hex("content_fp")))


def _time_column(df: DataFrame) -> str:
    return "crawled_at_ts" if "crawled_at_ts" in df.columns else "list_time"


def dedup_by_content(df: DataFrame, latest: Callable[..., DataFrame] = dedup.latest_by, **options) -> DataFrame:
    return latest(df, ["content_fp"], newest_first(df, _time_column(df)), **options)


def dedup_by_place(df: DataFrame, latest: Callable[..., DataFrame] = dedup.latest_by, **options) -> DataFrame:
    keys = [*dedup.geo_keys(), F.col("price"), F.col("size")]
    return latest(df, keys, newest_first(df, _time_column(df)), **options)


def repaired_ward() -> Column:
    return text.strip_pattern(F.col("ward_name"), vocab.OLD_DISTRICT_SUFFIX)


def repair(df: DataFrame) -> DataFrame:
    """All row-level repairs."""
    return df.withColumns(
        {
            "rooms": F.coalesce(F.col("rooms"), F.lit(0.0)),
            "ward_name": repaired_ward(),
            "param_price_m2": text.extract_number(F.col("param_price_m2")),
        }
    )


def classify(df: DataFrame) -> DataFrame:
    """All row-level flags and repairs."""
    return with_flags(repair(df))


def with_flags(df: DataFrame) -> DataFrame:
    """All row-level flags; words are looked for once a row and not again in each flag."""
    traits = F.lower(F.coalesce(F.col("param_pty_characteristics").cast("string"), F.lit("")))
    lowered = df.withColumn("__traits", traits)
    words = {"__good": vocab.GOOD_TRAITS, "__risk": vocab.RISK_TRAITS}
    found = lowered.withColumns({c: text.holds_any(F.col("__traits"), terms) for c, terms in words.items()})
    return found.withColumns(
        {
            **type_flags(F.col("category_name")),
            **furnishing_flags(F.col("param_furnishing_sell")),
            **trait_classes(F.col("__good"), F.col("__risk")),
            **advertiser_flags(F.col("company_ad")),
            **legal_flags(F.col("param_property_legal_document")),
        }
    ).drop("__traits", *words)


#: Columns the cleaning rules read, with the type an absent one gets.
OPTIONAL_COLUMNS = {
    "category_name": "string", "area_name": "string", "ward_name": "string", "param_furnishing_sell": "string", "param_pty_characteristics": "string",
    "param_property_legal_document": "string", "param_price_m2": "string", "company_ad": "int", "rooms": "double", "width": "double", "length": "double",
    "size": "double", "price": "double", "number_of_images": "double",
}
PLACE_COLUMNS = ["latitude", "longitude", "price", "size"]


def narrowed(flat: DataFrame) -> DataFrame:
    """The columns that cleaning uses or keeps; nested originals and unused fields stay behind before any shuffle."""
    wanted = dict.fromkeys([*SILVER_COLUMNS, *FINGERPRINT_COLUMNS, *ADDRESS_COLUMNS, *OPTIONAL_COLUMNS, "list_time", "_ingest_ts"])
    return flat.select(*[c for c in wanted if c in flat.columns])


def clean_listings(
    flat: DataFrame,
    *,
    area_codes: DataFrame | None = None,
    ward_codes: DataFrame | None = None,
    exact: bool = True,
    watch: Callable[[DataFrame, str], DataFrame] = lambda rows, _: rows,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flat listings to silver rows plus the (label, code) tables used.

    Given code tables are kept and extended, so codes stay stable over runs.
    Rows are written once, numbered, and stay where they lie: the dedups shuffle
    keys and times alone and mark what stays, which the median, the codes and the
    outlier bounds each read. Labels are read once, and rows within the bounds are marked
    once, before the dedup by place reads them three times. Flags are made for the rows that are left. A rule
    whose column is absent does not apply; flags then come out as for a null. Rows
    without a ``list_id`` count as one listing, as defined, if the column is there
    at all. ``watch`` sees the rows after each step by name.
    """
    rows = narrowed(flat)
    given = set(rows.columns)
    rows = packed_fingerprint(with_fingerprint(rows)).drop(*PRINTED_ONLY)
    rows = written = stage(dedup.numbered(rows), "unique")
    if "list_id" in given:
        rows = dedup_by_id(rows, dedup.latest_marked)
    rows = watch(rows, "one_per_id")
    unique = watch(dedup_by_content(rows, dedup.latest_marked, of=written) if given & set(FINGERPRINT_COLUMNS) else rows, "one_per_content")
    addressed = watch(quality.drop_any_null(unique, ADDRESS_COLUMNS), "with_address")
    kept = shape.ensure_columns(addressed, OPTIONAL_COLUMNS)
    repaired = repair(kept)

    labels = quality.labels_of(kept, ["area_name", "ward_name", "category_name"])
    area_codes = _codes(area_codes, labels, "area_name")
    ward_codes = _codes(ward_codes, labels.withColumn("ward_name", repaired_ward()), "ward_name")

    priced = groups.remove_iqr_outliers(repaired, ["area_name"], "param_price_m2", exact=exact)
    consistent = watch(quality.drop_inconsistent(watch(priced, "without_outliers")), "consistent_size")
    plain = shape.ensure_columns(written, OPTIONAL_COLUMNS)
    sized = repair(dedup.still_in(plain, consistent)).withColumn("size", F.round("size", 2))
    if given.issuperset(PLACE_COLUMNS):
        single = dedup_by_place(sized, dedup.latest_marked, of=plain)
        sized = repair(single).withColumn("size", F.round("size", 2))
    coded = with_flags(quality.impute_median(watch(sized, "one_per_place"), "number_of_images", exact=exact, of=kept))
    if "category_name" in given:
        coded = shape.one_hot(coded, "category_name", text.slug_label, labels_from=labels)
    coded = joins.encode_labels(coded, "area_name", area_codes, "area_name_encoded", staged=True)
    coded = joins.encode_labels(coded, "ward_name", ward_codes, "ward_name_encoded", staged=True)
    silver = shape.project_existing(spelled_fingerprint(coded), SILVER_COLUMNS, ["cat_"])
    return shape.drop_null_typed(silver), area_codes, ward_codes


def _codes(known: DataFrame | None, df: DataFrame, column: str) -> DataFrame:
    return quality.label_map(df, column) if known is None else quality.extend_label_map(known, df, column)


def clean_stations(raw: DataFrame, area_codes: DataFrame, ward_codes: DataFrame) -> DataFrame:
    """Stations with numeric amenities and shared area / ward codes, one row per id.

    The code tables are stored tables, as :func:`clean_listings` returns them.
    """
    named = raw.withColumnsRenamed({"lat": "latitude", "lng": "longitude"})
    amenities = {c: text.bool_to_int(F.col(c)) for c in named.columns if c.startswith("amenity_")}
    typed = named.withColumns({"latitude": F.col("latitude").cast("double"), "longitude": F.col("longitude").cast("double"), **amenities})
    coded = joins.encode_labels(typed, "area_name", area_codes, "area_name_encoded", staged=True)
    coded = joins.encode_labels(coded, "ward_name", ward_codes, "ward_name_encoded", staged=True)
    single = dedup.latest_by(coded, ["station_id"], [F.col("station_code").asc_nulls_last(), F.col("station_name").asc_nulls_last()])
    return shape.project_existing(single, STATION_COLUMNS)


def clean_trends(raw: DataFrame, *, geo: str = "VN", region: str = "Vietnam") -> DataFrame:
    """Search-interest records to one wide row per date and keyword group."""
    named = shape.normalize_names(raw, text.slug_name)
    if "values" in named.columns:
        named = shape.widen_map(named, "values", vocab.KEYWORDS)
    named = shape.conform_names(named, vocab.LEGACY_KEYWORD_COLUMNS)
    named = shape.with_defaults(named, {"geo": geo, "target_region": region})
    if "collected_at_ms" in named.columns:
        named = named.withColumn("collected_at_ts", dates.epoch_ms_to_ts(F.col("collected_at_ms")))
    if "ispartial" in named.columns:
        named = quality.keep_complete(named, "ispartial")
    kinds = {"date": "date", "timeframe_start": "date", "timeframe_end": "date", **{c: "double" for c in vocab.KEYWORDS.values()}}
    typed = shape.cast_columns(named, kinds).drop("_corrupt_record")
    newest = [F.col(c).desc_nulls_last() for c in ("collected_at_ms", "timeframe_end") if c in typed.columns]
    newest += [F.col(c).desc_nulls_last() for c in vocab.KEYWORDS.values()]
    return dedup.latest_by(typed, ["date", "keyword_group"], newest)
