"""Star-schema dimensions and the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions import temporal
from inciscope.functions.rules import classify, map_values
from inciscope.functions.text import is_blank, standardise
from inciscope.operators.windows import assign_surrogate_key

LOCATION_KEY = ("community_area_num", "ward_num", "district_code", "beat")
LOCATION_LABELS = ("district_name", "ward_label", "community_name")


def build_dim_date(df: DataFrame, ts: str) -> DataFrame:
    """One row per calendar date; only the date is made distinct, its attributes follow from it."""
    days = df.select(F.to_date(F.col(ts)).alias("full_date")).dropna().distinct()
    day = F.col("full_date")
    return days.select(
        temporal.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        temporal.month_name(day).alias("month_name"),
        temporal.quarter_label(day).alias("quarter"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week_num"),
        temporal.day_name(day).alias("day_name"),
        temporal.weekday_type(day).alias("weekday_type"),
        F.lit(False).alias("is_holiday"),
    )


def describe_code(code: Column, code_map: Mapping[str, str], prefix: str) -> Column:
    return map_values(standardise(code), code_map, F.concat(F.lit(prefix), code))


def build_dim_type(
    df: DataFrame,
    kind: str = "primary_type",
    code: str = "fbi_code",
    code_map: Mapping[str, str] = config.OFFENCE_CODES,
    category_rules: Sequence[tuple[str, Sequence[str]]] = config.CATEGORY_RULES,
) -> DataFrame:
    """Distinct (type, code) pairs with key, code description, category and violent flag."""
    pairs = df.select(kind, code).dropna().distinct()
    keyed = assign_surrogate_key(pairs, [kind, code], "crime_type_key")
    category = classify(F.col(kind), category_rules, config.OTHER)
    return keyed.select(
        "crime_type_key",
        kind,
        code,
        describe_code(F.col(code), code_map, config.OFFENCE_CODE_FALLBACK).alias("fbi_description"),
        category.alias("crime_category"),
        (category == config.VIOLENT).alias("is_violent"),
    )


def build_dim_location(
    df: DataFrame, keys: Sequence[str] = LOCATION_KEY, labels: Sequence[str] = LOCATION_LABELS
) -> DataFrame:
    """One row per full geographic key; grouping rather than DISTINCT keeps the key unique."""
    known = df.dropna(subset=["beat", "district_code"])
    places = known.groupBy(*keys).agg(*[F.max(label).alias(label) for label in labels])
    return assign_surrogate_key(places, list(keys), "location_key")


def build_dim_shift(
    spark: SparkSession,
    shifts: Sequence[tuple[str, str, str, int, int]] = tuple(config.SHIFTS),
    default: tuple[str, str, str] = config.DEFAULT_SHIFT,
) -> DataFrame:
    """24 hours with the shift each belongs to."""
    hour = F.col("hour_of_day")

    def attribute(position: int) -> Column:
        chosen = F.when(F.lit(False), default[position])
        for shift in shifts:
            chosen = chosen.when(hour.between(shift[3], shift[4]), shift[position])
        return chosen.otherwise(default[position])

    hours = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))
    return hours.select(
        hour.alias("shift_key"),
        "hour_of_day",
        attribute(0).alias("shift_name"),
        attribute(1).alias("shift_hours"),
        attribute(2).alias("shift_type"),
    )


def build_dim_location_type(
    df: DataFrame,
    col: str = "location_description",
    rules: Sequence[tuple[str, Sequence[str]]] = config.PLACE_RULES,
) -> DataFrame:
    places = df.select(col).filter(~is_blank(F.col(col))).distinct()
    keyed = assign_surrogate_key(places, [col], "location_type_key")
    return keyed.withColumn("location_category", classify(F.col(col), rules, config.OTHER))


FACT_COLUMNS = (
    "crime_id", "case_number", "date_key", "crime_type_key", "location_key", "shift_key", "location_type_key", "is_arrest",
    "is_domestic", "lat_final", "lon_final", "incident_year", "incident_month", "incident_hour", "incident_dayofweek",
    "primary_type", "fbi_code", "crime_category", "is_violent", "community_area_num", "community_name", "district_code",
    "district_name", "ward_num", "location_description", "source_year_range", "_source_file",
)


def build_fact(
    df: DataFrame, dim_type: DataFrame, dim_location: DataFrame | None = None, dim_location_type: DataFrame | None = None
) -> DataFrame:
    """Conformed records with five foreign keys and the denormalised category columns.

    The location lookup uses the full key, null-safe, so rows neither multiply nor lose a NULL area. Keys of dimensions
    not given are left out, and so are columns that ``df`` lacks.
    """
    kinds = dim_type.select("primary_type", "fbi_code", "crime_type_key", "crime_category", "is_violent")
    joined = df.join(kinds, ["primary_type", "fbi_code"], "left")
    if dim_location is not None:
        places = dim_location.select("location_key", *[F.col(k).alias(f"_{k}") for k in LOCATION_KEY])
        joined = joined.join(places, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in LOCATION_KEY], "left")
    if dim_location_type is not None:
        place_types = dim_location_type.select("location_description", "location_type_key")
        joined = joined.join(place_types, ["location_description"], "left")
    keyed = joined.withColumns({"date_key": temporal.date_key(F.col("incident_datetime")), "shift_key": F.col("incident_hour")})
    return keyed.select(*[c for c in FACT_COLUMNS if c in keyed.columns], F.current_timestamp().alias("_gold_ts"))


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once; empty for a dimension that cannot fan out."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
