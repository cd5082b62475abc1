"""Read-only data-quality profiles; each is one scan with map-side aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions.metrics import count_if
from inciscope.functions.temporal import parse_timestamp
from inciscope.functions.text import (
    cast_or_null,
    is_bad_flag,
    is_blank,
    is_uncastable,
    latitude_from_text,
    longitude_from_text,
)

FIRST_FORMAT = config.TIMESTAMP_FORMATS[:1]


def null_profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and NULL-or-blank rows per column, wide; one row, or one per ``by`` group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_if(is_blank(F.col(c).cast("string"))).alias(f"null_{c}") for c in cols],
    )


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column, long form, columns without any left out."""
    counts = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "missing").filter("missing > 0")


def duplicate_summary(df: DataFrame, key: str, by: str) -> DataFrame:
    """Rows, distinct keys and excess per source; NULL keys count as excess and are also shown apart."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("distinct_ids"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_count"),
        count_if(F.col(key).isNull()).alias("null_ids"),
    )


def duplicate_histogram(df: DataFrame, key: str, source: str) -> DataFrame:
    """How many repeated keys appear in 1, 2, ... sources, with a sample key.

    Rows are first reduced to (key, source) counts, so a key holding a large part of the rows costs one
    partial row per map task.
    """
    per_source = df.groupBy(key, source).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_source.groupBy(key).agg(F.sum("n").alias("appearances"), F.count(source).alias("in_n_files"))
    return (
        per_key.filter("appearances > 1")
        .groupBy(F.col("in_n_files").alias("appears_in_n_files"))
        .agg(F.count(F.lit(1)).alias("id_count"), F.min(key).alias("sample_id"))
    )


def duplicate_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows of the ``n`` smallest repeated keys."""
    repeated = df.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return df.join(repeated.orderBy(key).limit(n).select(key), [key], "inner")


def type_validity(df: DataFrame, types: Mapping[str, str], flags: Sequence[str] = ()) -> DataFrame:
    """Per column, rows that are present but not convertible (or, for flags, neither true nor false)."""
    return df.agg(
        *[count_if(is_uncastable(F.col(c), t)).alias(f"{c}_not_{t}") for c, t in types.items()],
        *[count_if(is_bad_flag(F.col(c))).alias(f"{c}_invalid_value") for c in flags],
    )


def parse_samples(df: DataFrame, col: str, n: int, formats=FIRST_FORMAT) -> DataFrame:
    """The ``n`` smallest distinct texts with their parse attempt."""
    samples = df.select(F.col(col).alias("raw_date_value")).distinct().orderBy("raw_date_value").limit(n)
    return samples.withColumn("parsed_date_attempt", parse_timestamp(F.col("raw_date_value"), formats))


def parse_profile(df: DataFrame, col: str, formats=FIRST_FORMAT) -> DataFrame:
    """Rows that parse, fail to parse, or have nothing to parse."""
    parsed = df.select(F.col(col).alias("raw"), parse_timestamp(F.col(col), formats).alias("parsed"))
    blank = is_blank(F.col("raw"))
    return parsed.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("parsed").isNotNull()).alias("format1_success"),
        count_if(F.col("parsed").isNull() & ~blank).alias("format1_fail"),
        count_if(blank).alias("null_dates"),
    )


def range_profile(
    df: DataFrame, date: str, year: str, now: Column | None = None, years: tuple[int, int] = config.YEAR_BOUNDS
) -> DataFrame:
    """Future dates, out-of-range years and the raw extremes of the year text."""
    now = F.current_timestamp() if now is None else now
    first, last = years
    number = cast_or_null(F.col(year), "int")
    return df.agg(
        count_if(parse_timestamp(F.col(date), FIRST_FORMAT) > now).alias("future_dates"),
        count_if(number < first).alias(f"year_before_{first}"),
        count_if(number > last).alias(f"year_after_{last}"),
        F.min(year).alias("min_year_raw"),
        F.max(year).alias("max_year_raw"),
    )


def value_distribution(df: DataFrame, col: str, cleaner) -> DataFrame:
    """Raw values with their cleaned form, frequency and a flag where cleaning changes them."""
    counts = df.groupBy(F.col(col).alias("raw_value")).agg(F.count(F.lit(1)).alias("frequency"))
    raw = F.col("raw_value")
    return counts.select(
        "raw_value",
        cleaner(raw).alias("cleaned_value"),
        "frequency",
        F.when(raw != cleaner(raw), "NEEDS_CLEAN").otherwise("OK").alias("needs_cleaning"),
    )


def numeric_order(df: DataFrame, col: str) -> DataFrame:
    """Sort text by its number, non-numbers first."""
    return df.orderBy(F.col(col).try_cast("double").asc_nulls_first(), F.col(col))


def recovery_profile(df: DataFrame, lat: str, lon: str, text: str) -> DataFrame:
    """How many rows have direct coordinates, text to recover them from, or neither."""
    no_lat, no_lon, no_text = (is_blank(F.col(c)) for c in (lat, lon, text))
    return df.agg(
        count_if(~no_lat).alias("has_direct_lat"),
        count_if(~no_lon).alias("has_direct_lon"),
        count_if(~no_text).alias("has_location_str"),
        count_if(no_lat & no_lon & no_text).alias("has_nothing"),
        count_if(no_lat & ~no_text).alias("recoverable_via_location_str"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def recovery_samples(df: DataFrame, lat: str, text: str, n: int) -> DataFrame:
    """The ``n`` smallest distinct texts with the coordinates extracted from them."""
    rows = df.filter(~is_blank(F.col(text))).select(F.col(text).alias("raw_location"), F.col(lat).alias("raw_lat"))
    return (
        rows.distinct()
        .orderBy("raw_location", "raw_lat")
        .limit(n)
        .withColumns(
            {
                "extracted_lat": latitude_from_text(F.col("raw_location")),
                "extracted_lon": longitude_from_text(F.col("raw_location")),
                "lat_source": F.when(is_blank(F.col("raw_lat")), "NEEDS_PARSE").otherwise("HAS_DIRECT"),
            }
        )
    )


def redundancy_profile(df: DataFrame) -> DataFrame:
    """Evidence for dropping columns: year against date, audit values, doubled coordinates."""
    date_year = F.year(parse_timestamp(F.col("date"), FIRST_FORMAT)).cast("string")
    return df.agg(
        count_if(F.col("year") != date_year).alias("year_inconsistent_with_date"),
        F.count_distinct("updated_on").alias("distinct_updated_on_values"),
        count_if(F.col("x_coordinate").isNotNull() & F.col("latitude").isNotNull()).alias("both_coord_systems_present"),
        count_if(F.col("location").isNotNull() & F.col("latitude").isNotNull()).alias("has_both_location_and_latlon"),
    )


def key_profile(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows, distinct, blank and non-integer keys, blank labels and the key range of a raw dimension."""
    number = cast_or_null(F.col(key), "int")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        count_if(is_blank(F.col(key))).alias("null_keys"),
        count_if(number.isNull() & F.col(key).isNotNull()).alias("key_not_castable_to_int"),
        count_if(is_blank(F.col(label))).alias("null_labels"),
        F.min(number).alias("min_key"),
        F.max(number).alias("max_key"),
    )
