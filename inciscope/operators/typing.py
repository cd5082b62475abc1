"""Raw text records -> typed, standardised records; raw boundary rows -> clean dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions.rules import first_like
from inciscope.functions.temporal import date_parts, parse_timestamp
from inciscope.functions.text import (
    cast_or_null,
    latitude_from_text,
    longitude_from_text,
    numeric_text_to_int,
    parse_flag,
    standardise,
)
from inciscope.operators.shaping import keep_castable

#: What the final coordinates and their label follow from.
COORDINATES = ("latitude", "longitude", "lat_recovered", "lon_recovered")


def final_coordinates() -> dict[str, Column]:
    """What follows from the numeric and the recovered coordinates."""
    return {
        "lat_final": F.coalesce("latitude", "lat_recovered"),
        "lon_final": F.coalesce("longitude", "lon_recovered"),
        "coord_source": F.when(F.col("latitude").isNotNull(), "DIRECT")
        .when(F.col("lat_recovered").isNotNull(), "RECOVERED_FROM_STR")
        .otherwise("NULL"),
    }


def incident_parts() -> dict[str, Column]:
    return {f"incident_{name}": part for name, part in date_parts(F.col("incident_datetime")).items()}


def derived_columns() -> dict[str, Column]:
    """Columns of a typed record that follow from columns before them, so that they need not be moved with it."""
    return incident_parts() | final_coordinates()


def recover_coordinates(df: DataFrame, lat: str, lon: str, text: str) -> DataFrame:
    """Numeric coordinates, falling back to the "(lat, lon)" text, with a label for where they came from.

    The latitude alone decides the label; the literal text 'NULL' marks an unrecoverable row.
    """
    return df.withColumns(
        {
            "latitude": F.trim(F.col(lat)).try_cast("double"),
            "longitude": F.trim(F.col(lon)).try_cast("double"),
            "lat_recovered": latitude_from_text(F.col(text)),
            "lon_recovered": longitude_from_text(F.col(text)),
        }
    ).withColumns(final_coordinates())


def to_typed(
    df: DataFrame,
    formats: Sequence[tuple[str, str | None]] = config.TIMESTAMP_FORMATS,
    periods: Sequence[tuple[str, str]] = config.SOURCE_PERIODS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cast, standardise and derive every column of a raw incident record in one narrow pass.

    The timestamp is parsed once and its parts are read from the result. ``_raw_date`` stays with the row, so
    that the date gates need no lookup back into the landing layer. ``carry`` names extra columns to keep.
    """
    parsed = recover_coordinates(df, "latitude", "longitude", "location").withColumn(
        "incident_datetime", parse_timestamp(F.col("date"), formats)
    )
    upper = {
        name: standardise(F.col(source))
        for name, source in [
            ("block", "block"),
            ("iucr", "iucr"),
            ("primary_type", "primary_type"),
            ("crime_description", "description"),
            ("location_description", "location_description"),
            ("fbi_code", "fbi_code"),
        ]
    }
    columns: dict[str, Column] = {
        "crime_id": cast_or_null(F.trim(F.col("id")), "bigint"),
        "case_number": F.trim(F.col("case_number")),
        "incident_datetime": F.col("incident_datetime"),
        **incident_parts(),
        **upper,
        "is_arrest": parse_flag(F.col("arrest")),
        "is_domestic": parse_flag(F.col("domestic")),
        "beat": standardise(F.col("beat")),
        "district": numeric_text_to_int(F.col("district")).cast("string"),
        "ward": numeric_text_to_int(F.col("ward")),
        "community_area": numeric_text_to_int(F.col("community_area")),
        **{
            name: F.col(name)
            for name in [
                "latitude", "longitude", "lat_recovered", "lon_recovered", "lat_final", "lon_final", "coord_source",
            ]
        },
        "source_year_range": first_like(F.col("_source_file"), periods, "UNKNOWN"),
        "_source_file": F.col("_source_file"),
        "_raw_date": F.col("date"),
        **{name: F.col(name) for name in carry},
        "_silver_step": F.lit("STEP4_TYPED"),
        "_transform_ts": F.current_timestamp(),
    }
    return parsed.select(*[expr.alias(name) for name, expr in columns.items()])


def clean_dim(
    df: DataFrame, key: str, out_key: str, labels: Mapping[str, Column], measures: Mapping[str, str] | None = None
) -> DataFrame:
    """Keep rows with an integer key, cast it, derive labels and cast the ``{source: output}`` measures.

    Columns not asked for (geometry text, repeated keys) are dropped, so they are never read.
    """
    valid = keep_castable(df, key, "int")
    return valid.select(
        F.trim(F.col(key)).try_cast("int").alias(out_key),
        *[expr.alias(name) for name, expr in labels.items()],
        *[F.trim(F.col(c)).try_cast("double").alias(name) for c, name in (measures or {}).items()],
    )
