"""Quality gates: flag bad rows with reason codes, in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions.text import is_blank
from inciscope.operators.joins import with_known_flag


@dataclass(frozen=True)
class Gate:
    code: str
    condition: Column
    description: str | Column
    raw_value: Column | None = None


def run_gates(df: DataFrame, gates: Sequence[Gate], record_id: Column) -> DataFrame:
    """Long failure log, one row per record and failed gate; a NULL condition passes.

    The gates are evaluated side by side on each row, so the input is scanned once however many there are.
    """
    outcomes = [
        F.when(
            gate.condition,
            F.struct(
                F.lit(gate.code).alias("reason_code"),
                (gate.description if isinstance(gate.description, Column) else F.lit(gate.description)).alias("reason_desc"),
                (F.lit(None) if gate.raw_value is None else gate.raw_value).cast("string").alias("raw_value"),
            ),
        )
        for gate in gates
    ]
    return df.select(record_id.alias("record_id"), F.inline(F.array_compact(F.array(*outcomes))))


def gate_summary(failures: DataFrame, base_count: Column | int) -> DataFrame:
    """Failures per reason and their percentage of ``base_count`` (a number or a scalar subquery)."""
    base = F.lit(base_count) if isinstance(base_count, int) else base_count
    counts = failures.groupBy("reason_code").agg(F.count(F.lit(1)).alias("failed_records"))
    return counts.withColumn("pct_of_total", F.round(F.lit(100.0) * F.col("failed_records") / base, 4))


def incident_gates(
    now: Column | None = None,
    years: tuple[int, int] = config.YEAR_BOUNDS,
    header_words: Sequence[str] = tuple(config.HEADER_WORDS),
) -> list[Gate]:
    """The fourteen gates over typed records that carry ``_raw_date`` and ``_district_known``."""
    now = F.current_timestamp() if now is None else now
    has_id = F.col("crime_id").isNotNull()
    ts, year, kind = F.col("incident_datetime"), F.col("incident_year"), F.col("primary_type")
    area, district = F.col("community_area"), F.col("district")
    no_raw_date = is_blank(F.col("_raw_date"))
    first, last = years
    rows = [
        ("NULL_DATE", ts.isNull() & no_raw_date, "no date text in the source", None),
        ("UNPARSEABLE_DATE", ts.isNull() & ~no_raw_date, "date text matches no known format", F.col("_raw_date")),
        ("FUTURE_DATE", ts > now, "incident time lies in the future", ts),
        (
            "INVALID_YEAR",
            ~year.between(first, last),
            F.concat(F.lit("incident year "), year.cast("string"), F.lit(f" is outside {first}-{last}")),
            year,
        ),
        ("NULL_PRIMARY_TYPE", is_blank(kind), "incident type is missing", None),
        (
            "INVALID_PRIMARY_TYPE",
            kind.isin(*header_words),
            F.concat(F.lit("incident type "), kind, F.lit(" is a column header")),
            kind,
        ),
        ("NULL_ARREST_FLAG", F.col("is_arrest").isNull(), "arrest flag is neither true nor false", None),
        ("NULL_COMMUNITY_AREA", area.isNull(), "community area is missing", None),
        ("COMMUNITY_AREA_ZERO", area == 0, "community area 0 is not in the dimension", F.lit("0")),
        ("NULL_DISTRICT", district.isNull(), "district is missing", None),
        (
            "UNMATCHED_DISTRICT",
            district.isNotNull() & ~F.col("_district_known"),
            F.concat(F.lit("district "), district, F.lit(" is not in the dimension")),
            district,
        ),
        ("NULL_WARD", F.col("ward").isNull(), "ward is missing", None),
        (
            "NO_COORDINATES",
            F.col("lat_final").isNull() & F.col("lon_final").isNull(),
            "no direct or recovered coordinates",
            None,
        ),
    ]
    gates = [Gate("NULL_CRIME_ID", ~has_id, "record id is not a number")]
    return gates + [Gate(code, has_id & condition, text, raw) for code, condition, text, raw in rows]


def incident_failures(typed: DataFrame, dim_districts: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """Failure log of typed incidents; the id, else the case number, names the record."""
    marked = with_known_flag(typed, F.col("district").try_cast("int"), dim_districts, "district_num", "_district_known")
    record = F.coalesce(F.col("crime_id").cast("string"), F.col("case_number"), F.lit("UNKNOWN"))
    return run_gates(marked, gates, record)
