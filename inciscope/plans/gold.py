"""Conformed records -> star schema, views and feature tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope.operators import dims, views
from inciscope.operators.features import entity_features, group_year_features
from inciscope.session import materialise, side_by_side
from inciscope.sources import logs
from inciscope.sources.tables import AuditRow, read_table, replace_table, write_table


# Views that are stored, since features are built on them, and the names of their tables.
STORED_VIEWS = {"v_geo_community_profile": "community_profile", "v_geo_district_performance": "district_performance"}


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame | None
    dim_crime_type: DataFrame
    dim_location: DataFrame | None
    dim_shift: DataFrame | None
    dim_location_type: DataFrame | None
    fact: DataFrame


DIMENSIONS = ("dim_crime_type", "dim_location", "dim_location_type", "dim_date", "dim_shift")


def star(
    conformed: DataFrame, store: Callable[[DataFrame, str], DataFrame] = materialise, names: Sequence[str] = DIMENSIONS,
    **type_rules,
) -> Star:
    """Build the dimensions, store them side by side, and join the fact to the stored copies.

    Stored dimensions have a known file size, so the fact joins them by broadcast while they are small and the
    fact itself is shuffled only if they are not. ``names`` are the dimensions to build, the types among them; the fact
    has no keys of the others.
    """
    builders = {
        "dim_crime_type": lambda: dims.build_dim_type(conformed, **type_rules),
        "dim_location": lambda: dims.build_dim_location(conformed),
        "dim_location_type": lambda: dims.build_dim_location_type(conformed),
        "dim_date": lambda: dims.build_dim_date(conformed, "incident_datetime"),
        "dim_shift": lambda: dims.build_dim_shift(conformed.sparkSession),
    }
    stored = side_by_side(conformed.sparkSession, [lambda n=n: store(builders[n](), n) for n in names])
    built = dict.fromkeys(DIMENSIONS) | dict(zip(names, stored))
    fact = dims.build_fact(conformed, built["dim_crime_type"], built["dim_location"], built["dim_location_type"])
    return Star(**built, fact=fact)


def all_views(built: Star, years: tuple[int, int]) -> dict[str, DataFrame]:
    fact = built.fact
    return {
        "v_temporal_monthly_trend": views.monthly_trend(fact, built.dim_date),
        "v_temporal_yoy_change": views.yoy_change(fact),
        "v_temporal_shift_analysis": views.shift_analysis(fact, built.dim_shift),
        "v_temporal_weekday_pattern": views.weekday_pattern(fact, built.dim_date),
        "v_geo_community_profile": views.entity_profile(fact, years),
        "v_geo_district_performance": views.group_performance(fact),
        "v_crime_type_breakdown": views.type_breakdown(fact, built.dim_crime_type),
        "v_crime_type_by_area": views.type_by_area(fact),
        "v_arrest_effectiveness": views.rate_vs_overall(fact),
        "v_domestic_crime_analysis": views.flag_analysis(fact),
        "v_city_kpi_summary": views.kpi_summary(fact),
    }


def build_gold(spark: SparkSession, root: str, run_id: str, years: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """Run the layer from the stored conformed table; returns every published object by name.

    ``years`` are the two compared in the entity profile, by default the last two in the data. Views over the
    stored fact stay lazy; the two they feed features from are stored, so the fact is read once for each.
    """
    with logs.logged_run(spark, root, run_id, "gold_build", "GOLD", "plans/gold.py") as run:
        return _build(spark, root, run_id, years, run)


def check_keys(built: Star) -> None:
    """Fail before the fact is written if a dimension key that it looks up repeats, for then rows would multiply."""
    keys = {
        "dim_crime_type": ["primary_type", "fbi_code"], "dim_location": list(dims.LOCATION_KEY),
        "dim_location_type": ["location_description"],
    }
    for name, columns in keys.items():
        if dims.duplicate_keys(getattr(built, name), columns).head(1):
            raise ValueError(f"{name} repeats a key: the fact would gain rows")


def _build(spark: SparkSession, root: str, run_id: str, years: tuple[int, int] | None, run) -> dict[str, DataFrame]:
    conformed = read_table(spark, f"{root}/silver/crimes_conformed")
    audits = []

    def store(df: DataFrame, name: str) -> DataFrame:
        rows = replace_table(df, f"{root}/gold/{name}")
        audits.append(AuditRow(f"GOLD_{name.upper()}", name, rows, rows, "crimes_conformed", "built anew"))
        return read_table(spark, f"{root}/gold/{name}")

    built = star(conformed, store)
    check_keys(built)
    rows = replace_table(built.fact, f"{root}/gold/fact_crimes", ["incident_year"])
    audits.append(AuditRow("GOLD_STEP6_FACT_CRIMES", "fact_crimes", rows, rows, "crimes_conformed", "keys of the star looked up"))
    fact = read_table(spark, f"{root}/gold/fact_crimes")
    built = Star(**{**vars(built), "fact": fact})

    if years is None:
        last = fact.agg(F.max("incident_year")).first()[0]
        years = (last - 1, last)
    published = all_views(built, years)
    profile, performance = (store(published[view], name) for view, name in STORED_VIEWS.items())
    n_years = fact.agg(F.count_distinct("incident_year")).first()[0]
    change = f"yoy_pct_{years[1]}_vs_{years[0]}"
    published |= {"v_geo_community_profile": profile, "v_geo_district_performance": performance}
    published |= {
        "ml_community_features": store(entity_features(profile, n_years, change), "ml_community_features"),
        "ml_district_features": store(group_year_features(performance), "ml_district_features"),
        "fact_crimes": fact,
        **{name: df for name, df in vars(built).items() if name != "fact"},
    }
    kinds = {name: "VIEW" if name.startswith("v_") else "TABLE" for name in published}
    counts = {a.target_table: a.rows_out for a in audits} | {v: a.rows_out for v, t in STORED_VIEWS.items() for a in audits if a.target_table == t}
    write_table(logs.publication_log(published, run_id, kinds, counts), f"{root}/{logs.PUBLICATION_LOG}", token=run_id)
    logs.log_steps(spark, root, run_id, audits, "meta/gold_step_log")
    run.processed = rows
    return published
