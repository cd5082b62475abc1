"""Feature tables for clustering, built on the (small, materialised) views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope.functions.metrics import avg_per_period, safe_pct
from inciscope.operators.stats import quantile_row, with_stats
from inciscope.operators.windows import effectiveness

# Flag -> (profile column, quantile, whether the flag means above it).
DEFAULT_FLAGS = {
    "is_high_volume_area": ("total_crimes", 0.5, True),
    "is_low_arrest_area": ("arrest_rate_pct", 0.5, False),
    "is_high_violent_area": ("violent_pct", 0.75, True),
}


def entity_features(
    profile: DataFrame,
    n_periods: Column | int,
    change_col: str,
    key: str = "community_area_num",
    label: str = "community_name",
    flags: Mapping[str, tuple[str, float, bool]] = DEFAULT_FLAGS,
) -> DataFrame:
    """One row per entity: raw and derived features and flags against quantiles over all entities.

    The thresholds are one row of exact quantiles. ``profile`` is read several times, so pass a stored table.
    """
    thresholds = quantile_row(profile, {flag: (col, q) for flag, (col, q, _) in flags.items()})
    total = F.col("total_crimes")

    def flagged(flag: str, col: str, above: bool) -> Column:
        limit = F.col(f"_stats.{flag}")
        hit = F.col(col) > limit if above else F.col(col) < limit
        return F.coalesce(hit, F.lit(False))

    tests = {flag: flagged(flag, col, above) for flag, (col, _, above) in flags.items()}
    return with_stats(profile.dropna(subset=[key]), thresholds, tests).select(
        key,
        label,
        "total_crimes",
        "arrest_rate_pct",
        "domestic_pct",
        "violent_pct",
        "peak_crime_hour",
        F.col(change_col).alias("yoy_change_pct"),
        avg_per_period(total, n_periods).alias("avg_crimes_per_year"),
        safe_pct(F.col("violent_crimes"), total).alias("violent_share_pct"),
        safe_pct(F.col("property_crimes"), total).alias("property_share_pct"),
        *flags,
    )


def group_year_features(performance: DataFrame) -> DataFrame:
    """One row per group and year with an effectiveness score."""
    scored = effectiveness(
        performance.dropna(subset=["district_name"]),
        "arrest_rate_pct",
        "crime_volume_rank",
        ["incident_year"],
        "effectiveness_score",
    )
    return scored.select(
        "district_code",
        "district_name",
        "incident_year",
        "total_crimes",
        "arrest_rate_pct",
        "violent_crime_pct",
        "crime_volume_rank",
        "arrest_rate_rank",
        "effectiveness_score",
    )
