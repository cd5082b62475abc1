"""The analytical views.

Records are first reduced to counts per foreign key or group, with map-side aggregation, and only those counts
meet the dimensions and windows. So no view shuffles raw records, whatever the size of a dimension.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inciscope import config
from inciscope.functions.metrics import avg_of_rates, count_if, distinct_codes, mode_of, rate_pct, ratio_pct, safe_pct
from inciscope.operators.windows import (
    moving_average,
    period_over_period,
    with_dense_rank,
    with_rank,
    with_share,
)


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_crimes"),
        count_if(F.col("is_arrest")).alias("total_arrests"),
        count_if(F.col("is_domestic")).alias("domestic_crimes"),
        count_if(F.col("is_violent")).alias("violent_crimes"),
    ]


COUNTS = ("total_crimes", "total_arrests", "domestic_crimes", "violent_crimes")


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _share_of_total(name: str, digits: int = 2) -> Column:
    return ratio_pct(F.col(name), F.col("total_crimes"), digits)


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Counts and arrest rate per month, with a 3-month moving average of the volume."""
    per_day = fact.groupBy("incident_year", "incident_month", "date_key").agg(*_counts())
    labels = dim_date.select("date_key", "month_name", "quarter")
    monthly = (
        per_day.join(labels, ["date_key"], "left")
        .groupBy("incident_year", "incident_month", "month_name", "quarter")
        .agg(*_sums(*COUNTS))
        .withColumn("arrest_rate_pct", _share_of_total("total_arrests"))
    )
    return moving_average(monthly, ["incident_year", "incident_month"], "total_crimes", 3, "rolling_3m_avg")


def yoy_change(fact: DataFrame, by: str = "district_name") -> DataFrame:
    """Yearly counts per group against the previous calendar year.

    A first year, or one after a gap, has no previous count and is labelled STABLE.
    """
    yearly = fact.dropna(subset=[by]).groupBy(by, "incident_year").agg(*_counts()).drop("domestic_crimes", "violent_crimes")
    paired = period_over_period(yearly, [by], "incident_year", {"total_crimes": "prev_year_crimes"})
    now, before = F.col("total_crimes"), F.col("prev_year_crimes")
    return paired.select(
        by,
        "incident_year",
        "total_crimes",
        "total_arrests",
        _share_of_total("total_arrests").alias("arrest_rate_pct"),
        "prev_year_crimes",
        (now - before).alias("yoy_change_abs"),
        safe_pct(now - before, before).alias("yoy_change_pct"),
        F.when(now > before, "INCREASING").when(now < before, "DECREASING").otherwise("STABLE").alias("trend_direction"),
    )


def shift_analysis(fact: DataFrame, dim_shift: DataFrame) -> DataFrame:
    """Counts and rates per shift and hour."""
    per_hour = fact.groupBy("shift_key", "incident_hour").agg(*_counts())
    shifts = dim_shift.select("shift_key", "shift_name", "shift_hours", "shift_type")
    return (
        per_hour.join(shifts, ["shift_key"], "left")
        .groupBy("shift_name", "shift_hours", "shift_type", "incident_hour")
        .agg(*_sums(*COUNTS))
        .withColumns(
            {
                "arrest_rate_pct": _share_of_total("total_arrests"),
                "violent_crime_pct": _share_of_total("violent_crimes"),
            }
        )
    )


def weekday_pattern(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Counts per weekday and its share of all records that have a date."""
    per_day = fact.groupBy("date_key").agg(*_counts())
    labels = dim_date.select("date_key", "day_name", "day_of_week_num", "weekday_type")
    weekdays = (
        per_day.join(labels, ["date_key"], "inner")
        .groupBy("day_name", "day_of_week_num", "weekday_type")
        .agg(*_sums(*COUNTS))
        .withColumn("arrest_rate_pct", _share_of_total("total_arrests"))
    )
    return with_share(weekdays, "total_crimes", "pct_of_all_crimes")


def roll_up_modes(cells: DataFrame, by: Sequence[str], weight: str, modes: Mapping[str, str], sums: Sequence[str]) -> DataFrame:
    """Aggregate weighted cells to ``by``: summed measures, and the heaviest value per mode column.

    NULL values do not compete and ties go to the smallest value. The cells move once, to their ``by`` group;
    the windows and the final grouping reuse that partitioning.
    """
    placed = cells.repartition(*by)
    weighed = placed.withColumns(
        {f"_n_{out}": F.sum(weight).over(Window.partitionBy(*by, col)) for out, col in modes.items()}
    )
    heaviest = [
        F.min_by(col, F.when(F.col(col).isNotNull(), F.struct(-F.col(f"_n_{out}"), F.col(col)))).alias(out)
        for out, col in modes.items()
    ]
    return weighed.groupBy(*by).agg(*_sums(*sums), *heaviest)


def entity_profile(
    fact: DataFrame,
    years: tuple[int, int],
    by: Sequence[str] = ("community_area_num", "community_name"),
    modes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Volume, composition, most frequent hour and type, and change between two years per entity."""
    modes = modes or {"peak_crime_hour": "incident_hour", "dominant_crime_type": "primary_type"}
    before, now = years
    old, new = f"crimes_{before}", f"crimes_{now}"
    cells = (
        fact.dropna(subset=[by[-1]])
        .groupBy(*by, *modes.values())
        .agg(
            *_counts(),
            count_if(F.col("crime_category") == config.PROPERTY).alias("property_crimes"),
            count_if(F.col("incident_year") == now).alias(new),
            count_if(F.col("incident_year") == before).alias(old),
        )
    )
    profile = roll_up_modes(cells, by, "total_crimes", modes, [*COUNTS, "property_crimes", new, old])
    return profile.withColumns(
        {
            "arrest_rate_pct": _share_of_total("total_arrests"),
            "violent_pct": _share_of_total("violent_crimes"),
            "domestic_pct": _share_of_total("domestic_crimes"),
            f"yoy_pct_{now}_vs_{before}": safe_pct(F.col(new) - F.col(old), F.col(old)),
        }
    )


def group_performance(fact: DataFrame, by: Sequence[str] = ("district_code", "district_name")) -> DataFrame:
    """Yearly counts and rates per group, ranked within the year by volume and by arrest rate."""
    yearly = (
        fact.dropna(subset=[by[-1]])
        .groupBy(*by, "incident_year")
        .agg(*_counts())
        .withColumns(
            {
                "arrest_rate_pct": _share_of_total("total_arrests"),
                "violent_crime_pct": _share_of_total("violent_crimes"),
            }
        )
    )
    ranked = with_rank(yearly, ["incident_year"], [F.desc("total_crimes")], "crime_volume_rank")
    return with_rank(ranked, ["incident_year"], [F.desc("arrest_rate_pct")], "arrest_rate_rank")


def type_breakdown(fact: DataFrame, dim_type: DataFrame) -> DataFrame:
    """Counts per type, code and year, with the share of the year and the rank in it."""
    yearly = (
        fact.groupBy("primary_type", "fbi_code", "incident_year")
        .agg(F.count(F.lit(1)).alias("total_crimes"), count_if(F.col("is_arrest")).alias("total_arrests"))
        .withColumn("arrest_rate_pct", _share_of_total("total_arrests"))
    )
    labels = dim_type.select("primary_type", "fbi_code", "fbi_description", "crime_category")
    labelled = yearly.join(labels, ["primary_type", "fbi_code"], "left")
    shared = with_share(labelled, "total_crimes", "pct_of_year_total", ["incident_year"])
    return with_rank(shared, ["incident_year"], [F.desc("total_crimes")], "rank_in_year")


def type_by_area(fact: DataFrame) -> DataFrame:
    """Counts per area and type, with the share and dense rank within the area."""
    counts = (
        fact.dropna(subset=["community_name"])
        .groupBy("community_name", "primary_type", "crime_category")
        .agg(F.count(F.lit(1)).alias("crime_count"))
    )
    shared = with_share(counts, "crime_count", "pct_of_community", ["community_name"])
    return with_dense_rank(shared, ["community_name"], [F.desc("crime_count")], "rank_in_community")


def rate_vs_overall(fact: DataFrame) -> DataFrame:
    """Arrest rate per type, place and year against the type's overall rate."""
    cells = (
        fact.dropna(subset=["district_name", "community_name"])
        .groupBy("primary_type", "crime_category", "district_name", "community_name", "incident_year")
        .agg(F.count(F.lit(1)).alias("total_crimes"), count_if(F.col("is_arrest")).alias("total_arrests"))
    )
    per_type = cells.groupBy(F.col("primary_type").alias("_type")).agg(
        ratio_pct(F.sum("total_arrests"), F.sum("total_crimes")).alias("citywide_avg_arrest_rate")
    )
    rated = (
        cells.withColumn("arrest_rate_pct", _share_of_total("total_arrests"))
        .join(per_type, F.col("primary_type").eqNullSafe(F.col("_type")))
        .drop("_type")
    )
    return rated.withColumn("below_citywide_avg", F.col("arrest_rate_pct") < F.col("citywide_avg_arrest_rate"))


def flag_analysis(fact: DataFrame) -> DataFrame:
    """Domestic records per place and year: counts, share, arrest rate within them and yearly rank."""
    yearly = (
        fact.dropna(subset=["community_name"])
        .groupBy("community_name", "district_name", "incident_year")
        .agg(
            F.count(F.lit(1)).alias("total_crimes"),
            count_if(F.col("is_domestic")).alias("domestic_count"),
            count_if(~F.col("is_domestic")).alias("non_domestic_count"),
            rate_pct(F.col("is_domestic")).alias("domestic_pct"),
            count_if(F.col("is_domestic") & F.col("is_arrest")).alias("domestic_arrests"),
        )
        .withColumn("domestic_arrest_rate_pct", safe_pct(F.col("domestic_arrests"), F.col("domestic_count")))
    )
    return with_rank(yearly, ["incident_year"], [F.desc("domestic_pct")], "domestic_rate_rank")


def kpi_summary(fact: DataFrame) -> DataFrame:
    """One row of headline figures.

    Modes and distinct counts come from (column, value) counts taken by shuffle, so no task holds a column's values.
    """
    figures = fact.agg(
        F.count(F.lit(1)).alias("total_crimes"),
        F.min("incident_year").alias("first_year"),
        F.max("incident_year").alias("last_year"),
        rate_pct(F.col("is_arrest")).alias("overall_arrest_rate_pct"),
        rate_pct(F.col("is_domestic")).alias("domestic_crime_pct"),
        rate_pct(F.col("is_violent")).alias("violent_crime_pct"),
    )
    distinct = {
        "years_covered": "incident_year", "communities_with_crime": "community_area_num", "districts_covered": "district_code",
    }
    modes = {
        "most_common_crime": "primary_type", "highest_crime_community": "community_name", "peak_crime_hour": "incident_hour",
        "most_common_location_type": "location_description",
    }
    wanted = list(dict.fromkeys([*distinct.values(), *modes.values()]))
    types = dict(fact.dtypes)
    texts = fact.select(*[F.col(c).cast("string").alias(c) for c in wanted]).unpivot([], wanted, "column", "value")
    counts = texts.dropna(subset=["value"]).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))

    def of(column: str) -> Column:
        return F.col("column") == column

    def mode(column: str) -> Column:
        value = F.col("value").cast(types[column])
        return F.min_by(value, F.when(of(column), F.struct(-F.col("n"), value)))

    summed = counts.agg(
        *[F.count_if(of(c)).alias(out) for out, c in distinct.items()], *[mode(c).alias(out) for out, c in modes.items()]
    )
    order = [
        "total_crimes", "years_covered", "first_year", "last_year", "communities_with_crime", "districts_covered",
        "overall_arrest_rate_pct", "domestic_crime_pct", "violent_crime_pct", *modes,
    ]
    return with_row(figures, summed).select(*order)


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Columns of a one-row table beside those of ``df``."""
    return df.withColumn("_row", row.select(F.struct(*row.columns)).scalar()).select(*df.columns, "_row.*")


def shift_rollup(shifts: DataFrame) -> DataFrame:
    """Shift totals and the average of their hourly arrest rates."""
    return shifts.groupBy("shift_name", "shift_hours").agg(
        *_sums("total_crimes", "total_arrests"), avg_of_rates(F.col("arrest_rate_pct")).alias("avg_arrest_rate_pct")
    )


def type_rollup(breakdown: DataFrame) -> DataFrame:
    """Type totals over all years and the average of their yearly arrest rates."""
    return breakdown.groupBy("primary_type", "crime_category").agg(
        F.sum("total_crimes").alias("total"), avg_of_rates(F.col("arrest_rate_pct")).alias("avg_arrest_rate")
    )
