"""Events read as incident records with a time of day, and as a run log; row counts of every table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope.bindings.common import TABLES, as_text, read, sql_count, sql_pct, sql_sum, sql_text
from inciscope.bindings.orders import avg_rate
from inciscope.functions.temporal import date_key
from inciscope.operators import dims, shaping, views
from inciscope.sources.logs import latest_status


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return read(spark, sf_dir, "events").select(
        date_key(ts).alias("date_key"),
        F.hour(ts).alias("incident_hour"),
        F.hour(ts).alias("shift_key"),
        (F.col("event_type") == "purchase").alias("is_arrest"),
        (F.col("event_type") == "error").alias("is_violent"),
        (F.col("value") > 50).alias("is_domestic"),
    )


def shift_analysis(spark, sf_dir):
    return views.shift_analysis(fact(spark, sf_dir), dims.build_dim_shift(spark))


def shift_dim(spark, sf_dir):
    """All 24 hours with their shift and the events in each."""
    counts = fact(spark, sf_dir).groupBy("shift_key").agg(F.count(F.lit(1)).alias("n_events"))
    hours = dims.build_dim_shift(spark)
    return hours.join(counts, "shift_key", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


def weekday_pattern(spark, sf_dir):
    return views.weekday_pattern(fact(spark, sf_dir), dims.build_dim_date(read(spark, sf_dir, "events"), "ts"))


def runlog_latest(spark, sf_dir):
    """Each user's events as the appended states of a run; the newest is its status."""
    log = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), "ts", "event_id"
    )
    latest = latest_status(log, "run_id", [F.desc("ts"), F.desc("event_id")])
    return latest.withColumn("ts", as_text(F.col("ts")))


def row_counts(spark, sf_dir):
    tables = {name: read(spark, sf_dir, name) for name in TABLES}
    return shaping.row_counts(tables, ["orders", "lineitem"], "--- TOTAL FACTS ---")


QUERIES = {
    "shift_dim": shift_dim,
    "shift_analysis": shift_analysis,
    "shift_rollup": lambda s, d: views.shift_rollup(shift_analysis(s, d)),
    "weekday_pattern": weekday_pattern,
    "runlog_latest": runlog_latest,
    "row_counts": row_counts,
}

SHIFT = """CASE WHEN {0} BETWEEN 6 AND 13 THEN '{1}' WHEN {0} BETWEEN 14 AND 21 THEN '{2}' ELSE '{3}' END"""


def _shift(hour: str) -> str:
    return ", ".join(
        f"{SHIFT.format(hour, *names)} AS {out}"
        for out, names in {
            "shift_name": ("Morning Shift", "Evening Shift", "Night Shift"),
            "shift_hours": ("06:00 – 14:00", "14:00 – 22:00", "22:00 – 06:00"),
            "shift_type": ("DAY", "EVENING", "NIGHT"),
        }.items()
    )


ARRESTS, VIOLENT = sql_count("event_type = 'purchase'"), sql_count("event_type = 'error'")
COUNTS = f"""count(*) AS total_crimes, {ARRESTS} AS total_arrests, {sql_count('value > 50')} AS domestic_crimes,
    {VIOLENT} AS violent_crimes, {sql_pct(ARRESTS, 'count(*)')} AS arrest_rate_pct"""
SHIFTS = f"""shifts AS (SELECT {_shift('incident_hour')}, incident_hour, {COUNTS},
    {sql_pct(VIOLENT, 'count(*)')} AS violent_crime_pct
    FROM (SELECT *, CAST(hour(ts) AS INTEGER) AS incident_hour FROM events) GROUP BY 1, 2, 3, 4)"""

ORACLE = {
    "shift_dim": f"""SELECT CAST(h AS INTEGER) AS shift_key, CAST(h AS INTEGER) AS hour_of_day, {_shift('h')},
        count(event_id) AS n_events FROM range(24) r(h) LEFT JOIN events ON hour(ts) = h GROUP BY h""",
    "shift_analysis": f"WITH {SHIFTS} SELECT * FROM shifts",
    "shift_rollup": f"""WITH {SHIFTS} SELECT shift_name, shift_hours, {sql_sum('total_crimes')} AS total_crimes,
        {sql_sum('total_arrests')} AS total_arrests, {avg_rate('arrest_rate_pct')} AS avg_arrest_rate_pct
        FROM shifts GROUP BY 1, 2""",
    "weekday_pattern": f"""SELECT strftime(ts, '%A') AS day_name, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week_num,
        CASE WHEN dayofweek(ts) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS weekday_type, {COUNTS},
        {sql_pct('count(*)', '(SELECT count(*) FROM events)')} AS pct_of_all_crimes FROM events GROUP BY 1, 2, 3""",
    "runlog_latest": f"""SELECT run_id, status, {sql_text('ts')} AS ts, event_id FROM (SELECT user_id AS run_id,
        event_type AS status, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE user_id IS NOT NULL) WHERE rn = 1""",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    + " UNION ALL SELECT '--- TOTAL FACTS ---', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)",
}
