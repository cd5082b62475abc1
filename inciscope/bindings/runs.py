"""Whole runs over the raw records as delimited files: ingestion, the silver and the gold build, and their logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope import config
from inciscope.bindings import orders, raw, star
from inciscope.operators import quality
from inciscope.plans.gold import build_gold
from inciscope.plans.silver import build_silver
from inciscope.session import remove, scratch_path
from inciscope.sources import logs
from inciscope.sources.csv import FileSpec, export_csv, ingest_files
from inciscope.sources.tables import read_table

ONE, TWO = raw.SOURCES.values()
BOUNDARIES = {
    "bronze/districts": (raw.districts_raw, config.DISTRICT_HEADERS),
    "bronze/wards": (raw.wards_raw, config.WARD_HEADERS),
    "bronze/areas": (raw.areas_raw, config.AREA_HEADERS),
}


def _export(spark: SparkSession, sf_dir: str, names: list[str], path: str) -> None:
    """Records as delimited text, compressed: as plain text they are ten times the size of the table they come from."""
    back = {landed: header for header, landed in config.INCIDENT_HEADERS.items()}
    rows = raw.raw(spark, sf_dir).filter(F.col("_source_file").isin(names)).select(*raw.TEXT_COLUMNS)
    export_csv(rows.withColumnsRenamed(back), path, packed=True)


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: same-named files of two folders, a missing and a wrong one; then one of them changed, and a new target.

    One row for each logged file, for the rows of each landing table and for the rows of each file in them.
    """
    root = scratch_path(spark, "ingest")
    path = {folder: f"{root}/in/{folder}/incidents.csv" for folder in "abcd"}
    _export(spark, sf_dir, [ONE], path["a"])
    _export(spark, sf_dir, [TWO], path["b"])
    export_csv(raw.districts_raw(spark, sf_dir), path["d"])

    def spec(folder: str, target: str) -> FileSpec:
        return FileSpec(path[folder], target, config.INCIDENT_HEADERS)

    ingest_files(spark, [spec(f, "bronze/one") for f in "abcd"], root, "r1")
    _export(spark, sf_dir, [ONE, TWO], path["a"])
    ingest_files(spark, [spec("a", "bronze/one"), spec("b", "bronze/one"), spec("a", "bronze/two")], root, "r2")

    folder = F.regexp_extract("path", r"/in/([a-d])/", 1)
    files = logs.read_log(spark, f"{root}/{logs.FILE_LOG}").select(
        F.lit("file").alias("kind"), "run_id", F.col("source_file_path").alias("path"), "target_table", "status", "row_count",
        (F.col("file_size_bytes") > 0).alias("has_size"), F.col("error_message").isNotNull().alias("has_error"),
    )
    rows = files
    for target in ("bronze/one", "bronze/two"):
        landed = read_table(spark, f"{root}/{target}")
        lineage = landed.groupBy(F.col("_source_path").alias("path"), F.col("_bronze_table").alias("target_table")).agg(
            F.count(F.lit(1)).alias("row_count")
        )
        rows = rows.unionByName(lineage.select(F.lit("lineage").alias("kind"), "*"), allowMissingColumns=True)
        total = landed.agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.unionByName(
            total.select(F.lit("table").alias("kind"), F.lit(target).alias("target_table"), "row_count"), allowMissingColumns=True
        )
    named = rows.withColumn("folder", folder).drop("path")
    by = [c for c in named.columns if c != "row_count"]
    return named.groupBy(*by).agg(F.sum("row_count").alias("row_count"))  # a folder's part files are one file


def _silver(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root, specs = scratch_path(spark, "lake"), []
    for tag, name in raw.SOURCES.items():
        _export(spark, sf_dir, [name], f"{root}/in/{name}")
        specs.append(FileSpec(f"{root}/in/{name}", f"bronze/incidents_{tag}", config.INCIDENT_HEADERS))
    for target, (rows, headers) in BOUNDARIES.items():
        path = f"{root}/in/{target}.csv"
        export_csv(rows(spark, sf_dir).withColumnsRenamed({v: k for k, v in headers.items()}), path)
        specs.append(FileSpec(path, target, headers))
    ingest_files(spark, specs, root, "bronze-1")
    remove(spark, f"{root}/in")  # all of it has landed
    landings = {tag: f"{root}/bronze/incidents_{tag}" for tag in raw.SOURCES}
    gates = quality.incident_gates(F.lit(raw.NOW).cast("timestamp"), raw.YEARS)
    summary = build_silver(spark, root, landings, tuple(f"{root}/{t}" for t in BOUNDARIES), "silver-1", gates, purge=True)
    return root, summary


def _history(spark: SparkSession, root: str) -> DataFrame:
    history = logs.run_history(logs.read_log(spark, f"{root}/{logs.RUN_LOG}"))
    complete = F.col("run_by").isNotNull() & F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()
    return history.select(
        F.lit("run").alias("kind"), F.col("run_id").alias("name"), F.col("status").alias("detail"),
        F.col("rows_processed").alias("rows_out"), complete.alias("complete"),
    )


def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps with their rows in, out and dropped, failures by reason, and the runs."""
    root, summary = _silver(spark, sf_dir)
    steps = logs.read_log(spark, f"{root}/{logs.STEP_LOG}").select(
        F.lit("step").alias("kind"), F.col("target_table").alias("name"), F.col("step_name").alias("detail"), "rows_in",
        "rows_out", "rows_dropped",
        (F.col("source_table").isNotNull() & F.col("notes").isNotNull() & F.col("transform_ts").isNotNull()).alias("complete"),
    )
    gates = summary.select(
        F.lit("gate").alias("kind"), F.col("reason_code").alias("name"), F.col("failed_records").alias("rows_out")
    )
    rows = steps.unionByName(gates, allowMissingColumns=True)
    return rows.unionByName(_history(spark, root), allowMissingColumns=True)


def gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published objects with their rows, the fact's audit, and the runs, one of which fails for want of its input."""
    root, _ = _silver(spark, sf_dir)
    try:
        build_gold(spark, f"{root}/nowhere", "gold-0")
    except Exception:  # logged as FAILED, which is what is looked at here
        pass
    build_gold(spark, root, "gold-1", orders.YEARS)
    published = read_table(spark, f"{root}/{logs.PUBLICATION_LOG}").select(
        F.lit("object").alias("kind"), F.col("target_table").alias("name"), F.col("notes").alias("detail"), "rows_in", "rows_out",
        "rows_dropped", (F.col("log_ts").isNotNull() & (F.col("source_table") == "N/A")).alias("complete"),
    )
    fact = logs.read_log(spark, f"{root}/meta/gold_step_log").where("target_table = 'fact_crimes'").select(
        F.lit("step").alias("kind"), F.col("target_table").alias("name"), F.col("step_name").alias("detail"), "rows_in",
        "rows_out", "rows_dropped", F.col("notes").isNotNull().alias("complete"),
    )
    failed = _history(spark, f"{root}/nowhere").drop("rows_out")
    rows = published.unionByName(fact, allowMissingColumns=True)
    return rows.unionByName(failed, allowMissingColumns=True).unionByName(_history(spark, root), allowMissingColumns=True)


QUERIES = {"ingest_report": ingest_report, "silver_run": silver_run, "gold_run": gold_run}

# --- DuckDB side -------------------------------------------------------------------------------
# Empty text fields land as NULL, and the folders that the files are exported to name no period.
_FIELDS = ", ".join(f"nullif({c}, '') AS {c}" for c in raw.TEXT_COLUMNS)
_REST = ", ".join(c for c in raw.RAW_COLUMNS if c not in raw.TEXT_COLUMNS)
LANDED = f"{raw.RAW.replace('raw AS', 'given AS', 1)}, raw AS (SELECT {_FIELDS}, {_REST} FROM given)"
# The file loaded last is the newest.
LATEST = raw.LATEST.replace("_ingest_seq DESC, source_year_range DESC", f"(_source_file = '{TWO}') DESC")
BASE = f"WITH {LANDED}, {raw.DIMS}, {raw.TYPED}, {raw.KEPT}, {LATEST}"


def _row(kind: str, name: str, detail: str, n_in: str, n_out: str, dropped: str, complete: str) -> str:
    counts = ", ".join(f"CAST({n} AS BIGINT) AS {c}" for n, c in ((n_in, "rows_in"), (n_out, "rows_out"), (dropped, "rows_dropped")))
    return f"SELECT '{kind}' AS kind, {name} AS name, {detail} AS detail, {counts}, {complete} AS complete"


def _step(name: str, detail: str, n_in: str, n_out: str) -> str:
    return _row("step", f"'{name}'", f"'{detail}'", n_in, n_out, f"({n_in}) - ({n_out})", "true")


def _n(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


def _run(name: str, status: str, rows: str) -> str:
    return _row("run", f"'{name}'", f"'{status}'", "NULL", rows, "NULL", "true")


_ALL_FILES = f"({_n('raw')} + {_n('districts_raw')} + {_n('wards_raw')} + {_n('areas_raw')})"
_RUNS = [_run("bronze-1", "SUCCESS", _ALL_FILES), _run("silver-1", "SUCCESS", _n("latest"))]
_STEPS = [
    _step("dim_districts", "STEP3_CLEAN_DIMS", _n("districts_raw"), _n("districts")),
    _step("dim_wards", "STEP3_CLEAN_DIMS", _n("wards_raw"), _n("wards")),
    _step("dim_community_areas", "STEP3_CLEAN_DIMS", _n("areas_raw"), _n("areas")),
    _step("crimes_typed", "STEP4_TYPE_CAST_STANDARDISE", _n("raw"), _n("typed")),
    _step("crimes_typed", "STEP5_GEOGRAPHY_FILTER_DELETE", _n("typed"), _n("kept")),
    _step("crimes_conformed", "STEP7_DIMENSION_JOIN", _n("kept"), _n("latest")),
]
_GATES = _row("gate", "reason_code", "NULL", "NULL", "count(*)", "NULL", "NULL") + """ FROM failures
    WHERE reason_code <> 'NULL_CRIME_ID' GROUP BY reason_code"""
_GOLD = f"""{BASE}, {raw.CONFORMED}, {star.DIM_TYPE}, {star.DIM_LOCATION}, {star.DIM_LOCATION_TYPE}, {star.FACT}"""
_VIEWS = {
    "dim_date": "(SELECT count(DISTINCT date_key) FROM fact)",
    "dim_crime_type": _n("dim_type"),
    "dim_location": _n("dim_location"),
    "dim_shift": "24",
    "dim_location_type": _n("dim_location_type"),
    "fact_crimes": _n("fact"),
    "v_temporal_monthly_trend": "(SELECT count(*) FROM (SELECT DISTINCT incident_year, incident_month FROM fact))",
    "v_temporal_shift_analysis": "(SELECT count(DISTINCT incident_hour) FROM fact)",
    "v_temporal_weekday_pattern": "(SELECT count(DISTINCT incident_dayofweek) FROM fact)",
    "v_city_kpi_summary": "1",
}
_ORDERED = {
    "v_temporal_yoy_change": "raw_yoy_change",
    "v_geo_community_profile": "raw_community_profile",
    "v_geo_district_performance": "raw_district_performance",
    "v_crime_type_breakdown": "raw_type_breakdown",
    "v_crime_type_by_area": "raw_type_by_area",
    "v_arrest_effectiveness": "raw_rate_vs_overall",
    "v_domestic_crime_analysis": "raw_domestic_rates",
    "ml_community_features": "raw_community_profile",
    "ml_district_features": "raw_district_performance",
}


def _object(name: str, count: str) -> str:
    kind = "VIEW" if name.startswith("v_") else "TABLE"
    note = logs.PUBLICATION_NOTE.format(kind=kind)
    return _row("object", f"'{name}'", f"'{note}'", count, count, "0", "true")


def _sub(query: str) -> str:
    """Rows of a view's SQL over the landed records."""
    landed = star.ORACLE[query].replace(f"WITH {raw.RAW}", f"WITH {LANDED}").replace(raw.LATEST, LATEST)
    return f"(SELECT count(*) FROM ({landed}))"


_COUNTS = "(SELECT count(*) FILTER (WHERE _source_file = '{0}') FROM raw)"
_N1, _N2 = _COUNTS.format(ONE), _COUNTS.format(TWO)


def _file(kind: str, run: str, folder: str, target: str, status: str, rows: str, size: str, error: str) -> str:
    return f"""SELECT '{kind}' AS kind, {run} AS run_id, '{folder}' AS folder, '{target}' AS target_table, {status} AS status,
    CAST({rows} AS BIGINT) AS row_count, {size} AS has_size, {error} AS has_error"""


def _logged(run: str, folder: str, target: str, status: str, rows: str, size: str, error: str) -> str:
    return _file("file", f"'{run}'", folder, target, f"'{status}'", rows, size, error)


ORACLE = {
    "ingest_report": f"WITH {raw.RAW} " + " UNION ALL ".join(
        [
            _logged("r1", "a", "bronze/one", "SUCCESS", _N1, "true", "false"),
            _logged("r1", "b", "bronze/one", "SUCCESS", _N2, "true", "false"),
            _logged("r1", "c", "bronze/one", "FAILED", "0", "NULL", "true"),
            _logged("r1", "d", "bronze/one", "FAILED", "0", "true", "true"),
            _logged("r2", "a", "bronze/one", "SUCCESS", f"{_N1} + {_N2}", "true", "false"),
            _logged("r2", "b", "bronze/one", "SKIPPED", "0", "true", "false"),
            _logged("r2", "a", "bronze/two", "SUCCESS", f"{_N1} + {_N2}", "true", "false"),
            _file("lineage", "NULL", "a", "bronze/one", "NULL", f"{_N1} + {_N2}", "NULL", "NULL"),
            _file("lineage", "NULL", "b", "bronze/one", "NULL", _N2, "NULL", "NULL"),
            _file("lineage", "NULL", "a", "bronze/two", "NULL", f"{_N1} + {_N2}", "NULL", "NULL"),
            _file("table", "NULL", "", "bronze/one", "NULL", f"{_N1} + {_N2} + {_N2}", "NULL", "NULL").replace("'' AS folder", "NULL AS folder"),
            _file("table", "NULL", "", "bronze/two", "NULL", f"{_N1} + {_N2}", "NULL", "NULL").replace("'' AS folder", "NULL AS folder"),
        ]
    ),
    "silver_run": f"{BASE}, {raw.FAILURES} " + " UNION ALL ".join([*_STEPS, _GATES, *_RUNS]),
    "gold_run": f"{_GOLD} " + " UNION ALL ".join(
        [
            *(_object(name, count) for name, count in _VIEWS.items()),
            *(_object(name, _sub(query)) for name, query in _ORDERED.items()),
            _step("fact_crimes", "GOLD_STEP6_FACT_CRIMES", _n("latest"), _n("latest")),
            _run("gold-0", "FAILED", "NULL"), *_RUNS, _run("gold-1", "SUCCESS", _n("latest")),
        ]
    ),
}
