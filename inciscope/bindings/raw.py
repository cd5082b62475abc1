"""Dirty incident records derived from lineitem, and boundary rows from nation, supplier and customer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope import config
from inciscope.bindings.common import as_text, read, sql_count, sql_pct, sql_text
from inciscope.functions.temporal import parse_timestamp
from inciscope.functions.text import cast_or_null, numeric_text_to_int, pad_code, parse_flag, standardise
from inciscope.operators import joins, profiling, quality, shaping
from inciscope.operators.typing import recover_coordinates, to_typed
from inciscope.operators.windows import share_by
from inciscope.plans import silver
from inciscope.session import materialise, scratch_path, side_by_side
from inciscope.sources import tables
from inciscope.sources.csv import export_csv, land_csv

# Expressions valid in both engines.
RAW_COLUMNS = {
    "id": """CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 97 = 1 THEN 'ID'
        ELSE cast(l_orderkey * 10 + l_linenumber AS string) END""",
    "case_number": "'C' || cast(l_orderkey AS string)",
    "date": """CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 101 = 1 THEN ''
        WHEN l_partkey % 101 = 2 THEN 'garbage'
        WHEN l_suppkey % 5 = 0 THEN cast(month(l_shipdate) AS string) || '/' || cast(day(l_shipdate) AS string) || '/'
            || cast(year(l_shipdate) AS string) || ' ' || cast(l_partkey % 24 AS string) || ':05'
        ELSE lpad(cast(month(l_shipdate) AS string), 2, '0') || '/' || lpad(cast(day(l_shipdate) AS string), 2, '0') || '/'
            || cast(year(l_shipdate) AS string) || ' '
            || lpad(cast(CASE WHEN l_partkey % 12 = 0 THEN 12 ELSE l_partkey % 12 END AS string), 2, '0') || ':05:00 '
            || CASE WHEN l_partkey % 24 < 12 THEN 'AM' ELSE 'PM' END END""",
    "block": "lpad(cast(l_partkey % 1000 AS string), 3, '0') || 'xx w Main st '",
    "iucr": "lpad(cast(l_partkey % 40 AS string), 4, '0')",
    "primary_type": """CASE WHEN l_partkey % 89 = 0 THEN ' ' WHEN l_partkey % 89 = 1 THEN 'IUCR'
        WHEN l_partkey % 3 = 0 THEN ' theft' WHEN l_partkey % 3 = 1 THEN 'Robbery ' ELSE 'NARCOTICS' END""",
    "description": "CASE WHEN l_linestatus = 'O' THEN 'over $500 ' ELSE ' Simple' END",
    "location_description": """CASE l_partkey % 6 WHEN 0 THEN 'street' WHEN 1 THEN ' APARTMENT' WHEN 2 THEN 'Bank'
        WHEN 3 THEN 'SCHOOL - PUBLIC BUILDING' WHEN 4 THEN NULL ELSE 'MOON' END""",
    "arrest": "CASE WHEN l_partkey % 53 = 0 THEN 'maybe' WHEN l_returnflag = 'R' THEN 'True' ELSE ' FALSE ' END",
    "domestic": "CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber % 2 = 0 THEN 'TRUE' ELSE 'false ' END",
    "beat": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE lpad(cast(l_suppkey % 60 AS string), 4, '0') END",
    "district": "CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE cast(l_suppkey % 26 AS string) || '.0' END",
    "ward": "CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE cast(l_suppkey % 50 + 1 AS string) || '.0' END",
    "community_area": "CASE WHEN l_partkey % 67 = 0 THEN '' ELSE cast(l_orderkey % 78 AS string) END",
    "fbi_code": """CASE WHEN l_partkey % 79 = 0 THEN '99' WHEN l_partkey % 3 = 0 THEN '06' WHEN l_partkey % 3 = 1 THEN '03 '
        ELSE '18' END""",
    "x_coordinate": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(1100000 + l_suppkey AS string) END",
    "y_coordinate": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(1800000 + l_suppkey AS string) END",
    "year": """CASE WHEN l_partkey % 97 = 1 THEN 'Y Coordinate'
        WHEN l_partkey % 103 = 0 THEN cast(year(l_shipdate) + 1 AS string) ELSE cast(year(l_shipdate) AS string) END""",
    "updated_on": "'02/' || lpad(cast(l_partkey % 28 + 1 AS string), 2, '0') || '/2018 03:50:01 PM'",
    "latitude": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE '41.' || cast(l_orderkey % 90 + 10 AS string) END",
    "longitude": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE '-87.' || cast(l_suppkey % 90 + 10 AS string) END",
    "location": """CASE WHEN l_partkey % 14 = 0 THEN NULL ELSE '(41.' || cast(l_orderkey % 90 + 10 AS string) || ', -87.'
        || cast(l_suppkey % 90 + 10 AS string) || ')' END""",
    "_source_file": """CASE WHEN year(l_shipdate) <= 1997 THEN 'incidents_1995_to_1997.csv'
        ELSE 'incidents_1998_to_2001.csv' END""",
    "_ingest_seq": "l_partkey",
}
TEXT_COLUMNS = [c for c in RAW_COLUMNS if not c.startswith("_")]
SOURCES = {"1995_1997": "incidents_1995_to_1997.csv", "1998_2001": "incidents_1998_to_2001.csv"}
PERIODS = [("%1995%", "1995_1997"), ("%1998%", "1998_2001")]
NOW = "2001-01-01 00:00:00"
YEARS = (1996, 2000)

DISTRICTS_RAW = """SELECT 'MULTIPOLYGON' AS the_geom, ' ' || lower(n_name) || ' ' AS dist_label,
    CASE WHEN n_nationkey IN (13, 21) THEN 'no ' ELSE '' END || cast(n_nationkey AS string) AS dist_num FROM nation"""
WARDS_RAW = """SELECT DISTINCT 'MULTIPOLYGON' AS the_geom, cast(s_suppkey % 45 + 1 AS string) AS ward,
    cast(s_suppkey % 45 + 1 AS string) || '.25' AS shape_leng, cast(s_suppkey % 45 + 1 AS string) || '.5' AS shape_area
    FROM supplier
    UNION ALL SELECT 'MULTIPOLYGON', r_name, NULL, '' FROM region"""
AREAS_RAW = """SELECT DISTINCT 'MULTIPOLYGON' AS the_geom, ' ' || cast(c_custkey % 76 + 1 AS string) AS area_numbe,
    ' area ' || cast(c_custkey % 76 + 1 AS string) AS community, cast(c_custkey % 76 + 1 AS string) AS area_num_1,
    cast(c_custkey % 76 + 1 AS string) || '.75' AS shape_area, cast(c_custkey % 76 + 1 AS string) AS shape_len
    FROM customer
    UNION ALL SELECT 'MULTIPOLYGON', r_name, '', NULL, 'x', 'x' FROM region"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(read(spark, sf_dir, "lineitem"))


def raw_rows(items: DataFrame) -> DataFrame:
    return items.selectExpr(*[f"{expr} AS {name}" for name, expr in RAW_COLUMNS.items()])


def _sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    for table in tables:
        read(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(text)


def districts_raw(spark, sf_dir):
    return _sql(spark, sf_dir, DISTRICTS_RAW, "nation")


def wards_raw(spark, sf_dir):
    return _sql(spark, sf_dir, WARDS_RAW, "supplier", "region")


def areas_raw(spark, sf_dir):
    return _sql(spark, sf_dir, AREAS_RAW, "customer", "region")


def dims(spark, sf_dir):
    return (
        silver.clean_districts(districts_raw(spark, sf_dir)),
        silver.clean_wards(wards_raw(spark, sf_dir)),
        silver.clean_areas(areas_raw(spark, sf_dir)),
    )


def typed(spark, sf_dir, strip: bool = True) -> DataFrame:
    return typed_rows(raw(spark, sf_dir), strip)


def typed_rows(rows: DataFrame, strip: bool = True) -> DataFrame:
    rows = shaping.keep_castable(rows, "id", "bigint") if strip else rows
    return to_typed(rows, periods=PERIODS, carry=["_ingest_seq"])


def comparable(df: DataFrame) -> DataFrame:
    """Without the time of the run, and with the incident time as text."""
    return df.withColumn("incident_datetime", as_text(F.col("incident_datetime"))).drop("_transform_ts")


def latest(spark, sf_dir, columns: Sequence[str] | None = None) -> DataFrame:
    """What is the same in all typed rows of a run is added after the dedup, so that it is not sorted and moved."""
    same = {"_silver_step": F.lit("STEP4_TYPED"), "_transform_ts": F.current_timestamp()}
    items = read(spark, sf_dir, "lineitem")
    records = raw_rows(items)

    def kept(rows: DataFrame) -> DataFrame:
        """Rows without an id are left to the dedup, so that the id too is worked out once."""
        once = shaping.computed_once(typed_rows(rows, strip=False).drop(*same), ["crime_id", "incident_datetime"])
        return shaping.delete_where(once, silver.deleted_places())

    def rows_of(ids: DataFrame) -> DataFrame:
        """Ids are met in the given table, which is stored, so that no others get the columns of a raw record."""
        id_ = cast_or_null(F.trim(F.expr(RAW_COLUMNS["id"])), "bigint")
        return kept(raw_rows(materialise(items.join(ids, id_ == F.col("crime_id"), "left_semi"), "open")))

    newest = [F.desc("_ingest_seq"), F.desc("source_year_range")]
    found = silver.latest_incidents(kept(records), newest, columns, rows_of)
    return found.withColumns(same).select(*typed_rows(records).columns) if columns is None else found


def conformed(spark, sf_dir, columns: Sequence[str] | None = None) -> DataFrame:
    """The cleaned dimensions are stored first, so that the planner joins them by their own size. ``columns`` are the typed
    ones that are needed, by default all."""
    stored = side_by_side(spark, [partial(materialise, d, "dim") for d in dims(spark, sf_dir)])
    return silver.conform_incidents(latest(spark, sf_dir, columns), *stored)


def failures(spark, sf_dir) -> DataFrame:
    gates = quality.incident_gates(F.lit(NOW).cast("timestamp"), YEARS)
    return quality.incident_failures(typed(spark, sf_dir, strip=False), dims(spark, sf_dir)[0], gates)


def _columns(spark, sf_dir, **exprs):
    return raw(spark, sf_dir).select("id", *[e.alias(n) for n, e in exprs.items()])


def standardize_text(spark, sf_dir):
    return _columns(
        spark,
        sf_dir,
        block=standardise(F.col("block")),
        primary_type=standardise(F.col("primary_type")),
        arrest=F.lower(F.trim("arrest")),
    )


def bool_normalize(spark, sf_dir):
    return _columns(spark, sf_dir, is_arrest=parse_flag(F.col("arrest")), is_domestic=parse_flag(F.col("domestic")))


def parse_multi_format(spark, sf_dir):
    return _columns(spark, sf_dir, date=F.col("date"), parsed=as_text(parse_timestamp(F.col("date"))))


def double_string_int(spark, sf_dir):
    return _columns(
        spark, sf_dir, ward=numeric_text_to_int(F.col("ward")), district=numeric_text_to_int(F.col("district"))
    )


def coord_recovery(spark, sf_dir):
    rows = recover_coordinates(raw(spark, sf_dir), "latitude", "longitude", "location")
    return rows.select("id", "lat_recovered", "lon_recovered", "lat_final", "lon_final", "coord_source")


def source_bucket(spark, sf_dir):
    rows = shaping.bucket_source(raw(spark, sf_dir), "_source_file", PERIODS, "source_year_range")
    return rows.groupBy("source_year_range").agg(F.count(F.lit(1)).alias("n"))


def union_tagged(spark, sf_dir):
    rows = raw(spark, sf_dir)
    parts = {tag: rows.filter(F.col("_source_file") == name) for tag, name in SOURCES.items()}
    return shaping.union_tagged(parts, "yr_range").select("id", "case_number", "date", "yr_range")


def delete_from_table(spark, sf_dir):
    """Typed records stored by district, the deleted places deleted from the stored table: the rows left, how many were
    dropped, and how many files were rewritten."""
    path = scratch_path(spark, "typed-table")
    tables.write_table(typed(spark, sf_dir).select("crime_id", "community_area", "district"), path, ["district"])
    done = tables.delete_rows(spark, path, silver.deleted_places())
    counts = {"rows_dropped": F.lit(done.rows_dropped), "files_rewritten": F.lit(done.files_rewritten)}
    return tables.read_table(spark, path).withColumns({name: n.cast("bigint") for name, n in counts.items()})


def delete_where(spark, sf_dir):
    rows = shaping.delete_where(typed(spark, sf_dir), silver.deleted_places())
    return rows.select("crime_id", "district", "community_area")


def null_profile(spark, sf_dir, by=()):
    return profiling.null_profile(raw(spark, sf_dir), TEXT_COLUMNS, by)


def duplicate_rows(spark, sf_dir):
    rows = raw(spark, sf_dir).select("id", "date", "primary_type", "district", "_source_file")
    return profiling.duplicate_rows(rows, "id", 5)


def coord_source_share(spark, sf_dir):
    return share_by(latest(spark, sf_dir, ["coord_source"]), "coord_source", "record_count", "pct_of_total")


def value_distribution_numeric(spark, sf_dir):
    counts = profiling.value_distribution(raw(spark, sf_dir), "district", F.trim)
    return profiling.numeric_order(counts.select("raw_value", "frequency"), "raw_value")


def conformed_unmatched(spark, sf_dir):
    return joins.unmatched_after_join(conformed(spark, sf_dir, ["community_area"]), "community_area_num", "community_name", "crime_count")


def key_profile(spark, sf_dir):
    named = {
        "districts": (districts_raw(spark, sf_dir), "dist_num", "dist_label"),
        "wards": (wards_raw(spark, sf_dir), "ward", "ward"),
        "areas": (areas_raw(spark, sf_dir), "area_numbe", "community"),
    }
    return shaping.union_tagged({n: profiling.key_profile(*spec) for n, spec in named.items()}, "dim")


def unmatched_keys(spark, sf_dir):
    code = numeric_text_to_int(F.col("district"))
    known = dims(spark, sf_dir)[0]
    return joins.unmatched_keys(raw(spark, sf_dir), code, known, "district_num", "district_code", "crime_count")


def join_key_validation(spark, sf_dir):
    districts, wards, areas = dims(spark, sf_dir)
    specs = {
        "district_codes_not_in_dim": joins.DimSpec(districts, "district_num", numeric_text_to_int(F.col("district"))),
        "ward_codes_not_in_dim": joins.DimSpec(wards, "ward_num", numeric_text_to_int(F.col("ward"))),
        "community_area_codes_not_in_dim": joins.DimSpec(
            areas, "area_num", numeric_text_to_int(F.col("community_area"))
        ),
    }
    return joins.join_key_validation(raw(spark, sf_dir), specs)


def _undated(spark, sf_dir):
    """Typed rows without a time, and the source rows of any id that do carry date text."""
    rows = typed(spark, sf_dir)
    undated = rows.filter(F.col("incident_datetime").isNull()).select("crime_id", "case_number")
    source = rows.filter(F.coalesce(F.trim("_raw_date"), F.lit("")) != "").select("crime_id", "_raw_date")
    return undated, source


def semi_exists(spark, sf_dir):
    undated, source = _undated(spark, sf_dir)
    return joins.exists_in(undated, source, ["crime_id"])


def anti_not_exists(spark, sf_dir):
    undated, source = _undated(spark, sf_dir)
    return joins.not_exists_in(undated, source, ["crime_id"])


def correlated_raw_value(spark, sf_dir):
    undated, source = _undated(spark, sf_dir)
    return joins.lookup_first(undated, source, ["crime_id"], "_raw_date", "raw_value")


def gate_summary(spark, sf_dir):
    base = raw(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    return quality.gate_summary(failures(spark, sf_dir), base)


def parse_samples(spark, sf_dir):
    rows = profiling.parse_samples(raw(spark, sf_dir), "date", 20)
    return rows.withColumn("parsed_date_attempt", as_text(F.col("parsed_date_attempt")))


def csv_roundtrip(spark, sf_dir):
    """Export each source as delimited text under its original headers, then land it again."""
    back = {landed: header for header, landed in config.INCIDENT_HEADERS.items()}
    landed = {}
    for tag, name in SOURCES.items():
        path = f"{scratch_path(spark, 'csv')}/{name}"
        rows = raw(spark, sf_dir).filter(F.col("_source_file") == name).select(*TEXT_COLUMNS)
        export_csv(rows.withColumnsRenamed(back), path)
        landed[tag] = land_csv(spark, path, config.INCIDENT_HEADERS, "bronze.incidents")
    return shaping.union_tagged(landed, "yr_range").select(*TEXT_COLUMNS, "_corrupt_record", "_bronze_table", "yr_range")


QUERIES = {
    "null_profile": null_profile,
    "null_profile_by": lambda s, d: null_profile(s, d, ["_source_file"]),
    "missing_counts": lambda s, d: profiling.missing_counts(raw(s, d), TEXT_COLUMNS),
    "strip_invalid_ids": lambda s, d: shaping.keep_castable(raw(s, d), "id", "bigint").select("id", "case_number"),
    "standardize_text": standardize_text,
    "bool_normalize": bool_normalize,
    "parse_multi_format": parse_multi_format,
    "parse_samples": parse_samples,
    "parse_profile": lambda s, d: profiling.parse_profile(raw(s, d), "date"),
    "double_string_int": double_string_int,
    "type_validity": lambda s, d: profiling.type_validity(
        raw(s, d),
        {"id": "bigint", "ward": "int", "community_area": "int", "year": "int", "latitude": "double"},
        ["arrest", "domestic"],
    ),
    "coord_recovery": coord_recovery,
    "coord_recovery_profile": lambda s, d: profiling.recovery_profile(raw(s, d), "latitude", "longitude", "location"),
    "coord_recovery_samples": lambda s, d: profiling.recovery_samples(raw(s, d), "latitude", "location", 15),
    "coord_source_share": coord_source_share,
    "redundancy_profile": lambda s, d: profiling.redundancy_profile(raw(s, d)),
    "range_profile": lambda s, d: profiling.range_profile(
        raw(s, d), "date", "year", F.lit(NOW).cast("timestamp"), YEARS
    ),
    "value_distribution": lambda s, d: profiling.value_distribution(raw(s, d), "primary_type", standardise),
    "value_distribution_numeric": value_distribution_numeric,
    "source_bucket": source_bucket,
    "union_tagged": union_tagged,
    "typed_records": lambda s, d: comparable(typed(s, d)),
    "delete_where": delete_where,
    "delete_from_table": delete_from_table,
    "dedup_latest": lambda s, d: comparable(latest(s, d)),
    "duplicate_summary": lambda s, d: profiling.duplicate_summary(raw(s, d), "id", "_source_file"),
    "duplicate_histogram": lambda s, d: profiling.duplicate_histogram(
        raw(s, d).dropna(subset=["id"]), "id", "_source_file"
    ),
    "duplicate_rows": duplicate_rows,
    "quality_gates": failures,
    "gate_summary": gate_summary,
    "semi_exists": semi_exists,
    "anti_not_exists": anti_not_exists,
    "correlated_raw_value": correlated_raw_value,
    "unmatched_keys": unmatched_keys,
    "join_key_validation": join_key_validation,
    "conform_dims": lambda s, d: comparable(conformed(s, d)),
    "conformed_unmatched": conformed_unmatched,
    "clean_dim": lambda s, d: silver.clean_wards(wards_raw(s, d)),
    "clean_dim_districts": lambda s, d: silver.clean_districts(districts_raw(s, d)),
    "clean_dim_areas": lambda s, d: silver.clean_areas(areas_raw(s, d)),
    "key_profile": key_profile,
    "pad_code": lambda s, d: districts_raw(s, d).select("dist_num", pad_code(F.col("dist_num"), 3).alias("padded")),
    "csv_roundtrip": csv_roundtrip,
}

# --- DuckDB side -------------------------------------------------------------------------------
RAW = "raw AS (SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in RAW_COLUMNS.items()) + " FROM lineitem)"
DIMS = f"""districts_raw AS ({DISTRICTS_RAW}), wards_raw AS ({WARDS_RAW}), areas_raw AS ({AREAS_RAW}),
districts AS (SELECT TRY_CAST(trim(dist_num) AS INTEGER) AS district_num, upper(trim(dist_label)) AS district_label
    FROM districts_raw WHERE TRY_CAST(trim(dist_num) AS INTEGER) IS NOT NULL),
wards AS (SELECT TRY_CAST(trim(ward) AS INTEGER) AS ward_num, 'Ward ' || trim(ward) AS ward_label,
    TRY_CAST(trim(shape_area) AS DOUBLE) AS shape_area, TRY_CAST(trim(shape_leng) AS DOUBLE) AS shape_leng
    FROM wards_raw WHERE TRY_CAST(trim(ward) AS INTEGER) IS NOT NULL),
areas AS (SELECT TRY_CAST(trim(area_numbe) AS INTEGER) AS area_num, upper(trim(community)) AS community_name,
    TRY_CAST(trim(shape_area) AS DOUBLE) AS shape_area, TRY_CAST(trim(shape_len) AS DOUBLE) AS shape_len
    FROM areas_raw WHERE TRY_CAST(trim(area_numbe) AS INTEGER) IS NOT NULL)"""
FORMAT_A = "try_strptime(trim(date), '%m/%d/%Y %I:%M:%S %p')"
FORMAT_B = "try_strptime(trim(date), '%-m/%-d/%Y %-H:%M')"
LAT_TEXT = r"TRY_CAST(nullif(regexp_extract(trim(location), '\(([^,]+),', 1), '') AS DOUBLE)"
LON_TEXT = r"TRY_CAST(nullif(regexp_extract(trim(location), ',\s*([^)]+)\)', 1), '') AS DOUBLE)"


def _flag(col: str) -> str:
    return f"CASE lower(trim({col})) WHEN 'true' THEN true WHEN 'false' THEN false END"


def _int(col: str) -> str:
    return f"CAST(trunc(TRY_CAST(trim({col}) AS DOUBLE)) AS INTEGER)"


def _blank(col: str) -> str:
    return f"coalesce(trim({col}), '') = ''"


BUCKET = "CASE WHEN _source_file LIKE '%1995%' THEN '1995_1997' WHEN _source_file LIKE '%1998%' THEN '1998_2001' ELSE 'UNKNOWN' END"
TYPED_COLUMNS = {
    "crime_id": "TRY_CAST(trim(id) AS BIGINT)",
    "case_number": "trim(case_number)",
    "incident_datetime": "ts",
    "incident_year": "CAST(year(ts) AS INTEGER)",
    "incident_month": "CAST(month(ts) AS INTEGER)",
    "incident_day": "CAST(day(ts) AS INTEGER)",
    "incident_hour": "CAST(hour(ts) AS INTEGER)",
    "incident_dayofweek": "CAST(dayofweek(ts) + 1 AS INTEGER)",
    "block": "upper(trim(block))",
    "iucr": "upper(trim(iucr))",
    "primary_type": "upper(trim(primary_type))",
    "crime_description": "upper(trim(description))",
    "location_description": "upper(trim(location_description))",
    "fbi_code": "upper(trim(fbi_code))",
    "is_arrest": _flag("arrest"),
    "is_domestic": _flag("domestic"),
    "beat": "upper(trim(beat))",
    "district": f"CAST({_int('district')} AS VARCHAR)",
    "ward": _int("ward"),
    "community_area": _int("community_area"),
    "latitude": "TRY_CAST(trim(latitude) AS DOUBLE)",
    "longitude": "TRY_CAST(trim(longitude) AS DOUBLE)",
    "lat_recovered": LAT_TEXT,
    "lon_recovered": LON_TEXT,
    "lat_final": f"coalesce(TRY_CAST(trim(latitude) AS DOUBLE), {LAT_TEXT})",
    "lon_final": f"coalesce(TRY_CAST(trim(longitude) AS DOUBLE), {LON_TEXT})",
    "coord_source": f"""CASE WHEN TRY_CAST(trim(latitude) AS DOUBLE) IS NOT NULL THEN 'DIRECT'
        WHEN {LAT_TEXT} IS NOT NULL THEN 'RECOVERED_FROM_STR' ELSE 'NULL' END""",
    "source_year_range": BUCKET,
    "_source_file": "_source_file",
    "_raw_date": "date",
    "_ingest_seq": "_ingest_seq",
}
TYPED = (
    f"parsed AS (SELECT *, coalesce({FORMAT_A}, {FORMAT_B}) AS ts FROM raw), typed_all AS (SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in TYPED_COLUMNS.items())
    + " FROM parsed), typed AS (SELECT * FROM typed_all WHERE crime_id IS NOT NULL)"
)
KEPT = """kept AS (SELECT * FROM typed
    WHERE NOT coalesce(community_area = 0 OR TRY_CAST(district AS INTEGER) IN (13, 21), false))"""
_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in TYPED_COLUMNS if c != "crime_id")
LATEST = f"""latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY crime_id
    ORDER BY _ingest_seq DESC, source_year_range DESC, {_TIES}) AS rn FROM kept WHERE incident_datetime IS NOT NULL)
    WHERE rn = 1)"""
CONFORMED = """conformed AS (SELECT l.crime_id, l.case_number, l.incident_datetime, l.incident_year, l.incident_month,
    l.incident_day, l.incident_hour, l.incident_dayofweek, l.block, l.iucr, l.primary_type, l.crime_description,
    l.location_description, l.fbi_code, l.is_arrest, l.is_domestic, l.beat, l.district AS district_code,
    l.ward AS ward_num, l.community_area AS community_area_num, d.district_label AS district_name, w.ward_label,
    a.community_name, l.lat_final, l.lon_final, l.coord_source, l.source_year_range, l._source_file
    FROM latest l LEFT JOIN districts d ON TRY_CAST(l.district AS INTEGER) = d.district_num
    LEFT JOIN wards w ON l.ward = w.ward_num LEFT JOIN areas a ON l.community_area = a.area_num)"""
_TEXT_TIME = f"* REPLACE ({sql_text('incident_datetime')} AS incident_datetime)"


def _gate(code: str, condition: str, text: str, value: str = "NULL") -> str:
    return f"""SELECT CAST(crime_id AS VARCHAR) AS record_id, '{code}' AS reason_code, {text} AS reason_desc,
    CAST({value} AS VARCHAR) AS raw_value FROM typed_all WHERE crime_id IS NOT NULL AND ({condition})"""


_HEADER_WORDS = ", ".join(f"'{w}'" for w in config.HEADER_WORDS)
FAILURES = "failures AS (" + " UNION ALL ".join(
    [
        """SELECT coalesce(case_number, 'UNKNOWN') AS record_id, 'NULL_CRIME_ID' AS reason_code,
        'record id is not a number' AS reason_desc, CAST(NULL AS VARCHAR) AS raw_value FROM typed_all WHERE crime_id IS NULL""",
        _gate("NULL_DATE", f"incident_datetime IS NULL AND {_blank('_raw_date')}", "'no date text in the source'"),
        _gate("UNPARSEABLE_DATE", f"incident_datetime IS NULL AND NOT ({_blank('_raw_date')})", "'date text matches no known format'", "_raw_date"),
        _gate("FUTURE_DATE", f"incident_datetime > TIMESTAMP '{NOW}'", "'incident time lies in the future'", "incident_datetime"),
        _gate("INVALID_YEAR", f"incident_year < {YEARS[0]} OR incident_year > {YEARS[1]}",
            f"'incident year ' || incident_year || ' is outside {YEARS[0]}-{YEARS[1]}'", "incident_year"),
        _gate("NULL_PRIMARY_TYPE", _blank("primary_type"), "'incident type is missing'"),
        _gate("INVALID_PRIMARY_TYPE", f"primary_type IN ({_HEADER_WORDS})",
            "'incident type ' || primary_type || ' is a column header'", "primary_type"),
        _gate("NULL_ARREST_FLAG", "is_arrest IS NULL", "'arrest flag is neither true nor false'"),
        _gate("NULL_COMMUNITY_AREA", "community_area IS NULL", "'community area is missing'"),
        _gate("COMMUNITY_AREA_ZERO", "community_area = 0", "'community area 0 is not in the dimension'", "'0'"),
        _gate("NULL_DISTRICT", "district IS NULL", "'district is missing'"),
        _gate(
            "UNMATCHED_DISTRICT",
            """district IS NOT NULL AND NOT EXISTS (SELECT 1 FROM districts d
            WHERE d.district_num = TRY_CAST(typed_all.district AS INTEGER))""",
            "'district ' || district || ' is not in the dimension'", "district",
        ),
        _gate("NULL_WARD", "ward IS NULL", "'ward is missing'"),
        _gate("NO_COORDINATES", "lat_final IS NULL AND lon_final IS NULL", "'no direct or recovered coordinates'"),
    ]
) + ")"
DATED = f"dated AS (SELECT crime_id, _raw_date FROM typed WHERE NOT ({_blank('_raw_date')}))"
_MISSING_DIM = """(SELECT count(DISTINCT {code}) FROM raw WHERE {code} IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.{key} = {code})) AS {out}"""
_INT_TEXT = "regexp_matches(trim({0}), '^[+-]?[0-9]+$')"


def _uncastable_int(col: str) -> str:
    return sql_count(f"NOT ({_blank(col)}) AND NOT {_INT_TEXT.format(col)}")


def _uncastable_flag(col: str) -> str:
    return sql_count(f"NOT ({_blank(col)}) AND lower(trim({col})) NOT IN ('true', 'false')")


def _key_profile(dim: str, table: str, key: str, label: str) -> str:
    return f"""SELECT count(*) AS total_rows, count(DISTINCT {key}) AS distinct_keys, {sql_count(_blank(key))} AS null_keys,
    {sql_count(f'{key} IS NOT NULL AND TRY_CAST({key} AS INTEGER) IS NULL')} AS key_not_castable_to_int,
    {sql_count(_blank(label))} AS null_labels, min(TRY_CAST({key} AS INTEGER)) AS min_key,
    max(TRY_CAST({key} AS INTEGER)) AS max_key, '{dim}' AS dim FROM {table}"""


_NULLS = ", ".join(f"{sql_count(_blank(c))} AS null_{c}" for c in TEXT_COLUMNS)
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {sql_count(f'{c} IS NULL')} AS missing FROM raw" for c in TEXT_COLUMNS
)

ORACLE = {
    "null_profile": f"WITH {RAW} SELECT count(*) AS total_rows, {_NULLS} FROM raw",
    "null_profile_by": f"WITH {RAW} SELECT _source_file, count(*) AS total_rows, {_NULLS} FROM raw GROUP BY 1",
    "missing_counts": f"WITH {RAW} SELECT * FROM ({_MISSING}) WHERE missing > 0",
    "strip_invalid_ids": f"WITH {RAW} SELECT id, case_number FROM raw WHERE TRY_CAST(trim(id) AS BIGINT) IS NOT NULL",
    "standardize_text": f"""WITH {RAW} SELECT id, upper(trim(block)) AS block, upper(trim(primary_type)) AS primary_type,
        lower(trim(arrest)) AS arrest FROM raw""",
    "bool_normalize": f"WITH {RAW} SELECT id, {_flag('arrest')} AS is_arrest, {_flag('domestic')} AS is_domestic FROM raw",
    "parse_multi_format": f"""WITH {RAW} SELECT id, date, {sql_text(f'coalesce({FORMAT_A}, {FORMAT_B})')} AS parsed
        FROM raw""",
    "parse_samples": f"""WITH {RAW} SELECT raw_date_value, parsed_date_attempt FROM (SELECT DISTINCT date AS raw_date_value,
        {sql_text(FORMAT_A)} AS parsed_date_attempt FROM raw) ORDER BY raw_date_value NULLS FIRST LIMIT 20""",
    "parse_profile": f"""WITH {RAW} SELECT count(*) AS total, {sql_count(f'{FORMAT_A} IS NOT NULL')} AS format1_success,
        {sql_count(f"{FORMAT_A} IS NULL AND NOT ({_blank('date')})")} AS format1_fail,
        {sql_count(_blank('date'))} AS null_dates FROM raw""",
    "double_string_int": f"WITH {RAW} SELECT id, {_int('ward')} AS ward, {_int('district')} AS district FROM raw",
    "type_validity": f"""WITH {RAW} SELECT {_uncastable_int('id')} AS id_not_bigint, {_uncastable_int('ward')} AS ward_not_int,
        {_uncastable_int('community_area')} AS community_area_not_int, {_uncastable_int('year')} AS year_not_int,
        {sql_count(f"NOT ({_blank('latitude')}) AND TRY_CAST(latitude AS DOUBLE) IS NULL")} AS latitude_not_double,
        {_uncastable_flag('arrest')} AS arrest_invalid_value, {_uncastable_flag('domestic')} AS domestic_invalid_value
        FROM raw""",
    "coord_recovery": f"""WITH {RAW} SELECT id, {', '.join(f'{TYPED_COLUMNS[c]} AS {c}' for c in
        ['lat_recovered', 'lon_recovered', 'lat_final', 'lon_final', 'coord_source'])} FROM raw""",
    "coord_recovery_profile": f"""WITH {RAW} SELECT {sql_count(f"NOT ({_blank('latitude')})")} AS has_direct_lat,
        {sql_count(f"NOT ({_blank('longitude')})")} AS has_direct_lon,
        {sql_count(f"NOT ({_blank('location')})")} AS has_location_str,
        {sql_count(f"{_blank('latitude')} AND {_blank('longitude')} AND {_blank('location')}")} AS has_nothing,
        {sql_count(f"{_blank('latitude')} AND NOT ({_blank('location')})")} AS recoverable_via_location_str,
        count(*) AS total_rows FROM raw""",
    "coord_recovery_samples": f"""WITH {RAW} SELECT location AS raw_location, latitude AS raw_lat, {LAT_TEXT} AS extracted_lat,
        {LON_TEXT} AS extracted_lon, CASE WHEN {_blank('latitude')} THEN 'NEEDS_PARSE' ELSE 'HAS_DIRECT' END AS lat_source
        FROM (SELECT DISTINCT location, latitude FROM raw WHERE NOT ({_blank('location')}))
        ORDER BY location, latitude NULLS FIRST LIMIT 15""",
    "coord_source_share": f"""WITH {RAW}, {DIMS}, {TYPED}, {KEPT}, {LATEST}, {CONFORMED},
        g AS (SELECT coord_source, count(*) AS record_count FROM conformed GROUP BY 1)
        SELECT coord_source, record_count, {sql_pct('record_count', '(SELECT sum(record_count) FROM g)')} AS pct_of_total
        FROM g""",
    "redundancy_profile": f"""WITH {RAW} SELECT
        {sql_count(f'year <> CAST(year({FORMAT_A}) AS VARCHAR)')} AS year_inconsistent_with_date,
        count(DISTINCT updated_on) AS distinct_updated_on_values,
        {sql_count('x_coordinate IS NOT NULL AND latitude IS NOT NULL')} AS both_coord_systems_present,
        {sql_count('location IS NOT NULL AND latitude IS NOT NULL')} AS has_both_location_and_latlon FROM raw""",
    "range_profile": f"""WITH {RAW} SELECT {sql_count(f"{FORMAT_A} > TIMESTAMP '{NOW}'")} AS future_dates,
        {sql_count(f'TRY_CAST(year AS INTEGER) < {YEARS[0]}')} AS year_before_{YEARS[0]},
        {sql_count(f'TRY_CAST(year AS INTEGER) > {YEARS[1]}')} AS year_after_{YEARS[1]},
        min(year) AS min_year_raw, max(year) AS max_year_raw FROM raw""",
    "value_distribution": f"""WITH {RAW} SELECT primary_type AS raw_value, upper(trim(primary_type)) AS cleaned_value,
        count(*) AS frequency, CASE WHEN primary_type <> upper(trim(primary_type)) THEN 'NEEDS_CLEAN' ELSE 'OK' END
        AS needs_cleaning FROM raw GROUP BY primary_type""",
    "value_distribution_numeric": f"WITH {RAW} SELECT district AS raw_value, count(*) AS frequency FROM raw GROUP BY 1",
    "source_bucket": f"WITH {RAW} SELECT {BUCKET} AS source_year_range, count(*) AS n FROM raw GROUP BY 1",
    "union_tagged": f"WITH {RAW} SELECT id, case_number, date, {BUCKET} AS yr_range FROM raw",
    "typed_records": f"WITH {RAW}, {TYPED} SELECT {_TEXT_TIME}, 'STEP4_TYPED' AS _silver_step FROM typed",
    "delete_where": f"WITH {RAW}, {TYPED}, {KEPT} SELECT crime_id, district, community_area FROM kept",
    "delete_from_table": f"""WITH {RAW}, {TYPED}, {KEPT}, gone AS (SELECT district FROM typed
        WHERE community_area = 0 OR TRY_CAST(district AS INTEGER) IN (13, 21))
        SELECT crime_id, community_area, district, (SELECT count(*) FROM gone) AS rows_dropped,
        (SELECT count(DISTINCT coalesce(district, 'none')) FROM gone) AS files_rewritten FROM kept""",
    "dedup_latest": f"WITH {RAW}, {TYPED}, {KEPT}, {LATEST} SELECT {_TEXT_TIME}, 'STEP4_TYPED' AS _silver_step FROM latest",
    "duplicate_summary": f"""WITH {RAW} SELECT _source_file, count(*) AS total_rows, count(DISTINCT id) AS distinct_ids,
        count(*) - count(DISTINCT id) AS duplicate_count, {sql_count('id IS NULL')} AS null_ids FROM raw GROUP BY 1""",
    "duplicate_histogram": f"""WITH {RAW}, k AS (SELECT id, count(DISTINCT _source_file) AS files FROM raw
        WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
        SELECT files AS appears_in_n_files, count(*) AS id_count, min(id) AS sample_id FROM k GROUP BY 1""",
    "duplicate_rows": f"""WITH {RAW}, k AS (SELECT id FROM raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
        ORDER BY id LIMIT 5)
        SELECT raw.id, date, primary_type, district, _source_file FROM raw JOIN k ON raw.id = k.id""",
    "quality_gates": f"WITH {RAW}, {DIMS}, {TYPED}, {FAILURES} SELECT * FROM failures",
    "gate_summary": f"""WITH {RAW}, {DIMS}, {TYPED}, {FAILURES} SELECT reason_code, count(*) AS failed_records,
        {sql_pct('count(*)', '(SELECT count(*) FROM typed_all)', 4)} AS pct_of_total FROM failures GROUP BY 1""",
    "semi_exists": f"""WITH {RAW}, {TYPED}, {DATED} SELECT crime_id, case_number FROM typed t
        WHERE incident_datetime IS NULL AND EXISTS (SELECT 1 FROM dated d WHERE d.crime_id = t.crime_id)""",
    "anti_not_exists": f"""WITH {RAW}, {TYPED}, {DATED} SELECT crime_id, case_number FROM typed t
        WHERE incident_datetime IS NULL AND NOT EXISTS (SELECT 1 FROM dated d WHERE d.crime_id = t.crime_id)""",
    "correlated_raw_value": f"""WITH {RAW}, {TYPED}, {DATED} SELECT crime_id, case_number,
        (SELECT min(_raw_date) FROM dated d WHERE d.crime_id = t.crime_id) AS raw_value
        FROM typed t WHERE incident_datetime IS NULL""",
    "unmatched_keys": f"""WITH {RAW}, {DIMS}, c AS (SELECT {_int('district')} AS district_code FROM raw)
        SELECT district_code, count(*) AS crime_count FROM c WHERE district_code IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM districts d WHERE d.district_num = district_code) GROUP BY 1""",
    "join_key_validation": f"""WITH {RAW}, {DIMS} SELECT """
    + ", ".join(
        _MISSING_DIM.format(code=_int(col), dim=dim, key=key, out=out)
        for col, dim, key, out in [
            ("district", "districts", "district_num", "district_codes_not_in_dim"),
            ("raw.ward", "wards", "ward_num", "ward_codes_not_in_dim"),
            ("community_area", "areas", "area_num", "community_area_codes_not_in_dim"),
        ]
    ),
    "conform_dims": f"WITH {RAW}, {DIMS}, {TYPED}, {KEPT}, {LATEST}, {CONFORMED} SELECT {_TEXT_TIME}, 'STEP7_CONFORMED' AS _silver_step FROM conformed",
    "conformed_unmatched": f"""WITH {RAW}, {DIMS}, {TYPED}, {KEPT}, {LATEST}, {CONFORMED} SELECT community_area_num,
        count(*) AS crime_count FROM conformed WHERE community_name IS NULL AND community_area_num IS NOT NULL GROUP BY 1""",
    "clean_dim": f"WITH {DIMS} SELECT * FROM wards",
    "clean_dim_districts": f"WITH {DIMS} SELECT * FROM districts",
    "clean_dim_areas": f"WITH {DIMS} SELECT * FROM areas",
    "key_profile": f"WITH {DIMS} "
    + " UNION ALL ".join(
        [
            _key_profile("districts", "districts_raw", "dist_num", "dist_label"),
            _key_profile("wards", "wards_raw", "ward", "ward"),
            _key_profile("areas", "areas_raw", "area_numbe", "community"),
        ]
    ),
    "pad_code": f"WITH {DIMS} SELECT dist_num, lpad(trim(dist_num), 3, '0') AS padded FROM districts_raw",
    # Delimited text has no empty string apart from NULL, so empty fields land as NULL.
    "csv_roundtrip": f"""WITH {RAW} SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in TEXT_COLUMNS)}, CAST(NULL AS VARCHAR) AS _corrupt_record,
        'bronze.incidents' AS _bronze_table, {BUCKET} AS yr_range FROM raw""",
}
