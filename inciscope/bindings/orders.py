"""Orders with their customer's place read as conformed incident records: star schema, views, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inciscope import config
from inciscope.bindings.common import as_text, read, sql_count, sql_pct, sql_signed_pct, sql_sum, sql_text
from inciscope.functions.metrics import distinct_codes
from inciscope.functions.rules import classify, map_values
from inciscope.functions.temporal import date_key, date_parts
from inciscope.operators import dims, features, shaping, views
from inciscope.operators.windows import share_by
from inciscope.plans import gold
from inciscope.session import materialise
from inciscope.sources.logs import publication_log

AREAS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
RULES = [("VIOLENT", ["1-URGENT", "2-HIGH"]), ("PROPERTY", ["2-HIGH", "3-MEDIUM"])]
CODES = {"02": "Second", "03": "Third", "05": "Fifth"}
PLACES = [("OUTDOOR / TRANSPORT", ["REGION_0", "AFRICA"]), ("RESIDENTIAL", ["REGION_1", "ASIA", "EUROPE"])]
YEARS = (1999, 2000)


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    parts = date_parts(F.col("o_orderdate"))
    return rows.select(
        F.col("o_orderkey").alias("crime_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("case_number"),
        F.col("o_orderdate").alias("incident_datetime"),
        parts["year"].alias("incident_year"),
        parts["month"].alias("incident_month"),
        parts["day"].alias("incident_day"),
        (F.col("o_orderkey") % 24).cast("int").alias("incident_hour"),
        parts["dayofweek"].alias("incident_dayofweek"),
        F.col("o_orderpriority").alias("primary_type"),
        F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1)).alias("fbi_code"),
        F.col("r_name").alias("location_description"),
        (F.col("o_orderstatus") == "F").alias("is_arrest"),
        (F.col("o_totalprice") > 150000).alias("is_domestic"),
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("beat"),
        F.col("n_nationkey").cast("string").alias("district_code"),
        F.col("n_name").alias("district_name"),
        F.col("n_regionkey").alias("ward_num"),
        F.col("r_name").alias("ward_label"),
        map_values(F.col("c_mktsegment"), AREAS).alias("community_area_num"),
        F.col("c_mktsegment").alias("community_name"),
        F.lit(None).cast("double").alias("lat_final"),
        F.lit(None).cast("double").alias("lon_final"),
        F.lit("ALL").alias("source_year_range"),
        F.lit("orders").alias("_source_file"),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns the views use; the category follows from the type, so no key lookup is needed."""
    category = classify(F.col("primary_type"), RULES, config.OTHER)
    return conformed(spark, sf_dir).withColumns(
        {
            "date_key": date_key(F.col("incident_datetime")),
            "shift_key": F.col("incident_hour"),
            "crime_category": category,
            "is_violent": category == config.VIOLENT,
        }
    )


def dim_date(spark, sf_dir):
    return dims.build_dim_date(read(spark, sf_dir, "orders"), "o_orderdate")


def dim_type(spark, sf_dir):
    codes = F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1)).alias("fbi_code")
    pairs = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("primary_type"), codes)
    return dims.build_dim_type(pairs, code_map=CODES, category_rules=RULES)


def star(spark, sf_dir):
    return gold.star(materialise(conformed(spark, sf_dir), "conformed"), code_map=CODES, category_rules=RULES)


def profile(spark, sf_dir):
    return views.entity_profile(fact(spark, sf_dir), YEARS)


def entity_features(spark, sf_dir):
    stored = materialise(profile(spark, sf_dir), "profile")
    n_years = read(spark, sf_dir, "orders").agg(distinct_codes(F.year("o_orderdate"))).scalar()
    return features.entity_features(stored, n_years, f"yoy_pct_{YEARS[1]}_vs_{YEARS[0]}")


FEATURE_PREVIEW = [
    "community_name", "total_crimes", "arrest_rate_pct", "violent_pct", "domestic_pct", "is_high_volume_area",
    "is_low_arrest_area",
]


def feature_preview(spark, sf_dir):
    rows = entity_features(spark, sf_dir).select(*FEATURE_PREVIEW)
    return shaping.top_k(rows, [F.desc("total_crimes"), F.asc("community_name")], 10)


def published(spark, sf_dir):
    built = star(spark, sf_dir)
    stored = gold.Star(**{**vars(built), "fact": materialise(built.fact, "fact")})
    objects = {name: df for name, df in vars(stored).items()} | gold.all_views(stored, YEARS)
    kinds = {name: "VIEW" for name in objects if name.startswith("v_")}
    log = publication_log(objects, "run-1", kinds)
    return log.withColumn("log_ts", F.col("log_ts").isNotNull())


def date_parts_query(spark, sf_dir):
    ts = F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", *[part.alias(name) for name, part in date_parts(ts).items()], date_key(ts).alias("date_key")
    )


def top_areas(spark, sf_dir):
    rows = profile(spark, sf_dir).select(
        "community_name", "total_crimes", "arrest_rate_pct", "violent_pct", "domestic_pct", "dominant_crime_type"
    )
    return shaping.top_k(rows, [F.desc("total_crimes"), F.asc("community_name")], 10)


def top_districts(spark, sf_dir):
    rows = fact(spark, sf_dir).groupBy("district_name").agg(F.count(F.lit(1)).alias("total_crimes"))
    return shaping.top_k(rows, [F.desc("total_crimes"), F.asc("district_name")], 10)


def top_orders_per_area(spark, sf_dir):
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_mktsegment", "o_orderkey", "o_totalprice"
    )
    return shaping.top_k_per_group(rows, ["c_mktsegment"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


def fact_build(spark, sf_dir):
    return star(spark, sf_dir).fact.drop("_gold_ts")


def conformed_by_year(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return share_by(rows, "year", "crime_count", "pct_of_total")


def inline_values(spark, sf_dir):
    """An inline relation of status labels met by the orders having each status."""
    labels = spark.createDataFrame(
        [("F", "Filled", 1), ("O", "Open", 2), ("P", "Pending", 3), ("X", "Unused", 4)], "code string, label string, step int"
    )
    counts = read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return labels.join(counts, "code", "left").select("step", "code", "label", F.coalesce("n", F.lit(0)).alias("n"))


QUERIES = {
    "dim_date": lambda s, d: dim_date(s, d).withColumn("full_date", F.col("full_date").cast("string")),
    "dim_type": dim_type,
    "dim_location": lambda s, d: dims.build_dim_location(conformed(s, d)),
    "dim_location_type": lambda s, d: dims.build_dim_location_type(conformed(s, d), rules=PLACES),
    "fact_build": fact_build,
    "monthly_trend": lambda s, d: views.monthly_trend(fact(s, d), dim_date(s, d)),
    "yoy_change": lambda s, d: views.yoy_change(fact(s, d)),
    "community_profile": profile,
    "district_performance": lambda s, d: views.group_performance(fact(s, d)),
    "type_breakdown": lambda s, d: views.type_breakdown(fact(s, d), dim_type(s, d)),
    "type_by_area": lambda s, d: views.type_by_area(fact(s, d)),
    "rate_vs_overall": lambda s, d: views.rate_vs_overall(fact(s, d)),
    "domestic_style_rates": lambda s, d: views.flag_analysis(fact(s, d)),
    "kpi_summary": lambda s, d: views.kpi_summary(fact(s, d)),
    "feature_table_entity": entity_features,
    "feature_preview": feature_preview,
    "feature_table_group_year": lambda s, d: features.group_year_features(views.group_performance(fact(s, d))),
    "type_rollup": lambda s, d: views.type_rollup(views.type_breakdown(fact(s, d), dim_type(s, d))),
    "year_distribution": conformed_by_year,
    "date_parts": date_parts_query,
    "top_areas": top_areas,
    "top_k": top_districts,
    "top_k_per_group": top_orders_per_area,
    "preview_ordered": lambda s, d: shaping.preview(
        read(s, d, "orders").withColumn("o_orderdate", as_text(F.col("o_orderdate"))), [F.asc("o_orderkey")], 5
    ),
    "inline_values": inline_values,
    "publication_log": published,
}

# --- DuckDB side -------------------------------------------------------------------------------


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(col: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} IN {_in(v)} THEN '{label}'" for label, v in rules) + f" ELSE '{default}' END"


CATEGORY = _case("o_orderpriority", RULES, "OTHER")
FACT = f"""f AS (SELECT o_orderkey AS crime_id, 'C' || CAST(o_custkey AS VARCHAR) AS case_number,
    o_orderdate AS incident_datetime, CAST(year(o_orderdate) AS INTEGER) AS incident_year,
    CAST(month(o_orderdate) AS INTEGER) AS incident_month, CAST(o_orderkey % 24 AS INTEGER) AS incident_hour,
    CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS incident_dayofweek, o_orderpriority AS primary_type,
    '0' || substr(o_orderpriority, 1, 1) AS fbi_code, r_name AS location_description, o_orderstatus = 'F' AS is_arrest,
    o_totalprice > 150000 AS is_domestic, lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS beat,
    CAST(n_nationkey AS VARCHAR) AS district_code, n_name AS district_name, n_regionkey AS ward_num, r_name AS ward_label,
    CASE c_mktsegment {' '.join(f"WHEN '{k}' THEN {v}" for k, v in AREAS.items())} END AS community_area_num,
    c_mktsegment AS community_name, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
    {CATEGORY} AS crime_category, {CATEGORY} = 'VIOLENT' AS is_violent
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""
N, ARRESTS, DOMESTIC, VIOLENT = "count(*)", sql_count("is_arrest"), sql_count("is_domestic"), sql_count("is_violent")
COUNTS = f"{N} AS total_crimes, {ARRESTS} AS total_arrests, {DOMESTIC} AS domestic_crimes, {VIOLENT} AS violent_crimes"
ARREST_RATE = f"{sql_pct(ARRESTS, N)} AS arrest_rate_pct"
VIOLENT_RATE = f"{sql_pct(VIOLENT, N)} AS violent_crime_pct"


def code_case(col: str, codes, prefix: str) -> str:
    return f"CASE upper(trim({col})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items()) + f" ELSE '{prefix}' || {col} END"


DIM_TYPE = f"""dim_type AS (SELECT CAST(dense_rank() OVER (ORDER BY primary_type, fbi_code) AS INTEGER) AS crime_type_key,
    primary_type, fbi_code, {code_case('fbi_code', CODES, config.OFFENCE_CODE_FALLBACK)} AS fbi_description,
    {_case('primary_type', RULES, 'OTHER')} AS crime_category, primary_type IN {_in(RULES[0][1])} AS is_violent
    FROM (SELECT DISTINCT primary_type, fbi_code FROM f))"""
DIM_LOCATION = """dim_location AS (SELECT CAST(dense_rank() OVER (ORDER BY community_area_num, ward_num, district_code, beat)
    AS INTEGER) AS location_key, * FROM (SELECT DISTINCT community_area_num, ward_num, district_code, beat, district_name,
    ward_label, community_name FROM f))"""
DIM_LOCATION_TYPE = f"""dim_location_type AS (SELECT CAST(dense_rank() OVER (ORDER BY location_description) AS INTEGER)
    AS location_type_key, location_description, {_case('location_description', PLACES, 'OTHER')} AS location_category
    FROM (SELECT DISTINCT location_description FROM f))"""
DIM_DATE_SELECT = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_num, strftime(d, '%A') AS day_name,
    CASE WHEN dayofweek(d) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS weekday_type, false AS is_holiday FROM"""
MONTHLY = f"""SELECT incident_year, incident_month, strftime(incident_datetime, '%B') AS month_name,
    'Q' || CAST(quarter(incident_datetime) AS VARCHAR) AS quarter, {COUNTS}, {ARREST_RATE} FROM f GROUP BY 1, 2, 3, 4"""
YEARLY = f"""yearly AS (SELECT district_name, incident_year, {N} AS total_crimes, {ARRESTS} AS total_arrests
    FROM f GROUP BY 1, 2)"""


def _mode(col: str, by: str = "") -> str:
    """Most frequent value with the smallest winning ties, as a scalar subquery over f."""
    where = f"WHERE {col} IS NOT NULL" + (f" AND g.{by} = p.{by}" if by else "")
    return f"(SELECT {col} FROM f g {where} GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


NEW, OLD = f"crimes_{YEARS[1]}", f"crimes_{YEARS[0]}"
CHANGE = f"yoy_pct_{YEARS[1]}_vs_{YEARS[0]}"
PROFILE = f"""base AS (SELECT community_area_num, community_name, {COUNTS},
    {sql_count("crime_category = 'PROPERTY'")} AS property_crimes, {sql_count(f'incident_year = {YEARS[1]}')} AS {NEW},
    {sql_count(f'incident_year = {YEARS[0]}')} AS {OLD} FROM f GROUP BY 1, 2),
profile AS (SELECT p.*, {_mode('incident_hour', 'community_name')} AS peak_crime_hour,
    {_mode('primary_type', 'community_name')} AS dominant_crime_type,
    {sql_pct('total_arrests', 'total_crimes')} AS arrest_rate_pct, {sql_pct('violent_crimes', 'total_crimes')} AS violent_pct,
    {sql_pct('domestic_crimes', 'total_crimes')} AS domestic_pct,
    {sql_signed_pct(f'{NEW} - {OLD}', f'nullif({OLD}, 0)')} AS {CHANGE} FROM base p)"""
PERFORMANCE = f"""performance AS (SELECT *, CAST(rank() OVER (PARTITION BY incident_year ORDER BY total_crimes DESC) AS INTEGER)
    AS crime_volume_rank, CAST(rank() OVER (PARTITION BY incident_year ORDER BY arrest_rate_pct DESC) AS INTEGER) AS arrest_rate_rank
    FROM (SELECT district_code, district_name, incident_year, {COUNTS}, {ARREST_RATE}, {VIOLENT_RATE}
    FROM f GROUP BY 1, 2, 3))"""
BREAKDOWN = f"""breakdown AS (SELECT y.*, fbi_description, crime_category,
    {sql_pct('total_crimes', 'CAST(sum(total_crimes) OVER (PARTITION BY incident_year) AS BIGINT)')} AS pct_of_year_total,
    CAST(rank() OVER (PARTITION BY incident_year ORDER BY total_crimes DESC) AS INTEGER) AS rank_in_year
    FROM (SELECT primary_type, fbi_code, incident_year, {N} AS total_crimes, {ARRESTS} AS total_arrests, {ARREST_RATE}
    FROM f GROUP BY 1, 2, 3) y LEFT JOIN dim_type USING (primary_type, fbi_code))"""


def avg_rate(col: str) -> str:
    """Average of two-digit rates, rounded half up exactly."""
    return f"(CAST((2 * sum(CAST(round({col} * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100)"


_OBJECTS = {
    "dim_date": "(SELECT count(DISTINCT date_key) FROM f)",
    "dim_crime_type": "(SELECT count(*) FROM dim_type)",
    "dim_location": "(SELECT count(*) FROM dim_location)",
    "dim_shift": "24",
    "dim_location_type": "(SELECT count(*) FROM dim_location_type)",
    "fact": "(SELECT count(*) FROM f)",
    "v_temporal_monthly_trend": "(SELECT count(*) FROM (SELECT DISTINCT incident_year, incident_month FROM f))",
    "v_temporal_yoy_change": "(SELECT count(*) FROM yearly)",
    "v_temporal_shift_analysis": "(SELECT count(DISTINCT incident_hour) FROM f)",
    "v_temporal_weekday_pattern": "(SELECT count(DISTINCT incident_dayofweek) FROM f)",
    "v_geo_community_profile": "(SELECT count(*) FROM base)",
    "v_geo_district_performance": "(SELECT count(*) FROM yearly)",
    "v_crime_type_breakdown": "(SELECT count(*) FROM (SELECT DISTINCT primary_type, fbi_code, incident_year FROM f))",
    "v_crime_type_by_area": "(SELECT count(*) FROM (SELECT DISTINCT community_name, primary_type FROM f))",
    "v_arrest_effectiveness": """(SELECT count(*) FROM (SELECT DISTINCT primary_type, district_name, community_name,
        incident_year FROM f))""",
    "v_domestic_crime_analysis": """(SELECT count(*) FROM (SELECT DISTINCT community_name, district_name,
        incident_year FROM f))""",
    "v_city_kpi_summary": "1",
}

ORACLE = {
    "dim_date": f"{DIM_DATE_SELECT} (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)",
    "dim_type": f"WITH {FACT}, {DIM_TYPE} SELECT * FROM dim_type",
    "dim_location": f"WITH {FACT}, {DIM_LOCATION} SELECT * FROM dim_location",
    "dim_location_type": f"WITH {FACT}, {DIM_LOCATION_TYPE} SELECT * FROM dim_location_type",
    "fact_build": f"""WITH {FACT}, {DIM_TYPE}, {DIM_LOCATION}, {DIM_LOCATION_TYPE}
        SELECT crime_id, case_number, date_key, crime_type_key, location_key, incident_hour AS shift_key, location_type_key,
        is_arrest, is_domestic, CAST(NULL AS DOUBLE) AS lat_final, CAST(NULL AS DOUBLE) AS lon_final, incident_year,
        incident_month, incident_hour, incident_dayofweek, f.primary_type, f.fbi_code, f.crime_category, f.is_violent,
        f.community_area_num, f.community_name, f.district_code, f.district_name, f.ward_num, f.location_description,
        'ALL' AS source_year_range, 'orders' AS _source_file
        FROM f JOIN dim_type t ON f.primary_type = t.primary_type AND f.fbi_code = t.fbi_code
        JOIN dim_location l ON f.beat = l.beat AND f.district_code = l.district_code AND f.ward_num = l.ward_num
        AND f.community_area_num = l.community_area_num
        JOIN dim_location_type p ON f.location_description = p.location_description""",
    "monthly_trend": f"""WITH {FACT}, m AS ({MONTHLY}) SELECT *, round(avg(total_crimes) OVER
        (ORDER BY incident_year, incident_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS rolling_3m_avg FROM m""",
    "yoy_change": f"""WITH {FACT}, {YEARLY} SELECT c.district_name, c.incident_year, c.total_crimes, c.total_arrests,
        {sql_pct('c.total_arrests', 'c.total_crimes')} AS arrest_rate_pct, p.total_crimes AS prev_year_crimes,
        c.total_crimes - p.total_crimes AS yoy_change_abs,
        {sql_signed_pct('c.total_crimes - p.total_crimes', 'nullif(p.total_crimes, 0)')} AS yoy_change_pct,
        CASE WHEN c.total_crimes > p.total_crimes THEN 'INCREASING' WHEN c.total_crimes < p.total_crimes THEN 'DECREASING'
        ELSE 'STABLE' END AS trend_direction FROM yearly c LEFT JOIN yearly p
        ON c.district_name = p.district_name AND c.incident_year = p.incident_year + 1""",
    "community_profile": f"WITH {FACT}, {PROFILE} SELECT * FROM profile",
    "district_performance": f"WITH {FACT}, {PERFORMANCE} SELECT * FROM performance",
    "type_breakdown": f"WITH {FACT}, {DIM_TYPE}, {BREAKDOWN} SELECT * FROM breakdown",
    "type_by_area": f"""WITH {FACT}, g AS (SELECT community_name, primary_type, crime_category, {N} AS crime_count
        FROM f GROUP BY 1, 2, 3) SELECT *,
        {sql_pct('crime_count', 'CAST(sum(crime_count) OVER (PARTITION BY community_name) AS BIGINT)')} AS pct_of_community,
        CAST(dense_rank() OVER (PARTITION BY community_name ORDER BY crime_count DESC) AS INTEGER) AS rank_in_community FROM g""",
    "rate_vs_overall": f"""WITH {FACT}, g AS (SELECT primary_type, crime_category, district_name, community_name,
        incident_year, {N} AS total_crimes, {ARRESTS} AS total_arrests, {ARREST_RATE} FROM f GROUP BY 1, 2, 3, 4, 5),
        o AS (SELECT primary_type, {sql_pct(ARRESTS, N)} AS citywide_avg_arrest_rate FROM f GROUP BY 1)
        SELECT *, arrest_rate_pct < citywide_avg_arrest_rate AS below_citywide_avg FROM g JOIN o USING (primary_type)""",
    "domestic_style_rates": f"""WITH {FACT}, g AS (SELECT community_name, district_name, incident_year, {N} AS total_crimes,
        {DOMESTIC} AS domestic_count, {sql_count('NOT is_domestic')} AS non_domestic_count,
        {sql_pct(DOMESTIC, N)} AS domestic_pct, {sql_count('is_domestic AND is_arrest')} AS domestic_arrests,
        {sql_pct(sql_count('is_domestic AND is_arrest'), f'nullif({DOMESTIC}, 0)')} AS domestic_arrest_rate_pct
        FROM f GROUP BY 1, 2, 3)
        SELECT *, CAST(rank() OVER (PARTITION BY incident_year ORDER BY domestic_pct DESC) AS INTEGER) AS domestic_rate_rank FROM g""",
    "kpi_summary": f"""WITH {FACT} SELECT {N} AS total_crimes, count(DISTINCT incident_year) AS years_covered,
        min(incident_year) AS first_year, max(incident_year) AS last_year,
        count(DISTINCT community_area_num) AS communities_with_crime, count(DISTINCT district_code) AS districts_covered,
        {sql_pct(ARRESTS, N)} AS overall_arrest_rate_pct, {sql_pct(DOMESTIC, N)} AS domestic_crime_pct,
        {sql_pct(VIOLENT, N)} AS violent_crime_pct, {_mode('primary_type')} AS most_common_crime,
        {_mode('community_name')} AS highest_crime_community, {_mode('incident_hour')} AS peak_crime_hour,
        {_mode('location_description')} AS most_common_location_type FROM f""",
    "feature_table_entity": f"""WITH {FACT}, {PROFILE}, y AS (SELECT count(DISTINCT incident_year) AS n FROM f),
        t AS (SELECT quantile_cont(total_crimes, 0.5) AS volume, quantile_cont(arrest_rate_pct, 0.5) AS arrest,
        quantile_cont(violent_pct, 0.75) AS violent FROM profile)
        SELECT community_area_num, community_name, total_crimes, arrest_rate_pct, domestic_pct, violent_pct,
        peak_crime_hour, {CHANGE} AS yoy_change_pct, round(CAST(total_crimes AS DOUBLE) / y.n, 0) AS avg_crimes_per_year,
        {sql_pct('violent_crimes', 'total_crimes')} AS violent_share_pct,
        {sql_pct('property_crimes', 'total_crimes')} AS property_share_pct,
        total_crimes > t.volume AS is_high_volume_area, arrest_rate_pct < t.arrest AS is_low_arrest_area,
        violent_pct > t.violent AS is_high_violent_area FROM profile, y, t""",
    "feature_table_group_year": f"""WITH {FACT}, {PERFORMANCE} SELECT district_code, district_name, incident_year,
        total_crimes, arrest_rate_pct, violent_crime_pct, crime_volume_rank, arrest_rate_rank,
        round(arrest_rate_pct - CAST(crime_volume_rank AS DOUBLE)
        / max(crime_volume_rank) OVER (PARTITION BY incident_year) * 100, 2) AS effectiveness_score FROM performance""",
    "type_rollup": f"""WITH {FACT}, {DIM_TYPE}, {BREAKDOWN} SELECT primary_type, crime_category,
        {sql_sum('total_crimes')} AS total, {avg_rate('arrest_rate_pct')} AS avg_arrest_rate FROM breakdown GROUP BY 1, 2""",
    "year_distribution": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {N} AS crime_count,
        {sql_pct(N, '(SELECT count(*) FROM orders)')} AS pct_of_total FROM orders GROUP BY 1""",
    "date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER)
        AS month, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(hour(o_orderdate) AS INTEGER) AS hour,
        CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dayofweek,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders""",
    "top_areas": f"""WITH {FACT}, {PROFILE} SELECT community_name, total_crimes, arrest_rate_pct, violent_pct, domestic_pct,
        dominant_crime_type FROM profile ORDER BY total_crimes DESC, community_name LIMIT 10""",
    "top_k": f"""WITH {FACT} SELECT district_name, {N} AS total_crimes FROM f GROUP BY 1
        ORDER BY total_crimes DESC, district_name LIMIT 10""",
    "top_k_per_group": """SELECT * FROM (SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(row_number() OVER
        (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank_in_group
        FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rank_in_group <= 5""",
    "preview_ordered": f"""SELECT * REPLACE ({sql_text('o_orderdate')} AS o_orderdate) FROM orders
        ORDER BY orders.o_orderkey LIMIT 5""",
    "inline_values": """SELECT step, code, label, count(o_orderkey) AS n FROM (VALUES ('F', 'Filled', 1), ('O', 'Open', 2),
        ('P', 'Pending', 3), ('X', 'Unused', 4)) v(code, label, step) LEFT JOIN orders ON o_orderstatus = code
        GROUP BY 1, 2, 3""",
    "publication_log": f"WITH {FACT}, {DIM_TYPE}, {DIM_LOCATION}, {DIM_LOCATION_TYPE}, {YEARLY}, {PROFILE} "
    + " UNION ALL ".join(
        f"""SELECT 'run-1' AS run_id, 'GOLD_STEP9_FINAL_PUBLICATION' AS step_name, 'N/A' AS source_table, '{name}' AS target_table,
        CAST({rows} AS BIGINT) AS rows_in, CAST({rows} AS BIGINT) AS rows_out, CAST(0 AS BIGINT) AS rows_dropped,
        'Object Type: {"VIEW" if name.startswith("v_") else "TABLE"} - Published and verified successfully.' AS notes,
        true AS log_ts"""
        for name, rows in _OBJECTS.items()
    ),
}
ORACLE["feature_preview"] = f"""SELECT {', '.join(FEATURE_PREVIEW)} FROM ({ORACLE['feature_table_entity']})
    ORDER BY total_crimes DESC, community_name LIMIT 10"""
