"""Part types as codes and brands as places: code lookup and category rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from inciscope import config
from inciscope.bindings.common import read
from inciscope.bindings.orders import _case, code_case
from inciscope.functions.rules import classify
from inciscope.operators.dims import build_dim_location_type, describe_code

CODES = {"STANDARD": "Standard goods", "SMALL": "Small goods", "PROMO": "Promotion"}
TYPE_RULES = [("VIOLENT", ["LARGE", "PROMO"]), ("PROPERTY", ["PROMO", "SMALL"])]
PLACE_RULES = [
    ("OUTDOOR / TRANSPORT", ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]),
    ("RESIDENTIAL", ["Brand#4", "Brand#5", "Brand#6"]),
    ("COMMERCIAL", ["Brand#11", "Brand#12"]),
    ("INSTITUTIONAL", ["Brand#12", "Brand#21"]),
]


def code_lookup(spark, sf_dir):
    counts = read(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("description", describe_code(F.col("p_type"), CODES, "Code "))


def category_map(spark, sf_dir):
    counts = read(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    category = classify(F.col("p_type"), TYPE_RULES, config.OTHER)
    return counts.withColumns({"category": category, "is_listed": F.col("p_type").isin("LARGE", "PROMO")})


def location_category(spark, sf_dir):
    return build_dim_location_type(read(spark, sf_dir, "part"), "p_brand", PLACE_RULES)


QUERIES = {"code_lookup": code_lookup, "category_map": category_map, "location_category": location_category}

ORACLE = {
    "code_lookup": f"""SELECT p_type, count(*) AS n, {code_case('p_type', CODES, 'Code ')} AS description
        FROM part GROUP BY p_type""",
    "category_map": f"""SELECT p_type, count(*) AS n, {_case('p_type', TYPE_RULES, 'OTHER')} AS category,
        p_type IN ('LARGE', 'PROMO') AS is_listed FROM part GROUP BY p_type""",
    "location_category": f"""SELECT CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS location_type_key, p_brand,
        {_case('p_brand', PLACE_RULES, 'OTHER')} AS location_category FROM (SELECT DISTINCT p_brand FROM part)""",
}
