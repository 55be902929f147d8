"""Seed rows applied with overwrite (insert-or-update by key)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.functions import scalars as S
from aerolith.operators.dims import upsert_by_key

# The seeded parameters (source id, code, display name, description, unit).
SEED_PARAMETERS = [
    (2, "pm25", "PM2.5", "Fine particulate matter with diameter smaller than 2.5 micrometers", "ug/m3"),
    (1, "pm10", "PM10", "Particulate matter with diameter smaller than 10 micrometers", "ug/m3"),
    (7, "no2", "NO2", "Nitrogen dioxide", "ug/m3"),
    (3, "o3", "O3", "Ozone", "ug/m3"),
]
# The seeded city rules (city, parameter code), four default levels each.
SEED_CITY_RULES = [("Budapest", "pm25")]
SEED_ID_OFFSET = 100  # surrogate id of a seeded parameter not yet stored = offset + source id


def seed_parameters(spark: SparkSession, parameter: DataFrame) -> DataFrame:
    """Seeded parameters upserted by code: listed columns overwritten, the
    stored id kept; new codes get ``SEED_ID_OFFSET + source id``."""
    seeds = spark.createDataFrame(SEED_PARAMETERS, "openaq_parameter_id int, code string, display_name string, "
                                                   "description string, preferred_unit string") \
        .withColumn("parameter_id", (F.lit(SEED_ID_OFFSET) + F.col("openaq_parameter_id")).cast("int"))
    cur = parameter.select("parameter_id", "openaq_parameter_id", "code", "display_name", "description",
                           "preferred_unit")
    return upsert_by_key(seeds, cur, ["code"],
                         update=["openaq_parameter_id", "display_name", "description", "preferred_unit"])


def seed_city_rules(spark: SparkSession, parameter: DataFrame, existing_rules: DataFrame) -> DataFrame:
    """Default levels for the seeded cities (only for parameters that exist)."""
    from aerolith.operators.alerts import default_rules
    scope = spark.createDataFrame(SEED_CITY_RULES, "city string, code string") \
        .join(parameter.select("code", "parameter_id"), "code")
    return default_rules(scope, existing_rules)


__all__ = ["seed_parameters", "seed_city_rules", "SEED_PARAMETERS", "S"]
