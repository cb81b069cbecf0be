"""The fixed dimension values as DataFrames; a user's own tables can take their place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge import fixed_values
from flowgauge.schema import FACILITY_SCHEMA


def facilities(spark: SparkSession) -> DataFrame:
    """Facility rows in their stored form, stamped with the time of this call."""
    rows = spark.createDataFrame(
        fixed_values.FACILITIES, "facility_id string, facility_name string, timezone string"
    )
    return rows.withColumn("created_at", F.current_timestamp()).select(*FACILITY_SCHEMA.names)


def volume_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed_values.DAILY_VOLUME, "facility_id string, volume_min int, volume_max int"
    )


def service_line_bias(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed_values.SERVICE_LINE_BIAS, "facility_id string, service_line string, weight double"
    )


def anesthesia_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fixed_values.ANESTHESIA_MIX, "service_line string, anesthesia_type string, weight double"
    )


def hour_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(fixed_values.CHECKIN_HOUR_WEIGHTS)), "hour int, weight double")


def asa_weights(spark: SparkSession) -> DataFrame:
    rows = list(enumerate(fixed_values.ASA_WEIGHTS, start=1))
    return spark.createDataFrame(rows, "asa_class int, weight double")
