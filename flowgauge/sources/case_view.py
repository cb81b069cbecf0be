"""The case-event table as a view over order tables.

A line item is a case: its part gives the procedure, its supplier's region the
facility, and integer arithmetic on its keys the minutes between milestones. Part and
supplier grow with the data, so the planner picks their join from measured sizes;
nation and region have 25 and 5 rows at every scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.columns import add_minutes
from flowgauge.operators.derive import with_durations
from flowgauge.schema import CASE_STATUSES
from flowgauge.session import settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility dimension: one row per region, with its expected daily volume."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("facility_id"),
        F.concat(F.lit("Center "), F.initcap("r_name")).alias("facility_name"),
        F.lit("UTC").alias("timezone"),
        (key + 1).alias("volume_min"),
        (key * 2 + 6).alias("volume_max"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedure dimension: one row per brand, its service line that of the brand's last part."""
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("procedure_type"))
    return settle(brands.agg(F.max_by("p_type", "p_partkey").alias("service_line")), "catalog")


def _supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    regions = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_regionkey", "r_name"
    )
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(F.broadcast(regions), supplier.s_nationkey == regions.n_nationkey).select(
        "s_suppkey", "r_regionkey", "r_name"
    )


def _status(roll: Column) -> Column:
    completed, canceled, converted, delayed = CASE_STATUSES
    return (
        F.when(roll < 2, canceled).when(roll < 3, converted).when(roll < 6, delayed).otherwise(completed)
    )


def from_line_items(lines: DataFrame, sf_dir: str, created_at: bool = True) -> DataFrame:
    """Case events of a line-item frame, which may also be one batch of a stream.

    ``created_at`` is the order's date, null without an order; leaving it out saves the
    join with the orders.
    """
    spark = lines.sparkSession
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        _supplier_regions(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")
    )
    if created_at:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("created_at"))
        joined = joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line, size, region = F.col("l_linenumber"), F.col("p_size"), F.col("r_regionkey")
    checkin = 360 + (part * 7 + order * 13 + line) % 660
    preop = checkin + 8 + (order * 7 + line * 3) % 25
    op = preop + 10 + (part * 11 + line) % 20
    postop = op + 10 + size + F.col("l_quantity").cast("int") % 30
    long_stay = F.when((order + part) % 20 == 0, 120).otherwise(0)
    discharge = postop + 15 + (order * 17 + part) % 40 + region * 15 + long_stay
    offset = (order * 31 + supplier) % 41 - 20 + region * 3

    def minute(number: Column) -> Column:
        return add_minutes("l_shipdate", number.cast("int"))

    return joined.select(
        F.concat_ws("-", order, line, part, supplier).alias("event_id"),
        F.col("r_name").alias("facility_id"),
        F.col("p_brand").alias("procedure_type"),
        minute(op - offset).alias("scheduled_start_time"),
        minute(checkin).alias("checkin_time"),
        minute(preop).alias("preop_start_time"),
        minute(op).alias("op_start_time"),
        minute(postop).alias("postop_start_time"),
        minute(discharge).alias("discharge_time"),
        F.col("l_returnflag").alias("anesthesia_type"),
        (1 + order % 6).cast("int").alias("asa_class"),
        _status((order * 7 + line * 13 + part) % 100).alias("case_status"),
        *([F.col("created_at")] if created_at else []),
        F.col("l_linestatus").alias("source_generator_id"),
    )


def case_events(spark: SparkSession, sf_dir: str, created_at: bool = False) -> DataFrame:
    return from_line_items(table(spark, sf_dir, "lineitem"), sf_dir, created_at)


def timed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_durations(case_events(spark, sf_dir))


def settled_cases(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Timed cases written once, for operators that read them several times."""
    return settle(timed_cases(spark, sf_dir).select(*columns), "cases")


def flawed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cases as a careless source would send them, for the quality rules.

    Every case is kept; arithmetic on its own values decides which flaws it carries.
    """
    minute = F.hour("checkin_time") * 60 + F.minute("checkin_time")
    mark = (minute + F.col("asa_class")) % 97
    return timed_cases(spark, sf_dir).withColumns(
        {
            "facility_id": F.when(mark == 1, F.lit("UNLISTED")).otherwise(F.col("facility_id")),
            "procedure_type": F.when(mark != 2, F.col("procedure_type")),
            "asa_class": F.when(mark.isin(3, 4), F.lit(7) * (mark - 3)).otherwise(F.col("asa_class")),
            "case_status": F.when(mark == 5, F.lit("unknown")).otherwise(F.col("case_status")),
            "postop_start_time": F.when(mark == 6, F.col("checkin_time")).otherwise(F.col("postop_start_time")),
            "dur_total": F.when(mark == 7, F.col("dur_total") + 1).otherwise(F.col("dur_total")),
            "dur_preop_to_op": F.when(mark == 8, -F.col("dur_preop_to_op")).otherwise(F.col("dur_preop_to_op")),
        }
    )


def as_resent(cases: DataFrame) -> DataFrame:
    """The cases as a feed that sends one case once per line of its order.

    The order number is the case id, so all lines of an order are copies of one case,
    sent at different times.
    """
    order = F.substring_index("event_id", "-", 1)
    sent = add_minutes("created_at", F.minute("checkin_time"))
    return cases.withColumns({"created_at": sent, "event_id": F.concat(F.lit("case-"), order)})


def careless_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed from a source that loses some ids and some times of sending."""
    minute = F.minute("checkin_time")
    return resent_cases(spark, sf_dir).withColumns(
        {
            "event_id": F.when(minute != 7, F.col("event_id")),
            "created_at": F.when(minute != 11, F.col("created_at")),
        }
    )


def resent_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_resent(case_events(spark, sf_dir, created_at=True))
