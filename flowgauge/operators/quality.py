"""Data-quality rules: a rule is a name and a column that is true for a bad row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions.columns import is_weekday
from flowgauge.schema import CASE_STATUSES, COMPLETED, MILESTONES, PHASE_COLUMNS, TOTAL

REQUIRED = ("event_id", "facility_id", "procedure_type", *MILESTONES)


def _happens(condition: Column) -> Column:
    """Unknown counts as not violated; missing values have their own rule."""
    return F.coalesce(condition, F.lit(False))


def missing_rules(columns: Sequence[str] = REQUIRED) -> dict[str, Column]:
    return {f"missing_{name}": F.col(name).isNull() for name in columns}


def domain_rules() -> dict[str, Column]:
    return {
        "asa_class_out_of_range": _happens(~F.col("asa_class").between(1, 6)),
        "unknown_case_status": _happens(~F.col("case_status").isin(*CASE_STATUSES)),
    }


def milestone_order_rule() -> dict[str, Column]:
    """Each milestone of a completed case is at or after the one before it."""
    reversed_pair = [F.col(later) < F.col(earlier) for earlier, later in pairwise(MILESTONES)]
    broken = F.lit(False)
    for pair in reversed_pair:
        broken = broken | F.coalesce(pair, F.lit(False))
    return {"milestones_out_of_order": _happens(F.col("case_status") == COMPLETED) & broken}


def positive_duration_rule() -> dict[str, Column]:
    durations = [F.coalesce(F.col(name) <= 0, F.lit(False)) for name in (*PHASE_COLUMNS, TOTAL.column)]
    broken = F.lit(False)
    for duration in durations:
        broken = broken | duration
    return {"duration_not_positive": _happens(F.col("case_status") == COMPLETED) & broken}


def additivity_rule(relative: float = 1e-5) -> dict[str, Column]:
    """The phases add up to the total."""
    parts = sum((F.col(name) for name in PHASE_COLUMNS[1:]), F.col(PHASE_COLUMNS[0]))
    off = F.abs(F.col(TOTAL.column) - parts) > F.abs(parts) * relative
    return {"durations_do_not_add_up": _happens(off)}


def case_rules() -> dict[str, Column]:
    """Every rule that needs no more than the row with its durations."""
    return {
        **missing_rules(),
        **domain_rules(),
        **milestone_order_rule(),
        **positive_duration_rule(),
        **additivity_rule(),
    }


def with_violations(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``violations``, the names of the rules each row breaks.

    The names are generated as one row per row: a filter on them then stays above them. Pushed below, it would hold the
    expressions of all columns once for each use in a rule, which makes code that the JVM does not compile.
    """
    rules = case_rules() if rules is None else rules
    hits = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return df.withColumn("violations", F.explode(F.array(F.array_compact(hits))))


def split_by_quality(
    df: DataFrame, rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the quarantined rows with the rules they break. Nothing is written; for both, see ``write_by_quality``."""
    checked = with_violations(df, rules)
    valid = checked.filter(F.size("violations") == 0).drop("violations")
    return valid, checked.filter(F.size("violations") > 0)


VERDICT, VALID, QUARANTINED = "verdict", "valid", "quarantined"


def write_by_quality(df: DataFrame, path: str, rules: Mapping[str, Column] | None = None) -> None:
    """Check the rows once and write both halves in one job, each to its own part of the table at ``path``."""
    verdict = F.when(F.size("violations") == 0, VALID).otherwise(QUARANTINED)
    with_violations(df, rules).withColumn(VERDICT, verdict).write.mode("overwrite").partitionBy(VERDICT).parquet(path)


def read_by_quality(spark: SparkSession, path: str, verdict: str, schema: T.StructType) -> DataFrame:
    """One half of such a table, from its own files; ``schema`` is that of the rows checked."""
    parted = T.StructType([*schema.fields, T.StructField("violations", T.ArrayType(T.StringType())), T.StructField(VERDICT, T.StringType())])
    half = spark.read.schema(parted).parquet(path).filter(F.col(VERDICT) == verdict).drop(VERDICT)
    return half.drop("violations") if verdict == VALID else half


def weights_off(weights: DataFrame, by: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """The groups of ``by`` whose ``weight`` values do not add up to 1, with their sum."""
    sums = weights.groupBy(*by).agg(F.sum("weight").alias("total"))
    return sums.filter(F.coalesce(F.abs(F.col("total") - 1) > tolerance, F.lit(True)))


def violation_counts(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per rule with the number of rows that break it; one pass over the data."""
    rules = case_rules() if rules is None else rules
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that the dimension lacks, with their number of rows.

    The fact table is counted per value, so only distinct values are joined; with a
    dimension small enough to broadcast, Spark looks the values up during the scan instead.
    """
    used = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("cases"))
    return used.join(dimension.select(key), key, "left_anti")


def on_weekdays(df: DataFrame, timestamp: str = "checkin_time") -> DataFrame:
    return df.filter(is_weekday(timestamp))
