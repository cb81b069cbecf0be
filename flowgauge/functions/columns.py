"""Column expressions; all of them built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROSECONDS_PER_MINUTE = 6e7


def minutes_between(start, end, zoned: bool = False) -> Column:
    """Elapsed minutes with their fraction.

    For timestamps with time zone, ``zoned`` compares the instants themselves, so a change
    of the clock in between does not count.
    """
    if zoned:
        elapsed = F.unix_micros(end) - F.unix_micros(start)
    else:
        elapsed = F.timestamp_diff("MICROSECOND", start, end)
    return elapsed / F.lit(MICROSECONDS_PER_MINUTE)


def add_minutes(timestamp, minutes) -> Column:
    return F.timestamp_add("MINUTE", minutes, timestamp)


def late_start(started="op_start_time", scheduled="scheduled_start_time", grace_minutes: int = 15) -> Column:
    """1 when the case began more than ``grace_minutes`` after its schedule.

    A case without a schedule counts as not late.
    """
    limit = add_minutes(F.col(scheduled), F.lit(grace_minutes))
    return F.coalesce(F.col(started) > limit, F.lit(False)).cast("int")


def hour_of_day(timestamp) -> Column:
    return F.hour(timestamp)


def day_of_week(timestamp) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(timestamp)


def is_weekday(day) -> Column:
    return F.weekday(day) < 5


def local_time(timestamp, timezone) -> Column:
    """Shift a UTC timestamp to the facility's own clock."""
    return F.from_utc_timestamp(timestamp, timezone)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def variation_pct(std: Column, mean: Column) -> Column:
    """Coefficient of variation in percent; 0 when the mean is not positive."""
    return F.when(mean > 0, std / mean * 100).otherwise(F.lit(0.0))


def graded(value: Column, *, high: float, medium: float | None = None) -> Column:
    """Severity of ``value``; both limits are exclusive.

    Without a ``medium`` limit everything at or below ``high`` is medium.
    """
    grade = F.when(value > high, "high")
    if medium is None:
        return grade.otherwise("medium")
    return grade.when(value > medium, "medium").otherwise("info")


def severity_rank(severity: Column) -> Column:
    """0 for high, 1 for medium, 2 for everything else."""
    return F.when(severity == "high", 0).when(severity == "medium", 1).otherwise(2)


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def feature_title(name: Column) -> Column:
    """Readable form of a feature name, such as ``Op To Postop``."""
    plain = F.replace(F.replace(name, F.lit("_enc"), F.lit("")), F.lit("dur_"), F.lit(""))
    return F.initcap(F.replace(plain, F.lit("_"), F.lit(" ")))


def display_time(timestamp) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss")


def chart_label(procedure, facility) -> Column:
    return F.format_string("%s (%s)", procedure, facility)


def in_test_fold(event_id="event_id", folds: int = 5) -> Column:
    """True for about one case in ``folds``; depends on the id alone, so it is repeatable."""
    digits = F.substring(F.md5(F.col(event_id).cast("string")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % folds == 0
