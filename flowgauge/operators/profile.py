"""Measured distributions, to be compared with what the dimensions promise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import hour_of_day, is_weekday, ratio
from flowgauge.functions.stats import exact_percentiles, with_share
from flowgauge.operators.derive import completed_only, elapsed_minutes
from flowgauge.operators.enrich import with_catalog
from flowgauge.fixed_values import DEFAULT_BIAS
from flowgauge.schema import CASE_STATUSES, COMPLETED, PHASE_COLUMNS
from flowgauge.session import settle


def lognormal_fit(
    df: DataFrame,
    keys: Sequence[str] = ("procedure_type",),
    phases: Sequence[str] = PHASE_COLUMNS,
    statuses: Sequence[str] = (COMPLETED,),
) -> DataFrame:
    """Mean and deviation of the log of each positive phase duration, per group and phase."""
    cases = completed_only(df, statuses).na.drop(subset=list(keys))
    logs = {name: F.ln(F.when(F.col(name) > 0, F.col(name))) for name in phases}
    fitted = cases.groupBy(*keys).agg(
        *[
            F.struct(
                F.lit(name.removeprefix("dur_")).alias("phase"),
                F.count(log).alias("cases"),
                F.avg(log).alias("mu"),
                F.stddev_samp(log).alias("sigma"),
            ).alias(name)
            for name, log in logs.items()
        ]
    )
    return fitted.select(*keys, F.inline(F.array(*phases)))


def catalog_phases(catalog: DataFrame) -> DataFrame:
    """The catalog's parameters, one row per procedure and phase."""
    names = [name.removeprefix("dur_") for name in PHASE_COLUMNS]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("phase"),
                F.col(f"{name}_mu").alias("expected_mu"),
                F.col(f"{name}_sigma").alias("expected_sigma"),
            )
            for name in names
        ]
    )
    return catalog.select("procedure_type", F.inline(rows))


def lognormal_drift(fit: DataFrame, expected: DataFrame) -> DataFrame:
    """Difference of fitted and expected parameters; ``expected`` as from ``catalog_phases``."""
    return (
        fit.join(expected, ["procedure_type", "phase"], "left")
        .withColumn("mu_drift", F.col("mu") - F.col("expected_mu"))
        .withColumn("sigma_drift", F.col("sigma") - F.col("expected_sigma"))
    )


def beside_expected(observed: DataFrame, expected: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Add ``expected_share``, the normalised ``weight`` of each entry, and keep entries never seen.

    Both sides are summaries; ``expected`` has the keys and a ``weight``.
    """
    if expected is None:
        return observed
    shares = with_share(expected.select(*keys, "weight"), "weight", "expected_share", keys[:-1]).drop("weight")
    return observed.join(shares, list(keys), "full").na.fill(0)


def hourly_profile(
    df: DataFrame, timestamp: str = "checkin_time", expected: DataFrame | None = None
) -> DataFrame:
    """Number and share of check-ins per hour of day; ``expected`` has ``hour, weight``."""
    hours = df.filter(F.col(timestamp).isNotNull()).groupBy(hour_of_day(timestamp).alias("hour"))
    shares = with_share(hours.agg(F.count(F.lit(1)).alias("n")))
    return beside_expected(shares, expected, ["hour"])


def calendar(
    daily: DataFrame, facility: str = "facility_id", day: str = "day", known: DataFrame | None = None
) -> DataFrame:
    """Every weekday between the first and last day seen, once per facility.

    ``daily`` is already one row per facility and day; the days are generated per
    facility, without a cross join. Facilities of ``known`` that were not seen are there too.
    """
    first = daily.agg(F.min(day)).scalar()
    last = daily.agg(F.max(day)).scalar()
    days = F.explode(F.sequence(first, last))
    places = daily.select(facility)
    if known is not None:
        places = places.union(known.select(facility).filter(F.col(facility).isNotNull()))
    return places.distinct().select(facility, days.alias(day)).filter(is_weekday(day))


def daily_volume(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Cases per facility and weekday against the facility's expected band.

    Days without cases appear with 0, also at facilities without any. ``bands`` has ``facility_id, volume_min, volume_max``.
    """
    counted = (
        df.filter(F.col("facility_id").isNotNull() & F.col("checkin_time").isNotNull())
        .groupBy("facility_id", F.to_date("checkin_time").alias("day"))
        .agg(F.count(F.lit(1)).alias("observed"))
    )
    # read again for the bounds of the calendar
    daily = settle(counted, "daily-volume")
    cases = F.coalesce(F.col("observed"), F.lit(0))
    verdict = (
        F.when(cases < F.col("volume_min"), "below")
        .when(cases > F.col("volume_max"), "above")
        .when(F.col("volume_min").isNotNull(), "within")
    )
    return (
        calendar(daily, known=bands)
        .join(daily, ["facility_id", "day"], "left")
        .join(bands.select("facility_id", "volume_min", "volume_max"), "facility_id", "left")
        .select("facility_id", "day", cases.alias("cases"), "volume_min", "volume_max", verdict.alias("band"))
    )


def status_mix(df: DataFrame) -> DataFrame:
    """Per facility, the cases and the share of each status; any other status, or none, is ``other``."""
    status = F.col("case_status")
    known = F.coalesce(status.isin(*CASE_STATUSES), F.lit(False))
    counts = df.groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("cases"),
        *[F.count_if(status == name).alias(name) for name in CASE_STATUSES],
        F.count_if(~known).alias("other"),
    )
    names = (*CASE_STATUSES, "other")
    shares = [ratio(F.col(name), F.col("cases")).alias(f"{name}_share") for name in names]
    return counts.select("facility_id", "cases", *names, *shares)


def expected_case_mix(facilities: DataFrame, catalog: DataFrame, bias: DataFrame) -> DataFrame:
    """Expected share of each service line: its procedures, weighted by the facility's bias.

    The service lines travel as one short array, since the catalog is a dimension.
    """
    sizes = catalog.groupBy("service_line").agg(F.count(F.lit(1)).alias("procedures"))
    lines = sizes.agg(F.array_agg(F.struct("service_line", "procedures"))).scalar()
    weight = F.coalesce(F.col("weight"), F.lit(DEFAULT_BIAS)) * F.col("procedures")
    weighted = (
        facilities.select("facility_id")
        .distinct()
        .select("facility_id", F.inline(lines))
        .join(bias.select("facility_id", "service_line", "weight"), ["facility_id", "service_line"], "left")
        .select("facility_id", "service_line", weight.alias("pull"))
    )
    return with_share(weighted, "pull", "expected_share", ["facility_id"]).drop("pull")


def case_mix(df: DataFrame, catalog: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed against expected share of each service line per facility.

    Lines that were expected but never seen appear with 0 cases.
    """
    per_procedure = df.groupBy("facility_id", "procedure_type").agg(F.count(F.lit(1)).alias("cases"))
    observed = (
        with_catalog(per_procedure, catalog)
        .groupBy("facility_id", "service_line")
        .agg(F.sum("cases").alias("cases"))
    )
    both = observed.join(expected, ["facility_id", "service_line"], "full").na.fill(0, ["cases"])
    return with_share(both, "cases", "share", ["facility_id"])


def anesthesia_mix(df: DataFrame, catalog: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Share of each anesthesia type within its service line.

    ``expected``, if given, has ``service_line, anesthesia_type, weight``.
    """
    per_procedure = df.groupBy("procedure_type", "anesthesia_type").agg(F.count(F.lit(1)).alias("cases"))
    observed = (
        with_catalog(per_procedure, catalog)
        .groupBy("service_line", "anesthesia_type")
        .agg(F.sum("cases").alias("cases"))
    )
    shares = with_share(observed, "cases", "share", ["service_line"])
    return beside_expected(shares, expected, ["service_line", "anesthesia_type"])


def asa_mix(df: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Number and share of cases per ASA class; ``expected`` has ``asa_class, weight``."""
    known = df.filter(F.col("asa_class").isNotNull())
    shares = with_share(known.groupBy("asa_class").agg(F.count(F.lit(1)).alias("n")))
    return beside_expected(shares, expected, ["asa_class"])


def schedule_deviation(
    df: DataFrame, keys: Sequence[str] = ("facility_id",), statuses: Sequence[str] = (COMPLETED,)
) -> DataFrame:
    """Minutes between scheduled and actual start: mean, deviation, median, p90."""
    late = elapsed_minutes(df, "scheduled_start_time", "op_start_time")
    cases = completed_only(df, statuses).na.drop(subset=list(keys)).withColumn("deviation", late)
    sizes = cases.groupBy(*keys).agg(
        F.count("deviation").alias("cases"),
        F.avg("deviation").alias("deviation_mean"),
        F.stddev_samp("deviation").alias("deviation_std"),
    )
    ranks = exact_percentiles(cases, keys, ["deviation"], {"median": 0.5, "p90": 0.9})
    return sizes.join(ranks, list(keys), "left")
