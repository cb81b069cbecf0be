"""The registered queries: each runs operators over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions import columns as C
from flowgauge.functions import stats
from flowgauge.functions.stats import area_under_roc, regression_metrics
from flowgauge.operators import (
    aggregate,
    derive,
    enrich,
    ingest,
    insights,
    levels,
    models,
    profile,
    quality,
    ranking,
    report,
)
from flowgauge.plans.analysis import analyse
from flowgauge.plans.increment import load_increment
from flowgauge.schema import CASE_COLUMNS, CASE_SCHEMA, DURATIONS, KEYS, MILESTONES, PHASE_COLUMNS, TRANSFER_COLUMNS
from flowgauge.session import new_folder, settle
from flowgauge.sources import case_view as view
from flowgauge.sources import keyed, readers, writers
from flowgauge.streaming.ingest import file_stream, ingest_available, without_redeliveries

Query = Callable[[SparkSession, str], DataFrame]

# The point in time that splits the cases into a first and a later load.
FIRST_LOAD = datetime(1998, 1, 1)
FIRST_RUN, SECOND_RUN = datetime(1998, 1, 2), datetime(2002, 1, 1)

ESTIMATE_BIN = 5.0  # minutes
FILES_PER_DELIVERY = 4  # at least, and in each batch of the stream
ROWS_PER_FILE = 500_000  # of a delivery: one task writes a file

# What the group statistics read of a case besides its durations, and what a site's do.
GROUP_COLUMNS = ("event_id", *KEYS, "case_status", "scheduled_start_time", "op_start_time")
SITE_COLUMNS = ("facility_id", "case_status", "dur_total")
RECOVERY_COLUMNS = ("event_id", "case_status", "dur_postop_to_discharge")

# The settings that the registered search compares, each fitted in full.
COMPARED_SETTINGS = (
    {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3},
    {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.1},
    {"n_estimators": 20, "max_depth": 5, "learning_rate": 0.1},
)


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles to ``places`` digits, since two engines add them in different orders."""
    doubles = [field.name for field in df.schema if isinstance(field.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, places) for name in doubles})


def without_zone(df: DataFrame) -> DataFrame:
    stamps = [field.name for field in df.schema if isinstance(field.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def _groups(spark: SparkSession, sf_dir: str, statistics: Sequence[str], columns=DURATIONS) -> DataFrame:
    """Group statistics; percentiles read the cases several times, so these are settled."""
    if set(statistics) & set(aggregate.PERCENTILES):
        cases = view.settled_cases(spark, sf_dir, (*GROUP_COLUMNS, *columns))
    else:
        cases = view.timed_cases(spark, sf_dir)
    return aggregate.aggregates(cases, columns=columns, statistics=statistics)


# --- derived columns ---------------------------------------------------------


def case_events(spark, sf_dir):
    return derive.transfer_form(view.case_events(spark, sf_dir, created_at=True))


def durations(spark, sf_dir):
    return rounded(view.timed_cases(spark, sf_dir).select("event_id", *DURATIONS))


def late_start_flag(spark, sf_dir):
    return derive.with_late_start(view.case_events(spark, sf_dir)).select("event_id", "late_start")


def checkin_hour_dow(spark, sf_dir):
    cases = derive.with_checkin_features(view.case_events(spark, sf_dir))
    return cases.select("event_id", "checkin_hour", "checkin_dow")


def label_encode(spark, sf_dir):
    encoded = models.label_encode(derive.completed_only(view.case_events(spark, sf_dir)))
    return encoded.select("event_id", *[F.col(f"{name}_enc").cast("int") for name in models.CATEGORICALS])


def feature_matrix(spark, sf_dir):
    prepared, features = models.prepare_features(view.timed_cases(spark, sf_dir))
    return rounded(prepared.select("event_id", *features))


def clip_durations(spark, sf_dir):
    clipped = derive.clip_durations(view.timed_cases(spark, sf_dir), low=20.0, high=120.0)
    return rounded(clipped.select("event_id", *DURATIONS))


def phase_values(spark, sf_dir):
    cases = view.timed_cases(spark, sf_dir)
    return rounded(cases.unpivot(["event_id"], list(PHASE_COLUMNS), "phase", "minutes"))


def weekday_cases(spark, sf_dir):
    return quality.on_weekdays(view.case_events(spark, sf_dir)).select("event_id", "checkin_time")


def case_labels(spark, sf_dir):
    return view.case_events(spark, sf_dir).select(
        "event_id",
        C.chart_label("procedure_type", "facility_id").alias("label"),
        C.display_time("checkin_time").alias("checkin"),
    )


# --- aggregates --------------------------------------------------------------


def aggregates(spark, sf_dir):
    return rounded(_groups(spark, sf_dir, ("mean", "median", "p90", "std")))


def aggregates_of_levels(spark, sf_dir):
    """The same, and the facilities', from one count of bins; a facility has no procedure and only what its overview tells."""
    found = levels.summaries(view.settled_cases(spark, sf_dir, (*GROUP_COLUMNS, *DURATIONS)))
    sites = found.overview.select(
        "facility_id",
        F.col("avg_total_minutes").alias("dur_total_mean"),
        F.col("p90_total_minutes").alias("dur_total_p90"),
        F.col("total_cases").alias("case_volume"),
    )
    return rounded(found.groups.unionByName(sites, allowMissingColumns=True))


def percentile_estimates(spark, sf_dir):
    """Percentiles from the counts of five-minute bins beside the exact ones, and how far apart they may be and are."""
    cases = derive.completed_only(view.settled_cases(spark, sf_dir, (*SITE_COLUMNS, *PHASE_COLUMNS)))
    keys = ("facility_id",)
    bins = settle(stats.bin_counts(cases, keys, DURATIONS, ESTIMATE_BIN), "bins")
    estimates = stats.estimated_percentiles(stats.rolled_up(bins, keys), keys, aggregate.PERCENTILES, ESTIMATE_BIN)
    level = stats.Level(keys, {name: aggregate.PERCENTILES for name in DURATIONS})
    exact = stats.percentiles_at(cases, bins, keys, [level], ESTIMATE_BIN)[0]
    both = estimates.join(exact, [*keys, "metric", "name"])
    error = F.abs(F.col("estimate") - F.col("percentile"))
    return rounded(both.select(*keys, "metric", "name", "estimate", F.col("percentile").alias("exact"), "bound", error.alias("error")))


def aggregates_csv(spark, sf_dir):
    """The aggregates written as CSV and read back."""
    path = new_folder(spark, "aggregates-csv")
    writers.write_aggregates(_groups(spark, sf_dir, ("mean", "median", "p90", "std")), path)
    return rounded(readers.read_aggregates(spark, path))


def timestamps_from_text(spark, sf_dir):
    """Milestones sent as text, with and without a fraction, parsed again."""
    cases = view.case_events(spark, sf_dir)
    texts = {
        name: F.when(F.col("asa_class") % 2 == 0, F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
            F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
        for name in MILESTONES
    }
    return without_zone(derive.as_timestamps(cases.select("event_id", "asa_class", *MILESTONES).withColumns(texts)).drop("asa_class"))


def late_start_rate(spark, sf_dir):
    return rounded(aggregate.late_start_rates(view.case_events(spark, sf_dir)), 6)


def aggregates_late_join(spark, sf_dir):
    cases = view.timed_cases(spark, sf_dir)
    groups = aggregate.aggregates(cases, columns=("dur_total",), statistics=("mean",)).drop("late_start_rate")
    return rounded(aggregate.join_late_rates(groups, aggregate.late_start_rates(cases)))


def phase_mean_of_means(spark, sf_dir):
    return rounded(aggregate.phase_means(_groups(spark, sf_dir, ("mean",))))


def phase_breakdown_long(spark, sf_dir):
    return rounded(aggregate.phase_breakdown(_groups(spark, sf_dir, ("mean",))))


def phase_matrix(spark, sf_dir):
    return report.phase_matrix(settle(_groups(spark, sf_dir, ("mean",)), "groups"))


def bottleneck_phase(spark, sf_dir):
    longest = aggregate.longest_phase(_groups(spark, sf_dir, ("mean",))).filter(F.col("phase_pct") > 35)
    return rounded(longest.withColumn("severity", C.graded(F.col("phase_pct"), high=45)))


def facility_summary(spark, sf_dir):
    return rounded(aggregate.facility_overview(view.settled_cases(spark, sf_dir, SITE_COLUMNS)))


def cancellation_rate(spark, sf_dir):
    rate = aggregate.cancellation_rate(view.case_events(spark, sf_dir))
    return rounded(rate.withColumn("severity", C.graded(F.col("rate"), high=0.05, medium=0.02)), 6)


def facilities_seen(spark, sf_dir):
    return aggregate.distinct_values(derive.completed_only(view.case_events(spark, sf_dir)), "facility_id")


# --- rankings ----------------------------------------------------------------


def high_variance_top5(spark, sf_dir):
    top = ranking.most_variable(_groups(spark, sf_dir, ("mean", "std"), ("dur_total",)))
    return rounded(top.withColumn("severity", C.graded(F.col("coefficient_of_variation"), high=50)))


def late_starts_top5(spark, sf_dir):
    top = ranking.most_late(_groups(spark, sf_dir, ("mean",), ("dur_total",)))
    return rounded(top.withColumn("severity", C.graded(F.col("late_start_rate"), high=0.5)))


def cross_facility_gap(spark, sf_dir):
    return rounded(ranking.wide_gaps(_groups(spark, sf_dir, ("mean",), ("dur_total",))))


def top10_volume(spark, sf_dir):
    return report.top_procedures_chart(_groups(spark, sf_dir, ("mean", "p90"), ("dur_total",)))


def top20_volume(spark, sf_dir):
    groups = _groups(spark, sf_dir, ("mean", "median", "p90", "std"), ("dur_total",))
    return report.top_procedures_table(groups)


# --- insights and report -----------------------------------------------------


def _findings(spark, sf_dir) -> DataFrame:
    cases = view.settled_cases(spark, sf_dir, (*GROUP_COLUMNS, *DURATIONS))
    wanted = {"dur_total": {"p90": aggregate.PERCENTILES["p90"]}}
    found = levels.summaries(cases, statistics=("mean", "p90", "std"), group_percentiles=wanted)
    return insights.findings_of(found._replace(groups=settle(found.groups, "groups")))


def insights_all(spark, sf_dir):
    return insights.positioned(_findings(spark, sf_dir))


def insight_counts(spark, sf_dir):
    return report.insight_counts(_findings(spark, sf_dir))


def insight_totals(spark, sf_dir):
    return report.finding_totals(_findings(spark, sf_dir))


def _kpi(spark, sf_dir) -> DataFrame:
    cases = view.settled_cases(spark, sf_dir, SITE_COLUMNS)
    return report.kpi_row(aggregate.facility_overview(cases), aggregate.cancellation_rate(cases))


def kpi_row(spark, sf_dir):
    return rounded(_kpi(spark, sf_dir))


def status_distribution(spark, sf_dir):
    return report.status_distribution(_kpi(spark, sf_dir))


def facility_chart(spark, sf_dir):
    cases = view.settled_cases(spark, sf_dir, SITE_COLUMNS)
    return report.facility_chart(aggregate.facility_overview(cases))


# --- data quality ------------------------------------------------------------


def dq_violations(spark, sf_dir):
    return quality.violation_counts(view.flawed_cases(spark, sf_dir))


def dq_quarantine(spark, sf_dir):
    _, bad = quality.split_by_quality(view.flawed_cases(spark, sf_dir))
    return bad.select("event_id", F.array_join("violations", ",").alias("violations"))


def dq_valid(spark, sf_dir):
    good, _ = quality.split_by_quality(view.flawed_cases(spark, sf_dir))
    return good.select("event_id", "facility_id", "case_status")


def dq_written(spark, sf_dir):
    """Both halves written in one job: how many rows each has, and by how many rules the quarantined are held back."""
    cases, path = view.flawed_cases(spark, sf_dir), new_folder(spark, "checked")
    quality.write_by_quality(cases, path)
    good, bad = (quality.read_by_quality(spark, path, half, cases.schema) for half in (quality.VALID, quality.QUARANTINED))
    counted = good.select(F.lit(quality.VALID).alias("verdict"), F.lit(0).alias("broken")).unionAll(
        bad.select(F.lit(quality.QUARANTINED), F.size("violations"))
    )
    return counted.groupBy("verdict").agg(F.count(F.lit(1)).alias("cases"), F.sum("broken").alias("broken_rules"))


def dq_orphan_procedures(spark, sf_dir):
    """Procedures that a catalog without one of its service lines lacks."""
    catalog = view.catalog(spark, sf_dir).filter("service_line <> 'ECONOMY'")
    return quality.orphan_keys(view.flawed_cases(spark, sf_dir), catalog, "procedure_type")


def weights_adding_up(spark, sf_dir):
    """Anesthesia weights per service line: shares that add up to 1, but for one line where a type was left out."""
    mix = profile.anesthesia_mix(view.case_events(spark, sf_dir), view.catalog(spark, sf_dir))
    given = mix.withColumnRenamed("share", "weight").filter("not (service_line = 'ECONOMY' and anesthesia_type = 'N')")
    return rounded(quality.weights_off(given, ["service_line"]))


def sample_guard(spark, sf_dir):
    """Whether all completed cases, and those that were converted on Saturdays, are enough to learn from."""
    cases = view.case_events(spark, sf_dir)
    few = cases.filter("case_status = 'converted_to_inpatient' and weekday(checkin_time) = 5 and asa_class = 1")
    rows = [("completed", models.has_rows(derive.completed_only(cases))), ("converted", models.has_rows(few))]
    return spark.createDataFrame(rows, "cases string, enough boolean")


def dq_orphans(spark, sf_dir):
    cases = view.flawed_cases(spark, sf_dir)
    return quality.orphan_keys(cases, view.facilities(spark, sf_dir), "facility_id")


def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(view.resent_cases(spark, sf_dir))


def milestone_order(spark, sf_dir):
    checked = quality.with_violations(view.flawed_cases(spark, sf_dir), quality.milestone_order_rule())
    return checked.filter(F.size("violations") > 0).select("event_id", "op_start_time", "postop_start_time")


def duration_additivity(spark, sf_dir):
    checked = quality.with_violations(view.flawed_cases(spark, sf_dir), quality.additivity_rule())
    return rounded(checked.filter(F.size("violations") > 0).select("event_id", *DURATIONS))


# --- dimensions --------------------------------------------------------------


def service_line_rollup(spark, sf_dir):
    cases = view.timed_cases(spark, sf_dir)
    return rounded(enrich.service_line_rollup(cases, view.catalog(spark, sf_dir)))


def star_enrichment(spark, sf_dir):
    cases = enrich.with_catalog(view.case_events(spark, sf_dir), view.catalog(spark, sf_dir))
    placed = enrich.with_facility(cases, view.facilities(spark, sf_dir))
    return placed.select("event_id", "facility_name", "timezone", "service_line")


def service_lines(spark, sf_dir):
    return enrich.service_lines(view.catalog(spark, sf_dir))


def procedures_of_line(spark, sf_dir):
    return enrich.procedures_of(view.catalog(spark, sf_dir), "ECONOMY")


# --- profiles ----------------------------------------------------------------


def _overall_fit(spark, sf_dir) -> DataFrame:
    """The fit over all facilities, in the place of a stored catalog."""
    fit = profile.lognormal_fit(view.timed_cases(spark, sf_dir))
    expected = fit.withColumnsRenamed({"mu": "expected_mu", "sigma": "expected_sigma"}).drop("cases")
    return settle(expected, "expected-fit")


def lognormal_fit(spark, sf_dir):
    return rounded(profile.lognormal_fit(view.timed_cases(spark, sf_dir)))


def lognormal_drift(spark, sf_dir):
    fit = profile.lognormal_fit(view.timed_cases(spark, sf_dir), KEYS)
    return rounded(profile.lognormal_drift(fit, _overall_fit(spark, sf_dir)))


def hourly_profile(spark, sf_dir):
    return rounded(profile.hourly_profile(view.case_events(spark, sf_dir)), 6)


def hourly_expected(spark, sf_dir):
    """Check-ins per hour beside the share of the schedule in that hour."""
    cases = view.case_events(spark, sf_dir)
    planned = profile.hourly_profile(cases, "scheduled_start_time").select("hour", F.col("n").alias("weight"))
    return rounded(profile.hourly_profile(cases, expected=planned), 6)


def anesthesia_expected(spark, sf_dir):
    """All cases' mix beside that of the completed ones."""
    cases, catalog = view.case_events(spark, sf_dir), view.catalog(spark, sf_dir)
    weights = profile.anesthesia_mix(derive.completed_only(cases), catalog).withColumnRenamed("cases", "weight").drop("share")
    return rounded(profile.anesthesia_mix(cases, catalog, weights), 6)


def asa_expected(spark, sf_dir):
    """All cases' classes beside those of the completed ones."""
    cases = view.case_events(spark, sf_dir)
    weights = profile.asa_mix(derive.completed_only(cases)).select("asa_class", F.col("n").alias("weight"))
    return rounded(profile.asa_mix(cases, weights), 6)


def calendar_spine_volume(spark, sf_dir):
    return profile.daily_volume(view.case_events(spark, sf_dir), view.facilities(spark, sf_dir))


def status_mix(spark, sf_dir):
    return rounded(profile.status_mix(view.flawed_cases(spark, sf_dir)), 6)


def _bias(spark, sf_dir) -> DataFrame:
    """A weight of 2 where the region's number equals the line's rank by name length, else none."""
    lines = view.catalog(spark, sf_dir).select("service_line").distinct()
    marked = lines.withColumn("volume_min", F.length("service_line") - 4)
    places = view.facilities(spark, sf_dir).select("facility_id", "volume_min")
    return places.join(marked, "volume_min").select("facility_id", "service_line", F.lit(2.0).alias("weight"))


def case_mix(spark, sf_dir):
    catalog = view.catalog(spark, sf_dir)
    expected = profile.expected_case_mix(view.facilities(spark, sf_dir), catalog, _bias(spark, sf_dir))
    return rounded(profile.case_mix(view.case_events(spark, sf_dir), catalog, expected), 6)


def anesthesia_mix(spark, sf_dir):
    mix = profile.anesthesia_mix(view.case_events(spark, sf_dir), view.catalog(spark, sf_dir))
    return rounded(mix, 6)


def asa_mix(spark, sf_dir):
    return rounded(profile.asa_mix(view.case_events(spark, sf_dir)), 6)


def schedule_deviation(spark, sf_dir):
    columns = ("facility_id", "case_status", "scheduled_start_time", "op_start_time")
    cases = view.settled_cases(spark, sf_dir, columns)
    return rounded(profile.schedule_deviation(cases))


# --- incremental load --------------------------------------------------------


def first_write_wins(spark, sf_dir):
    return derive.transfer_form(ingest.first_write_wins(view.resent_cases(spark, sf_dir)))


def _run_log(spark, sf_dir, later: bool) -> DataFrame:
    """What the first load, or the load after it, would have logged per source."""
    cases = view.case_events(spark, sf_dir, created_at=True)
    split = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    loaded = cases.filter(F.col("created_at") >= split if later else F.col("created_at") < split)
    run_at = F.lit(SECOND_RUN if later else FIRST_RUN).cast("timestamp_ntz")
    return loaded.groupBy(F.col("source_generator_id").alias("source_id")).agg(
        F.max("created_at").alias("last_created_at"),
        F.max(run_at).alias("last_run_at"),
        F.count(F.lit(1)).alias("rows_transferred"),
    )


def watermark_after(spark, sf_dir):
    return ingest.merge_watermarks(_run_log(spark, sf_dir, False), _run_log(spark, sf_dir, True))


def incremental_batch(spark, sf_dir):
    watermark = ingest.position_of(_run_log(spark, sf_dir, False), "F")
    new = ingest.rows_after(view.case_events(spark, sf_dir, created_at=True), watermark)
    return new.select("event_id", "created_at", "source_generator_id")


def insert_ignore_counts(spark, sf_dir):
    feed = settle(view.resent_cases(spark, sf_dir), "feed")
    split = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    stored = settle(ingest.first_write_wins(feed.filter(F.col("created_at") < split)), "stored")
    pulled = feed.filter(F.col("created_at") >= split)
    batch = settle(ingest.first_write_wins(pulled), "batch")
    fresh = ingest.not_stored(batch, stored)
    one = F.count(F.lit(1))
    return stored.agg(one.alias("stored")).select(
        "stored",
        pulled.agg(one).scalar().alias("pulled"),
        batch.agg(one).scalar().alias("distinct_cases"),
        fresh.agg(one).scalar().alias("inserted"),
    )


def increment_cycle(spark, sf_dir):
    """A first load up to a point in time, then everything, then everything again."""
    feed = settle(view.resent_cases(spark, sf_dir), "feed")
    target, state = new_folder(spark, "target"), new_folder(spark, "state")
    early = feed.filter(F.col("created_at") < F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    for source in (early, feed, feed):
        load_increment(source, target, state)
    return keyed.read_table(spark, target).select(*TRANSFER_COLUMNS)


def increment_careless_feed(spark, sf_dir):
    """The same loads of a feed that lacks some ids and times: what is stored, and what is set aside."""
    feed = settle(view.careless_feed(spark, sf_dir), "careless-feed")
    target, state = new_folder(spark, "target"), new_folder(spark, "state")
    early = feed.filter(F.col("created_at") < F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    for source in (early, feed, feed):
        load_increment(source, target, state)
    places = (target, writers.rejected_path(target))
    stored, aside = (keyed.read_table(spark, place).select(*TRANSFER_COLUMNS) for place in places)
    return stored.unionByName(aside)


def _files_per_delivery(feed: DataFrame) -> int:
    return max(FILES_PER_DELIVERY, -(-feed.count() // ROWS_PER_FILE))


def _deliver(feed: DataFrame, folder: str, turn: int, files: int, turns: int = 3) -> None:
    """Files of one part of the cases, and once more of the part before it; all copies of a case are in one part and file."""
    part = F.pmod(F.xxhash64("event_id"), F.lit(turns))
    due = feed.filter(part.isin(turn, turn - 1))
    due.repartition(files, "event_id").write.mode("append").parquet(folder)


def stream_ingest(spark, sf_dir):
    """Deliveries of many files, each repeating the one before, read in batches and by two runs of the stream."""
    feed = settle(derive.transfer_form(view.resent_cases(spark, sf_dir)), "feed")
    folder, target, checkpoint = (new_folder(spark, f"stream-{name}") for name in ("arrivals", "target", "checkpoint"))
    files = _files_per_delivery(feed)
    for turn in range(3):
        _deliver(feed, folder, turn, files)
        if turn:  # the first run finds two deliveries
            arrivals = file_stream(spark, folder, feed.schema, files_per_batch=files)
            ingest_available(without_redeliveries(arrivals), target, checkpoint)
    return keyed.read_table(spark, target).select(*TRANSFER_COLUMNS)


# --- files -------------------------------------------------------------------


def csv_round_trip(spark, sf_dir):
    path = new_folder(spark, "cases-csv")
    writers.write_cases_csv(view.case_events(spark, sf_dir), path)
    return without_zone(readers.read_cases_csv(spark, path, CASE_SCHEMA))


def json_round_trip(spark, sf_dir):
    path = new_folder(spark, "cases-json")
    writers.write_cases_json(view.case_events(spark, sf_dir), path)
    return without_zone(readers.read_cases_json(spark, path, CASE_SCHEMA))


def raw_csv_load(spark, sf_dir):
    """CSV files of two layouts without creation times in one folder, loaded into an emptied table, one row per case."""
    raw, table = new_folder(spark, "raw-csv"), new_folder(spark, "loaded")
    cases = view.as_resent(view.case_events(spark, sf_dir, created_at=True)).drop("created_at")
    first = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    writers.write_cases_csv(cases.filter(first), f"{raw}/first")
    turned = cases.filter(~first).select(*reversed(CASE_COLUMNS), F.lit("left out").alias("remark"))
    turned.write.option("header", True).option("escape", '"').csv(f"{raw}/second")
    writers.replace_table(readers.read_raw_csv(spark, raw), table)
    return without_zone(keyed.read_table(spark, table).select(*TRANSFER_COLUMNS))


def dimension_seed(spark, sf_dir):
    """Facilities seeded from the regions, then again from the nations' regions and names."""
    path = new_folder(spark, "facility")
    places = view.facilities(spark, sf_dir).select("facility_id", "facility_name", "timezone")
    names = view.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("facility_id"), F.lit("Office").alias("facility_name"), F.lit("UTC").alias("timezone")
    )
    writers.seed_dimension(places, path, "facility_id")
    renamed = places.withColumn("facility_name", F.lit("Renamed"))
    writers.seed_dimension(renamed.unionByName(names), path, "facility_id")
    return keyed.read_table(spark, path)


def stored_analysis(spark, sf_dir):
    """The analysis without models, written as a results document and read back."""
    path = new_folder(spark, "results")
    frames = analyse(view.case_events(spark, sf_dir), with_models=False)
    writers.write_results(frames["results"], path)
    return readers.stored_insights(readers.read_results(spark, path))


# --- models ------------------------------------------------------------------


def extended_recovery_label(spark, sf_dir):
    labelled = aggregate.with_extended_recovery(view.settled_cases(spark, sf_dir, RECOVERY_COLUMNS))
    return labelled.select("event_id", "extended_recovery")


def train_test_split(spark, sf_dir):
    cases = derive.completed_only(view.case_events(spark, sf_dir))
    return cases.select("event_id", C.in_test_fold().alias("in_test"))


def class_balance(spark, sf_dir):
    labelled = aggregate.with_extended_recovery(view.settled_cases(spark, sf_dir, RECOVERY_COLUMNS))
    return rounded(aggregate.class_balance(labelled.filter(~C.in_test_fold())))


def eval_regression(spark, sf_dir):
    cases = derive.completed_only(view.timed_cases(spark, sf_dir))
    known = F.col("dur_checkin_to_preop") + F.col("dur_preop_to_op") + F.col("dur_op_to_postop")
    return rounded(regression_metrics(cases.withColumn("prediction", known + 60), "dur_total", "prediction"))


def eval_auc(spark, sf_dir):
    columns = (*RECOVERY_COLUMNS, "op_start_time", "dur_checkin_to_preop", "dur_op_to_postop")
    labelled = aggregate.with_extended_recovery(view.settled_cases(spark, sf_dir, columns))
    known = F.col("dur_checkin_to_preop") * 3 + F.col("dur_op_to_postop") + F.hour("op_start_time")
    return rounded(area_under_roc(labelled.withColumn("risk", known), "extended_recovery", "risk"), 6)


MODEL_COLUMNS = ("event_id", *KEYS, "case_status", "checkin_time", "anesthesia_type", "asa_class", *DURATIONS)


def _prepared(spark, sf_dir):
    return models.prepare_features(view.settled_cases(spark, sf_dir, MODEL_COLUMNS))


def _error_of_the_mean(prepared: DataFrame, features: Sequence[str]) -> Column:
    """Mean absolute error, on the test fold, of the training fold's mean as the only prediction."""
    rows = prepared.na.drop(subset=[*features, "dur_total"]).select("dur_total", C.in_test_fold().alias("in_test"))
    mean = rows.filter("not in_test").agg(F.avg("dur_total")).scalar()
    missed = rows.filter("in_test").select(F.abs(F.col("dur_total") - mean).alias("minutes"))
    return missed.agg(F.avg("minutes")).scalar()


def discharge_predictor(spark, sf_dir):
    """All trees are fitted; of the quality, what another library's trees must show too."""
    prepared, features = _prepared(spark, sf_dir)
    fitted = models.train_discharge_predictor(prepared, features)
    weights = F.aggregate(F.map_values("feature_importance"), F.lit(0.0), lambda total, weight: total + weight)
    return fitted.select(
        "model_type",
        "target",
        F.array_join(F.array_sort(F.map_keys("feature_importance")), ", ").alias("features"),
        F.col("n_train").cast("long").alias("n_train"),
        F.col("n_test").cast("long").alias("n_test"),
        (F.abs(weights - 1) < 1e-6).alias("importance_adds_up"),
        (F.col("mae_minutes") < _error_of_the_mean(prepared, features)).alias("better_than_mean"),
    )


def recovery_classifier(spark, sf_dir):
    return models.train_recovery_classifier(*_prepared(spark, sf_dir)).select(
        "model_type",
        "target",
        "p90_threshold_minutes",
        F.array_join(F.array_sort("features_used"), ", ").alias("features"),
        F.col("n_train").cast("long").alias("n_train"),
        F.col("n_test").cast("long").alias("n_test"),
        (F.col("auc_score") > 0.5).alias("better_than_chance"),
    )


def model_search(spark, sf_dir):
    prepared, features = _prepared(spark, sf_dir)
    found = models.model_search(prepared, features, COMPARED_SETTINGS)
    better = (F.col("mae_minutes") < _error_of_the_mean(prepared, features)).alias("better_than_mean")
    return found.select("setting", "max_depth", "trees", "learning_rate", better)


def model_search_errors(spark, sf_dir):
    """What the search found: each setting's error in minutes, and its place by it."""
    prepared, features = _prepared(spark, sf_dir)
    found = models.model_search(prepared, features, COMPARED_SETTINGS)
    return stats.numbered(found, [F.col("mae_minutes"), F.col("setting")], "place", 1)


def model_importances(spark, sf_dir):
    """The features of the trained predictor by their weight in it."""
    prepared, features = _prepared(spark, sf_dir)
    fitted = models.train_discharge_predictor(prepared, features, trees=10)
    return report.importance_ranking(fitted.select("feature_importance"))


def model_cards(spark, sf_dir):
    """The quality figures of both trained models, from a results document that was stored and read back."""
    cases = view.settled_cases(spark, sf_dir, (*MODEL_COLUMNS, "scheduled_start_time", "op_start_time"))
    path = new_folder(spark, "results")
    writers.write_results(analyse(cases, trees=10)["results"], path)
    return report.model_cards(readers.read_results(spark, path))


def importance_ranking(spark, sf_dir):
    """The ranking of a map of weights: here the share of each phase in all minutes."""
    cases = derive.completed_only(view.timed_cases(spark, sf_dir))
    shares = [part for name in PHASE_COLUMNS for part in (F.lit(name), F.sum(name) / F.sum("dur_total"))]
    return report.importance_ranking(cases.agg(F.create_map(*shares).alias("feature_importance")))


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        case_events,
        durations,
        late_start_flag,
        checkin_hour_dow,
        label_encode,
        feature_matrix,
        clip_durations,
        phase_values,
        weekday_cases,
        case_labels,
        aggregates,
        aggregates_of_levels,
        percentile_estimates,
        aggregates_csv,
        timestamps_from_text,
        late_start_rate,
        aggregates_late_join,
        phase_mean_of_means,
        phase_breakdown_long,
        phase_matrix,
        bottleneck_phase,
        facility_summary,
        cancellation_rate,
        facilities_seen,
        high_variance_top5,
        late_starts_top5,
        cross_facility_gap,
        top10_volume,
        top20_volume,
        insights_all,
        insight_counts,
        insight_totals,
        kpi_row,
        status_distribution,
        facility_chart,
        dq_violations,
        dq_quarantine,
        dq_valid,
        dq_written,
        dq_orphans,
        dq_orphan_procedures,
        weights_adding_up,
        sample_guard,
        dq_duplicates,
        milestone_order,
        duration_additivity,
        service_line_rollup,
        star_enrichment,
        service_lines,
        procedures_of_line,
        lognormal_fit,
        lognormal_drift,
        hourly_profile,
        hourly_expected,
        anesthesia_expected,
        asa_expected,
        calendar_spine_volume,
        status_mix,
        case_mix,
        anesthesia_mix,
        asa_mix,
        schedule_deviation,
        first_write_wins,
        watermark_after,
        incremental_batch,
        insert_ignore_counts,
        increment_cycle,
        increment_careless_feed,
        stream_ingest,
        csv_round_trip,
        json_round_trip,
        raw_csv_load,
        dimension_seed,
        stored_analysis,
        extended_recovery_label,
        train_test_split,
        class_balance,
        eval_regression,
        eval_auc,
        discharge_predictor,
        recovery_classifier,
        model_search,
        model_search_errors,
        model_importances,
        model_cards,
        importance_ranking,
    )
}
