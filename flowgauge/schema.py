"""Data model of the case-event table, its dimensions and derived tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Phase(NamedTuple):
    """One stretch of a case between two milestones."""

    column: str
    start: str
    end: str
    label: str


# --- Fixed values: column names, phase labels and allowed codes -------------
PHASES = (
    Phase("dur_checkin_to_preop", "checkin_time", "preop_start_time", "Check-in to Pre-op"),
    Phase("dur_preop_to_op", "preop_start_time", "op_start_time", "Pre-op to OR"),
    Phase("dur_op_to_postop", "op_start_time", "postop_start_time", "OR to PACU"),
    Phase("dur_postop_to_discharge", "postop_start_time", "discharge_time", "PACU to Discharge"),
)
TOTAL = Phase("dur_total", "checkin_time", "discharge_time", "Total")

MILESTONES = (
    "checkin_time",
    "preop_start_time",
    "op_start_time",
    "postop_start_time",
    "discharge_time",
)

CASE_STATUSES = ("completed", "canceled", "converted_to_inpatient", "delayed")
COMPLETED = "completed"
CANCELED = "canceled"

KEYS = ("facility_id", "procedure_type")

SEVERITY_ORDER = ("high", "medium", "info")

CASE_TABLE = "outpatient_case_event"
DEFAULT_SOURCE_ID = "edge-collector"
# ---------------------------------------------------------------------------

PHASE_COLUMNS = tuple(phase.column for phase in PHASES)
DURATIONS = PHASE_COLUMNS + (TOTAL.column,)

_CASE_FIELDS = [
    T.StructField("event_id", T.StringType()),
    T.StructField("facility_id", T.StringType()),
    T.StructField("procedure_type", T.StringType()),
    T.StructField("scheduled_start_time", T.TimestampType()),
    *[T.StructField(name, T.TimestampType()) for name in MILESTONES],
    T.StructField("anesthesia_type", T.StringType()),
    T.StructField("asa_class", T.IntegerType()),
    T.StructField("case_status", T.StringType()),
]
_CREATED_AT = T.StructField("created_at", T.TimestampType())
_SOURCE = T.StructField("source_generator_id", T.StringType())

# 13 columns as exported, 14 as transferred between stores, 19 once derived.
CASE_SCHEMA = T.StructType([*_CASE_FIELDS, _SOURCE])
TRANSFER_SCHEMA = T.StructType([*_CASE_FIELDS, _CREATED_AT, _SOURCE])
CENTRAL_SCHEMA = T.StructType(
    [*TRANSFER_SCHEMA.fields, *[T.StructField(name, T.DoubleType()) for name in DURATIONS]]
)
CASE_COLUMNS = tuple(CASE_SCHEMA.names)
TRANSFER_COLUMNS = tuple(TRANSFER_SCHEMA.names)

FACILITY_SCHEMA = T.StructType(
    [
        T.StructField("facility_id", T.StringType()),
        T.StructField("facility_name", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("procedure_type", T.StringType()),
        T.StructField("service_line", T.StringType()),
        *[
            T.StructField(f"{phase.column.removeprefix('dur_')}_{part}", T.DoubleType())
            for phase in PHASES
            for part in ("mu", "sigma")
        ],
    ]
)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("last_created_at", T.TimestampType()),
        T.StructField("last_run_at", T.TimestampType()),
        T.StructField("rows_transferred", T.LongType()),
    ]
)

STATISTICS = ("mean", "median", "p90", "std")

AGGREGATE_SCHEMA = T.StructType(
    [
        *[T.StructField(key, T.StringType()) for key in KEYS],
        *[
            T.StructField(f"{column}_{statistic}", T.DoubleType())
            for column in DURATIONS
            for statistic in STATISTICS
        ],
        T.StructField("case_volume", T.LongType()),
        T.StructField("late_start_rate", T.DoubleType()),
    ]
)

# The text fields are always filled; every other field belongs to some types only.
INSIGHT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("facility", T.StringType()),
        T.StructField("procedure", T.StringType()),
        T.StructField("total_duration_std", T.DoubleType()),
        T.StructField("coefficient_of_variation", T.DoubleType()),
        T.StructField("late_start_rate", T.DoubleType()),
        T.StructField("phase", T.StringType()),
        T.StructField("phase_minutes", T.DoubleType()),
        T.StructField("phase_pct", T.DoubleType()),
        T.StructField("gap_minutes", T.DoubleType()),
        T.StructField("gap_pct", T.DoubleType()),
        T.StructField("reference_facility", T.StringType()),
        T.StructField("avg_total_minutes", T.DoubleType()),
        T.StructField("p90_total_minutes", T.DoubleType()),
        T.StructField("total_cases", T.LongType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("count", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("impact", T.StringType()),
        T.StructField("action", T.StringType()),
    ]
)

REGRESSOR_SCHEMA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("mae_minutes", T.DoubleType()),
        T.StructField("r2_score", T.DoubleType()),
        T.StructField("feature_importance", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
    ]
)

CLASSIFIER_SCHEMA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("p90_threshold_minutes", T.DoubleType()),
        T.StructField("auc_score", T.DoubleType()),
        T.StructField("features_used", T.ArrayType(T.StringType())),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
    ]
)

RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("gpu_available", T.BooleanType()),
        T.StructField("discharge_predictor", REGRESSOR_SCHEMA),
        T.StructField("extended_recovery_classifier", CLASSIFIER_SCHEMA),
        T.StructField("insights", T.ArrayType(INSIGHT_SCHEMA)),
    ]
)
