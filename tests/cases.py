"""Small literal case frames."""

from datetime import datetime, timedelta

from flowgauge.schema import TRANSFER_SCHEMA

MONDAY = datetime(2025, 1, 6, 7, 0)


def case(
    event_id,
    facility="A",
    procedure="P",
    phases=(10, 20, 30, 40),
    late_by=0,
    status="completed",
    created_at=None,
    start=MONDAY,
    asa=2,
    anesthesia="MAC",
    scheduled=True,
):
    moments = [start]
    for minutes in phases:
        moments.append(moments[-1] + timedelta(minutes=minutes))
    return (
        event_id,
        facility,
        procedure,
        moments[2] - timedelta(minutes=late_by) if scheduled else None,
        *moments,
        anesthesia,
        asa,
        status,
        created_at,
        "test",
    )


def frame(spark, rows):
    return spark.createDataFrame(list(rows), TRANSFER_SCHEMA)


def timed(spark, rows):
    from flowgauge.operators.derive import with_durations

    return with_durations(frame(spark, rows))


def by_key(df, *keys):
    return {tuple(row[key] for key in keys): row.asDict(recursive=True) for row in df.collect()}


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
