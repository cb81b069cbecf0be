import pytest
from cases import case, timed

from flowgauge import texts
from flowgauge.operators import aggregate, insights
from flowgauge.schema import INSIGHT_SCHEMA


def found(spark, rows):
    df = timed(spark, rows)
    return insights.all_insights(df, aggregate.aggregates(df)).collect()


def busy_rows():
    """Two sites and two procedures; site B is slower, later and less even."""
    rows = []
    for n in range(20):
        rows.append(case(f"a{n}", "A", "P", phases=(10, 20, 30, 20 + n % 3)))
        rows.append(case(f"b{n}", "B", "P", phases=(10, 20, 30, 60 if n % 2 else 400), late_by=20 if n < 12 else 0))
        rows.append(case(f"c{n}", "A", "Q", phases=(10, 10, 10, 10), late_by=16 if n < 5 else 0))
    rows += [case("x", "A", "P", status="canceled"), case("y", "B", "P", status="canceled")]
    return rows


def test_families_severity_and_order(spark):
    rows = found(spark, busy_rows())
    assert [(r["type"], r["severity"], r["facility"], r["procedure"]) for r in rows] == [
        ("high_variance", "high", "B", "P"),
        ("late_starts", "high", "B", "P"),
        ("bottleneck", "high", "B", None),
        ("high_variance", "medium", "A", "P"),
        ("high_variance", "medium", "A", "Q"),
        ("late_starts", "medium", "A", "Q"),
        ("cross_facility", "medium", "B", "P"),
        ("cancellation_rate", "medium", None, None),
        ("facility_summary", "info", "A", None),
        ("facility_summary", "info", "B", None),
    ]
    assert list(rows[0].asDict()) == INSIGHT_SCHEMA.names
    for row in rows:
        assert all(row[part] for part in ("title", "message", "impact", "action"))


def test_texts(spark):
    rows = {(r["type"], r["facility"], r["procedure"]): r for r in found(spark, busy_rows())}
    gap = rows["cross_facility", "B", "P"]
    assert (gap["gap_minutes"], gap["gap_pct"], gap["reference_facility"]) == (round(290 - 80.95, 1), 258.2, "A")
    assert gap["title"] == "Performance gap: P"
    assert gap["message"] == "P at B takes 290 min on average — 209 min slower (258%) than A (81 min)."
    assert gap["impact"].startswith("If B matched A's efficiency, each case would free 209 minutes")
    late = rows["late_starts", "B", "P"]
    assert late["message"] == "At B, P starts more than 15 minutes past the scheduled time in 60% of cases."
    neck = rows["bottleneck", "B", None]
    assert neck["phase"] == "PACU to Discharge"
    assert neck["message"] == (
        'At B, the "PACU to Discharge" phase consumes 79% of the total patient journey '
        "(230 min average out of 290 min total)."
    )
    assert "approximately 29 minutes per case" in neck["impact"]
    assert neck["action"] == texts.PHASE_ACTIONS["PACU to Discharge"]
    cancel = rows["cancellation_rate", None, None]
    assert cancel["message"] == "Out of 62 total cases, 2 were cancelled — a rate of 3.2%."
    assert (cancel["rate"], cancel["count"], cancel["total"]) == (0.0323, 2, 62)
    assert cancel["impact"] == texts.CANCELLATION["impact_raised"]
    summary = rows["facility_summary", "A", None]
    assert summary["total_cases"] == 40
    assert "A processed 40 completed cases" in summary["message"]


def test_one_site_has_no_gap_and_a_single_case_has_no_deviation(spark):
    rows = found(spark, [case("a"), case("b", procedure="Q"), case("c", procedure="Q", phases=(10, 20, 30, 50))])
    assert "cross_facility" not in {r["type"] for r in rows}
    variance = [r for r in rows if r["type"] == "high_variance"]
    assert [(r["procedure"], r["total_duration_std"], r["severity"]) for r in variance] == [
        ("Q", 7.1, "medium"),
        ("P", None, "medium"),
    ]
    assert "standard deviation of nan minutes (CV nan%)" in variance[1]["message"]


def test_only_cancellations(spark):
    rows = found(spark, [case("a", status="canceled")])
    assert [(r["type"], r["severity"]) for r in rows] == [("cancellation_rate", "high")]
    assert found(spark, []) == []


def test_normal_cancellation_wording(spark):
    rows = found(spark, [case(f"e{n}") for n in range(50)] + [case("x", status="canceled")])
    cancel = next(r for r in rows if r["type"] == "cancellation_rate")
    assert cancel["severity"] == "info"
    assert cancel["action"] == texts.CANCELLATION["action_normal"]


@pytest.mark.parametrize(("phases", "severity"), [((35, 25, 20, 20), None), ((45, 20, 20, 15), "medium"), ((46, 20, 20, 14), "high")])
def test_bottleneck_limits_are_exclusive(spark, phases, severity):
    necks = [r for r in found(spark, [case("a", phases=phases)]) if r["type"] == "bottleneck"]
    assert [r["severity"] for r in necks] == ([severity] if severity else [])
