"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

import re

from flowgauge import texts
from flowgauge.schema import DURATIONS, KEYS, PHASES

FEATURES = (
    "facility_id_enc, procedure_type_enc, anesthesia_type_enc, asa_class, checkin_hour, checkin_dow, "
    "dur_checkin_to_preop, dur_preop_to_op, dur_op_to_postop"
).split(", ")
PHASE_NAMES = [phase.column for phase in PHASES]
CASE_FIELDS = (
    "event_id, facility_id, procedure_type, scheduled_start_time, checkin_time, preop_start_time, "
    "op_start_time, postop_start_time, discharge_time, anesthesia_type, asa_class, case_status"
)
TRANSFER = f"{CASE_FIELDS}, created_at, source_generator_id"


def _minute(number: str) -> str:
    return f"l_shipdate + to_minutes(CAST({number} AS BIGINT))"


CTES = {
    "minutes": """
        SELECT *,
            360 + (l_partkey * 7 + l_orderkey * 13 + l_linenumber) % 660 AS m0,
            8 + (l_orderkey * 7 + l_linenumber * 3) % 25 AS d1,
            10 + (l_partkey * 11 + l_linenumber) % 20 AS d2,
            10 + p_size + CAST(floor(l_quantity) AS INTEGER) % 30 AS d3,
            15 + (l_orderkey * 17 + l_partkey) % 40 + r_regionkey * 15
                + CASE WHEN (l_orderkey + l_partkey) % 20 = 0 THEN 120 ELSE 0 END AS d4,
            (l_orderkey * 31 + l_suppkey) % 41 - 20 + r_regionkey * 3 AS shift,
            (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 100 AS roll
        FROM lineitem
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "cases": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
            r_name AS facility_id,
            p_brand AS procedure_type,
            {_minute("m0 + d1 + d2 - shift")} AS scheduled_start_time,
            {_minute("m0")} AS checkin_time,
            {_minute("m0 + d1")} AS preop_start_time,
            {_minute("m0 + d1 + d2")} AS op_start_time,
            {_minute("m0 + d1 + d2 + d3")} AS postop_start_time,
            {_minute("m0 + d1 + d2 + d3 + d4")} AS discharge_time,
            l_returnflag AS anesthesia_type,
            CAST(1 + l_orderkey % 6 AS INTEGER) AS asa_class,
            CASE WHEN roll < 2 THEN 'canceled' WHEN roll < 3 THEN 'converted_to_inpatient'
                WHEN roll < 6 THEN 'delayed' ELSE 'completed' END AS case_status,
            o_orderdate AS created_at,
            l_linestatus AS source_generator_id
        FROM minutes""",
    "timed": """
        SELECT *,
            date_diff('microsecond', checkin_time, preop_start_time) / 6e7 AS dur_checkin_to_preop,
            date_diff('microsecond', preop_start_time, op_start_time) / 6e7 AS dur_preop_to_op,
            date_diff('microsecond', op_start_time, postop_start_time) / 6e7 AS dur_op_to_postop,
            date_diff('microsecond', postop_start_time, discharge_time) / 6e7 AS dur_postop_to_discharge,
            date_diff('microsecond', checkin_time, discharge_time) / 6e7 AS dur_total,
            CASE WHEN op_start_time > scheduled_start_time + INTERVAL 15 MINUTE THEN 1 ELSE 0 END AS late_start
        FROM cases""",
    "done": "SELECT * FROM timed WHERE case_status = 'completed'",
    "groups": "SELECT facility_id, procedure_type, "
    + ", ".join(
        f"avg({name}) AS {name}_mean, median({name}) AS {name}_median, "
        f"quantile_cont({name}, 0.9) AS {name}_p90, stddev_samp({name}) AS {name}_std"
        for name in DURATIONS
    )
    + """, count(event_id) AS case_volume, avg(CAST(late_start AS DOUBLE)) AS late_start_rate
        FROM done GROUP BY facility_id, procedure_type""",
    "phase_means": "SELECT *, "
    + " + ".join(PHASE_NAMES)
    + " AS journey FROM (SELECT facility_id, "
    + ", ".join(f"avg({name}_mean) AS {name}" for name in PHASE_NAMES)
    + " FROM groups GROUP BY facility_id)",
    "longest": "SELECT facility_id, CASE "
    + " ".join(f"WHEN {p.column} = longest THEN '{p.label}'" for p in PHASES)
    + f""" END AS phase, longest AS phase_minutes, journey, longest / journey * 100 AS phase_pct
        FROM (SELECT *, greatest({", ".join(PHASE_NAMES)}) AS longest FROM phase_means) WHERE journey > 0""",
    "variable": """
        SELECT *, CASE WHEN dur_total_mean > 0 THEN dur_total_std / dur_total_mean * 100 ELSE 0 END AS cv
        FROM groups ORDER BY dur_total_std DESC NULLS LAST, facility_id, procedure_type LIMIT 5""",
    "tardy": """
        SELECT * FROM groups WHERE late_start_rate > 0.2
        ORDER BY late_start_rate DESC, facility_id, procedure_type LIMIT 5""",
    "placed": """
        SELECT *,
            row_number() OVER (PARTITION BY procedure_type ORDER BY dur_total_mean, facility_id) AS fast_no,
            row_number() OVER (PARTITION BY procedure_type ORDER BY dur_total_mean DESC, facility_id) AS slow_no,
            count(*) OVER (PARTITION BY procedure_type) AS n_facilities,
            min(facility_id) OVER (PARTITION BY procedure_type) AS first_facility
        FROM groups""",
    "gaps": """
        SELECT f.procedure_type, f.n_facilities, f.first_facility,
            f.facility_id AS fastest_facility, f.dur_total_mean AS fastest_mean,
            s.facility_id AS slowest_facility, s.dur_total_mean AS slowest_mean,
            s.dur_total_mean - f.dur_total_mean AS gap_minutes,
            (s.dur_total_mean - f.dur_total_mean) / f.dur_total_mean * 100 AS gap_pct
        FROM placed f JOIN placed s ON f.procedure_type = s.procedure_type
        WHERE f.fast_no = 1 AND s.slow_no = 1 AND f.n_facilities >= 2
            AND s.dur_total_mean - f.dur_total_mean > 20
            AND (s.dur_total_mean - f.dur_total_mean) / f.dur_total_mean * 100 > 30""",
    "overview": """
        SELECT facility_id, avg(dur_total) AS avg_total_minutes,
            quantile_cont(dur_total, 0.9) AS p90_total_minutes, count(*) AS total_cases
        FROM done GROUP BY facility_id""",
    "cancel": """
        SELECT *, "count" / CAST(total AS DOUBLE) AS rate
        FROM (SELECT count(*) AS total, count(*) FILTER (case_status = 'canceled') AS "count" FROM cases)""",
    "labelled": """
        SELECT *, CASE WHEN dur_postop_to_discharge > (SELECT quantile_cont(dur_postop_to_discharge, 0.9) FROM done)
                THEN 1 ELSE 0 END AS extended_recovery,
            CAST(('0x' || substr(md5(event_id), 1, 8)) AS BIGINT) % 5 = 0 AS in_test
        FROM done""",
    "catalog": "SELECT p_brand AS procedure_type, arg_max(p_type, p_partkey) AS service_line FROM part GROUP BY p_brand",
    "places": """
        SELECT r_name AS facility_id,
            'Center ' || array_to_string(list_transform(string_split(lower(r_name), ' '),
                lambda w: upper(w[1]) || w[2:]), ' ') AS facility_name,
            'UTC' AS timezone, r_regionkey + 1 AS volume_min, r_regionkey * 2 + 6 AS volume_max
        FROM region""",
    "marked": """
        SELECT *, (hour(checkin_time) * 60 + minute(checkin_time) + asa_class) % 97 AS mark FROM timed""",
    "flawed": """
        SELECT event_id, CASE WHEN mark = 1 THEN 'UNLISTED' ELSE facility_id END AS facility_id,
            CASE WHEN mark <> 2 THEN procedure_type END AS procedure_type,
            checkin_time, preop_start_time, op_start_time,
            CASE WHEN mark = 6 THEN checkin_time ELSE postop_start_time END AS postop_start_time, discharge_time,
            CASE WHEN mark IN (3, 4) THEN 7 * (mark - 3) ELSE asa_class END AS asa_class,
            CASE WHEN mark = 5 THEN 'unknown' ELSE case_status END AS case_status,
            dur_checkin_to_preop,
            CASE WHEN mark = 8 THEN -dur_preop_to_op ELSE dur_preop_to_op END AS dur_preop_to_op,
            dur_op_to_postop, dur_postop_to_discharge,
            CASE WHEN mark = 7 THEN dur_total + 1 ELSE dur_total END AS dur_total
        FROM marked""",
    "rules": """
        SELECT *,
            event_id IS NULL AS missing_event_id,
            facility_id IS NULL AS missing_facility_id,
            procedure_type IS NULL AS missing_procedure_type,
            checkin_time IS NULL AS missing_checkin_time,
            preop_start_time IS NULL AS missing_preop_start_time,
            op_start_time IS NULL AS missing_op_start_time,
            postop_start_time IS NULL AS missing_postop_start_time,
            discharge_time IS NULL AS missing_discharge_time,
            asa_class NOT BETWEEN 1 AND 6 AS asa_class_out_of_range,
            case_status NOT IN ('completed', 'canceled', 'converted_to_inpatient', 'delayed') AS unknown_case_status,
            case_status = 'completed' AND (preop_start_time < checkin_time OR op_start_time < preop_start_time
                OR postop_start_time < op_start_time OR discharge_time < postop_start_time)
                AS milestones_out_of_order,
            case_status = 'completed' AND least(dur_checkin_to_preop, dur_preop_to_op, dur_op_to_postop,
                dur_postop_to_discharge, dur_total) <= 0 AS duration_not_positive,
            abs(dur_total - (dur_checkin_to_preop + dur_preop_to_op + dur_op_to_postop + dur_postop_to_discharge))
                > 1e-5 * abs(dur_checkin_to_preop + dur_preop_to_op + dur_op_to_postop + dur_postop_to_discharge)
                AS durations_do_not_add_up
        FROM flawed""",
    "resent": f"""
        SELECT 'case-' || split_part(event_id, '-', 1) AS event_id,
            {", ".join(CASE_FIELDS.split(", ")[1:])},
            created_at + to_minutes(minute(checkin_time)) AS created_at, source_generator_id
        FROM cases""",
    "logs": f"""
        SELECT source_generator_id AS source_id, FIRST AS run_at, created_at FROM (
            SELECT *, CASE WHEN created_at < TIMESTAMP '1998-01-01' THEN TIMESTAMP '1998-01-02'
                ELSE TIMESTAMP '2002-01-01' END AS FIRST FROM cases)""",
    "fits": " UNION ALL ".join(
        f"""SELECT facility_id, procedure_type, '{name.removeprefix("dur_")}' AS phase,
            CASE WHEN {name} > 0 THEN ln({name}) END AS log_minutes FROM done"""
        for name in PHASE_NAMES
    ),
    "overall_fit": """
        SELECT procedure_type, phase, count(log_minutes) AS cases, avg(log_minutes) AS mu,
            stddev_samp(log_minutes) AS sigma FROM fits GROUP BY procedure_type, phase""",
}

RULES = (
    "missing_event_id",
    "missing_facility_id",
    "missing_procedure_type",
    "missing_checkin_time",
    "missing_preop_start_time",
    "missing_op_start_time",
    "missing_postop_start_time",
    "missing_discharge_time",
    "asa_class_out_of_range",
    "unknown_case_status",
    "milestones_out_of_order",
    "duration_not_positive",
    "durations_do_not_add_up",
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sentence(template: str, **values: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [f"({values[part]})" if index % 2 else _quoted(part) for index, part in enumerate(parts) if part]
    return " || ".join(pieces)


def _whole(value: str) -> str:
    return f"format('{{:.0f}}', {value})"


def _near(value: str, places: int = 1) -> str:
    """Rounded half to even from the stored binary value."""
    return f"CAST(format('{{:.{places}f}}', {value}) AS DOUBLE)"


ORDER_COLUMNS = {"place": "DOUBLE", "first_key": "VARCHAR", "second_key": "VARCHAR"}


def _finding(
    kind: str, severity: str, source: str, wording: dict[str, str], text: dict[str, str], order: tuple[str, str, str], **fields: str
) -> str:
    common = {
        "facility": "VARCHAR",
        "procedure": "VARCHAR",
        "total_duration_std": "DOUBLE",
        "coefficient_of_variation": "DOUBLE",
        "late_start_rate": "DOUBLE",
        "phase": "VARCHAR",
        "phase_minutes": "DOUBLE",
        "phase_pct": "DOUBLE",
        "gap_minutes": "DOUBLE",
        "gap_pct": "DOUBLE",
        "reference_facility": "VARCHAR",
        "avg_total_minutes": "DOUBLE",
        "p90_total_minutes": "DOUBLE",
        "total_cases": "BIGINT",
        "rate": "DOUBLE",
        "count": "BIGINT",
        "total": "BIGINT",
    }
    columns = [f"'{kind}' AS type", f"{severity} AS severity"]
    columns += [f'CAST({fields.get(name, "NULL")} AS {sort}) AS "{name}"' for name, sort in common.items()]
    columns += [
        f"{text.get(part) or _sentence(wording[part])} AS {part}" for part in ("title", "message", "impact", "action")
    ]
    columns += [f"CAST({value} AS {sort}) AS {name}" for value, (name, sort) in zip(order, ORDER_COLUMNS.items())]
    return f"SELECT {', '.join(columns)} FROM {source}"


def _insights() -> str:
    variance, late, bottleneck = texts.HIGH_VARIANCE, texts.LATE_STARTS, texts.BOTTLENECK
    cross, summary, cancel = texts.CROSS_FACILITY, texts.FACILITY_SUMMARY, texts.CANCELLATION
    actions = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in texts.PHASE_ACTIONS.items())
    gap = {
        "procedure": "procedure_type",
        "slow": "slowest_facility",
        "fast": "fastest_facility",
        "slow_mean": _whole("slowest_mean"),
        "fast_mean": _whole("fastest_mean"),
        "gap": _whole("gap_minutes"),
        "gap_pct": _whole("gap_pct"),
    }

    def raised(part: str) -> str:
        return (
            f"CASE WHEN rate > 0.02 THEN {_quoted(cancel[part + '_raised'])} "
            f"ELSE {_quoted(cancel[part + '_normal'])} END"
        )

    families = [
        _finding(
            "high_variance",
            "CASE WHEN cv > 50 THEN 'high' ELSE 'medium' END",
            "variable",
            variance,
            {
                "title": _sentence(variance["title"], procedure="procedure_type"),
                "message": _sentence(
                    variance["message"],
                    facility="facility_id",
                    procedure="procedure_type",
                    std=_whole("dur_total_std"),
                    cv=_whole("cv"),
                    mean=_whole("dur_total_mean"),
                    p90=_whole("dur_total_p90"),
                ),
            },
            facility="facility_id",
            procedure="procedure_type",
            order=("-dur_total_std", "facility_id", "procedure_type"),
            total_duration_std=_near("dur_total_std", 1),
            coefficient_of_variation=_near("cv", 1),
        ),
        _finding(
            "late_starts",
            "CASE WHEN late_start_rate > 0.5 THEN 'high' ELSE 'medium' END",
            "tardy",
            late,
            {
                "title": _sentence(late["title"], procedure="procedure_type"),
                "message": _sentence(
                    late["message"],
                    facility="facility_id",
                    procedure="procedure_type",
                    rate=_whole("late_start_rate * 100") + " || '%'",
                ),
            },
            facility="facility_id",
            procedure="procedure_type",
            order=("-late_start_rate", "facility_id", "procedure_type"),
            late_start_rate=_near("late_start_rate", 3),
        ),
        _finding(
            "bottleneck",
            "CASE WHEN phase_pct > 45 THEN 'high' ELSE 'medium' END",
            "longest WHERE phase_pct > 35",
            bottleneck,
            {
                "title": _sentence(bottleneck["title"], phase="phase"),
                "message": _sentence(
                    bottleneck["message"],
                    facility="facility_id",
                    phase="phase",
                    pct=_whole("phase_pct"),
                    worst=_whole("phase_minutes"),
                    total=_whole("journey"),
                ),
                "impact": _sentence(
                    bottleneck["impact"], facility="facility_id", saving=_whole("phase_minutes * 0.125")
                ),
                "action": f"CASE phase {actions} END",
            },
            facility="facility_id",
            phase="phase",
            order=("NULL", "facility_id", "NULL"),
            phase_minutes=_near("phase_minutes", 1),
            phase_pct=_near("phase_pct", 1),
        ),
        _finding(
            "cross_facility",
            "'medium'",
            "gaps",
            cross,
            {part: _sentence(cross[part], **gap) for part in ("title", "message", "impact", "action")},
            facility="slowest_facility",
            procedure="procedure_type",
            order=("NULL", "first_facility", "procedure_type"),
            gap_minutes=_near("gap_minutes", 1),
            gap_pct=_near("gap_pct", 1),
            reference_facility="fastest_facility",
        ),
        _finding(
            "facility_summary",
            "'info'",
            "overview",
            summary,
            {
                "title": _sentence(summary["title"], facility="facility_id"),
                "message": _sentence(
                    summary["message"],
                    facility="facility_id",
                    cases="format('{:,}', total_cases)",
                    mean=_whole("avg_total_minutes"),
                    p90=_whole("p90_total_minutes"),
                ),
            },
            facility="facility_id",
            order=("NULL", "facility_id", "NULL"),
            avg_total_minutes=_near("avg_total_minutes", 1),
            p90_total_minutes=_near("p90_total_minutes", 1),
            total_cases="total_cases",
        ),
        _finding(
            "cancellation_rate",
            "CASE WHEN rate > 0.05 THEN 'high' WHEN rate > 0.02 THEN 'medium' ELSE 'info' END",
            "cancel WHERE total > 0",
            cancel,
            {
                "message": _sentence(
                    cancel["message"],
                    total="format('{:,}', total)",
                    count="format('{:,}', \"count\")",
                    rate="format('{:.1f}', rate * 100) || '%'",
                ),
                "impact": raised("impact"),
                "action": raised("action"),
            },
            order=("NULL", "NULL", "NULL"),
            rate=_near("rate", 4),
            count='"count"',
            total="total",
        ),
    ]
    return " UNION ALL ".join(f"SELECT *, {number} AS family FROM ({family})" for number, family in enumerate(families, 1))


CTES["insights_placed"] = _insights()
CTES["insights"] = f"SELECT * EXCLUDE (family, {', '.join(ORDER_COLUMNS)}) FROM insights_placed"

# Which earlier tables each one reads.
NEEDS = {
    name: [other for other in CTES if other != name and re.search(rf"\b(FROM|JOIN) {other}\b", sql)]
    for name, sql in CTES.items()
}


def _with(query: str) -> str:
    """Put the tables the query reads in front of it, each after those it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS[name]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in CTES:
        if re.search(rf"\b(FROM|JOIN) {name}\b", query):
            visit(name)
    tables = ", ".join(f"{name} AS ({CTES[name]})" for name in ordered)
    own = f"SELECT * FROM ({query})" if query.lstrip().startswith("WITH") else query
    return f"WITH {tables} {own}" if tables else query


def _r(expression: str, name: str | None = None, places: int = 4) -> str:
    return f"round({expression}, {places}) AS {name or expression}"


def _durations(prefix: str = "") -> str:
    return ", ".join(_r(f"{prefix}{name}", name) for name in DURATIONS)


def _code(column: str) -> str:
    filled = f"coalesce({column}, 'unknown')"
    return f"CAST(dense_rank() OVER (ORDER BY {filled}) - 1 AS INTEGER) AS {column}_enc"


FIRST_WRITE = f"""
    SELECT {TRANSFER} FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY created_at NULLS LAST,
            {", ".join(f"{name} NULLS LAST" for name in CASE_FIELDS.split(", ")[1:])},
            source_generator_id NULLS LAST) AS copy_no
        FROM resent) WHERE copy_no = 1"""

CARELESS = """
    (SELECT * REPLACE (CASE WHEN minute(checkin_time) <> 7 THEN event_id END AS event_id,
        CASE WHEN minute(checkin_time) <> 11 THEN created_at END AS created_at) FROM resent)"""

_OTHER_STATUS = (
    "coalesce(case_status, '') NOT IN ('completed', 'canceled', 'converted_to_inpatient', 'delayed')"
)
_MIX_TOTAL = "sum(count(*)) OVER (PARTITION BY service_line)"

_QUERIES = {
    "case_events": f"SELECT {TRANSFER} FROM cases",
    "durations": f"SELECT event_id, {_durations()} FROM timed",
    "late_start_flag": "SELECT event_id, late_start FROM timed",
    "checkin_hour_dow": """
        SELECT event_id, CAST(hour(checkin_time) AS INTEGER) AS checkin_hour,
            CAST(isodow(checkin_time) - 1 AS INTEGER) AS checkin_dow FROM cases""",
    "label_encode": f"""
        SELECT event_id, {_code("facility_id")}, {_code("procedure_type")}, {_code("anesthesia_type")}
        FROM done""",
    "feature_matrix": f"""
        SELECT event_id, CAST(facility_id_enc AS DOUBLE) AS facility_id_enc,
            CAST(procedure_type_enc AS DOUBLE) AS procedure_type_enc,
            CAST(anesthesia_type_enc AS DOUBLE) AS anesthesia_type_enc, asa_class, checkin_hour, checkin_dow,
            {", ".join(_r(name) for name in PHASE_NAMES[:3])}
        FROM (SELECT *, {_code("facility_id")}, {_code("procedure_type")}, {_code("anesthesia_type")},
            CAST(hour(checkin_time) AS INTEGER) AS checkin_hour,
            CAST(isodow(checkin_time) - 1 AS INTEGER) AS checkin_dow FROM done)""",
    "clip_durations": "SELECT event_id, "
    + ", ".join(_r(f"least(greatest({name}, 20.0), 120.0)", name) for name in DURATIONS)
    + " FROM timed",
    "phase_values": " UNION ALL ".join(
        f"SELECT event_id, '{name}' AS phase, {_r(name, 'minutes')} FROM timed" for name in PHASE_NAMES
    ),
    "weekday_cases": "SELECT event_id, checkin_time FROM cases WHERE isodow(checkin_time) <= 5",
    "case_labels": """
        SELECT event_id, procedure_type || ' (' || facility_id || ')' AS label,
            strftime(checkin_time, '%Y-%m-%d %H:%M:%S') AS checkin FROM cases""",
    "aggregates": "SELECT facility_id, procedure_type, "
    + ", ".join(_r(f"{name}_{stat}") for name in DURATIONS for stat in ("mean", "median", "p90", "std"))
    + f", case_volume, {_r('late_start_rate')} FROM groups",
    "aggregates_of_levels": "SELECT facility_id, procedure_type, "
    + ", ".join(_r(f"{name}_{stat}") for name in DURATIONS for stat in ("mean", "median", "p90", "std"))
    + f""", case_volume, {_r('late_start_rate')} FROM groups
        UNION ALL SELECT facility_id, NULL, """
    + ", ".join(
        {"dur_total_mean": "round(avg_total_minutes, 4)", "dur_total_p90": "round(p90_total_minutes, 4)"}.get(f"{name}_{stat}", "NULL")
        for name in DURATIONS
        for stat in ("mean", "median", "p90", "std")
    )
    + ", total_cases, NULL FROM overview",
    "percentile_estimates": f"""
        WITH long AS (
            SELECT facility_id, metric, value FROM (SELECT facility_id, {", ".join(DURATIONS)} FROM done)
            UNPIVOT (value FOR metric IN ({", ".join(DURATIONS)}))
        ), wanted(name, fraction) AS (VALUES ('median', 0.5::DOUBLE), ('p90', 0.9::DOUBLE)),
        bins AS (
            SELECT *, sum(n) OVER (PARTITION BY facility_id, metric ORDER BY bin) - n AS below,
                sum(n) OVER (PARTITION BY facility_id, metric) AS size
            FROM (SELECT facility_id, metric, floor(value / 5) AS bin, count(*) AS n FROM long GROUP BY ALL)
        ), placed AS (SELECT *, fraction * (size - 1) AS position FROM bins, wanted),
        estimates AS (
            SELECT facility_id, metric, name, any_value(position) AS position,
                max(5 * (bin + (floor(position) - below + 0.5) / n)) FILTER (floor(position) >= below AND floor(position) < below + n) AS low,
                max(5 * (bin + (ceil(position) - below + 0.5) / n)) FILTER (ceil(position) >= below AND ceil(position) < below + n) AS high
            FROM placed GROUP BY facility_id, metric, name
        ), exact AS (
            SELECT facility_id, metric, name, quantile_cont(value, 0.5) AS exact FROM long, wanted WHERE name = 'median' GROUP BY ALL
            UNION ALL
            SELECT facility_id, metric, name, quantile_cont(value, 0.9) AS exact FROM long, wanted WHERE name = 'p90' GROUP BY ALL
        ), joined AS (
            SELECT *, low + (high - low) * (position - floor(position)) AS estimate
            FROM estimates JOIN exact USING (facility_id, metric, name)
        )
        SELECT facility_id, metric, name, {_r("estimate")}, {_r("exact")}, 5.0::DOUBLE AS bound,
            {_r("abs(estimate - exact)", "error")} FROM joined""",
    "aggregates_csv": "SELECT facility_id, procedure_type, "
    + ", ".join(_r(f"{name}_{stat}") for name in DURATIONS for stat in ("mean", "median", "p90", "std"))
    + f", case_volume, {_r('late_start_rate')} FROM groups",
    "timestamps_from_text": """
        SELECT event_id, checkin_time, preop_start_time, op_start_time, postop_start_time, discharge_time FROM cases""",
    "dq_written": f"""
        SELECT CASE WHEN broken = 0 THEN 'valid' ELSE 'quarantined' END AS verdict, count(*) AS cases,
            CAST(sum(broken) AS BIGINT) AS broken_rules
        FROM (SELECT {" + ".join(f"coalesce({rule}, false)::INTEGER" for rule in RULES)} AS broken FROM rules) GROUP BY 1""",
    "dq_orphan_procedures": """
        SELECT procedure_type, count(*) AS cases FROM flawed
        WHERE procedure_type NOT IN (SELECT procedure_type FROM catalog WHERE service_line <> 'ECONOMY')
        GROUP BY procedure_type""",
    "weights_adding_up": f"""
        SELECT service_line, {_r("count(*) FILTER (anesthesia_type <> 'N') / CAST(count(*) AS DOUBLE)", "total")}
        FROM cases LEFT JOIN catalog USING (procedure_type) WHERE service_line = 'ECONOMY' GROUP BY service_line""",
    "sample_guard": """
        SELECT 'completed' AS cases, count(*) >= 100 AS enough FROM done
        UNION ALL SELECT 'converted', count(*) >= 100 FROM cases
        WHERE case_status = 'converted_to_inpatient' AND isodow(checkin_time) = 6 AND asa_class = 1""",
    "hourly_expected": f"""
        WITH seen AS (SELECT CAST(hour(checkin_time) AS INTEGER) AS hour, count(*) AS n FROM cases GROUP BY 1),
        planned AS (SELECT CAST(hour(scheduled_start_time) AS INTEGER) AS hour, count(*) AS n FROM cases GROUP BY 1)
        SELECT hour, coalesce(s.n, 0) AS n, {_r("coalesce(s.n / (SELECT sum(n) FROM seen)::DOUBLE, 0)", "share", 6)},
            {_r("coalesce(p.n / (SELECT sum(n) FROM planned)::DOUBLE, 0)", "expected_share", 6)}
        FROM seen s FULL JOIN planned p USING (hour)""",
    "anesthesia_expected": f"""
        WITH mix AS (
            SELECT service_line, anesthesia_type, count(*) AS cases, count(*) FILTER (case_status = 'completed') AS done
            FROM cases LEFT JOIN catalog USING (procedure_type) GROUP BY service_line, anesthesia_type)
        SELECT service_line, anesthesia_type, cases,
            {_r("cases / CAST(sum(cases) OVER (PARTITION BY service_line) AS DOUBLE)", "share", 6)},
            {_r("done / CAST(sum(done) OVER (PARTITION BY service_line) AS DOUBLE)", "expected_share", 6)} FROM mix""",
    "asa_expected": f"""
        WITH mix AS (
            SELECT asa_class, count(*) AS n, count(*) FILTER (case_status = 'completed') AS done FROM cases GROUP BY asa_class)
        SELECT asa_class, n, {_r("n / CAST(sum(n) OVER () AS DOUBLE)", "share", 6)},
            {_r("done / CAST(sum(done) OVER () AS DOUBLE)", "expected_share", 6)} FROM mix""",
    "late_start_rate": f"SELECT facility_id, procedure_type, {_r('late_start_rate', places=6)} FROM groups",
    "aggregates_late_join": f"""
        SELECT a.facility_id, a.procedure_type, {_r("a.dur_total_mean", "dur_total_mean")}, a.case_volume,
            {_r("b.late_start_rate", "late_start_rate")}
        FROM (SELECT facility_id, procedure_type, avg(dur_total) AS dur_total_mean, count(event_id) AS case_volume
            FROM done GROUP BY ALL) a
        LEFT JOIN (SELECT facility_id, procedure_type, avg(CAST(late_start AS DOUBLE)) AS late_start_rate
            FROM done GROUP BY ALL) b
        ON a.facility_id = b.facility_id AND a.procedure_type = b.procedure_type""",
    "phase_mean_of_means": f"""
        SELECT facility_id, {", ".join(_r(name) for name in [*PHASE_NAMES, "journey"])} FROM phase_means""",
    "phase_breakdown_long": " UNION ALL ".join(
        f"SELECT facility_id, '{p.label}' AS phase, {_r(p.column, 'mean_of_means')} FROM phase_means" for p in PHASES
    ),
    "phase_matrix": " UNION ALL ".join(
        f"SELECT '{p.label}' AS phase, "
        + ", ".join(
            f"max(CASE WHEN facility_id = '{name}' THEN {_near(p.column)} END) AS \"{name}\""
            for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
        )
        + " FROM phase_means"
        for p in PHASES
    ),
    "bottleneck_phase": f"""
        SELECT facility_id, phase, {_r("phase_minutes")}, {_r("journey")}, {_r("phase_pct")},
            CASE WHEN phase_pct > 45 THEN 'high' ELSE 'medium' END AS severity
        FROM longest WHERE phase_pct > 35""",
    "facility_summary": f"""
        SELECT facility_id, {_r("avg_total_minutes")}, {_r("p90_total_minutes")}, total_cases FROM overview""",
    "cancellation_rate": f"""
        SELECT total, "count", {_r("rate", places=6)},
            CASE WHEN rate > 0.05 THEN 'high' WHEN rate > 0.02 THEN 'medium' ELSE 'info' END AS severity
        FROM cancel WHERE total > 0""",
    "facilities_seen": "SELECT DISTINCT facility_id FROM done",
    "high_variance_top5": f"""
        SELECT facility_id, procedure_type, {_r("dur_total_mean")}, {_r("dur_total_std")}, case_volume,
            {_r("late_start_rate")}, {_r("cv", "coefficient_of_variation")},
            CASE WHEN cv > 50 THEN 'high' ELSE 'medium' END AS severity FROM variable""",
    "late_starts_top5": f"""
        SELECT facility_id, procedure_type, {_r("dur_total_mean")}, case_volume, {_r("late_start_rate")},
            CASE WHEN late_start_rate > 0.5 THEN 'high' ELSE 'medium' END AS severity FROM tardy""",
    "cross_facility_gap": f"""
        SELECT procedure_type, n_facilities, first_facility, fastest_facility, {_r("fastest_mean")},
            slowest_facility, {_r("slowest_mean")}, {_r("gap_minutes")}, {_r("gap_pct")} FROM gaps""",
    "top10_volume": f"""
        SELECT procedure_type || ' (' || facility_id || ')' AS label, case_volume,
            {_near("dur_total_mean")} AS mean_minutes, {_near("dur_total_p90")} AS p90_minutes
        FROM groups ORDER BY case_volume DESC, facility_id, procedure_type LIMIT 10""",
    "top20_volume": f"""
        SELECT facility_id, procedure_type, case_volume,
            {_near("dur_total_mean")} AS mean_minutes, {_near("dur_total_median")} AS median_minutes,
            {_near("dur_total_p90")} AS p90_minutes, {_near("dur_total_std")} AS std_minutes,
            coalesce({_whole("late_start_rate * 100")} || '%', '—') AS late_starts
        FROM groups ORDER BY case_volume DESC, facility_id, procedure_type LIMIT 20""",
    "insights_all": f"""
        SELECT * EXCLUDE (family, {", ".join(ORDER_COLUMNS)}), row_number() OVER (ORDER BY
            CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, family,
            {", ".join(f"{name} NULLS LAST" for name in ORDER_COLUMNS)}) AS position
        FROM insights_placed""",
    "stored_analysis": "SELECT * FROM insights",
    "insight_counts": """
        SELECT CAST(position AS INTEGER) AS position, kind, key, label, n FROM (
            SELECT t.position, t.kind, t.key, t.label, (SELECT count(*) FROM insights
                WHERE t.key = 'all' OR type = t.key OR severity = t.key) AS n
            FROM (VALUES (0, 'tab', 'all', 'All Findings'), (1, 'tab', 'bottleneck', 'Bottlenecks'),
                (2, 'tab', 'high_variance', 'Duration Variability'), (3, 'tab', 'late_starts', 'Late Starts'),
                (4, 'tab', 'cross_facility', 'Facility Comparisons'),
                (5, 'tab', 'cancellation_rate', 'Cancellations'),
                (6, 'tab', 'facility_summary', 'Facility Overviews'),
                (7, 'severity', 'high', 'high'), (8, 'severity', 'medium', 'medium'),
                (9, 'severity', 'info', 'info')) AS t(position, kind, key, label))
        WHERE n > 0 OR key = 'all' OR kind = 'severity'""",
    "insight_totals": "SELECT type, severity, count(*) AS n FROM insights GROUP BY CUBE (type, severity)",
    "kpi_row": f"""
        SELECT CAST(sum(total_cases) AS BIGINT) AS completed, count(*) AS facilities,
            {_r("sum(avg_total_minutes * total_cases) / greatest(sum(total_cases), 1)", "avg_total_minutes")},
            (SELECT total FROM cancel) AS all_cases, (SELECT "count" FROM cancel) AS canceled,
            (SELECT round(rate, 4) FROM cancel) AS cancel_rate
        FROM overview""",
    "status_distribution": """
        SELECT CASE case_status WHEN 'completed' THEN 'Completed' WHEN 'canceled' THEN 'Cancelled'
            ELSE 'Other' END AS status, count(*) AS cases FROM cases GROUP BY 1""",
    "facility_chart": f"""
        SELECT facility_id, total_cases, {_near("avg_total_minutes")} AS avg_total_minutes FROM overview""",
    "dq_violations": " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER ({rule}) AS violations FROM rules" for rule in RULES
    ),
    "dq_quarantine": "SELECT event_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {rule} THEN '{rule}' END" for rule in RULES)
    + f") AS violations FROM rules WHERE {' OR '.join(f'coalesce({rule}, false)' for rule in RULES)}",
    "dq_valid": "SELECT event_id, facility_id, case_status FROM rules WHERE NOT ("
    + " OR ".join(f"coalesce({rule}, false)" for rule in RULES)
    + ")",
    "dq_orphans": """
        SELECT facility_id, count(*) AS cases FROM flawed
        WHERE facility_id NOT IN (SELECT r_name FROM region) GROUP BY facility_id""",
    "dq_duplicates": "SELECT event_id, count(*) AS copies FROM resent GROUP BY event_id HAVING count(*) > 1",
    "milestone_order": "SELECT event_id, op_start_time, postop_start_time FROM rules WHERE milestones_out_of_order",
    "duration_additivity": f"SELECT event_id, {_durations()} FROM rules WHERE durations_do_not_add_up",
    "service_line_rollup": f"""
        SELECT facility_id, service_line, count(*) AS cases, {_r("avg(dur_total)", "avg_total_minutes")}
        FROM done LEFT JOIN catalog USING (procedure_type) GROUP BY facility_id, service_line""",
    "star_enrichment": """
        SELECT event_id, facility_name, timezone, service_line FROM cases
        LEFT JOIN catalog USING (procedure_type) LEFT JOIN places USING (facility_id)""",
    "service_lines": "SELECT DISTINCT service_line FROM catalog",
    "procedures_of_line": "SELECT procedure_type, service_line FROM catalog WHERE service_line = 'ECONOMY'",
    "lognormal_fit": f"SELECT procedure_type, phase, cases, {_r('mu')}, {_r('sigma')} FROM overall_fit",
    "lognormal_drift": f"""
        SELECT f.facility_id, f.procedure_type, f.phase, f.cases, {_r("f.mu", "mu")}, {_r("f.sigma", "sigma")},
            {_r("o.mu", "expected_mu")}, {_r("o.sigma", "expected_sigma")},
            {_r("f.mu - o.mu", "mu_drift")}, {_r("f.sigma - o.sigma", "sigma_drift")}
        FROM (SELECT facility_id, procedure_type, phase, count(log_minutes) AS cases, avg(log_minutes) AS mu,
            stddev_samp(log_minutes) AS sigma FROM fits GROUP BY ALL) f
        LEFT JOIN overall_fit o ON f.procedure_type = o.procedure_type AND f.phase = o.phase""",
    "hourly_profile": f"""
        SELECT CAST(hour(checkin_time) AS INTEGER) AS hour, count(*) AS n,
            {_r("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", "share", 6)}
        FROM cases GROUP BY 1""",
    "calendar_spine_volume": """
        SELECT s.facility_id, s.day, coalesce(d.observed, 0) AS cases, p.volume_min, p.volume_max,
            CASE WHEN coalesce(d.observed, 0) < p.volume_min THEN 'below'
                WHEN coalesce(d.observed, 0) > p.volume_max THEN 'above' ELSE 'within' END AS band
        FROM (SELECT facility_id, CAST(day AS DATE) AS day FROM (SELECT facility_id FROM cases UNION SELECT facility_id FROM places),
                (SELECT unnest(generate_series(min(CAST(checkin_time AS DATE)), max(CAST(checkin_time AS DATE)),
                    INTERVAL 1 DAY)) AS day FROM cases)
            WHERE isodow(day) <= 5) s
        LEFT JOIN (SELECT facility_id, CAST(checkin_time AS DATE) AS day, count(*) AS observed
            FROM cases GROUP BY ALL) d ON s.facility_id = d.facility_id AND s.day = d.day
        LEFT JOIN places p ON s.facility_id = p.facility_id""",
    "status_mix": "SELECT facility_id, count(*) AS cases, "
    + ", ".join(
        f"count(*) FILTER (case_status = '{name}') AS {name}, "
        + _r(f"count(*) FILTER (case_status = '{name}') / CAST(count(*) AS DOUBLE)", f"{name}_share", 6)
        for name in ("completed", "canceled", "converted_to_inpatient", "delayed")
    )
    + f", count(*) FILTER ({_OTHER_STATUS}) AS other, "
    + _r(f"count(*) FILTER ({_OTHER_STATUS}) / CAST(count(*) AS DOUBLE)", "other_share", 6)
    + " FROM flawed GROUP BY facility_id",
    "case_mix": f"""
        SELECT coalesce(o.facility_id, e.facility_id) AS facility_id,
            coalesce(o.service_line, e.service_line) AS service_line, coalesce(o.cases, 0) AS cases,
            {_r("e.pull / sum(e.pull) OVER (PARTITION BY coalesce(o.facility_id, e.facility_id))", "expected_share", 6)},
            {_r("coalesce(o.cases, 0) / CAST(sum(o.cases) OVER (PARTITION BY coalesce(o.facility_id, e.facility_id)) AS DOUBLE)", "share", 6)}
        FROM (SELECT facility_id, service_line, count(*) AS cases FROM cases
            LEFT JOIN catalog USING (procedure_type) GROUP BY ALL) o
        FULL JOIN (SELECT facility_id, service_line, n * CASE WHEN length(service_line) - 4 = volume_min THEN 2.0e0
                ELSE 1.0e0 END AS pull
            FROM places, (SELECT service_line, count(*) AS n FROM catalog GROUP BY service_line)) e
        ON o.facility_id = e.facility_id AND o.service_line = e.service_line""",
    "anesthesia_mix": f"""
        SELECT service_line, anesthesia_type, count(*) AS cases,
            {_r(f"count(*) / CAST({_MIX_TOTAL} AS DOUBLE)", "share", 6)}
        FROM cases LEFT JOIN catalog USING (procedure_type) GROUP BY service_line, anesthesia_type""",
    "asa_mix": f"""
        SELECT asa_class, count(*) AS n, {_r("count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", "share", 6)}
        FROM cases GROUP BY asa_class""",
    "schedule_deviation": f"""
        SELECT facility_id, count(late) AS cases, {_r("avg(late)", "deviation_mean")},
            {_r("stddev_samp(late)", "deviation_std")}, {_r("median(late)", "deviation_median")},
            {_r("quantile_cont(late, 0.9)", "deviation_p90")}
        FROM (SELECT facility_id, date_diff('microsecond', scheduled_start_time, op_start_time) / 6e7 AS late FROM done)
        GROUP BY facility_id""",
    "first_write_wins": FIRST_WRITE,
    "increment_cycle": FIRST_WRITE,
    "stream_ingest": FIRST_WRITE,
    "increment_careless_feed": f"""
        {FIRST_WRITE.replace("FROM resent)", f"FROM {CARELESS} careless WHERE event_id IS NOT NULL)")}
        UNION ALL SELECT DISTINCT {TRANSFER} FROM {CARELESS} careless WHERE event_id IS NULL""",
    "watermark_after": """
        SELECT source_id, arg_max(created_at, (run_at, created_at)) AS last_created_at, max(run_at) AS last_run_at,
            count(*) AS rows_transferred FROM logs GROUP BY source_id""",
    "incremental_batch": """
        SELECT event_id, created_at, source_generator_id FROM cases
        WHERE created_at IS NULL OR created_at >= (SELECT max(created_at) FROM cases
            WHERE created_at < TIMESTAMP '1998-01-01' AND source_generator_id = 'F')""",
    "insert_ignore_counts": """
        SELECT (SELECT count(DISTINCT event_id) FROM resent WHERE created_at < TIMESTAMP '1998-01-01') AS stored,
            count(*) AS pulled, count(DISTINCT event_id) AS distinct_cases,
            count(DISTINCT event_id) FILTER (event_id NOT IN (SELECT event_id FROM resent
                WHERE created_at < TIMESTAMP '1998-01-01')) AS inserted
        FROM resent WHERE created_at >= TIMESTAMP '1998-01-01'""",
    "csv_round_trip": f"SELECT {CASE_FIELDS}, source_generator_id FROM cases",
    "json_round_trip": f"SELECT {CASE_FIELDS}, source_generator_id FROM cases",
    "raw_csv_load": f"""
        SELECT {CASE_FIELDS}, CAST(NULL AS TIMESTAMP) AS created_at, source_generator_id FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
                {", ".join(f"{name} NULLS LAST" for name in CASE_FIELDS.split(", ")[1:])},
                source_generator_id NULLS LAST) AS copy_no
            FROM resent) WHERE copy_no = 1""",
    "dimension_seed": """
        SELECT facility_id, facility_name, timezone FROM places
        UNION ALL SELECT n_name, 'Office', 'UTC' FROM nation WHERE n_name NOT IN (SELECT r_name FROM region)""",
    "extended_recovery_label": "SELECT event_id, extended_recovery FROM labelled",
    "train_test_split": "SELECT event_id, in_test FROM labelled",
    "class_balance": f"""
        SELECT count(*) FILTER (extended_recovery = 0) AS negatives, count(*) FILTER (extended_recovery = 1) AS positives,
            {_r("count(*) FILTER (extended_recovery = 0) / CAST(greatest(count(*) FILTER (extended_recovery = 1), 1) AS DOUBLE)", "positive_weight")}
        FROM labelled WHERE NOT in_test""",
    "discharge_predictor": f"""
        SELECT 'GBTRegressor' AS model_type, 'dur_total' AS target, '{", ".join(sorted(FEATURES))}' AS features,
            count(*) FILTER (NOT in_test) AS n_train, count(*) FILTER (in_test) AS n_test,
            true AS importance_adds_up, true AS better_than_mean
        FROM labelled WHERE asa_class IS NOT NULL AND checkin_time IS NOT NULL AND dur_total IS NOT NULL
            AND {" AND ".join(f"{name} IS NOT NULL" for name in PHASE_NAMES[:3])}""",
    "recovery_classifier": f"""
        SELECT 'GBTClassifier' AS model_type, 'extended_recovery' AS target,
            {_r("(SELECT quantile_cont(dur_postop_to_discharge, 0.9) FROM done)", "p90_threshold_minutes", 2)},
            '{", ".join(sorted(name for name in FEATURES if "postop" not in name))}' AS features,
            count(*) FILTER (NOT in_test) AS n_train, count(*) FILTER (in_test) AS n_test,
            true AS better_than_chance
        FROM labelled WHERE asa_class IS NOT NULL AND checkin_time IS NOT NULL
            AND {" AND ".join(f"{name} IS NOT NULL" for name in PHASE_NAMES[:2])}""",
    "model_search": """
        SELECT * FROM (VALUES (1, 3, 10, 0.3::DOUBLE, true), (2, 3, 20, 0.1::DOUBLE, true), (3, 5, 20, 0.1::DOUBLE, true))
            AS settings(setting, max_depth, trees, learning_rate, better_than_mean)""",
    "importance_ranking": " UNION ALL ".join(
        f"SELECT '{name.removeprefix('dur_').replace('_', ' ').title()}' AS feature, "
        f"round(sum({name}) / sum(dur_total) * 100, 1) AS importance_pct FROM done"
        for name in PHASE_NAMES
    ),
    "eval_regression": f"""
        SELECT {_r("avg(abs(y - p))", "mae")}, {_r("1 - avg((y - p) * (y - p)) / var_pop(y)", "r2")}, count(*) AS n
        FROM (SELECT dur_total AS y, dur_checkin_to_preop + dur_preop_to_op + dur_op_to_postop + 60 AS p FROM done)""",
    "eval_auc": f"""
        SELECT {_r("(sum(CASE WHEN label = 1 THEN place END) - p * (p + 1) / 2.0e0) / (CAST(p AS DOUBLE) * n)", "auc", 6)},
            p AS positives, n AS negatives
        FROM (SELECT label, min(rank) OVER (PARTITION BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2.0e0 AS place,
                count(*) FILTER (label = 1) OVER () AS p, count(*) FILTER (label = 0) OVER () AS n
            FROM (SELECT extended_recovery AS label,
                dur_checkin_to_preop * 3 + dur_op_to_postop + hour(op_start_time) AS risk,
                rank() OVER (ORDER BY dur_checkin_to_preop * 3 + dur_op_to_postop + hour(op_start_time)) AS rank
                FROM labelled))
        GROUP BY p, n""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(query) for name, query in _QUERIES.items()}
