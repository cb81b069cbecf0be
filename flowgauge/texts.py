"""The wording of every insight.

``{name}`` marks a value that ``functions.text.fill`` puts in.
"""

HIGH_VARIANCE = {
    "title": "Unpredictable duration: {procedure}",
    "message": (
        "At {facility}, {procedure} shows a standard deviation of {std} minutes (CV {cv}%). "
        "The average case takes {mean} minutes, but 10% of cases exceed {p90} minutes."
    ),
    "impact": (
        "High duration variability makes scheduling unreliable. Downstream cases "
        "are frequently delayed when these procedures overrun, reducing daily throughput "
        "and increasing overtime costs."
    ),
    "action": (
        "1. Stratify cases by surgeon and complexity to identify the source of variation. "
        "2. Consider dedicated block scheduling with 15-20 min buffer for this procedure. "
        "3. Pre-screen complex cases for additional OR time allocation."
    ),
}

LATE_STARTS = {
    "title": "Chronic late starts: {procedure}",
    "message": (
        "At {facility}, {procedure} starts more than 15 minutes past the scheduled time "
        "in {rate} of cases."
    ),
    "impact": (
        "Late surgical starts cascade through the daily schedule, reducing OR utilization "
        "and causing last-case delays. Patients experience longer wait times, "
        "and staff overtime increases."
    ),
    "action": (
        "1. Audit the pre-op preparation timeline — identify where minutes are lost. "
        "2. Verify patient arrival instructions (target 60-90 min before OR time). "
        "3. Ensure pre-op labs and consults are completed the day before. "
        "4. Consider staggering check-in times rather than block-booking."
    ),
}

BOTTLENECK = {
    "title": "Bottleneck: {phase} phase",
    "message": (
        'At {facility}, the "{phase}" phase consumes {pct}% of the total patient journey '
        "({worst} min average out of {total} min total)."
    ),
    "impact": (
        "This phase is the single largest contributor to patient time at {facility}. "
        "A 10-15% reduction would save approximately {saving} minutes per case."
    ),
    # used for a phase that PHASE_ACTIONS does not list
    "action": (
        "Investigate {phase_lower} workflows. "
        "Target reduction of this phase by 10-15% to improve throughput."
    ),
}

PHASE_ACTIONS = {
    "Check-in to Pre-op": (
        "1. Implement digital pre-registration to reduce check-in paperwork. "
        "2. Use a patient-tracking board to flag arrivals immediately. "
        "3. Pre-assign nursing staff to incoming patients."
    ),
    "Pre-op to OR": (
        "1. Ensure the OR is being turned over during pre-op, not sequentially. "
        "2. Standardize the pre-op checklist to eliminate redundant steps. "
        "3. Move anaesthesia assessment earlier in the workflow."
    ),
    "OR to PACU": (
        "1. Review surgical close and handoff protocols for delays. "
        "2. Ensure PACU beds are available before case completion. "
        "3. Streamline the transport and handoff process."
    ),
    "PACU to Discharge": (
        "1. Begin discharge planning during the procedure, not after. "
        "2. Standardize recovery milestones for common procedures. "
        "3. Pre-arrange transport and home care instructions. "
        "4. Set phase-specific time targets and track compliance."
    ),
}

CROSS_FACILITY = {
    "title": "Performance gap: {procedure}",
    "message": (
        "{procedure} at {slow} takes {slow_mean} min on average — {gap} min slower ({gap_pct}%) "
        "than {fast} ({fast_mean} min)."
    ),
    "impact": (
        "If {slow} matched {fast}'s efficiency, "
        "each case would free {gap} minutes of OR and recovery time."
    ),
    "action": (
        "1. Compare {slow} and {fast} protocols side by side for {procedure}. "
        "2. Identify differences in staffing, equipment, or pre-op preparation. "
        "3. Pilot the faster facility's workflow at the slower site."
    ),
}

FACILITY_SUMMARY = {
    "title": "Facility overview: {facility}",
    "message": (
        "{facility} processed {cases} completed cases during the reporting period. "
        "The average patient journey from check-in to discharge is {mean} minutes. "
        "The 90th percentile is {p90} minutes."
    ),
    "impact": "Baseline metric for tracking improvement over time.",
    "action": "No action required — use as a benchmark for future comparisons.",
}

CANCELLATION = {
    "title": "Case cancellation rate",
    "message": "Out of {total} total cases, {count} were cancelled — a rate of {rate}.",
    "impact_raised": (
        "Each cancelled case represents lost OR time, wasted pre-op resources, "
        "and a delayed patient. Industry benchmark is typically under 2%."
    ),
    "impact_normal": "Current rate is within the industry-accepted range of under 2%.",
    "action_raised": (
        "1. Categorize cancellations by root cause (patient no-show, medical, scheduling). "
        "2. Focus on the top two reasons — they typically account for 60%+ of cancellations. "
        "3. Implement day-before confirmation calls and pre-op clearance checklists."
    ),
    "action_normal": "Continue monitoring. Set an alert if the rate exceeds 3%.",
}
