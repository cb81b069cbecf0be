"""Small lookup tables a user's own tables can replace.

The procedure catalog (one row per procedure with its log-normal parameters) is
not listed here; it is a parameter, read with ``sources.readers.read_catalog``.
"""

# facility_id, facility_name, timezone
FACILITIES = [
    ("HOSP_A", "Metro General Ambulatory Center", "America/New_York"),
    ("HOSP_B", "Lakeside Outpatient Surgery Center", "America/Chicago"),
    ("HOSP_C", "Pacific Coast Surgical Institute", "America/Los_Angeles"),
]

# facility_id, smallest and largest expected number of cases on a weekday
DAILY_VOLUME = [
    ("HOSP_A", 60, 100),
    ("HOSP_B", 40, 80),
    ("HOSP_C", 50, 90),
]

# facility_id, service_line, weight; every other pair weighs 1.0
SERVICE_LINE_BIAS = [
    ("HOSP_A", "GI", 2.0),
    ("HOSP_A", "Ophthalmology", 1.5),
    ("HOSP_A", "Dermatology", 1.5),
    ("HOSP_B", "Orthopedics", 2.0),
    ("HOSP_B", "Pain", 2.0),
    ("HOSP_B", "General", 1.5),
    ("HOSP_C", "ENT", 1.5),
    ("HOSP_C", "Urology", 1.5),
    ("HOSP_C", "Gynecology", 1.5),
    ("HOSP_C", "Cardiology", 1.5),
]
DEFAULT_BIAS = 1.0

# service_line, anesthesia_type, weight
ANESTHESIA_MIX = [
    ("GI", "MAC", 0.6),
    ("GI", "Conscious sedation", 0.3),
    ("GI", "General", 0.1),
    ("Ophthalmology", "Topical", 0.4),
    ("Ophthalmology", "Local", 0.3),
    ("Ophthalmology", "MAC", 0.3),
    ("ENT", "General", 0.7),
    ("ENT", "MAC", 0.2),
    ("ENT", "Local", 0.1),
    ("Orthopedics", "General", 0.4),
    ("Orthopedics", "Regional", 0.4),
    ("Orthopedics", "MAC", 0.2),
    ("Pain", "Local", 0.5),
    ("Pain", "MAC", 0.3),
    ("Pain", "Conscious sedation", 0.2),
    ("Urology", "General", 0.3),
    ("Urology", "MAC", 0.3),
    ("Urology", "Spinal", 0.2),
    ("Urology", "Local", 0.2),
    ("Gynecology", "General", 0.5),
    ("Gynecology", "MAC", 0.3),
    ("Gynecology", "Regional", 0.2),
    ("Dermatology", "Local", 0.7),
    ("Dermatology", "MAC", 0.2),
    ("Dermatology", "Conscious sedation", 0.1),
    ("General", "General", 0.6),
    ("General", "MAC", 0.2),
    ("General", "Regional", 0.2),
    ("Cardiology", "MAC", 0.4),
    ("Cardiology", "Conscious sedation", 0.3),
    ("Cardiology", "General", 0.3),
]

# relative number of check-ins per hour of day, hours 0 to 23
CHECKIN_HOUR_WEIGHTS = [
    0.0, 0.0, 0.0, 0.0, 0.0, 0.5,
    3.0, 5.0, 5.0, 4.0, 3.0, 2.5,
    2.0, 2.0, 1.5, 1.0, 0.5, 0.2,
    0.0, 0.0, 0.0, 0.0, 0.0, 0.0,
]

# share of cases per ASA class 1 to 6
ASA_WEIGHTS = [0.15, 0.40, 0.30, 0.12, 0.02, 0.01]

# bounds, in minutes, of a plausible phase duration
DURATION_BOUNDS = (3.0, 600.0)

# report tabs: insight type, label
INSIGHT_TABS = [
    ("all", "All Findings"),
    ("bottleneck", "Bottlenecks"),
    ("high_variance", "Duration Variability"),
    ("late_starts", "Late Starts"),
    ("cross_facility", "Facility Comparisons"),
    ("cancellation_rate", "Cancellations"),
    ("facility_summary", "Facility Overviews"),
]

# model search: depth, trees, learning rate, row share, feature share
SEARCH_GRID = [
    {"max_depth": 6, "n_estimators": 800, "learning_rate": 0.05},
    {"max_depth": 10, "n_estimators": 1000, "learning_rate": 0.03},
    {"max_depth": 12, "n_estimators": 600, "learning_rate": 0.1, "subsample": 0.7},
    {"max_depth": 8, "n_estimators": 1200, "learning_rate": 0.02, "colsample": 0.6},
]
