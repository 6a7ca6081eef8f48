"""Fixed values of the citation-cleaning and modelling job.

Everything below must equal the original job's values for results to match:
raw header names, sentinel codes, rewrite rules, ranges and feature order.
They are stated verbatim, in the order the original job lists them.
Library code refers to the *standardized* form of a raw name
(``standardize_name``: strip, lower-case, spaces to underscores).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original job's values)
# ---------------------------------------------------------------------------

# Raw header names that need fixing before any other rename
# (trailing spaces and one misspelling occur in the published CSV exports).
RAW_NAME_FIXES = {
    "Days Parking In Effect    ": "Days Parking In Effect",
    "Days Parkin In Effect": "Days Parking In Effect",
    "Community Council ": "Community Council",
}

# Columns not needed for the model.
UNNEEDED_COLUMNS = [
    "Summons Number", "Plate ID", "Issuer Code", "Vehicle Expiration Date",
    "Violation Precinct", "House Number", "Street Name", "Date First Observed",
    "Law Section", "Sub Division", "Vehicle Color", "Vehicle Year", "Feet From Curb",
    "Violation Post Code", "Violation Description",
]
# Columns with more than 30% missing values.
MISSING_OVER_30 = ["Days Parking In Effect", "From Hours In Effect", "To Hours In Effect"]
# Columns with more than 75% missing values.
MISSING_OVER_75 = [
    "Time First Observed", "Intersecting Street", "Violation Legal Code",
    "Unregistered Vehicle?", "Meter Number", "No Standing or Stopping Violation",
    "Hydrant Violation", "Double Parking Violation", "Latitude", "Longitude",
    "Community Board", "Community Council", "Census Tract", "BIN", "BBL", "NTA",
]
# Columns consumed by feature derivation and no longer needed.
CONSUMED_COLUMNS = ["Year", "Violation_Time", "Issue Date", "Issuer Squad"]

# Raw columns read as numbers (all others are text).
RAW_INTEGER_COLUMNS = [
    "Violation Code", "Street Code1", "Street Code2", "Street Code3",
    "Violation Location", "Violation Precinct", "Issuer Precinct",
]
RAW_LONG_COLUMNS = ["Summons Number"]

# Issue date format (month/day/year) and its split separator.
ISSUE_DATE_FORMAT = "M/d/yyyy"
ISSUE_DATE_SEPARATOR = "/"
# Violation time is hhmm followed by A or P: hour = chars 1-2, meridiem = char 5.
HOUR_POSITION = (1, 2)
MERIDIEM_POSITION = (5, 1)
# Hours outside (0, 12] are replaced by this value.
HOUR_RANGE = (0.0, 12.0)
HOUR_FILL = 1.0
# Years kept, both bounds exclusive.
YEAR_RANGE = (2012, 2015)

# Sentinel codes whose rows are removed (comparison also removes nulls).
SENTINELS = {
    "Registration State": "99",
    "Plate Type": "999",
    "Violation County": "103",
}

# Ordered rewrite rules for the county target, applied as unanchored
# substring replacements, one after the other.
COUNTY_RULES = [
    ("KINGS", "K"),
    ("QUEEN", "Q"),
    ("BRONX", "BX"),
    ("RC", "R"),
    ("RICH", "R"),
    ("NYC", "NY"),
]

TARGET_COLUMN = "Violation County"
# Numeric features used as they are (not indexed).
NUMERIC_FEATURES = ["Month", "Day", "Time_Hour"]

# Model feature order (17 slots): the numeric features, then category indices.
FEATURE_ORDER = [
    "Month", "Day", "Time_Hour",
    "Violation_In_Front_Of_Or_Opposite_index", "Street_Code1_index", "Issuer_Command_index",
    "Violation_Location_index", "Vehicle_Body_Type_index", "Meridiem_index",
    "Registration_State_index", "Plate_Type_index", "Issuer_Precinct_index",
    "Street_Code2_index", "Issuing_Agency_index", "Violation_Code_index",
    "Vehicle_Make_index", "Street_Code3_index",
]

# Cleaned table header, in order.
CLEANED_HEADER = [
    "Registration_State", "Plate_Type", "Violation_Code", "Vehicle_Body_Type", "Vehicle_Make",
    "Issuing_Agency", "Street_Code1", "Street_Code2", "Street_Code3", "Violation_Location",
    "Issuer_Precinct", "Issuer_Command", "Violation_County", "Violation_In_Front_Of_Or_Opposite",
    "Month", "Day", "Meridiem", "Time_Hour",
]

# Column batches of the row synthesizer (9 + 9 columns).
SYNTH_BATCHES = [
    ["Registration_State", "Plate_Type", "Violation_Code", "Vehicle_Body_Type", "Vehicle_Make",
     "Issuing_Agency", "Street_Code1", "Street_Code2", "Street_Code3"],
    ["Violation_Location", "Issuer_Precinct", "Issuer_Command", "Violation_County",
     "Violation_In_Front_Of_Or_Opposite", "Month", "Day", "Meridiem", "Time_Hour"],
]

# Model settings.
FOREST_TREES = 20
TREE_DEPTH = 5
MAX_BINS = 6700
TRAIN_FRACTION = 0.8
# Stream trigger interval.
STREAM_TRIGGER = "15 seconds"
# Attribution settings: rows explained, background rows, coalition samples, class.
EXPLAIN_ROWS = 5
BACKGROUND_ROWS = 100
ATTRIBUTION_SAMPLES = 50_000
TARGET_CLASS = 1
# Synthesis: lines generated per batch (learnt from the whole cleaned table).
SYNTH_LINES = 2_000
# Sample export size.
SAMPLE_EXPORT_ROWS = 10_000

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


def standardize_name(name: str) -> str:
    """Library form of a raw column name: strip, lower-case, spaces to '_'."""
    return name.strip().lower().replace(" ", "_")


def std(names):
    """Standardize a list of raw names."""
    return [standardize_name(n) for n in names]


# Derived, standardized views used throughout the library.
DROP_COLUMNS = std(MISSING_OVER_75 + MISSING_OVER_30 + UNNEEDED_COLUMNS + CONSUMED_COLUMNS)
TARGET = standardize_name(TARGET_COLUMN)
FEATURES = std(FEATURE_ORDER)
NUMERIC = std(NUMERIC_FEATURES)
CLEANED_COLUMNS = std(CLEANED_HEADER)
CATEGORY_COLUMNS = [c for c in CLEANED_COLUMNS if c not in NUMERIC and c != TARGET]
SENTINEL_VALUES = {standardize_name(k): v for k, v in SENTINELS.items()}
BATCHES = [std(b) for b in SYNTH_BATCHES]
