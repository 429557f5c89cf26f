"""Thresholds, word lists, patterns and labels that decide the results."""

# --- fixed values: type inference -------------------------------------------------
DATE_PATTERNS = (
    r"^\d{4}-\d{2}-\d{2}$",
    r"^\d{2}[./-]\d{2}[./-]\d{4}$",
    r"^\d{4}[./-]\d{2}[./-]\d{2}",
)
ID_PATTERNS = (
    r"^[A-Z]{2,4}-[A-Z0-9]{4,}",
    r"^[A-Z0-9]+-\d+$",
    r"^\d{6,}$",
    r"^[A-F0-9]{8}-",
)
CONTROL_CHARACTERS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f�]"
NUMBER_PATTERN = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?$"
INFINITY_PATTERN = r"^[+-]?(?i:inf(?:inity)?)$"

DATE_RATIO = 0.7
NUMERIC_RATIO = 0.85
ID_RATIO = 0.6
CATEGORICAL_RATIO = 0.3
CATEGORICAL_MAX_VALUES = 30

# --- fixed values: column-name hints ----------------------------------------------
PRIMARY_KEY_NAMES = ("code", "id", "key", "ref", "number", "num")
FOREIGN_KEY_NAMES = ("code", "id", "key", "ref", "type")
FLOW_NAMES = ("quantity", "qty", "volume", "units")
POSITIVE_NAMES = ("price", "value", "ratio", "rate", "amount", "volume", "pct")

# --- fixed values: thresholds -----------------------------------------------------
PRIMARY_KEY_UNIQUE_PCT = 99.0
FOREIGN_KEY_UNIQUE_PCT = 80.0
MIN_ROWS_PRIMARY_KEY = 5
MIN_ROWS_CARDINALITY = 15
MIN_ROWS_DUPLICATE_KEY = 10
HIGH_CARDINALITY_RATIO = 0.5
HIGH_CARDINALITY_VALUES = 20
FENCE_MULTIPLIER = 3
OUTLIER_MEDIUM_SHARE = 0.05
MIN_DATES_FOR_GAPS = 5
MAX_DAILY_MEDIAN_DAYS = 2
MAX_UNREPORTED_GAPS = 3
ZSCORE_LIMIT = 3
BENFORD_MIN_ROWS = 30
RANGE_DRIFT_SHARE = 0.5

# --- fixed values: relationship rules ---------------------------------------------
NAME_SPLIT_PATTERN = r"[-_\s]"
MATCH_FLOOR_PCT = 5
MATCH_WEAK_PCT = 20
MATCH_MEDIUM_PCT = 50
MATCH_HIGH_PCT = 80
MATCH_SURE_PCT = 95
NAME_SIMILAR = 0.5
NAME_STRONG = 0.7

# --- fixed values: result sizes ---------------------------------------------------
TOP_VALUES = 10
SAMPLE_VALUES = 5
DICTIONARY_SAMPLES = 3
EXAMPLES = 5
SNIPPET_ROWS = 5
INVENTORY_COLUMNS = 5
OVERVIEW_SUGGESTION_CHARS = 80

# --- fixed values: order and priority of severities -------------------------------
SEVERITY_RANK = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}

# --- fixed values: text tokens a CSV reader takes as missing ----------------------
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- fixed values: the expected tables and columns of the portfolio model ---------
EXPECTED_SCHEMA = {
    "transactions": [
        "transaction-code", "portfolio-code", "product-code",
        "transaction-quantity", "transaction-price", "transaction-date",
    ],
    "products": [
        "product-code", "product-type", "product-currency",
        "product-issuer-code", "loan-property-value-ratio",
    ],
    "portfolios": ["portfolio-code", "portfolio-currency"],
    "fx": ["price-date", "EURUSD"],
    "prices": ["price-date", "P1-EUR", "P2-USD"],
}
VERSION_SUFFIX = r"(?i)_v\d+$"

# --- fixed values: registry of checks (number, name, category) --------------------
CHECK_REGISTRY = (
    ("CHK-01", "Null Detection", "COMPLETENESS"),
    ("CHK-02", "IQR Outlier Detection", "OUTLIER"),
    ("CHK-03", "Z-Score Outlier Detection", "OUTLIER"),
    ("CHK-04", "Benford's Law Analysis", "STATISTICAL"),
    ("CHK-05", "Coefficient of Variation", "STATISTICAL"),
    ("CHK-06", "Negative Value Detection", "INTEGRITY"),
    ("CHK-07", "Date Parse Validation", "COMPLETENESS"),
    ("CHK-08", "Future Date Detection", "INTEGRITY"),
    ("CHK-09", "Business-Day Gap Detection", "TEMPORAL"),
    ("CHK-10", "Duplicate Row Detection", "INTEGRITY"),
    ("CHK-11", "Primary Key Duplicate Detection", "INTEGRITY"),
    ("CHK-12", "Referential Integrity", "REFERENTIAL"),
    ("CHK-13", "Temporal Alignment", "TEMPORAL"),
    ("CHK-14", "Disconnected Table Detection", "ARCHITECTURE"),
    ("CHK-15", "Schema Drift Detection", "GOVERNANCE"),
    ("CHK-16", "Value Set Drift", "GOVERNANCE"),
    ("CHK-17", "Numeric Range Drift", "GOVERNANCE"),
    ("CHK-18", "Business Rules Validation", "CONFIG"),
    ("CHK-19", "Mixed Type Detection", "STRUCTURE"),
    ("CHK-20", "Encoding Issue Detection", "STRUCTURE"),
)

# --- fixed values: wording of findings; {x:2} shows x with two decimals ------------
FINDING_TEXT = {
    "empty_rows": "{fully_empty_rows} fully empty row(s) found",
    "duplicate_rows": "{duplicate_rows} fully duplicate row(s) detected",
    "duplicate_keys": "{duplicate_pk_rows} rows share a duplicate inferred primary key [{likely_pk}]",
    "nulls": "{null_count} null(s) in [{column}] ({null_pct:1}% of rows)",
    "outliers": "{outlier_count} statistical outlier(s) in [{column}] (3×IQR fence: [{outlier_fence_lo:4} → {outlier_fence_hi:4}])",
    "negatives": "{negative_count} negative value(s) in [{column}] — unexpected for this field",
    "unparsed_dates": "{date_parse_fail} value(s) in [{column}] could not be parsed as dates",
    "future_dates": "{date_future} future date(s) in [{column}]",
    "date_gaps": "{date_gaps} business-day gap(s) in date sequence of [{column}]",
    "mixed_types": "[{column}] contains mixed types — some values cannot be parsed as {inferred_type}",
    "high_cardinality": "[{column}] has high cardinality ({unique_count} unique values) for a categorical field",
    "orphans": "{orphan_rows} value(s) in [{table}.{column}] not found in [{to_table}.{to_column}] — {orphan_values} orphaned codes",
    "start": "[{table}.{column}] starts {own_date} — [{reference_table}.{reference_column}] goes back to {reference_date} ({gap_days}-day gap)",
    "end": "[{table}.{column}] ends {own_date} — [{reference_table}.{reference_column}] goes up to {reference_date} ({gap_days}-day gap)",
    "isolated": "[{table}] has no direct key relationship to other tables",
}

# --- wording of the findings and suggestions of configured rules --------------------
RULE_TEXT = {
    "missing_column": "[{id}] [{table}] lacks the column [{column}] that a rule calls for",
    "unknown_values": "[{id}] [{column}] has {values} value(s) outside the allowed set, listed in [unknown_values]",
    "value_range": "[{id}] [{column}] has {outside} value(s) outside [{min}, {max}]",
}
RULE_SUGGESTION = {
    "missing_column": "Add [{column}] to [{table}], or take the rule out of the configuration.",
    "unknown_values": "Extend the allowed set or correct the listed values of [{column}].",
    "value_range": "Check the bounds of [{column}].",
}

# --- fixed values: names of the statistics of a finding ----------------------------
FINDING_STATISTICS = {
    "empty_rows": {"Empty rows": "{fully_empty_rows}", "Total rows": "{row_count}"},
    "duplicate_rows": {"Duplicate rows": "{duplicate_rows}", "Total rows": "{row_count}"},
    "duplicate_keys": {"Duplicate key rows": "{duplicate_pk_rows}", "Key column": "{likely_pk}"},
    "nulls": {
        "Null count": "{null_count}", "Null %": "{null_pct:1}%", "Total rows": "{row_count}",
    },
    "outliers": {
        "Q1 (25th percentile)": "{num_q1:4}",
        "Q3 (75th percentile)": "{num_q3:4}",
        "IQR": "{num_iqr:4}",
        "Lower fence (Q1 − 3×IQR)": "{outlier_fence_lo:4}",
        "Upper fence (Q3 + 3×IQR)": "{outlier_fence_hi:4}",
        "Outlier count": "{outlier_count}",
        "Min value": "{num_min:4}",
        "Max value": "{num_max:4}",
    },
    "negatives": {"Negative count": "{negative_count}", "Column min": "{num_min:4}"},
    "unparsed_dates": {"Parse failures": "{date_parse_fail}"},
    "future_dates": {"Future date count": "{date_future}", "Column max date": "{date_max}"},
    "date_gaps": {"Business-day gaps": "{date_gaps}", "Date range": "{date_min} → {date_max}"},
    "mixed_types": {"Inferred type": "{inferred_type}"},
    "high_cardinality": {
        "Unique values": "{unique_count}", "Unique %": "{unique_pct:1}%",
        "Total rows": "{row_count}",
    },
    "orphans": {
        "Orphaned values": "{orphan_values}", "Affected rows": "{orphan_rows}",
        "Relationship confidence": "{confidence}", "Detection reason": "{reason}",
    },
    "isolated": {
        "Date columns found": "{found_dates}",
        "Reason": "It has no key column in common with any other table",
    },
}
