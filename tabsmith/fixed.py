"""Fixed values that results depend on.

These are rules and thresholds stated by the behaviour we reproduce; they are
kept together so that every operator reads the same numbers.
"""

# --- fixed values: column dropping ------------------------------------------
ID_NAME_HINTS = ("id", "index", "serial", "key", "no.")
HIGH_NULL_PCT = 60.0          # drop a column whose null percent is above this
CONSTANT_MAX_DISTINCT = 1     # drop a column with at most this many values

# --- fixed values: task rules -----------------------------------------------
CLASS_MAX_DISTINCT = 15       # <= this many values: classification / one-hot
ALGORITHM_CLASSIFICATION_WORDS = ("classifier", "classification", "logistic", "svc")

# --- fixed values: text cleaning --------------------------------------------
FORMATTED_FAIL_SHARE = 0.5    # revert the numeric parse if more than this fails
FORMATTED_MATCH_SHARE = 0.5   # apply the parse only if this share looks formatted
FORMATTED_PATTERN = r"^[$€£]?\s*[0-9][0-9,]*(\.[0-9]+)?\s*(%|[A-Za-z]{1,4})?$"
FORMATTED_SIGNED_PATTERN = r"^-?[$€£]?\s*-?[0-9][0-9,]*(\.[0-9]+)?\s*(%|[A-Za-z]{1,4})?$"
LONG_TEXT_MEAN_WORDS = 3.0    # truncate a column whose mean word count is above this
LONG_TEXT_KEEP_WORDS = 2      # ... to this many words
BOOLEAN_TRUE_WORDS = ("yes", "y")
BOOLEAN_FALSE_WORDS = ("no", "n")

# --- fixed values: dates ----------------------------------------------------
DATE_NAME_HINTS = ("date", "time", "year", "month", "day", "timestamp")
DATE_MIN_PARSED_SHARE = 0.8
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MM-yyyy",
    "dd.MM.yyyy",
    "yyyy-MM",
    "yyyy",
)
# the text shape each format can accept (a superset, checked before parsing)
DATE_FORMAT_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    "yyyy-MM-dd": r"^[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}$",
    "yyyy/MM/dd": r"^[0-9]{4,}/[0-9]{1,2}/[0-9]{1,2}$",
    "MM/dd/yyyy": r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4,}$",
    "dd-MM-yyyy": r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4,}$",
    "dd.MM.yyyy": r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4,}$",
    "yyyy-MM": r"^[0-9]{4,}-[0-9]{1,2}$",
    "yyyy": r"^[0-9]{4,}$",
}

# --- fixed values: missing values and outliers -----------------------------
MEDIAN_SKEW_ABOVE = 1.0       # numeric fill uses the median above this skew
UNKNOWN_LABEL = "Unknown"
IQR_FACTOR = 1.5

# --- fixed values: CSV null tokens (the pandas default list) ---------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- fixed values: sources --------------------------------------------------
TABLE_SUFFIXES = (".csv", ".xlsx", ".xls", ".parquet")
SAMPLE_SIZE = 10
SAMPLE_WINDOW = 1000

# --- fixed values: split ----------------------------------------------------
TEST_SHARE = 0.2
SEED = 42
TINY_TABLE_ROWS = 5           # below this, train = test = the whole table

# --- fixed values: display --------------------------------------------------
PREFERRED_DISPLAY_COLUMNS = ("Open", "High", "Low", "Volume")
DISPLAY_FALLBACK_COUNT = 3
PRED_PREFIX = "Pred_"

# --- fixed values: verdict --------------------------------------------------
BINARY_MIN_ACCURACY = 0.55
MULTICLASS_MIN_ACCURACY = 0.45
MIN_R2 = 0.0                  # regression passes when R2 is above this

# --- fixed values: scorecard text and log filtering ------------------------
SCORECARD_START = "=== START OF MODEL PERFORMANCE SCORECARD ==="
SCORECARD_HEADER = "=== MODEL PERFORMANCE SCORECARD ==="
SCORECARD_END = "=== END OF MODEL PERFORMANCE SCORECARD ==="
SCORECARD_RULE = "=" * 35
SCORECARD_KEYWORDS = (
    "scorecard", "strategy", "framework", "target", "accuracy", "precision",
    "recall", "f1", "error", "squared", "r-squared", "r2", "mae", "mse", "====",
)
SCORECARD_WRAPPER_WORDS = ("start of model", "end of model")
SCORECARD_MAX_LINES = 100
FALLBACK_TAIL_LINES = 15
STATUS_LINE_WORDS = "model trained and saved"
LOG_TIMESTAMP_PATTERN = r"\[?\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\]?"
LOG_EDGE_PATTERN = r"^[:\-\s]+|[:\-\s]+$"

# --- fixed values: metric labels in the scorecard --------------------------
METRIC_LABELS = {
    "accuracy": "Accuracy Score",
    "precision": "Precision Score (Weighted)",
    "recall": "Recall Score (Weighted)",
    "f1": "F1 Score (Weighted)",
    "mse": "Mean Squared Error (MSE)",
    "mae": "Mean Absolute Error (MAE)",
    "r2": "R-squared (R2) Score",
}
