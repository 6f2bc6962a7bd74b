"""Job configuration and the fixed column vocabularies of the trip model.

Everything here is plain data: operators take a ``TripSettings`` (or its
fields) as arguments instead of reading environment variables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the original trip-duration model (feature order is the model's input order).
# ---------------------------------------------------------------------------

# Model input order: alphabetical, as a sorting dict vectorizer produces it.
ORDERED_FEATURE_NAMES = [
    "cbd_congestion_fee",
    "congestion_surcharge",
    "fare_amount",
    "improvement_surcharge",
    "store_and_fwd_flag_encoded",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "trip_distance",
]

# Columns that go missing together in incomplete records (the "null block").
NULL_BLOCK_COLUMNS = [
    "store_and_fwd_flag",
    "RatecodeID",
    "passenger_count",
    "payment_type",
    "trip_type",
    "congestion_surcharge",
]

# Columns removed by feature encoding (ids, timestamps, derived, target).
EXCLUDED_COLUMNS = [
    "VendorID",
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "payment_type",
    "payment_type_name",
    "trip_type",
    "pickup_hour",
    "pickup_day_of_week",
    "total_amount_difference",
    "expected_total_amount",
    "RatecodeID_name",
    "trip_type_name",
    "tip_percentage",
    "extra",
    "mta_tax",
    "ehail_fee",
    "trip_duration",
]

# Numeric record keys copied (as doubles) when normalising a record.
RECORD_NUMERIC_KEYS = [
    "cbd_congestion_fee",
    "improvement_surcharge",
    "trip_distance",
    "congestion_surcharge",
    "tolls_amount",
    "fare_amount",
    "tip_amount",
    "total_amount",
]

# Money columns profiled together.
MONETARY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
    "total_amount",
]

# Components that should add up to total_amount (summed in this order).
FARE_COMPONENTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
]

# Excluded from the correlation matrix: ids/codes and derived columns.
CORRELATION_EXCLUDED = [
    "VendorID",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "payment_type",
    "trip_type",
    "pickup_hour",
    "pickup_day_of_week",
    "expected_total_amount",
    "total_amount_difference",
    "tip_percentage",
]

# Monday = 0 ... Sunday = 6.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Code tables (public NYC TLC data dictionary for green taxi trips).
RATECODE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
PAYMENT_TYPE_NAMES = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
TRIP_TYPE_NAMES = {1: "Street-hail", 2: "Dispatch"}

# Request contract: the validated fields in declaration order, their bounds and
# defaults (None = required). Bounds: (exclusive lower, inclusive lower, exclusive upper).
REQUEST_FIELDS = [
    # name, default, gt, ge, lt
    ("trip_distance", None, 0.0, None, 200.0),
    ("fare_amount", None, None, 0.0, None),
    ("total_amount", None, None, 0.0, None),
    ("store_and_fwd_flag", "N", None, None, None),
    ("tip_amount", 0.0, None, 0.0, None),
    ("tolls_amount", 0.0, None, 0.0, None),
    ("improvement_surcharge", 1.0, None, 0.0, None),
    ("congestion_surcharge", 0.0, None, 0.0, None),
    ("cbd_congestion_fee", 0.0, None, 0.0, None),
]
FLAG_PATTERN = "^[YNyn]$"
BATCH_MIN_TRIPS = 1
BATCH_MAX_TRIPS = 1000
# Distance above which a scored trip is outside the training range.
OUT_OF_RANGE_DISTANCE = 100.0

# Validation messages (public text of the request validation library).
MSG_REQUIRED = "Field required"
MSG_NUMBER = "Input should be a valid number"
MSG_NUMBER_PARSE = "Input should be a valid number, unable to parse string as a number"
MSG_STRING = "Input should be a valid string"
MSG_GT = "Input should be greater than {}"
MSG_GE = "Input should be greater than or equal to {}"
MSG_LT = "Input should be less than {}"
MSG_PATTERN = "String should match pattern '{}'"
MSG_LIST_MIN = "List should have at least {} item after validation, not {}"
MSG_LIST_MAX = "List should have at most {} items after validation, not {}"

MODEL_TYPES = ("linear_regression", "random_forest")


@dataclass(frozen=True)
class TripSettings:
    """Operator arguments for a training / cleaning job."""

    pickup_col: str = "lpep_pickup_datetime"
    dropoff_col: str = "lpep_dropoff_datetime"
    target_col: str = "trip_duration"
    key_col: str = "trip_id"
    duration_min: float = 0.0
    duration_max_quantile: float = 0.995
    distance_min: float = 0.0
    test_size: float = 0.2
    val_size: float = 0.25
    random_state: int = 42
    model_type: str = "random_forest"
    n_estimators: int = 100
    # Tree settings that reproduce "grow until pure" as far as Spark allows.
    max_depth: int = 30
    max_bins: int = 256
    model_version: str = "0.1.0"
    feature_names: list[str] = field(default_factory=lambda: list(ORDERED_FEATURE_NAMES))
    # Rows per partition of a fit; the partition count follows the row count, so
    # the same data give the same partitions (see model.py). ``fit_partitions``
    # overrides it.
    rows_per_fit_partition: int = 50_000
    fit_partitions: int | None = None
    # Where the trips are read from unless a path is given.
    data_path: str = "data/trips.parquet"
    # None: exact, linearly interpolated quantile (the default, same as the
    # reference). An integer: percentile_approx with this accuracy, for
    # continuous columns whose distinct values are unbounded.
    quantile_accuracy: int | None = None

    def with_(self, **kw) -> "TripSettings":
        return replace(self, **kw)


DEFAULT_SETTINGS = TripSettings()
