"""Table schemas, keys and default values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDGE = ["prev", "curr", "type"]

RAW_CLICKS = T.StructType(
    [
        T.StructField("prev", T.StringType()),
        T.StructField("curr", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("n", T.IntegerType()),
    ]
)

FORECAST_FIELDS = [
    T.StructField("forecast_n", T.DoubleType()),
    T.StructField("forecast_lower", T.DoubleType()),
    T.StructField("forecast_upper", T.DoubleType()),
    T.StructField("forecast_error", T.DoubleType()),
    T.StructField("forecast_ratio", T.DoubleType()),
    T.StructField("forecast_flag", T.BooleanType()),
]

# What an anomaly without a forecast carries.
FORECAST_DEFAULTS = {
    "forecast_n": 0.0,
    "forecast_lower": 0.0,
    "forecast_upper": 0.0,
    "forecast_error": 0.0,
    "forecast_ratio": 1.0,
    "forecast_flag": False,
}

FORECASTS = T.StructType(
    [T.StructField(k, T.StringType()) for k in [*EDGE, "month"]] + FORECAST_FIELDS
)

ANOMALIES = T.StructType(
    [
        T.StructField("anomaly_id", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("prev", T.StringType()),
        T.StructField("curr", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("baseline_median", T.DoubleType()),
        T.StructField("deviation_ratio", T.DoubleType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("description", T.StringType()),
        *FORECAST_FIELDS,
    ]
)

GRAPH_SCORES = T.StructType(
    [T.StructField(k, T.StringType()) for k in [*EDGE, "month"]]
    + [
        T.StructField("gnn_score", T.DoubleType()),
        T.StructField("gnn_flag", T.BooleanType()),
    ]
)


def anomaly_id(*parts: Column | str) -> Column:
    """Stable id: equal for the same finding in every run."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep the wanted columns that are there, in the wanted order, once each."""
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns and replace nulls by the given values."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )


def as_anomalies(df: DataFrame) -> DataFrame:
    """Bring a detector's rows to the one anomaly schema."""
    return with_defaults(df, FORECAST_DEFAULTS).to(ANOMALIES)
