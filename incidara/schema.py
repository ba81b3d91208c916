"""Column names and types of the incident table."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# The published file's column names, with the names and types used here.
INCIDENT_COLUMNS = [
    ("ID", "id", T.StringType()),
    ("Start_Time", "start_time", T.TimestampType()),
    ("End_Time", "end_time", T.TimestampType()),
    ("Severity", "severity", T.IntegerType()),
    ("City", "city", T.StringType()),
    ("State", "state", T.StringType()),
    ("Distance(mi)", "distance_mi", T.DoubleType()),
    ("Temperature(F)", "temperature_f", T.DoubleType()),
    ("Humidity(%)", "humidity_pct", T.DoubleType()),
    ("Visibility(mi)", "visibility_mi", T.DoubleType()),
    ("Precipitation(in)", "precipitation_in", T.DoubleType()),
    ("Weather_Condition", "weather_condition", T.StringType()),
]

INCIDENTS = T.StructType([T.StructField(name, kind) for _, name, kind in INCIDENT_COLUMNS])

# The weather measures that are imputed.
WEATHER_MEASURES = ["temperature_f", "humidity_pct", "visibility_mi", "precipitation_in"]

# Panel column -> incident column it averages.
PANEL_MEASURES = {
    "temp": "temperature_f",
    "humidity": "humidity_pct",
    "visibility": "visibility_mi",
    "precip": "precipitation_in",
    "sever": "severity",
}

# Names of the published result tables.
RESULT_NAMES = {
    "city": "City",
    "date": "Date",
    "state": "State",
    "accident_count": "Accident_Count",
    "temp": "Temp",
    "humidity": "Humidity",
    "visibility": "Visibility",
    "precip": "Precip",
    "sever": "Sever",
    "accident_count_log": "Accident_Count_Log",
    "total_accidents": "Total_Accidents",
    "feature": "Feature",
    "importance": "Importance",
    "hour": "Hour",
    "actual_avg_duration": "Actual_Avg_Duration",
    "predicted_avg_duration": "Predicted_Avg_Duration",
}

# The hourly result file uses these names.
HOURLY_RESULT_NAMES = {"hours": "Hours", "severity": "Severity", "accident_count": "Accident Count"}

IMPORTANCES = T.StructType(
    [T.StructField("Feature", T.StringType()), T.StructField("Importance", T.DoubleType())]
)

# Header of the cluster profile file.
CLUSTER_PROFILE = T.StructType(
    [T.StructField("Cluster", T.IntegerType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "Mean Temperature (F)",
            "Mean Humidity (%)",
            "Mean Severity",
            "Mean Visibility (mi)",
            "Mean Precipitation (in)",
        )
    ]
)


def with_incident_names(df: DataFrame) -> DataFrame:
    """Incident columns under the names of the published file."""
    return df.withColumnsRenamed({name: original for original, name, _ in INCIDENT_COLUMNS})


def with_library_names(df: DataFrame) -> DataFrame:
    """Incident columns of a published file under the names used here."""
    return df.withColumnsRenamed({original: name for original, name, _ in INCIDENT_COLUMNS})


def with_result_names(df: DataFrame, names: dict[str, str] = RESULT_NAMES) -> DataFrame:
    """Result columns under their published names."""
    return df.withColumnsRenamed(names)
