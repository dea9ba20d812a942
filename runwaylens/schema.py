"""Column layout of the fact table and of the run log, and the role each column plays."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The fact columns in storage order with their types.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("fl_date", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("op_unique_carrier", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("dest", T.StringType()),
        T.StructField("dep_delay", T.DoubleType()),
        T.StructField("arr_delay", T.DoubleType()),
        T.StructField("cancelled", T.DoubleType()),
        T.StructField("cancellation_code", T.StringType()),
        T.StructField("carrier_delay", T.DoubleType()),
        T.StructField("weather_delay", T.DoubleType()),
        T.StructField("nas_delay", T.DoubleType()),
        T.StructField("security_delay", T.DoubleType()),
        T.StructField("late_aircraft_delay", T.DoubleType()),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()
NUMBER_COLUMNS = [
    "dep_delay",
    "arr_delay",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
]
CODE_COLUMNS = ["op_unique_carrier", "origin", "dest", "cancellation_code"]
MANDATORY_COLUMNS = ["fl_date", "op_unique_carrier", "origin"]
RANGE_COLUMNS = ["dep_delay", "arr_delay"]

# Accepted delay range in minutes, and the range shown in histograms.
DELAY_RANGE = (-120.0, 1440.0)
HISTOGRAM_CLIP = (-60.0, 300.0)
HISTOGRAM_BINS = 80

# Cell texts that stand for a missing value in a raw CSV.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The characters that count as whitespace around a code.
# Forms of dates other than year-month-day, tried in order.
DATE_FORMATS = ["M/d/yyyy", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "yyyy/M/d", "yyyyMMdd", "d.M.yyyy"]
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Cancellation codes and month names.
CANCELLATION_LABELS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}
MONTH_LABELS = ["Gen", "Feb", "Mar", "Apr", "Mag", "Giu", "Lug", "Ago", "Set", "Ott", "Nov", "Dic"]

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("analysis", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("input_file", T.StringType()),
        T.StructField("input_size_mb", T.DoubleType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("elapsed_sec", T.DoubleType()),
        T.StructField("exit_code", T.IntegerType()),
        T.StructField("notes", T.StringType()),
    ]
)
RUN_KEY = ["analysis", "technology", "environment", "input_file"]

# The label of the whole data set, and the sizes in ascending order.
FULL_LABEL = "full_dataset"
SAMPLE_ORDER = [
    "sample_010pct",
    "sample_025pct",
    "sample_050pct",
    "full_dataset",
    "sample_125pct",
    "sample_150pct",
]
SAMPLE_FRACTIONS = [0.10, 0.25, 0.50, 1.25, 1.50]
SAMPLE_SEED = 42


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a report; defaults fit the flight fact table."""

    entity: str = "op_unique_carrier"
    site: str = "origin"
    period: str = "month"
    measure: str = "dep_delay"
    second_measure: str = "arr_delay"
    flag: str = "cancelled"
    causes: dict[str, str] = field(
        default_factory=lambda: {
            "carrier": "carrier_delay",
            "weather": "weather_delay",
            "nas": "nas_delay",
            "security": "security_delay",
            "late_aircraft": "late_aircraft_delay",
        }
    )


FLIGHT_ROLES = Roles()
