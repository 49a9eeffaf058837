"""Category bands, alert and advisory ladders, display texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.calendar import flag

# Upper edges of the category flags.
CATEGORY_EDGES = {
    "aqi_good": (None, 50),
    "aqi_moderate": (50, 100),
    "aqi_unhealthy_sensitive": (100, 150),
    "aqi_unhealthy": (150, 200),
    "aqi_very_unhealthy": (200, 300),
    "aqi_hazardous": (300, None),
}
# Label, colour, displayed range, lower and upper edge.
CATEGORIES = (
    ("Good", "green", 0, 50, None, 50.0),
    ("Moderate", "yellow", 51, 100, 50.0, 100.0),
    ("Unhealthy for Sensitive", "orange", 101, 150, 100.0, 150.0),
    ("Unhealthy", "red", 151, 200, 150.0, 200.0),
    ("Very Unhealthy", "purple", 201, 300, 200.0, 300.0),
    ("Hazardous", "maroon", 301, 500, 300.0, None),
)
# Default thresholds.
THRESHOLDS = {
    "good": 50,
    "moderate": 100,
    "unhealthy_sensitive": 150,
    "unhealthy": 200,
    "very_unhealthy": 300,
    "hazardous": 150,
}
# Level, kind, status text, message before and after the value.
LADDER = (
    ("hazardous", "error", "HAZARDOUS", "🚨 HAZARDOUS AQI: ",
     " - Immediate health warning! Everyone may experience more serious health effects."),
    ("very_unhealthy", "error", "VERY UNHEALTHY", "⚠️ VERY UNHEALTHY AQI: ",
     " - Health alert! Everyone may begin to experience more serious health effects."),
    ("unhealthy", "error", "UNHEALTHY", "⚠️ UNHEALTHY AQI: ",
     " - Everyone may begin to experience health effects."),
    ("unhealthy_sensitive", "warning", "UNHEALTHY FOR SENSITIVE GROUPS",
     "⚡ UNHEALTHY FOR SENSITIVE GROUPS AQI: ",
     " - Sensitive groups may experience health effects."),
    ("moderate", "success", "MODERATE", "ℹ️ MODERATE AQI: ",
     " - Air quality is acceptable for most."),
    ("good", "success", "GOOD", "✅ GOOD AQI: ", " - Air quality is satisfactory."),
)
BANNER_LEVELS = ("hazardous", "very_unhealthy", "unhealthy")
ADVISORY_LEVELS = ("unhealthy", "unhealthy_sensitive", "moderate")


def category_flags(value: Column) -> dict[str, Column]:
    out = {}
    for name, (low, high) in CATEGORY_EDGES.items():
        above = F.lit(True) if low is None else value > low
        below = F.lit(True) if high is None else value <= high
        out[name] = flag(above & below & value.isNotNull())
    return out


def add_category_flags(df: DataFrame, column: str = "aqi") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumns(category_flags(F.col(column)))


def category(value: Column) -> Column:
    """Struct of label, colour and displayed range; NULL for a missing value."""
    ladder = None
    for label, colour, low, high, _, upper in CATEGORIES:
        band = F.struct(
            F.lit(label).alias("label"), F.lit(colour).alias("colour"),
            F.lit(low).alias("low"), F.lit(high).alias("high"),
        )
        holds = value.isNotNull() if upper is None else value <= upper
        ladder = F.when(holds, band) if ladder is None else ladder.when(holds, band)
    return ladder


def category_table(spark: SparkSession) -> DataFrame:
    """The six bands as a dimension with half-open edges (lower, upper]."""
    return spark.createDataFrame(
        list(CATEGORIES),
        "label string, colour string, low int, high int, lower double, upper double",
    )


def join_category(df: DataFrame, column: str) -> DataFrame:
    """Band of each value by a range join with the six-row dimension."""
    bands = F.broadcast(category_table(df.sparkSession))
    value = F.col(column)
    inside = (F.col("lower").isNull() | (value > F.col("lower"))) & (
        F.col("upper").isNull() | (value <= F.col("upper"))
    )
    return df.join(bands, inside & value.isNotNull(), "left")


def threshold_table(spark: SparkSession, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """User-set thresholds as a one-row table."""
    values = tuple(float(thresholds[k]) for k in THRESHOLDS)
    return spark.createDataFrame([values], ", ".join(f"{k} double" for k in THRESHOLDS))


def read_thresholds(stored: DataFrame) -> dict[str, float]:
    """Thresholds of a one-row table; what it lacks keeps its default."""
    row = stored.first().asDict()
    return {k: v if row.get(k) is None else row[k] for k, v in THRESHOLDS.items()}


def _edges(thresholds: Mapping[str, float]) -> dict[str, Column]:
    return {k: F.lit(float(thresholds[k])) for k in THRESHOLDS}


def _ladder(value: Column, thresholds, result) -> Column:
    """First level, from the worst down, whose threshold the value exceeds."""
    edges = _edges(thresholds)
    chain = None
    for entry in LADDER:
        level = entry[0]
        holds = value.isNotNull() if level == "good" else value > edges[level]
        outcome = result(*entry)
        chain = F.when(holds, outcome) if chain is None else chain.when(holds, outcome)
    return chain


def alert(value: Column, thresholds: Mapping[str, float] = THRESHOLDS) -> Column:
    """Struct of level, message and type; NULL for a missing value."""
    shown = value.cast("string")
    return _ladder(
        value, thresholds,
        lambda level, kind, status, before, after: F.struct(
            F.lit(level).alias("level"),
            F.concat(F.lit(before), shown, F.lit(after)).alias("message"),
            F.lit(kind).alias("type"),
        ),
    )


def status(value: Column, thresholds: Mapping[str, float] = THRESHOLDS) -> Column:
    return _ladder(value, thresholds, lambda level, kind, text, before, after: F.lit(text))


def advisory(value: Column, thresholds: Mapping[str, float] = THRESHOLDS) -> Column:
    """Health-advisory band: one of three threshold names, else ``good``."""
    edges = _edges(thresholds)
    chain = None
    for level in ADVISORY_LEVELS:
        holds = value > edges[level]
        chain = F.when(holds, level) if chain is None else chain.when(holds, level)
    return chain.when(value.isNotNull(), "good")


def is_banner(level: Column) -> Column:
    return level.isin(*BANNER_LEVELS)


def level_title(level: Column) -> Column:
    return F.initcap(F.replace(level, F.lit("_"), F.lit(" ")))


def shortened(message: Column, length: int = 80) -> Column:
    return F.concat(F.substring(message, 1, length), F.lit("..."))


def day_text(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd")


def minute_text(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd HH:mm")


def weekday_text(t: Column) -> Column:
    return F.date_format(t, "EEEE, MMM dd")


def shape_labels(skewness: Column, kurtosis: Column) -> tuple[Column, Column]:
    """What skewness and excess kurtosis say about a distribution."""
    skew = (
        F.when(F.abs(skewness) < 0.5, "symmetric")
        .when(skewness > 0, "right-skewed")
        .when(skewness.isNotNull(), "left-skewed")
    )
    tails = (
        F.when(F.abs(kurtosis) < 0.5, "mesokurtic")
        .when(kurtosis > 0, "leptokurtic")
        .when(kurtosis.isNotNull(), "platykurtic")
    )
    return skew, tails
