"""Weather interactions, pollutant ratios, composite index, target estimate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.calendar import flag, season_columns

# Fixed values.
POLLUTANTS = ("pm25", "pm10", "no2", "o3")
INDEX_WEIGHTS = {"pm25": 0.4, "pm10": 0.3, "no2": 0.2, "o3": 0.1}
RATIO_GUARD = 1e-6
# What stands in for a missing input of the estimate, the centre
# each input is measured from and its effect per unit.
ESTIMATE_BASE = 120.0
ESTIMATE_INPUTS = {
    "temperature_2m": (25.0, 25.0, 0.5),
    "relative_humidity_2m": (50.0, 50.0, 0.3),
    "wind_speed_10m": (10.0, 0.0, -0.5),
    "pressure_msl": (1013.0, 1013.0, 0.1),
    "cloud_cover": (0.0, 0.0, -0.1),
}
ESTIMATE_RANGE = (30.0, 500.0)
ESTIMATE_POLLUTANTS = {"pm25": 45.0, "pm10": 70.0, "no2": 35.0, "o3": 50.0}


def interaction_columns(present: set[str]) -> dict[str, Column]:
    """Interaction and risk columns whose inputs are all present."""
    c = F.col
    rules = {
        "temp_humidity_interaction": (
            {"temperature_2m", "relative_humidity_2m"},
            lambda: c("temperature_2m") * c("relative_humidity_2m"),
        ),
        "wind_pressure_interaction": (
            {"wind_speed_10m", "pressure_msl"},
            lambda: c("wind_speed_10m") * c("pressure_msl") / 1000,
        ),
        "visibility_humidity_interaction": (
            {"visibility", "relative_humidity_2m"},
            lambda: F.try_divide(c("visibility"), c("relative_humidity_2m") + 1),
        ),
        "wind_from_sea": (
            {"wind_direction_10m"},
            lambda: flag(c("wind_direction_10m").between(180, 270)),
        ),
        "temp_inversion_risk": (
            {"pressure_msl", "cloud_cover", "temperature_2m"},
            lambda: flag(
                (c("pressure_msl") > 1015)
                & (c("cloud_cover") < 30)
                & (c("temperature_2m") < 20)
            ),
        ),
        "pollution_accumulation_risk": (
            {"wind_speed_10m", "pressure_msl", "precipitation"},
            lambda: flag(
                (c("wind_speed_10m") < 5)
                & (c("pressure_msl") > 1010)
                & (c("precipitation") == 0)
            ),
        ),
    }
    return {name: make() for name, (needs, make) in rules.items() if needs <= present}


def add_weather_interactions(df: DataFrame) -> DataFrame:
    columns = interaction_columns(set(df.columns))
    if "month" in df.columns:
        columns |= season_columns(F.col("month"))
    return df.withColumns(columns)


def ratio_columns(present: set[str]) -> dict[str, Column]:
    out = {}
    for top, bottom in (("pm25", "pm10"), ("no2", "o3")):
        if {top, bottom} <= present:
            out[f"{top}_{bottom}_ratio"] = F.try_divide(
                F.col(top), F.col(bottom) + RATIO_GUARD
            )
    return out


def composite_column(present: set[str]) -> Column | None:
    """Weighted pollutant sum; the weights of those present add up to one."""
    weights = {k: w for k, w in INDEX_WEIGHTS.items() if k in present}
    if not weights:
        return None
    total = sum(weights.values())
    return reduce(
        lambda a, b: a + b, [F.col(k) * F.lit(w / total) for k, w in weights.items()]
    )


def add_pollutant_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(ratio_columns(set(df.columns)))


def add_composite_index(df: DataFrame) -> DataFrame:
    index = composite_column(set(df.columns))
    return df if index is None else df.withColumn("pollution_index", index)


def estimate_columns(
    base: Column, pollutants: dict[str, Column] | None = None, digits: int | None = 1
) -> dict[str, Column]:
    """Weather-adjusted estimate of the target and of its pollutants.

    Rounded to one decimal, ties to even.  Missing inputs take their stand-ins;
    pollutants scale with the estimate while the base is positive.
    """
    def shown(x: Column) -> Column:
        return x if digits is None else F.bround(x, digits)

    base = F.coalesce(base, F.lit(ESTIMATE_BASE))
    effects = [
        (F.coalesce(F.col(name), F.lit(stand_in)) - centre) * effect
        for name, (stand_in, centre, effect) in ESTIMATE_INPUTS.items()
    ]
    low, high = ESTIMATE_RANGE
    estimate = F.greatest(
        F.lit(low), F.least(F.lit(high), reduce(lambda a, b: a + b, effects, base))
    )
    ratio = F.when(base > 0, F.try_divide(estimate, base)).otherwise(1.0)
    given = pollutants or {}
    scaled = {
        k: F.coalesce(given.get(k, F.lit(None)), F.lit(v)) * ratio
        for k, v in ESTIMATE_POLLUTANTS.items()
    }
    return {
        "aqi": shown(estimate),
        **{k: shown(v) for k, v in scaled.items()},
        "so2": shown(scaled["no2"] * 0.3),
        "co": shown(estimate / 100 * 2.5),
        "main_pollutant": F.when(estimate > 100, "pm25").otherwise("o3"),
    }


def impute_target(df: DataFrame, base: str = "base_aqi") -> DataFrame:
    """Fill a missing target, and then the pollutants, with the estimate."""
    estimates = estimate_columns(F.col(base))
    missing = F.col("aqi").isNull()
    filled = {
        k: F.when(missing, F.coalesce(F.col(k), estimates[k])).otherwise(F.col(k))
        for k in ("aqi", *POLLUTANTS)
        if k in df.columns
    }
    return df.withColumns({**filled, "is_estimated": flag(missing)})
