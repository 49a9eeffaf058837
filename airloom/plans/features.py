"""The full feature frame: 14 observation columns widened to 148."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.atmosphere import (
    POLLUTANTS, composite_column, interaction_columns, ratio_columns,
)
from airloom.functions.bands import CATEGORY_EDGES, category_flags
from airloom.functions.calendar import (
    CYCLE_DEFAULTS, cyclical_columns, holiday_flag, parsed_time, require, season_columns,
    time_columns,
)
from airloom.operators.cuts import OWN, ROWS_PER_CUT, arrange
from airloom.operators.joins import dedup_latest
from airloom.operators.windows import (
    LAGS, LONG_WINDOWS, ROLLING_WINDOWS, add_ema, add_rolling, change_columns, lag_columns,
)
from airloom.schemas import SERIES, TARGET, TIME, nan_to_null

NOT_FEATURES = ("datetime", "aqi", "source", "main_pollutant")  # fixed values
FEATURE_SETS = ("reference", "leak_free")


def row_features(df: DataFrame, time: str = TIME, target: str = TARGET) -> DataFrame:
    """All features that need one row only, in a single projection."""
    require(df, time)
    present = set(df.columns)
    t = parsed_time(df, time)
    calendar = time_columns(t)
    out = dict(calendar)
    out |= cyclical_columns(CYCLE_DEFAULTS, calendar)
    out |= interaction_columns(present)
    out |= season_columns(calendar["month"])
    if target in present:
        out |= category_flags(F.col(target))
    out["is_holiday"] = holiday_flag(t)
    out |= ratio_columns(present)
    index = composite_column(present)
    if index is not None:
        out["pollution_index"] = index
    return df.withColumns(out)


def feature_frame(
    df: DataFrame,
    keys: Sequence[str] = (SERIES,),
    time: str = TIME,
    target: str = TARGET,
    newest: Sequence[str] = (),
    feature_set: str = "reference",
    rows_per_cut: int = ROWS_PER_CUT,
    longest: int | None = None,
) -> DataFrame:
    """Observations (one row per series and time, in any order) to features.

    ``newest`` names the columns that decide between rows of the same series
    and time; without it such rows must not occur.  ``leak_free`` leaves out
    what the target's own row gives away: frames end on the previous row,
    averages and differences are shifted by one row, and the category flags,
    pollutants and their index are dropped.
    """
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"feature_set must be one of {FEATURE_SETS}")
    require(df, *keys, time, target)
    shift = 0 if feature_set == "reference" else 1
    clean = nan_to_null(df)
    if newest:
        clean = dedup_latest(clean, [*keys, time], newest)
    arranged = arrange(clean, keys, [time], rows_per_cut, longest).position("_pos")

    depth = max(max(LONG_WINDOWS) - 1 + shift, max(LAGS) + shift)
    arranged = add_ema(arranged, target)
    rows = arranged.extend(before=depth)
    w = arranged.window()
    lagged = [target, *[p for p in POLLUTANTS if p in df.columns]]
    emas = [c for c in rows.columns if c.startswith(f"{target}_ema_")]
    averages = [F.lag(c, shift).over(w).alias(c) if shift else F.col(c) for c in emas]
    rows = rows.select(
        *[c for c in rows.columns if c not in emas],
        *change_columns(arranged, target, shift),
        *averages,
        *lag_columns(arranged, lagged),
    )
    rows = add_rolling(
        rows, arranged, target, ROLLING_WINDOWS, offset=shift, long_sizes=LONG_WINDOWS
    )
    rows = rows.filter(OWN).drop(OWN, "_cut", "_pos")
    out = row_features(rows, time, target)
    if shift:
        # Lags of the pollutants stay: they are known when the row is predicted.
        same_row = [*CATEGORY_EDGES, *POLLUTANTS, "pollution_index",
                    "pm25_pm10_ratio", "no2_o3_ratio"]
        out = out.drop(*same_row)
    return out


def feature_names(df: DataFrame, time: str = TIME, target: str = TARGET) -> list[str]:
    """All columns but time and target."""
    return [c for c in df.columns if c not in (time, target) and not c.endswith("_lag_0h")]


def training_columns(
    df: DataFrame, leave_out: Sequence[str] = (), keep_lags: bool = False
) -> list[str]:
    """Feature columns used for training; lag columns are left out by default."""
    return [
        c
        for c in df.columns
        if c not in NOT_FEATURES and c not in leave_out and (keep_lags or "_lag_" not in c)
    ]
