"""The feature steps as MLlib transformers, to be put into a ``Pipeline``."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from airloom.functions.calendar import CYCLE_DEFAULTS, add_cyclical
from airloom.operators import windows
from airloom.plans.features import feature_frame
from airloom.schemas import SERIES, TARGET, TIME


class _Step(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def fit_transform(self, df: DataFrame) -> DataFrame:
        """Nothing is learnt, so this is ``transform``."""
        return self.transform(df)


class _Ordered(_Step):
    keys = Param(Params._dummy(), "keys", "series key columns", TypeConverters.toListString)
    order = Param(Params._dummy(), "order", "time column and tiebreak", TypeConverters.toListString)
    column = Param(Params._dummy(), "column", "target column", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "row counts", TypeConverters.toListInt)

    def _defaults(self, sizes) -> None:
        self._setDefault(keys=[SERIES], order=[TIME], column=TARGET, sizes=list(sizes))

    def _get(self, name: str):
        return self.getOrDefault(getattr(self, name))


class CyclicalTimeEncoder(_Step):
    """Sine and cosine of calendar columns."""

    columns = Param(Params._dummy(), "columns", "calendar columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=list(CYCLE_DEFAULTS))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_cyclical(df, self.getOrDefault(self.columns))


class RollingFeatureGenerator(_Ordered):
    """Rolling mean, deviation, extremes and range of the target."""

    @keyword_only
    def __init__(self, *, keys=None, order=None, column=None, sizes=None):
        super().__init__()
        self._defaults(windows.ROLLING_WINDOWS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return windows.rolling(
            df, self._get("column"), self._get("keys"), self._get("order"), self._get("sizes")
        )


class LagFeatureGenerator(_Ordered):
    """Earlier values of the target and of the pollutants present."""

    @keyword_only
    def __init__(self, *, keys=None, order=None, column=None, sizes=None):
        super().__init__()
        self._defaults(windows.LAGS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = [c for c in (self._get("column"), "pm25", "pm10", "no2", "o3") if c in df.columns]
        return windows.lags(df, columns, self._get("keys"), self._get("order"), self._get("sizes"))


class FeatureEngineer(_Step):
    """Observations to the whole feature frame."""

    feature_set = Param(Params._dummy(), "feature_set", "reference or leak_free", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "series key columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, keys=None, feature_set=None):
        super().__init__()
        self._setDefault(keys=[SERIES], feature_set="reference")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return feature_frame(
            df, self.getOrDefault(self.keys), feature_set=self.getOrDefault(self.feature_set)
        )
