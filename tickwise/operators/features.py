"""Rolling + lag feature transformer as a persistable Spark ML stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .window import lag_features, rolling_time_stats


class RollingLagFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Rolling mean / std / count over time windows and global lags with
    backfill (W1-W5 as one unit).

    ``windows`` maps labels to widths in ticks of ``t_col``; lags are taken in
    (t, tie) order. The reference falls back to a row number when the time
    column is missing, on which time windows are meaningless, so the column is
    required here.
    """

    tCol = Param(Params._dummy(), "tCol", "time tick column", TypeConverters.toString)
    valueCol = Param(Params._dummy(), "valueCol", "measured value", TypeConverters.toString)
    countCol = Param(Params._dummy(), "countCol", "column counted for the rate", TypeConverters.toString)
    tieCol = Param(Params._dummy(), "tieCol", "tie-break column for row order", TypeConverters.toString)
    windowSpecs = Param(Params._dummy(), "windowSpecs", "label=width list", TypeConverters.toListString)
    lags = Param(Params._dummy(), "lags", "lag steps", TypeConverters.toListInt)
    meanName = Param(Params._dummy(), "meanName", "mean column template", TypeConverters.toString)
    stdName = Param(Params._dummy(), "stdName", "std column template", TypeConverters.toString)
    rateName = Param(Params._dummy(), "rateName", "count column template", TypeConverters.toString)
    lagName = Param(Params._dummy(), "lagName", "lag column template", TypeConverters.toString)
    includeCurrent = Param(Params._dummy(), "includeCurrent", "whether a row's windows hold the row itself", TypeConverters.toBoolean)
    exactTies = Param(Params._dummy(), "exactTies", "rows of one tick see only those before them", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, t_col: str = "timestamp_ns", value_col: str = "latency_us",
                 windows: Mapping[str, int] | None = None, lags: Sequence[int] = tuple(range(1, 11)),
                 count_col: str | None = None, tie_col: str | None = None,
                 mean_name: str = "{v}_roll_mean_{w}", std_name: str = "{v}_roll_std_{w}",
                 rate_name: str = "rate_{w}", lag_name: str = "{v}_lag_{k}", include_current: bool = True, exact_ties: bool = False):
        super().__init__()
        windows = windows or {"1s": 1_000_000_000, "10s": 10_000_000_000, "60s": 60_000_000_000}
        self._set(tCol=t_col, valueCol=value_col, windowSpecs=[f"{k}={int(v)}" for k, v in windows.items()],
                  lags=[int(k) for k in lags], meanName=mean_name, stdName=std_name,
                  rateName=rate_name, lagName=lag_name, includeCurrent=include_current, exactTies=exact_ties)
        if count_col:
            self._set(countCol=count_col)
        if tie_col:
            self._set(tieCol=tie_col)

    def windows(self) -> dict[str, int]:
        return {s.split("=")[0]: int(s.split("=")[1]) for s in self.getOrDefault(self.windowSpecs)}

    def feature_names(self) -> list[str]:
        v = self.getOrDefault(self.valueCol)
        out = []
        for w in self.windows():
            out += [self.getOrDefault(self.meanName).format(v=v, w=w),
                    self.getOrDefault(self.stdName).format(v=v, w=w),
                    self.getOrDefault(self.rateName).format(v=v, w=w)]
        out += [self.getOrDefault(self.lagName).format(v=v, k=k) for k in self.getOrDefault(self.lags)]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        t = self.getOrDefault(self.tCol)
        v = self.getOrDefault(self.valueCol)
        if t not in df.columns:
            raise ValueError(f"time column {t!r} is required for time windows")
        cc = self.getOrDefault(self.countCol) if self.isSet(self.countCol) else None
        if cc is not None and cc not in df.columns:
            cc = None   # reference falls back to counting the value column
        x = rolling_time_stats(df, t, v, self.windows(), count_col=cc,
                               mean_name=self.getOrDefault(self.meanName),
                               std_name=self.getOrDefault(self.stdName),
                               count_name=self.getOrDefault(self.rateName),
                               include_current=self.getOrDefault(self.includeCurrent), exact_ties=self.getOrDefault(self.exactTies),
                               tie_col=self.getOrDefault(self.tieCol) if self.isSet(self.tieCol) else None)
        order = [F.col(t)]
        if self.isSet(self.tieCol):
            order.append(F.col(self.getOrDefault(self.tieCol)))
        lags = self.getOrDefault(self.lags)
        if lags:
            x = lag_features(x, order, v, lags, name=self.getOrDefault(self.lagName))
        return x
