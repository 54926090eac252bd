"""Grouped-map hook for user indicators written in pandas.

The reference computes its moving averages with a pandas function applied to
each symbol's frame.  ``apply_indicator`` keeps that interface but never hands
a whole symbol to one Python worker: the function runs on (symbol, block)
groups that carry ``lookback`` extra bars in front, and the extra bars are
dropped from its output.  The result is exact for any indicator whose value
depends on at most ``lookback`` previous bars.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators.sequence import halo_blocks, number_rows


def apply_indicator(bars: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                    out_schema: T.StructType, lookback: int, block_size: int = 4096,
                    chunk: Column | None = None) -> DataFrame:
    """Run ``fn`` (bars frame in date order -> frame with the columns of
    ``out_schema``, one row per input row, ``symbol`` and ``date`` included).
    ``chunk``: calendar unit of the numbering, a year unless given."""
    numbered = number_rows(bars, "symbol", "date", F.year("date") if chunk is None else chunk)
    blocked = halo_blocks(numbered, "bar_no", block_size, before=lookback)
    names = [f.name for f in out_schema.fields]
    _ship_by_value()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar_no", kind="stable").reset_index(drop=True)
        res = fn(pdf.drop(columns=["block", "halo", "bar_no"]))
        res = res[pdf["halo"].to_numpy() == 0]
        return res[names]

    return blocked.groupBy("symbol", "block").applyInPandas(run, out_schema)


def _ship_by_value() -> None:
    """Send this module's functions to Python workers by value, so that the
    hook works where the package is not installed on the executors."""
    import sys

    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except ValueError:
        pass


def pandas_moving_averages(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example indicator: simple means of 50 and 200 closes, pandas-rounded."""
    close = pdf["close"]
    return pd.DataFrame({
        "symbol": pdf["symbol"], "date": pdf["date"],
        "sma_50": close.rolling(window=50).mean().round(2),
        "sma_200": close.rolling(window=200).mean().round(2),
    })


MOVING_AVERAGES_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("sma_50", T.DoubleType()), T.StructField("sma_200", T.DoubleType()),
])


def custom_indicator(bars: DataFrame, block_size: int = 4096) -> DataFrame:
    return apply_indicator(bars, pandas_moving_averages, MOVING_AVERAGES_SCHEMA, 199, block_size)
