"""Bar sources: tick resampling, raw-bar normalising, bar-table scans.

The reference fetches daily bars from a vendor API.  Here a bar table is a
Parquet dataset (or any DataFrame), and bars can be built from ticks by a
grouped aggregate that Spark combines map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.functions.numeric import nan_to_null
from marketframe.schema import BAR_COLUMNS, BARS_SCHEMA

EXCHANGE_TZ = "America/New_York"


def session_date_column(ts: Column, dtype: T.DataType, tz: str = EXCHANGE_TZ) -> Column:
    """UTC timestamp -> calendar date at the exchange.

    A TIMESTAMP_NTZ holds UTC wall-clock time.  A TIMESTAMP (instant) shows as
    wall-clock time of the session's zone, so that zone is converted from;
    neither result depends on the session's setting.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts))
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(tz), ts.cast("timestamp_ntz")))


def session_date(df: DataFrame, ts_col: str = "timestamp", out_col: str = "date",
                 tz: str = EXCHANGE_TZ) -> DataFrame:
    """Add ``out_col``: the exchange-local date of ``ts_col``."""
    dtype = df.schema[ts_col].dataType
    return df.withColumn(out_col, session_date_column(F.col(ts_col), dtype, tz))


def normalise_bars(raw: DataFrame, tz: str = EXCHANGE_TZ) -> DataFrame:
    """Raw vendor bars (symbol, timestamp, OHLCV, trade_count, vwap) -> bars.

    Converts the timestamp to the exchange date, drops trade_count and vwap,
    and turns NaN into null so that later comparisons treat it as missing.
    """
    dated = session_date(raw, "timestamp", "date", tz)
    return dated.select(
        F.col("symbol"), F.col("date"),
        *[nan_to_null(F.col(c).cast("double")).alias(c) for c in BAR_COLUMNS[2:]],
    )


def resample_bars(ticks: DataFrame, bucket: Column, symbol: str = "symbol",
                  price: str = "px", size: str = "qty", order: Column | None = None) -> DataFrame:
    """Ticks -> OHLCV bars per (symbol, bucket).

    ``bucket`` is the bar period, e.g. ``F.to_date('ts')`` for daily bars or
    ``F.date_trunc('minute', 'ts')`` for minute bars.  ``order`` orders ticks
    inside a bar (open = price of the first tick, close = of the last); it must
    be unique within a bar.  All five aggregates are declarative, so Spark runs
    them partially before the shuffle: a hot symbol or a hot day reaches the
    reducer as one row per map task.
    """
    order = order if order is not None else F.col("ts")
    px = F.col(price)
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), bucket.alias("date"))
        .agg(
            F.min_by(px, order).alias("open"),
            F.max(px).alias("high"),
            F.min(px).alias("low"),
            F.max_by(px, order).alias("close"),
            F.sum(F.col(size).cast("double")).alias("volume"),
        )
    )


def scan_bars(spark, path: str, start: str | None = None, end: str | None = None,
              symbols: DataFrame | list | None = None) -> DataFrame:
    """Read a bar table with its fixed schema, restricted to a date range and
    a universe.  Date bounds are inclusive and are pushed into the Parquet scan."""
    df = spark.read.schema(BARS_SCHEMA).parquet(path)
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    if symbols is not None:
        from marketframe.sources.universe import restrict_to_universe
        df = restrict_to_universe(df, symbols)
    return df.select(*BAR_COLUMNS)
