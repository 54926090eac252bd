"""Column layouts and tunable parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Output columns of the feature table, in order.
FEATURE_COLUMNS = [
    "symbol", "date", "pct_change", "pct_open_to_close", "pct_gap",
    "open", "high", "low", "close",
    "volume", "adv", "rvol",
    "atr", "dtr", "tr_comp",
    "ema_9", "ema_21", "sma_50", "sma_200", "rsi",
    "range_pct", "trend_strength",
]

BAR_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume"]

BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

RAW_BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("trade_count", T.DoubleType(), True),
    T.StructField("vwap", T.DoubleType(), True),
])

FEATURES_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType(), False), T.StructField("date", T.DateType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLUMNS[2:]]
)

TRADE_IDEAS_SCHEMA = T.StructType([
    T.StructField("idea_id", T.LongType(), False),
    T.StructField("portfolio", T.StringType(), True),
    T.StructField("risk", T.StringType(), True),
    T.StructField("entry", T.DoubleType(), True),
    T.StructField("stop", T.DoubleType(), True),
    T.StructField("target", T.DoubleType(), True),
])


@dataclass(frozen=True)
class FeatureParams:
    """Window lengths of the feature build and the layout of the parallel scan.

    ``block_size`` bars of one symbol form a block (the unit of parallelism);
    each block also receives the ``lookback`` bars before it as a read-only
    halo, so sliding windows never need a whole symbol in one task.
    ``scan_chunk`` bounds the exponent range of the recursive scan
    ((1 - alpha)^-chunk must stay finite: 0.8^-1024 is about 1e99).
    """

    adv_window: int = 14
    atr_window: int = 14
    rsi_window: int = 14
    ema_fast: int = 9
    ema_slow: int = 21
    sma_fast: int = 50
    sma_slow: int = 200
    block_size: int = 4096
    scan_chunk: int = 1024

    @property
    def lookback(self) -> int:
        return max(self.adv_window, self.atr_window, self.sma_fast, self.sma_slow) - 1


@dataclass(frozen=True)
class ReportParams:
    """Thresholds of the end-of-day reports (reference defaults)."""

    min_adv: float = 2_000_000.0
    closer_high: float = 0.8
    closer_low: float = 0.2
    min_rvol: float = 0.8
    top_n: int = 10


@dataclass(frozen=True)
class StudyParams:
    """Rule study: liquidity window, entry rule and exit rule."""

    min_adv: float = 2_000_000.0
    # The reference study's window and its six symbols.
    start_exclusive: str = "2016-01-20"
    end_exclusive: str = "2018-01-01"
    symbols: tuple = ("AAPL", "TSLA", "NVDA", "CRM", "NFLX", "META")
    min_range_pct: float = 0.8
    min_rvol: float = 1.0
    min_gap: float = 0.0
    max_hold_bars: int = 7
    warmup_bars: int = 15
    commission: float = 0.002
    cash: float = 10_000.0
