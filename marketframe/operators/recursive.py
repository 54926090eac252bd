"""Grouped-map hook for user indicators with unbounded memory.

A recursive indicator (an exponential mean, RSI) depends on every bar before,
so no look-back makes blocks of a series exact.  Here the user's indicator
says what a block does instead:

* ``summarise`` a block to a state: a few numbers, as if nothing came before;
* ``compose`` the states of two neighbouring runs of bars to that of both;
* ``finish`` a block's output, given the state of all bars before it.

Blocks are summarised in parallel, the states are folded (blocks inside
super-blocks of ``SUPER`` blocks, super-blocks per symbol), and every block is
finished alone next to the state that enters it.  All three run on frames of
one (symbol, block), with ``lookback`` bars of context in front.  Only states
ever come together.

``ExponentialMeans`` and ``RelativeStrength`` are the indicators of the
feature table written this way, in pandas.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators.sequence import halo_blocks, number_rows
from marketframe.session import materialize

SUPER = 256


class Recursive(Protocol):
    """What a user's indicator provides.  Frames are in date order; their
    first ``context`` rows (at most ``lookback``) belong to the bars before."""

    lookback: int
    schema: T.StructType  # output columns besides symbol and date

    def summarise(self, bars: pd.DataFrame, context: int) -> list[float]:
        """State of the block's own bars, from an empty start."""

    def compose(self, first: list[float], then: list[float]) -> list[float]:
        """State of two runs in a row; must be associative."""

    def finish(self, bars: pd.DataFrame, context: int, before: list[float] | None) -> pd.DataFrame:
        """One output row per own bar; ``before`` is None for the first block."""


def apply_recursive(bars: DataFrame, indicator: Recursive, block_size: int = 4096, chunk: Column | None = None,
                    group: int = SUPER) -> DataFrame:
    """symbol, date and the indicator's columns for every bar.

    ``chunk``: calendar unit of the numbering, a year unless given."""
    _ship_by_value()
    numbered = number_rows(bars, "symbol", "date", F.year("date") if chunk is None else chunk)
    # Read twice, for the states and for the output.
    blocked = materialize(halo_blocks(numbered, "bar_no", block_size, before=indicator.lookback))
    states = "symbol string, super long, block long, before array<double>, whole array<double>"

    def ordered(pdf: pd.DataFrame) -> tuple[pd.DataFrame, int]:
        pdf = pdf.sort_values("bar_no", kind="stable").reset_index(drop=True)
        return pdf.drop(columns=["block", "halo", "bar_no"]), int((pdf["halo"] != 0).sum())

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        state = [float(v) for v in indicator.summarise(*ordered(pdf))]
        return pd.DataFrame({"symbol": pdf["symbol"].iloc[:1], "block": pdf["block"].iloc[:1], "state": [state]})

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        """The state before each run of a group; its last row is the group's own."""
        pdf = pdf.sort_values("block", kind="stable")
        before, out = None, []
        for state in pdf["state"]:
            out.append(before)
            before = list(state) if before is None else indicator.compose(before, list(state))
        whole = [None] * (len(out) - 1) + [before]
        return pd.DataFrame({"symbol": pdf["symbol"], "super": pdf["super"], "block": pdf["block"],
                             "before": out, "whole": whole})

    def finish(key, pdf: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        known = [list(s) for s in (state["outer"].iloc[0], state["before"].iloc[0]) if s is not None]
        before = None if not known else known[0] if len(known) == 1 else indicator.compose(*known)
        frame, context = ordered(pdf)
        out = indicator.finish(frame, context, before)
        own = frame.iloc[context:]
        # Whatever index the user's frame has, its rows are the own bars in order.
        return pd.DataFrame({"symbol": own["symbol"].to_numpy(), "date": own["date"].to_numpy(),
                             **{f.name: out[f.name].to_numpy() for f in indicator.schema.fields}})

    summed = (blocked.groupBy("symbol", "block").applyInPandas(summarise, "symbol string, block long, state array<double>")
              .withColumn("super", F.floor(F.col("block") / group)))
    within = materialize(summed.groupBy("symbol", "super").applyInPandas(fold, states))
    tops = within.where("whole is not null").select("symbol", "super", "block", F.col("whole").alias("state"))
    over = tops.groupBy("symbol").applyInPandas(fold, states).select("symbol", "super", F.col("before").alias("outer"))
    entering = within.join(over, ["symbol", "super"]).select("symbol", "block", "before", "outer")
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()),
                           *indicator.schema.fields])
    return (blocked.groupBy("symbol", "block").cogroup(entering.groupBy("symbol", "block"))
            .applyInPandas(finish, schema))


def _ship_by_value() -> None:
    """Send this module's functions to Python workers by value, so that the
    hook works where the package is not installed on the executors."""
    from pyspark import cloudpickle
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except ValueError:
        pass


def _ewm(values: pd.Series, alpha: float) -> pd.Series:
    """y = (1 - alpha) y + alpha x from the first value on; gaps show the last y."""
    return values.ewm(alpha=alpha, adjust=False, ignore_na=True).mean()


def _ewm_after(before: float, values: pd.Series, alpha: float) -> np.ndarray:
    return _ewm(pd.concat([pd.Series([before]), values]), alpha).to_numpy()[1:]


@dataclass
class ExponentialMeans:
    """Exponential means of the close over ``windows`` bars, from the first
    close on, null before their window is full; missing closes are skipped.

    State: number of closes, then per window the mean that the run gives from
    its own first close, and what it adds to a mean that stands before it."""

    windows: tuple = (9, 21)
    lookback: int = 0

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f"ema_{w}", T.DoubleType()) for w in self.windows])

    def summarise(self, bars, context):
        close = bars["close"].iloc[context:].astype(float)
        state = [float(close.notna().sum())]
        for w in self.windows:
            alpha = 2 / (w + 1)
            alone = _ewm(close, alpha).iloc[-1]
            state += [0.0 if np.isnan(alone) else alone, _ewm_after(0.0, close, alpha)[-1]]
        return state

    def compose(self, first, then):
        out = [first[0] + then[0]]
        for k, w in enumerate(self.windows):
            rate = (1 - 2 / (w + 1)) ** then[0]
            (alone, adds), (alone2, adds2) = first[1 + 2 * k:3 + 2 * k], then[1 + 2 * k:3 + 2 * k]
            out += [rate * alone + adds2 if first[0] else alone2, rate * adds + adds2]
        return out

    def finish(self, bars, context, before):
        close = bars["close"].iloc[context:].astype(float)
        count = close.notna().cumsum().to_numpy() + (before[0] if before else 0)
        out = {}
        for k, w in enumerate(self.windows):
            alpha = 2 / (w + 1)
            known = before is not None and before[0] > 0
            y = _ewm_after(before[1 + 2 * k], close, alpha) if known else _ewm(close, alpha).to_numpy()
            out[f"ema_{w}"] = np.where(count >= w, np.round(y, 2), np.nan)
        return pd.DataFrame(out)


@dataclass
class RelativeStrength:
    """RSI over ``window`` bars from exponential means of gains and losses.

    State: number of bars, and what the run adds to the means of gains and of
    losses.  The change of a block's first bar needs the close before it."""

    window: int = 14
    lookback: int = 1

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("rsi", T.DoubleType())])

    def _moves(self, bars, context):
        change = bars["close"].astype(float).diff().iloc[context:].fillna(0.0)
        return change.clip(lower=0), (-change).clip(lower=0)

    def summarise(self, bars, context):
        return [float(len(bars) - context), *[_ewm_after(0.0, m, 1 / self.window)[-1] for m in self._moves(bars, context)]]

    def compose(self, first, then):
        rate = (1 - 1 / self.window) ** then[0]
        return [first[0] + then[0], rate * first[1] + then[1], rate * first[2] + then[2]]

    def finish(self, bars, context, before):
        count, *means = before or [0.0, 0.0, 0.0]
        up, down = (_ewm_after(y, m, 1 / self.window) for y, m in zip(means, self._moves(bars, context)))
        with np.errstate(divide="ignore", invalid="ignore"):
            rsi = np.where(down == 0, 100.0, np.round(100 - 100 / (1 + up / down), 2))
        return pd.DataFrame({"rsi": np.where(count + np.arange(1, len(rsi) + 1) >= self.window, rsi, np.nan)})


@dataclass
class Together:
    """Several recursive indicators in one pass over the bars."""

    parts: tuple

    @property
    def lookback(self) -> int:
        return max(p.lookback for p in self.parts)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f for p in self.parts for f in p.schema.fields])

    def summarise(self, bars, context):
        states = [list(p.summarise(bars, context)) for p in self.parts]
        return [float(len(s)) for s in states] + [v for s in states for v in s]

    def _split(self, state):
        sizes, at = [int(n) for n in state[:len(self.parts)]], len(self.parts)
        for n in sizes:
            yield state[at:at + n]
            at += n

    def compose(self, first, then):
        states = [p.compose(a, b) for p, a, b in zip(self.parts, self._split(first), self._split(then))]
        return [float(len(s)) for s in states] + [v for s in states for v in s]

    def finish(self, bars, context, before):
        states = [None] * len(self.parts) if before is None else self._split(before)
        return pd.concat([p.finish(bars, context, s).reset_index(drop=True) for p, s in zip(self.parts, states)], axis=1)


def custom_recursive(bars: DataFrame, block_size: int = 512) -> DataFrame:
    """EMA 9, EMA 21 and RSI 14 through the hook, on several blocks per symbol."""
    out = apply_recursive(bars, Together((ExponentialMeans(), RelativeStrength())), block_size)
    return out.select("symbol", "date", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("ema_9", "ema_21", "rsi")])
