"""Next-smaller search, users' exit rules and curve statistics against loops."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketframe.operators.search import next_below
from marketframe.operators.sequence import prefix
from marketframe.plans import study as T
from test_study import P, feats


def test_next_below_equals_a_loop(spark):
    rng = np.random.default_rng(4)
    n = 400
    v = np.cumsum(rng.normal(0, 1, n))
    values = [None if i % 37 == 5 else float(x) for i, x in enumerate(v)]
    questions = [("a", i + 1, float(v[i] - d)) for i in range(0, n, 3) for d in (0.0, 3.0, 12.0)]
    questions += [("a", n, 1e9), ("a", 7, None), ("b", 1, 0.0), ("none", 3, 1.0)]
    series = spark.createDataFrame([("a", i + 1, x) for i, x in enumerate(values)] + [("b", 1, -5.0), ("b", 2, -6.0)],
                                   "k string, i long, v double")
    q = spark.createDataFrame(questions, "k string, at long, level double")
    for block, group in ((4, 3), (16, 4), (1000, 256)):
        got = {(r.k, r["at"], r.level): r.hit
               for r in next_below(q, series, "k", "at", "level", "i", "v", "hit", block, group).collect()}
        assert len(got) == len(set(questions))
        for k, at, level in questions:
            of = values if k == "a" else [-5.0, -6.0] if k == "b" else []
            want = next((i + 1 for i in range(at, len(of)) if level is not None and of[i] is not None and of[i] < level), None)
            assert got[k, at, level] == want


def test_prefix_sums_and_maxima(spark):
    rng = np.random.default_rng(9)
    rows = [("ab"[i % 2], i, None if i % 11 == 0 else float(rng.integers(0, 100))) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    for current in (True, False):
        out = prefix(df, "k", "i", F.floor(F.col("i") / 13), {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, current)
        for r in out.collect():
            seen = [v for k, i, v in rows if k == r.k and v is not None and (i <= r.i if current else i < r.i)]
            assert (r.s, r.m) == ((sum(seen), max(seen)) if seen else (None, None))


def series(spark, n=180, seed=6):
    rng = np.random.default_rng(seed)
    opens = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
    return feats(spark, n, set(range(2, n, 7)) | {n - 1}, lows=[float(x) for x in opens * rng.uniform(0.95, 1, n)],
                 opens=[float(x) for x in opens])


def walk(f, level, trailing=None, hold=None):
    """decision bar, exit bar and reason of each signal, bar by bar."""
    rows, out = sorted(f.collect(), key=lambda r: r.date), {}
    for s, r in enumerate(rows):
        if r.rvol <= 1:
            continue
        e, decision, reason = s + 1, None, "open"
        for d in range(e + 1, len(rows)):
            stop = (1 - trailing) * max(b.high for b in rows[e:d]) if trailing is not None else level(rows[e])
            if rows[d].low < stop or (hold is not None and d >= e + hold):
                decision, reason = d, "stop" if rows[d].low < stop else "time"
                break
        filled = decision is not None and decision + 1 < len(rows)
        out[s + 1] = (T.OPEN_FOREVER if decision is None else decision + 1, rows[decision + 1].open if filled else None,
                      decision + 1 - e if filled else None, reason if filled else "open")
    return out


def result(df):
    return {r.signal_bar: (r.decision_bar, r.exit_px, r.bars_held, r.exit_reason) for r in df.collect()}


@pytest.mark.parametrize("share,hold", [(1.0, None), (0.8, None), (0.9, 30), (0.0, 5)])
def test_stop_rules_equal_a_walk(spark, share, hold):
    f = series(spark)
    rule = T.ExitRule(level=F.col("low") * share, max_hold_bars=hold)
    got = result(T.label_exits_custom(f, rule, P, block=8, group=3))
    assert got == walk(f, lambda r: r.low * share, hold=hold)


@pytest.mark.parametrize("trailing", [0.05, 0.25])
def test_trailing_stops_equal_a_walk(spark, trailing):
    f = series(spark, seed=12)
    got = result(T.label_exits_custom(f, T.ExitRule(trailing=trailing), P, block=8, group=3))
    assert got == walk(f, None, trailing)


def test_the_built_in_rule_is_one_of_them(spark):
    f = series(spark, seed=3)
    same = T.label_exits_custom(f, T.ExitRule(max_hold_bars=P.max_hold_bars), P)
    built_in = T.label_exits(f, P)
    assert same.columns == built_in.columns and sorted(same.collect()) == sorted(built_in.collect())


def test_statistics_equal_a_walk_over_the_trades(spark):
    f = series(spark, seed=21)
    got = T.trade_statistics(f, P, chunk_bars=16).collect()[0]
    trades = T.non_overlapping_trades(T.labelled_signals(f, P), P).toPandas().sort_values("signal_bar")
    n, cash, top, since, below, dd, longest = f.count(), P.cash, P.cash, 1, False, 0.0, 0
    returns = []
    for r in trades.itertuples():
        if pd.isna(r.exit_px):
            continue
        returns.append(r.exit_px * (1 - P.commission) / (r.entry_px * (1 + P.commission)) - 1)
        cash *= 1 + returns[-1]
        bar = r.decision_bar + 1
        if cash < top or below:
            longest = max(longest, bar - since)
        below = cash < top
        if not below:
            top, since = cash, bar
        dd = max(dd, 1 - cash / top)
    if below:
        longest = max(longest, n - since)
    held = sum(n - r.signal_bar if pd.isna(r.bars_held) else r.bars_held for r in trades.itertuples())
    wins, losses = sum(x for x in returns if x > 0), -sum(x for x in returns if x < 0)
    assert (got.trades, got.max_drawdown_bars, got.max_bars_held) == (len(trades), longest, trades.bars_held.max())
    for a, b in ((got.exposure, held / n), (got.max_drawdown, dd), (got.profit_factor, wins / losses),
                 (got.sqn, math.sqrt(len(returns)) * np.mean(returns) / np.std(returns, ddof=1)),
                 (got.avg_bars_held, trades.bars_held.mean())):
        assert abs(a - b) < 1e-6
    assert abs(got.peak_value - top) < 0.01
    assert got.max_drawdown > 0 and got.max_drawdown_bars > 0


def test_symbols_without_trades_are_there(spark):
    r = T.trade_statistics(feats(spark, 20, set()), P).collect()[0]
    assert (r.trades, r.exposure, r.peak_value, r.max_drawdown, r.max_drawdown_bars) == (0, 0.0, P.cash, 0.0, 0)
