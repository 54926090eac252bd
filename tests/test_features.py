"""Layer 1 (hand-made series) and layer 3 (properties) for the feature build."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from helpers import frames_equal, make_bars, random_series
from marketframe.operators.features import build_features, true_range
from marketframe.schema import FeatureParams

COLS = ["pct_change", "pct_gap", "pct_open_to_close", "adv", "rvol", "atr", "dtr", "tr_comp",
        "ema_9", "ema_21", "sma_50", "sma_200", "rsi", "range_pct", "trend_strength"]
SMALL = FeatureParams(block_size=256, scan_chunk=32)


def run(spark, series, params=SMALL):
    bars = make_bars(spark, series)
    got = build_features(bars, params).toPandas()
    want = brute.features(bars.toPandas())
    return got, want


@pytest.mark.parametrize("n", [13, 14, 15])
def test_warmup_boundaries(spark, n):
    rng = np.random.default_rng(n)
    got, want = run(spark, {"S": random_series(rng, n)})
    frames_equal(got, want, COLS)
    g = got.sort_values("date")
    assert g.atr.isna().sum() == min(n, 13)
    assert g.rsi.isna().sum() == min(n, 13)
    assert g.ema_9.isna().sum() == 8 and g.ema_21.isna().sum() == min(n, 20)


def test_long_series_across_blocks_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    series = {f"S{i}": random_series(rng, n) for i, n in enumerate([700, 260, 40, 1])}
    got, want = run(spark, series)
    frames_equal(got, want, COLS)


def test_block_layout_does_not_change_results(spark):
    rng = np.random.default_rng(11)
    bars = make_bars(spark, {"A": random_series(rng, 600), "B": random_series(rng, 333)})
    a = build_features(bars, FeatureParams(block_size=200, scan_chunk=8)).toPandas()
    b = build_features(bars.repartition(5), FeatureParams(block_size=2048, scan_chunk=256)).toPandas()
    frames_equal(a, b, COLS)


def test_rising_closes_sma_and_rsi(spark):
    c = np.arange(1, 251, dtype=float) + 100
    got, want = run(spark, {"UP": {"open": c, "high": c + 1, "low": c - 1, "close": c, "volume": c}})
    frames_equal(got, want, COLS)
    g = got.sort_values("date")
    assert g.sma_200.notna().sum() == 51
    assert (g.rsi.dropna() == 100.0).all()


def test_flat_bars(spark):
    n = 20
    c = np.full(n, 50.0)
    got, _ = run(spark, {"F": {"open": c, "high": c, "low": c, "close": c, "volume": np.full(n, 10.0)}})
    assert got.range_pct.isna().all() and got.trend_strength.isna().all()
    assert (got.dtr == 0).all() and got.atr.isna().all() and got.tr_comp.isna().all()


def test_previous_close_zero_and_zero_volume(spark):
    n = 16
    c = np.r_[0.0, np.full(n - 1, 10.0)]
    got, want = run(spark, {"Z": {"open": np.full(n, 10.0), "high": np.full(n, 11.0),
                                  "low": np.full(n, 9.0), "close": c, "volume": np.zeros(n)}})
    g = got.sort_values("date").reset_index(drop=True)
    assert np.isnan(g.pct_gap[0]) and g.pct_gap[1] == 0.0 and np.isnan(g["pct_change"][1])
    assert (g.adv.dropna() == 0).all() and g.rvol.isna().all()


def test_two_symbols_interleaved_equal_separate(spark):
    rng = np.random.default_rng(5)
    a, b = random_series(rng, 120), random_series(rng, 90)
    both, _ = run(spark, {"A": a, "B": b})
    alone, _ = run(spark, {"A": a})
    frames_equal(both[both.symbol == "A"], alone, COLS)


def test_properties(spark):
    rng = np.random.default_rng(9)
    got, _ = run(spark, {f"P{i}": random_series(rng, 300) for i in range(4)})
    rp = got.range_pct.dropna()
    assert ((rp >= 0) & (rp <= 1)).all()
    rsi = got.rsi.dropna()
    assert ((rsi >= 0) & (rsi <= 100)).all()


def test_true_range_first_bar_is_high_minus_low(spark):
    rng = np.random.default_rng(2)
    s = random_series(rng, 30)
    bars = make_bars(spark, {"T": s})
    tr = true_range(bars, SMALL).toPandas().sort_values("date").reset_index(drop=True)
    assert tr.true_range[0] == pytest.approx(s["high"][0] - s["low"][0])
    pc = s["close"][4]
    assert tr.true_range[5] == pytest.approx(max(s["high"][5] - s["low"][5], abs(s["high"][5] - pc),
                                                 abs(s["low"][5] - pc)))


def test_intraday_bars_with_day_chunks(spark):
    """Minute bars: the same build with numbering chunked by day."""
    import datetime

    from pyspark.sql import functions as F

    from marketframe.schema import BARS_SCHEMA
    rng = np.random.default_rng(21)
    s = random_series(rng, 600)
    t0 = datetime.datetime(2024, 1, 2, 14, 30)
    rows = [("M", t0 + datetime.timedelta(minutes=7 * i),
             *(float(s[k][i]) for k in ["open", "high", "low", "close", "volume"])) for i in range(600)]
    schema = BARS_SCHEMA.fieldNames()
    bars = spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c == 'symbol' else 'timestamp' if c == 'date' else 'double'}"
                                                 for c in schema))
    got = build_features(bars, SMALL, chunk=F.to_date("date")).toPandas()
    want = brute.features(bars.toPandas())
    frames_equal(got, want, COLS)


@pytest.mark.parametrize("column", ["close", "high", "low", "volume"])
def test_missing_values_in_a_series(spark, column):
    rng = np.random.default_rng(31)
    s = random_series(rng, 300)
    for at in (3, 40, 41, 150, 255, 256):
        s[column][at] = np.nan
    if column == "high":
        s["low"][40] = np.nan
    got, want = run(spark, {"G": s, "H": random_series(rng, 60)})
    frames_equal(got, want, COLS)
    g = got[got.symbol == "G"].sort_values("date").reset_index(drop=True)
    ewm = pd.Series(s["close"]).ewm(span=9, adjust=False, ignore_na=True, min_periods=9).mean().round(2)
    assert np.allclose(g.ema_9, ewm, atol=1e-9, equal_nan=True)
    assert np.allclose(g.adv, pd.Series(s["volume"]).rolling(14).mean().round(0), atol=1e-9, equal_nan=True)


def test_constant_closes_stay_constant_over_a_gap(spark):
    c = np.full(60, 100.0)
    c[30] = np.nan
    got, _ = run(spark, {"C": {"open": np.full(60, 100.0), "high": np.full(60, 101.0), "low": np.full(60, 99.0),
                               "close": c, "volume": np.full(60, 5.0)}})
    g = got.sort_values("date")
    assert (g.ema_9.dropna() == 100.0).all() and g.ema_9.notna().sum() == 52
    assert (g.ema_21.dropna() == 100.0).all()


def test_only_wanted_stages_are_planned(spark):
    rng = np.random.default_rng(3)
    bars = make_bars(spark, {"A": random_series(rng, 300), "B": random_series(rng, 30)})
    full = build_features(bars, SMALL).toPandas()

    def plan(c):
        df = build_features(bars, SMALL, columns=["symbol", "date", c])
        frames_equal(df.toPandas(), full, [c])
        return df._jdf.queryExecution().optimizedPlan().toString()

    for c in ("pct_open_to_close", "dtr", "range_pct", "trend_strength"):
        p = plan(c)
        assert "Window" not in p and "Join" not in p and "Aggregate" not in p
    for c in ("pct_change", "pct_gap", "adv", "rvol", "sma_50", "sma_200"):
        p = plan(c)
        assert "Window" in p and "pow(" not in p.lower()
    for c in ("rsi", "atr", "tr_comp", "ema_9", "ema_21"):
        plan(c)


def test_sliding_means_are_exact_and_their_work_does_not_grow_with_the_window(spark):
    """Sums equal the exactly rounded ones, whatever the values' sizes."""
    import math

    from pyspark.sql import Window

    from marketframe.operators.features import _sliding_means
    rng = np.random.default_rng(2)
    n = 700
    x = rng.uniform(0, 1, n) * 10.0 ** rng.integers(-9, 9, n)
    x[::31] = np.nan
    x[300:320] = 0.0
    rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    w = Window.partitionBy(F.lit(1)).orderBy("i")
    out = _sliding_means(spark.createDataFrame(rows, "i int, x double"), {"a": ("x", 14), "b": ("x", 200)}, w, n)
    assert "-199" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = out.orderBy("i").collect()
    for name, k in (("a", 14), ("b", 200)):
        for i, r in enumerate(got):
            part = x[max(0, i - k + 1):i + 1]
            full = len(part) == k and not np.isnan(part).any()
            assert (r[name] is not None) == full
            if full:
                want = math.fsum(part) / k
                assert abs(r[name] - want) <= 4e-16 * max(want, np.nanmax(x) * 2.0 ** -30)


def test_feature_plan_has_no_sliding_frame(spark):
    from marketframe.sources import testdata as td
    bars = td.bars(spark, "/root/testdata/sf0.001")
    plan = build_features(bars, columns=["symbol", "date", "sma_200", "adv"])._jdf.queryExecution().optimizedPlan().toString()
    assert "-199" not in plan and "-13" not in plan and "RowFrame, unboundedpreceding" in plan.lower().replace("rowframe", "RowFrame")
