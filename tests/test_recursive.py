"""Indicators with unbounded memory through the hook, on many small blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
from helpers import frames_equal, make_bars, random_series
from marketframe.operators.recursive import ExponentialMeans, RelativeStrength, Together, apply_recursive, custom_recursive


@pytest.fixture(scope="module")
def bars(spark):
    rng = np.random.default_rng(5)
    return make_bars(spark, {"A": random_series(rng, 333), "B": random_series(rng, 40), "C": random_series(rng, 1)}).cache()


def test_ema_and_rsi_equal_a_loop_over_the_series(spark, bars):
    got = custom_recursive(bars, 16).toPandas()
    frames_equal(got, brute.features(bars.toPandas()), ["ema_9", "ema_21", "rsi"])


def test_super_blocks_and_missing_closes(spark, bars):
    gaps = bars.withColumn("close", F.when(F.dayofyear("date") % 5 != 2, F.col("close")))
    got = apply_recursive(gaps, ExponentialMeans(), 4, group=3).toPandas()
    frames_equal(got, brute.features(gaps.toPandas()), ["ema_9", "ema_21"])


def test_states_compose(spark, bars):
    one = bars.where("symbol = 'A'").orderBy("date").toPandas()
    for ind in (ExponentialMeans(), RelativeStrength(), Together((ExponentialMeans((5,)), RelativeStrength()))):
        k = ind.lookback
        whole = ind.summarise(one, 0)
        parts = [ind.summarise(one.iloc[:90], 0)]
        parts += [ind.summarise(one.iloc[a - k:b], k) for a, b in ((90, 91), (91, 200), (200, len(one)))]
        left = ind.compose(ind.compose(ind.compose(parts[0], parts[1]), parts[2]), parts[3])
        right = ind.compose(parts[0], ind.compose(parts[1], ind.compose(parts[2], parts[3])))
        assert np.allclose(left, whole, rtol=1e-12) and np.allclose(right, whole, rtol=1e-12)


def test_a_users_own_indicator(spark, bars):
    class RunningHigh:
        lookback = 0
        schema = T.StructType([T.StructField("high_so_far", T.DoubleType())])

        def summarise(self, bars, context):
            return [bars["high"].max()]

        def compose(self, first, then):
            return [max(first[0], then[0])]

        def finish(self, bars, context, before):
            return pd.DataFrame({"high_so_far": bars["high"].cummax().clip(lower=before[0] if before else None)})

    got = apply_recursive(bars, RunningHigh(), 7, group=2).toPandas().sort_values(["symbol", "date"])
    want = bars.toPandas().sort_values(["symbol", "date"])
    assert np.array_equal(got.high_so_far.to_numpy(), want.groupby("symbol").high.cummax().to_numpy())


def test_no_bars(spark, bars):
    assert custom_recursive(bars.where("false")).count() == 0
