"""The chunked affine scan equals the step-by-step recurrence for any chunking."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketframe.operators.scan import Recurrence, linear_scan
from marketframe.operators.sequence import halo_blocks


@settings(max_examples=6, deadline=None)
@given(n=st.integers(1, 400), chunk=st.sampled_from([1, 4, 16, 64]),
       blocks=st.sampled_from([1, 2, 4]), alpha=st.sampled_from([0.2, 1 / 14, 2 / 22, 0.5]),
       seed=st.integers(0, 1000))
def test_scan_equals_recurrence(spark, n, chunk, blocks, alpha, seed):
    x = np.random.default_rng(seed).uniform(0, 100, n)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "i": np.arange(1, n + 1), "x": x}))
    bs = chunk * blocks
    d = halo_blocks(df, "i", bs, before=0)
    u = F.when(F.col("i") == 1, F.col("x")).otherwise(F.lit(alpha) * F.col("x"))
    got = linear_scan(d, [Recurrence("y", 1 - alpha, u)], "k", "block", "i", chunk, bs)
    got = got.toPandas().sort_values("i").y.to_numpy()
    want = pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    assert np.allclose(got, want, rtol=1e-12, atol=0)


def test_long_chunk_is_exact_and_guarded(spark):
    import pytest
    n = 2500
    x = np.random.default_rng(4).uniform(1, 1000, n)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "i": np.arange(1, n + 1), "x": x}))
    d = halo_blocks(df, "i", 2048, before=0)
    u = F.when(F.col("i") == 1, F.col("x")).otherwise(F.lit(0.2) * F.col("x"))
    got = linear_scan(d, [Recurrence("y", 0.8, u)], "k", "block", "i", 1024, 2048)
    got = got.toPandas().sort_values("i").y.to_numpy()
    want = pd.Series(x).ewm(alpha=0.2, adjust=False).mean().to_numpy()
    assert np.allclose(got, want, rtol=1e-13, atol=0)
    with pytest.raises(ValueError):
        linear_scan(d, [Recurrence("y", 0.5, u)], "k", "block", "i", 2048, 2048)


def test_thousands_of_chunks_of_one_key(spark):
    n = 9000
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 100, n)
    ok = rng.uniform(size=n) > 0.2
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "i": np.arange(1, n + 1), "x": x, "ok": ok}))
    d = halo_blocks(df, "i", 4, before=0)
    specs = [Recurrence("y", 0.9, F.lit(0.1) * F.col("x")), Recurrence("z", 0.8, F.lit(0.2) * F.col("x"), F.col("ok")),
             Recurrence("n", 1.0, F.lit(1.0), F.col("ok"))]
    got = linear_scan(d, specs, "k", "block", "i", 2, 4).toPandas().sort_values("i")
    y, z, k, want = 0.0, 0.0, 0, []
    for v, o in zip(x, ok):
        y = 0.9 * y + 0.1 * v
        z, k = (0.8 * z + 0.2 * v, k + 1) if o else (z, k)
        want.append((y, z, k))
    assert np.allclose(got[["y", "z", "n"]].to_numpy(), np.array(want), rtol=1e-11, atol=0)


def test_no_list_per_key(spark):
    from marketframe.operators.scan import SUPER, _carries
    rows = spark.range(3 * SUPER).selectExpr("'a' AS k", "id AS block", "0 AS _sub",
                                             "named_struct('y', named_struct('n', 4L, 'l', 1.0D)) AS x")
    plan = _carries(rows, [Recurrence("y", 0.9, F.col("x"))], "k", "block")._jdf.queryExecution().optimizedPlan().toString()
    assert "_super" in plan and f"/ {SUPER}" in plan.replace("/ 256.0", "/ 256")
