import numpy as np
from pyspark.sql import functions as F

from marketframe.functions.numeric import div, nan_to_null, rnd


def test_rnd_matches_numpy_half_even(spark):
    rng = np.random.default_rng(3)
    xs = np.concatenate([rng.uniform(-1000, 1000, 2000), np.arange(-20, 20) + 0.5,
                         np.round(rng.uniform(-10, 10, 500), 3)])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select(rnd("x", 2).alias("r2"), rnd("x", 0).alias("r0"), rnd("x", 1).alias("r1")).toPandas()
    assert (got.r2.to_numpy() == np.round(xs, 2)).all()
    assert (got.r0.to_numpy() == np.round(xs, 0)).all()
    assert (got.r1.to_numpy() == np.round(xs, 1)).all()


def test_div_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0), (float("nan"), 1.0)], "a double, b double")
    got = df.select(div("a", "b").alias("q"), nan_to_null(F.col("a")).alias("n")).collect()
    assert [r.q for r in got[:3]] == [None, None, 2.0]
    assert got[3].n is None
