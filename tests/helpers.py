import datetime

import numpy as np
import pandas as pd

from marketframe.schema import BARS_SCHEMA


def make_bars(spark, series: dict[str, dict]):
    """series: symbol -> dict of equal-length lists (open, high, low, close, volume);
    dates are consecutive days from 2001-01-01."""
    rows = []
    for sym, cols in series.items():
        n = len(cols["close"])
        for i in range(n):
            d = datetime.date(2001, 1, 1) + datetime.timedelta(days=i)
            rows.append((sym, d, *(float(cols[k][i]) for k in ["open", "high", "low", "close", "volume"])))
    return spark.createDataFrame(rows, BARS_SCHEMA)


def random_series(rng, n, start=100.0):
    close = start * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
    open_ = close * np.exp(rng.normal(0, 0.01, n))
    high = np.maximum(open_, close) * (1 + rng.uniform(0, 0.02, n))
    low = np.minimum(open_, close) * (1 - rng.uniform(0, 0.02, n))
    vol = rng.integers(1_000, 100_000, n).astype(float)
    return {"open": open_, "high": high, "low": low, "close": close, "volume": vol}


def frames_equal(a: pd.DataFrame, b: pd.DataFrame, cols, tol=1e-9):
    a = a.sort_values(["symbol", "date"]).reset_index(drop=True)
    b = b.sort_values(["symbol", "date"]).reset_index(drop=True)
    assert len(a) == len(b)
    for c in cols:
        x, y = a[c].to_numpy(float), b[c].to_numpy(float)
        same_null = np.isnan(x) == np.isnan(y)
        assert same_null.all(), (c, np.where(~same_null)[0][:5], x[~same_null][:5], y[~same_null][:5])
        m = ~np.isnan(x)
        assert np.allclose(x[m], y[m], rtol=0, atol=tol), (c, np.abs(x[m] - y[m]).max())
