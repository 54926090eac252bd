"""Brute-force pandas versions of the features, written from the definitions
(one symbol at a time, bar by bar), used to check the Spark plans."""

import numpy as np
import pandas as pd


def ewm_step(x, alpha, seed=None, seed_count=1):
    """Recursive mean that skips missing values and shows the last one there;
    starts at the ``seed_count``-th value with ``seed`` (default: that value)."""
    out, y, k = np.full(len(x), np.nan), np.nan, 0
    for i, v in enumerate(x):
        if not np.isnan(v):
            k += 1
            if k == seed_count:
                y = v if seed is None else seed
            elif k > seed_count:
                y = (1 - alpha) * y + alpha * v
        out[i] = y
    return out


def counted(x, values, least):
    """``values`` where at least ``least`` values of x have been seen."""
    return np.where(np.cumsum(~np.isnan(x)) >= least, values, np.nan)


def features_one(df: pd.DataFrame) -> pd.DataFrame:
    df = df.sort_values("date").reset_index(drop=True)
    c, o, h, lo, v = (df[k].to_numpy(float) for k in ["close", "open", "high", "low", "volume"])
    n = len(df)
    pc = np.r_[np.nan, c[:-1]]
    out = pd.DataFrame({"symbol": df["symbol"], "date": df["date"]})
    with np.errstate(divide="ignore", invalid="ignore"):
        out["pct_change"] = np.round((c / pc - 1) * 100, 2)
        gap = np.where(pc == 0, 0.0, np.round((o - pc) / pc * 100, 2))
        out["pct_gap"] = np.where(np.isnan(pc), np.nan, gap)
        out["pct_open_to_close"] = np.round((c - o) / o * 100, 2)
        adv = pd.Series(v).rolling(14).mean().round(0).to_numpy()
        out["adv"] = adv
        out["rvol"] = np.where(adv == 0, np.nan, np.round(v / adv, 2))
        parts = np.vstack([h - lo, np.abs(h - pc), np.abs(lo - pc)])
        tr = np.where(np.isnan(parts).all(axis=0), np.nan, np.fmax.reduce(parts))
        known = tr[~np.isnan(tr)]
        atr = ewm_step(tr, 1 / 14, known[:14].mean() if len(known) >= 14 else 0.0, 14)
        atr = np.round(atr, 2)
        atr[atr == 0] = np.nan
        out["atr"] = atr
        dtr = np.round(np.abs(h - lo), 2)
        out["dtr"] = dtr
        out["tr_comp"] = np.round(dtr / atr, 2)
        e9 = counted(c, ewm_step(c, 0.2), 9)
        e21 = counted(c, ewm_step(c, 2 / 22), 21)
        out["ema_9"] = np.round(e9, 2)
        out["ema_21"] = np.round(e21, 2)
        out["sma_50"] = pd.Series(c).rolling(50).mean().round(2).to_numpy()
        out["sma_200"] = pd.Series(c).rolling(200).mean().round(2).to_numpy()
        d = np.r_[0.0, np.diff(c)]
        up = ewm_step(np.where(d > 0, d, 0.0), 1 / 14)
        dn = ewm_step(np.where(d < 0, -d, 0.0), 1 / 14)
        rsi = np.where(dn == 0, 100.0, 100 - 100 / (1 + up / dn))
        rsi[:13] = np.nan
        out["rsi"] = np.round(rsi, 2)
        out["range_pct"] = np.round((c - lo) / (h - lo), 2)
        out["trend_strength"] = np.round(np.abs(o - c) / np.abs(h - lo), 2)
    return out.replace([np.inf, -np.inf], np.nan)


def features(bars: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([features_one(g) for _, g in bars.groupby("symbol")], ignore_index=True)
