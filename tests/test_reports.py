"""Movers need K+1 rows; top-k ties break by symbol; breadth counts add up."""

import numpy as np

from helpers import make_bars
from marketframe.operators.features import build_features
from marketframe.plans import reports as R
from marketframe.schema import FeatureParams


def test_movers_need_k_plus_one_rows(spark):
    up = lambda n: {"open": np.linspace(10, 20, n), "high": np.linspace(10, 20, n) + 1,
                    "low": np.linspace(10, 20, n) - 1, "close": np.linspace(10, 20, n),
                    "volume": np.ones(n)}
    f = build_features(make_bars(spark, {"FIVE": up(5), "SIX": up(6), "K40": up(40), "K41": up(41)}),
                       FeatureParams(block_size=256, scan_chunk=32))
    # FIVE has 5 bars (needs 6); SIX doubles over 5 sessions; the 40/41-bar
    # ramps move under 20% over their last 5 sessions.
    assert [r.symbol for r in R.up_20_in_5(f).collect()] == ["SIX"]
    # K41 doubles over 40 sessions; K40 has 40 bars (needs 41).
    assert [r.symbol for r in R.up_50_in_40(f).collect()] == ["K41"]


def test_breadth_counts_add_up(spark):
    rng = np.random.default_rng(1)
    series = {}
    for i in range(12):
        c = 100 + np.cumsum(rng.normal(0, 1, 30))
        series[f"S{i:02d}"] = {"open": c, "high": c + 1, "low": c - 1, "close": c, "volume": np.ones(30)}
    f = build_features(make_bars(spark, series), FeatureParams(block_size=256, scan_chunk=32))
    a = R.advance_vs_decline(f).collect()[0]
    n = R.latest_session(f).count()
    nulls = R.latest_session(f).filter("pct_change is null").count()
    assert a.advances + a.declines + a.no_change + nulls == n
    top = R.top_rvol(f).collect()
    assert len(top) == 10 and top == sorted(top, key=lambda r: (r.rvol is None, -(r.rvol or 0), r.symbol))
    from marketframe.schema import ReportParams
    assert R.top_rvol(f, params=ReportParams(top_n=3)).collect() == top[:3]
    reps = R.all_reports(f, f, f, ReportParams(top_n=3))
    assert all(reps[k].count() == 3 for k in ("top_rvol", "top_tr_comp", "gainers", "losers"))
    rows = R.down_20_in_5(f).collect()
    assert [r.pct_change_5 for r in rows] == sorted(r.pct_change_5 for r in rows)
