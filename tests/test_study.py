"""Exit rules, open trades and the non-overlap rule on hand-made series."""

import numpy as np
import pandas as pd
import pytest

from marketframe.plans import study as T
from marketframe.schema import FEATURES_SCHEMA, StudyParams

P = StudyParams(min_adv=0.0, start_exclusive="2000-01-01", end_exclusive="2100-01-01",
                symbols=("S",), warmup_bars=0)


def feats(spark, n, fire_at, lows=None, opens=None):
    import datetime
    rows = []
    for i in range(n):
        fire = i in fire_at
        low = lows[i] if lows is not None else 10.0
        op = opens[i] if opens is not None else 10.0 + i
        rows.append(("S", datetime.date(2001, 1, 1) + datetime.timedelta(days=i),
                     None, None, 1.0 if fire else -1.0, op, op + 1, low, op, 1e6, 1e6,
                     2.0 if fire else 0.5, None, None, None, 0.0, None, None, None, None,
                     0.9 if fire else 0.1, None))
    return spark.createDataFrame(rows, FEATURES_SCHEMA)


def test_stop_exit(spark):
    lows = [10.0] * 20
    lows[4] = 9.0  # entry bar is 2 (signal on 1); bar 4 is 2 bars after entry
    t = T.label_exits(feats(spark, 20, {1}, lows=lows), P).toPandas()
    r = t.iloc[0]
    assert r.signal_bar == 2 and r.exit_reason == "stop"
    assert r.decision_bar == 5 and r.bars_held == 3
    assert r.entry_px == 12.0 and r.exit_px == 15.0


def test_time_exit_after_seven_bars(spark):
    t = T.label_exits(feats(spark, 20, {1}), P).toPandas().iloc[0]
    assert t.exit_reason == "time" and t.decision_bar == 3 + 7 and t.bars_held == 8


def test_signal_on_last_bar_stays_open(spark):
    t = T.label_exits(feats(spark, 10, {9}), P).toPandas().iloc[0]
    assert t.exit_reason == "open" and pd.isna(t.entry_date) and pd.isna(t.exit_px)
    t = T.label_exits(feats(spark, 10, {5}), P).toPandas().iloc[0]
    assert t.exit_reason == "open" and not pd.isna(t.entry_date) and pd.isna(t.exit_px)


def test_non_overlap(spark):
    # signals on every bar 1..12: first trade (signal bar 2) decides on bar 10,
    # so bars 3..9 are skipped and bar 10 fires again.
    f = feats(spark, 30, set(range(1, 13)))
    kept = T.non_overlapping_trades(T.labelled_signals(f, P), P).toPandas().sort_values("signal_bar")
    assert list(kept.signal_bar) == [2, 10]
    prev_d = 0
    for s, d in zip(kept.signal_bar, kept.decision_bar):
        assert s >= prev_d
        prev_d = d


def test_returns_and_summary(spark):
    f = feats(spark, 30, {1})
    tr = T.trades(f, P).toPandas().iloc[0]
    assert np.isclose(tr.return_pct, tr.exit_px * 0.998 / (tr.entry_px * 1.002) - 1)
    s = T.trade_summary(f, P).toPandas().iloc[0]
    assert s.trades == 1 and s.wins == 1 and s.win_rate == 1.0


def test_non_overlap_clusters_match_plain_fold(spark):
    """Signals in several clusters (gaps above and below the 8-bar span)."""
    fire = {1, 2, 5, 9, 10, 11, 30, 38, 39, 47, 48, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80}
    f = feats(spark, 100, fire)
    lab = T.label_exits(f, P).toPandas().sort_values("signal_bar")
    free, want = 0, []
    for r in lab.itertuples():
        if pd.isna(r.entry_date):
            continue
        if r.signal_bar >= free:
            want.append(r.signal_bar)
            free = r.decision_bar
    kept = T.non_overlapping_trades(T.labelled_signals(f, P), P).toPandas()
    assert sorted(kept.signal_bar) == want


def test_run_reads_one_trade_table(spark):
    f = feats(spark, 40, {1, 20})
    out = T.run(f, P)
    assert out["trades_ranked"].count() == 2
    assert out["trade_summary_all"].collect()[0].trades == 2


def test_clusters_equal_a_walk_over_all_signals(spark):
    fire = {1, 2, 5, 9, 10, 11, 30, 38, 39, 47, 48, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80}
    labelled = T.labelled_signals(feats(spark, 100, fire), P)
    kept = [r.signal_bar for r in T.non_overlapping_trades(labelled, P).orderBy("signal_bar").collect()]
    want, free = [], 0
    for r in labelled.orderBy("signal_bar").collect():
        if r.signal_bar >= free:
            want.append(r.signal_bar)
            free = r.decision_bar
    assert kept == want


def test_user_rule_replaces_the_built_in_one(spark):
    from pyspark.sql import functions as F
    f = feats(spark, 30, {5, 9})
    assert [r.signal_bar for r in T.entry_signals(f, P).orderBy("signal_bar").collect()] == [6, 10]
    mine = F.col("open") == 22.0
    assert [r.signal_bar for r in T.entry_signals(f, P, mine).collect()] == [13]
    assert [r.signal_bar for r in T.label_exits(f, P, rule=mine).collect()] == [13]
    assert T.run(f, P, mine)["trades_ranked"].count() == 1


def test_trades_come_best_first(spark):
    rows = T.trades_ranked(feats(spark, 60, {2, 20, 40}), P).collect()
    returns = [r.return_pct for r in rows]
    assert len(rows) == 3 and returns == sorted(returns, reverse=True)


def test_symbol_that_fires_every_bar_is_many_blocks(spark):
    rng = np.random.default_rng(8)
    n = 600
    f = feats(spark, n, set(range(n)), lows=[9.0 if u < 0.3 else 10.0 for u in rng.uniform(size=n)])
    labelled = T.labelled_signals(f, P)
    want, free = [], 0
    for r in sorted(labelled.collect(), key=lambda r: r.signal_bar):
        if r.entry_date is not None and r.signal_bar >= free:
            want.append(r.signal_bar)
            free = r.decision_bar
    for size in (8, 50, 256):
        kept = T.non_overlapping_trades(labelled, P, block_bars=size)
        assert sorted(r.signal_bar for r in kept.select("signal_bar").collect()) == want
    with pytest.raises(ValueError):
        T.non_overlapping_trades(labelled, P, block_bars=7)
