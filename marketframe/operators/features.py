"""The 15 per-bar features (F1-F18) as one DataFrame plan.

Plan shape: one shuffle by (symbol, chunk) to number the bars, one shuffle by
(symbol, block) that carries halo copies for the look-back windows; lag,
sliding means and the recursive scan then all run on that partitioning,
sorted once.  The carry table of the scan is tiny (one row per block).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions.numeric import div_sql, nan_to_null, rnd, rnd_sql
from marketframe.operators.scan import Recurrence, chunk_of, linear_scan
from marketframe.operators.sequence import halo_blocks, number_rows
from marketframe.schema import BAR_COLUMNS, FEATURE_COLUMNS, FeatureParams
from marketframe.session import materialize


#: What each derived column needs besides its own bar.
ROW_LOCAL = {"pct_open_to_close", "dtr", "range_pct", "trend_strength", *BAR_COLUMNS}
RECURSIVE = {"atr", "tr_comp", "ema_9", "ema_21", "rsi"}
MEANS = {"adv", "rvol", "sma_50", "sma_200"}


def _sliding_means(d: DataFrame, means: dict[str, tuple[str, int]], w: Window, rows: int) -> DataFrame:
    """Add ``name`` = mean of the last n rows of ``col`` for every
    ``name: (col, n)``; null unless all n have a value (pandas rolling).

    The work per row does not depend on n: a window's sum is the difference of
    two running sums of its partition.  To keep that free of cancellation, a
    value is split into a multiple of a power of two, coarse enough for the
    sums of the partition's ``rows`` rows to be exact in a double, and the
    small rest; only the rests' sums are rounded, by less than the value's own
    last digit.  Every partition starts with the rows that its first windows need.
    """
    cols = sorted({c for c, _ in means.values()})
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bits = 52 - math.ceil(math.log2(rows + 1))
    top = {c: F.max(F.abs(c)).over(whole) for c in cols}
    d = d.select("*", *[F.when(top[c] > 0, F.pow(F.lit(2.0), F.least(bits - 1 - F.ceil(F.log2(top[c])), F.lit(1000))))
                        .otherwise(F.lit(1.0)).alias(f"_unit_{c}") for c in cols])
    d = d.select("*", *[(F.rint(F.col(c) * F.col(f"_unit_{c}")) / F.col(f"_unit_{c}")).alias(f"_coarse_{c}") for c in cols])

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x).over(running), F.lit(0.0))

    d = d.select("*", *[a for c in cols for a in (
        total(F.col(f"_coarse_{c}")).alias(f"_s_{c}"), total(F.col(c) - F.col(f"_coarse_{c}")).alias(f"_r_{c}"),
        F.count(c).over(running).alias(f"_n_{c}"))])

    def since(name: str, n: int) -> Column:
        return F.col(name) - F.coalesce(F.lag(name, n).over(w), F.lit(0))

    made = [F.when(since(f"_n_{c}", n) == n, (since(f"_s_{c}", n) + since(f"_r_{c}", n)) / n).alias(name)
            for name, (c, n) in means.items()]
    return d.select("*", *made).drop(*[f"{p}{c}" for c in cols for p in ("_unit_", "_coarse_", "_s_", "_r_", "_n_")])


def with_sequence_columns(bars: DataFrame, params: FeatureParams, chunk: Column | None = None):
    """Number bars per symbol, then place them in (symbol, block) partitions
    with look-back halos.  Returns the frame and the window spec to use."""
    chunk = F.year("date") if chunk is None else chunk
    numbered = number_rows(bars, "symbol", "date", chunk)
    blocked = halo_blocks(numbered, "bar_no", params.block_size, before=params.lookback)
    # Scan chunk of each own row; halo copies get -1 so that ordering by
    # (sub, bar_no) is bar order and the scan can reuse this sort.
    sub = F.when(F.col("halo") == 0,
                 chunk_of("bar_no", "block", params.scan_chunk, params.block_size)).otherwise(-1)
    w = Window.partitionBy("symbol", "block").orderBy("sub", "bar_no")
    return blocked.withColumn("sub", sub), w


def build_features(bars: DataFrame, params: FeatureParams = FeatureParams(),
                   chunk: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """bars (symbol, date, open, high, low, close, volume) -> feature columns.

    ``columns`` names the wanted ones (default: all 22); only the stages they
    need are planned.  Without a recursive column the result is one lazy plan;
    with one, the scan writes its running sums and carries first.

    ``chunk`` is the calendar unit used for numbering (default: year); for
    intraday bars pass e.g. ``F.to_date('date')``.

    A missing close or true range is skipped by the recursive means (they show
    the value before it); a sliding mean needs all its values.
    """
    p, want = params, list(columns or FEATURE_COLUMNS)
    bars = bars.select("symbol", "date", *[nan_to_null(F.col(c).cast("double")).alias(c) for c in BAR_COLUMNS[2:]])
    if set(want) <= ROW_LOCAL:
        return _project(bars, p, want)
    d, w = with_sequence_columns(bars, p, chunk)

    # Pass 1 (same window spec throughout, so one sort): previous close and
    # the true range, gain and loss that depend on it.
    d = d.select("*", F.lag("close", 1).over(w).alias("prev_close"))
    prev = F.col("prev_close")
    diff = F.col("close") - prev
    # Pass 2: sliding means, null until the window is full.
    if MEANS & set(want):
        means = {"adv": ("volume", p.adv_window), "sma_f": ("close", p.sma_fast), "sma_s": ("close", p.sma_slow)}
        needed = {"adv": "adv", "rvol": "adv", "sma_50": "sma_f", "sma_200": "sma_s"}
        used = {needed[c] for c in want if c in needed}
        d = _sliding_means(d, {k: v for k, v in means.items() if k in used}, w, p.block_size + p.lookback)
        d = d.withColumn("adv", rnd("adv", 0)) if "adv" in used else d
    d = d.filter(F.col("halo") == 0)
    if not RECURSIVE & set(want):
        return _project(d, p, want)
    d = d.select(
        "*",
        F.greatest(F.col("high") - F.col("low"),
                   F.abs(F.col("high") - prev), F.abs(F.col("low") - prev)).alias("tr"),
        F.when(diff > 0, diff).otherwise(F.lit(0.0)).alias("gain"),
        F.when(diff < 0, -diff).otherwise(F.lit(0.0)).alias("loss"),
    )

    # Pass 3: the recursive means from an empty start in one scan; the seeds
    # (first close, mean of the first true ranges) are added afterwards.
    a_fast, a_slow = 2.0 / (p.ema_fast + 1), 2.0 / (p.ema_slow + 1)
    a_atr, a_rsi = 1.0 / p.atr_window, 1.0 / p.rsi_window
    has_close, has_tr = F.col("close").isNotNull(), F.col("tr").isNotNull()
    one = F.lit(1.0)
    specs = [
        Recurrence("e_fast", 1.0 - a_fast, F.lit(a_fast) * F.col("close"), has_close),
        Recurrence("e_slow", 1.0 - a_slow, F.lit(a_slow) * F.col("close"), has_close),
        Recurrence("n_close", 1.0, one, has_close),
        Recurrence("y_up", 1.0 - a_rsi, F.lit(a_rsi) * F.col("gain")),
        Recurrence("y_dn", 1.0 - a_rsi, F.lit(a_rsi) * F.col("loss")),
        Recurrence("e_atr", 1.0 - a_atr, F.lit(a_atr) * F.col("tr"), has_tr),
        Recurrence("s_tr", 1.0, F.col("tr"), has_tr),
        Recurrence("n_tr", 1.0, one, has_tr),
    ]
    needs = {"ema_9": {"e_fast", "n_close"}, "ema_21": {"e_slow", "n_close"}, "rsi": {"y_up", "y_dn"},
             "atr": {"e_atr", "s_tr", "n_tr"}, "tr_comp": {"e_atr", "s_tr", "n_tr"}}
    used = set().union(*[needs[c] for c in want if c in needs])
    d = linear_scan(d, [s for s in specs if s.name in used], "symbol", "block", "bar_no", p.scan_chunk, p.block_size,
                    sub_col="sub")
    seeds = []
    if "n_close" in used:
        first = has_close & (F.col("n_close") == 1)
        seeds.append(F.max(F.when(first, F.col("close"))).alias("first_close"))
    if "n_tr" in used:
        full = has_tr & (F.col("n_tr") == p.atr_window)
        seeds.append(F.max(F.when(full, F.col("s_tr") / p.atr_window)).alias("atr_seed"))
        seeds.append(F.max(F.when(full, F.col("e_atr"))).alias("atr_start"))
    if seeds:
        # One row per symbol, from the first bars of each.
        d = d.join(materialize(d.groupBy("symbol").agg(*seeds)), "symbol")
    if "n_close" in used:
        d = d.withColumns({f"y_{k}": F.col(f"e_{k}") + F.pow(F.lit(1.0 - a), F.col("n_close")) * F.col("first_close")
                           for k, a in (("fast", a_fast), ("slow", a_slow)) if f"e_{k}" in used})
    if "n_tr" in used:
        since = F.col("n_tr") - p.atr_window
        d = d.withColumn("y_atr", F.when(since == 0, F.col("atr_seed")).when(
            since > 0, F.col("e_atr") + F.pow(F.lit(1.0 - a_atr), since) * (F.col("atr_seed") - F.col("atr_start"))))
    return _project(d, p, want)


def _project(d: DataFrame, p: FeatureParams, want: list[str]) -> DataFrame:
    """The wanted columns from the stages' results, as SQL text (one parse
    per column instead of one JVM call per operator)."""
    atr = f"CASE WHEN {rnd_sql('y_atr', 2)} <> 0 THEN {rnd_sql('y_atr', 2)} END"
    dtr = rnd_sql("abs(high - low)", 2)
    rsi = ("CASE WHEN y_dn = 0 THEN 100.0D "
           f"ELSE {rnd_sql('100.0D - 100.0D / (1.0D + y_up / y_dn)', 2)} END")
    sql = {
        "pct_change": rnd_sql(f"({div_sql('close', 'prev_close')} - 1) * 100", 2),
        "pct_open_to_close": rnd_sql(div_sql('close - open', 'open') + ' * 100', 2),
        "pct_gap": f"CASE WHEN prev_close = 0 THEN 0.0D "
                   f"ELSE {rnd_sql(div_sql('open - prev_close', 'prev_close') + ' * 100', 2)} END",
        "rvol": rnd_sql(div_sql('volume', 'adv'), 2),
        "atr": atr,
        "dtr": dtr,
        "tr_comp": rnd_sql(div_sql(dtr, atr), 2),
        "ema_9": f"CASE WHEN n_close >= {p.ema_fast} THEN {rnd_sql('y_fast', 2)} END",
        "ema_21": f"CASE WHEN n_close >= {p.ema_slow} THEN {rnd_sql('y_slow', 2)} END",
        "sma_50": rnd_sql('sma_f', 2),
        "sma_200": rnd_sql('sma_s', 2),
        "rsi": f"CASE WHEN bar_no >= {p.rsi_window} THEN {rsi} END",
        "range_pct": rnd_sql(div_sql('close - low', 'high - low'), 2),
        "trend_strength": rnd_sql(div_sql('abs(open - close)', 'abs(high - low)'), 2),
    }
    return d.selectExpr(*[f"{sql[c]} AS {c}" if c in sql else c for c in want])


def true_range(bars: DataFrame, params: FeatureParams = FeatureParams()) -> DataFrame:
    """true range per bar; the first bar of a symbol uses high - low."""
    p = FeatureParams(block_size=params.block_size, scan_chunk=params.scan_chunk,
                      adv_window=2, atr_window=2, sma_fast=2, sma_slow=2)
    d, w = with_sequence_columns(bars, p)
    prev = F.lag("close", 1).over(w)
    d = d.select("symbol", "date", "high", "low", "halo", prev.alias("pc"))
    return d.filter(F.col("halo") == 0).select(
        "symbol", "date",
        F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("pc")),
                   F.abs(F.col("low") - F.col("pc"))).alias("true_range"))
