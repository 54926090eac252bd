"""DuckDB SQL that recomputes each query from the raw test tables.

Used as the independent check of the Spark plans (``oracle_sql()`` in
``__spark_entry__``).  Per-symbol recursions are written as recursive CTEs
stepping one bar at a time; sliding means sum the frame left to right, as
Spark does, so that rounding sees the same doubles.
"""

from __future__ import annotations

from marketframe.schema import FEATURE_COLUMNS, FeatureParams, ReportParams, StudyParams
from marketframe.sources.testdata import BASKET_MAX_BRAND, BASKET_TYPES, REPORT_PARAMS, STUDY_PARAMS

FP = FeatureParams()


def R(expr: str, places: int) -> str:
    """pandas-style rounding (half to even on the scaled double)."""
    if places == 0:
        return f"round_even({expr}, 0)"
    scale = f"{10 ** places}.0"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def D(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _sum_last(col: str, n: int) -> str:
    return (f"list_reduce(list({col}) OVER (PARTITION BY symbol ORDER BY date "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), lambda a, b: a + b)")


BASKET_TYPES_SQL = f"(SELECT DISTINCT p_type FROM part ORDER BY p_type LIMIT {BASKET_TYPES})"
BASKET_BRANDS_SQL = (f"(SELECT p_brand FROM part WHERE "
                     f"TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) BETWEEN 1 AND {BASKET_MAX_BRAND})")


def bars_ctes(pre: str, by: str) -> list[str]:
    if by == "basket":
        one, two = (bars_ctes(f"{pre}{c}_", c)[0].replace(f"{pre}{c}_ticks AS", f"{pre}{c}_ticks AS MATERIALIZED")
                    for c in ("p_brand", "p_type"))
        return [one, two, f"""{pre}ticks AS (
  SELECT * FROM {pre}p_brand_ticks WHERE symbol IN {BASKET_BRANDS_SQL}
  UNION ALL SELECT * FROM {pre}p_type_ticks WHERE symbol IN {BASKET_TYPES_SQL})""", bars_ctes(pre, "p_brand")[1]]
    return [
        f"""{pre}ticks AS (
  SELECT {by} AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / NULLIF(l_quantity, 0) AS px, l_quantity AS qty,
         row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
        f"""{pre}bars AS MATERIALIZED (
  SELECT symbol, date, arg_min(px, k) AS open, max(px) AS high, min(px) AS low,
         arg_max(px, k) AS close, CAST(sum(qty) AS DOUBLE) AS volume
  FROM {pre}ticks GROUP BY symbol, date)""",
    ]


GAPS = """SELECT symbol, date, open,
    CASE WHEN d % 23 <> 5 THEN high END AS high, CASE WHEN d % 46 <> 5 THEN low END AS low,
    CASE WHEN d % 17 <> 3 THEN close END AS close, CASE WHEN d % 101 <> 7 THEN volume END AS volume
  FROM (SELECT *, date - DATE '1970-01-01' AS d FROM {bars})"""


def features_ctes(pre: str, by: str, p: FeatureParams = FP, gaps: bool = False) -> list[str]:
    """CTEs ending in ``{pre}feat`` (the 22 feature columns); with ``gaps``,
    from bars in which some values are missing."""
    a9, a21 = 2.0 / (p.ema_fast + 1), 2.0 / (p.ema_slow + 1)
    a14 = 1.0 / p.rsi_window
    w = p.atr_window
    ctes = bars_ctes(pre, by)
    source = f"{pre}bars"
    if gaps:
        ctes.append(f"{pre}gaps AS MATERIALIZED (" + GAPS.format(bars=source) + ")")
        source = f"{pre}gaps"
    ctes.append(f"""{pre}f1 AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS n,
         lag(close) OVER (PARTITION BY symbol ORDER BY date) AS pc
  FROM {source})""")
    ctes.append(f"""{pre}f2 AS (
  SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
         CASE WHEN close - pc > 0 THEN close - pc ELSE CAST(0 AS DOUBLE) END AS gain,
         CASE WHEN close - pc < 0 THEN -(close - pc) ELSE CAST(0 AS DOUBLE) END AS loss
  FROM {pre}f1)""")
    def mean(col: str, n: int) -> str:
        full = (f"count({col}) OVER (PARTITION BY symbol ORDER BY date "
                f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n}")
        return f"CASE WHEN {full} THEN {_sum_last(col, n)} / {n} END"

    count = "count({}) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ctes.append(f"""{pre}f3 AS MATERIALIZED (
  SELECT *, {R('(' + mean('volume', p.adv_window) + ')', 0)} AS adv,
    {mean('close', p.sma_fast)} AS sma_f, {mean('close', p.sma_slow)} AS sma_s,
    {count.format('close')} AS nc, {count.format('tr')} AS nt,
    sum(tr) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tr_sum
  FROM {pre}f2)""")

    def ema(state: str, a: float) -> str:
        return (f"CASE WHEN f.close IS NULL THEN r.{state} WHEN f.nc = 1 THEN f.close "
                f"ELSE {D(1 - a)} * r.{state} + {D(a)} * f.close END")

    ctes.append(f"""{pre}rec AS (
  SELECT symbol, n, close AS e9, close AS e21, gain AS up, loss AS dn,
         CAST(NULL AS DOUBLE) AS atr
  FROM {pre}f3 WHERE n = 1
  UNION ALL
  SELECT f.symbol, f.n, {ema('e9', a9)}, {ema('e21', a21)},
         {D(1 - a14)} * r.up + {D(a14)} * f.gain,
         {D(1 - a14)} * r.dn + {D(a14)} * f.loss,
         CASE WHEN f.nt = {w} AND r.atr IS NULL THEN f.tr_sum / {w}
              WHEN f.tr IS NULL THEN r.atr
              WHEN f.nt > {w} THEN (r.atr * {w - 1} + f.tr) / {w} END
  FROM {pre}rec r JOIN {pre}f3 f ON f.symbol = r.symbol AND f.n = r.n + 1)""")
    atr_r = R("r.atr", 2)
    atr = f"(CASE WHEN {atr_r} <> 0 THEN {atr_r} END)"
    dtr = R("abs(f.high - f.low)", 2)
    ctes.append(f"""{pre}feat AS MATERIALIZED (
  SELECT f.symbol, f.date,
    {R('(f.close / NULLIF(f.pc, 0) - 1) * 100', 2)} AS pct_change,
    {R('(f.close - f.open) / NULLIF(f.open, 0) * 100', 2)} AS pct_open_to_close,
    CASE WHEN f.pc = 0 THEN CAST(0 AS DOUBLE) ELSE {R('(f.open - f.pc) / NULLIF(f.pc, 0) * 100', 2)} END AS pct_gap,
    f.open, f.high, f.low, f.close, f.volume, f.adv,
    {R('f.volume / NULLIF(f.adv, 0)', 2)} AS rvol,
    {atr} AS atr,
    {dtr} AS dtr,
    {R(f'{dtr} / NULLIF({atr}, 0)', 2)} AS tr_comp,
    CASE WHEN f.nc >= {p.ema_fast} THEN {R('r.e9', 2)} END AS ema_9,
    CASE WHEN f.nc >= {p.ema_slow} THEN {R('r.e21', 2)} END AS ema_21,
    {R('f.sma_f', 2)} AS sma_50,
    {R('f.sma_s', 2)} AS sma_200,
    CASE WHEN f.n >= {p.rsi_window} THEN
      (CASE WHEN r.dn = 0 THEN CAST(100 AS DOUBLE) ELSE {R('100 - 100 / (1 + r.up / r.dn)', 2)} END) END AS rsi,
    {R('(f.close - f.low) / NULLIF(f.high - f.low, 0)', 2)} AS range_pct,
    {R('abs(f.open - f.close) / NULLIF(abs(f.high - f.low), 0)', 2)} AS trend_strength
  FROM {pre}f3 f JOIN {pre}rec r ON f.symbol = r.symbol AND f.n = r.n)""")
    return ctes


def with_(ctes: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


STOCKS = features_ctes("s_", "p_brand")
ETFS = features_ctes("e_", "p_type")
BASKET = features_ctes("b_", "basket")
BASKET_FILTER = f"symbol IN {BASKET_BRANDS_SQL}"
LATEST = "date = (SELECT max(date) FROM s_feat)"


def _count(cond: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def report_sql(rp: ReportParams = REPORT_PARAMS) -> dict[str, str]:
    cols = ", ".join(FEATURE_COLUMNS)
    closer = (f"(range_pct > {rp.closer_high} OR range_pct < {rp.closer_low}) "
              f"AND rvol > {rp.min_rvol} AND adv > {rp.min_adv}")
    out = {
        "features": with_(STOCKS, f"SELECT {cols} FROM s_feat"),
        "etf_features": with_(ETFS, f"SELECT {cols} FROM e_feat"),
        "resample_bars": with_(bars_ctes("s_", "p_brand"), "SELECT * FROM s_bars"),
        "latest_session": with_(STOCKS, f"SELECT {cols} FROM s_feat WHERE {LATEST}"),
        "closers_with_rvol": with_(STOCKS, f"SELECT {cols} FROM s_feat WHERE {LATEST} AND {closer}"),
        "etf_closers_with_rvol": with_(STOCKS + ETFS,
                                       f"SELECT {cols} FROM e_feat WHERE {LATEST} AND {closer}"),
        "advance_vs_decline": with_(STOCKS, "SELECT " + ", ".join([
            _count("pct_change > 0", "advances"), _count("pct_change < 0", "declines"),
            _count("pct_change = 0", "no_change")]) + f" FROM s_feat WHERE {LATEST}"),
        "above_below_ma": with_(STOCKS, "SELECT " + ", ".join(
            _count(f"close {op} {c}", f"{side}_{label}")
            for c, label in [("ema_9", "9_ema"), ("ema_21", "21_ema"), ("sma_50", "50_sma"),
                             ("sma_200", "200_sma")]
            for op, side in [(">", "over"), ("<", "under")]) + f" FROM s_feat WHERE {LATEST}"),
    }
    top = {
        "top_rvol": ("symbol, rvol, close, pct_change, pct_open_to_close, pct_gap, tr_comp, volume",
                     "rvol DESC NULLS LAST"),
        "top_tr_comp": ("symbol, tr_comp, close, pct_change, pct_open_to_close, pct_gap, rvol, volume",
                        "tr_comp DESC NULLS LAST"),
        "gainers": ("symbol, close, pct_change, pct_open_to_close, pct_gap, rvol, tr_comp, volume",
                    "pct_open_to_close DESC NULLS LAST"),
        "losers": ("symbol, close, pct_change, pct_open_to_close, pct_gap, rvol, tr_comp, volume",
                   "pct_open_to_close ASC NULLS FIRST"),
    }
    for key, (sel, order) in top.items():
        out[key] = with_(STOCKS, f"SELECT {sel} FROM s_feat WHERE {LATEST} "
                                 f"ORDER BY {order}, symbol LIMIT {rp.top_n}")
    for prefix, ctes, table in [("", STOCKS, "s_feat"), ("basket_", BASKET, "b_feat")]:
        for name, k, thr, up in [("up_20_in_5", 5, 0.20, True), ("down_20_in_5", 5, 0.20, False),
                                 ("up_50_in_40", 40, 0.50, True), ("down_50_in_40", 40, 0.50, False)]:
            out[prefix + name] = with_(ctes, movers_sql(k, thr, up, table))
    exported = ["top_rvol", "top_tr_comp", "gainers", "losers", "up_20_in_5", "down_20_in_5",
                "up_50_in_40", "down_50_in_40", "closers_with_rvol", "etf_closers_with_rvol",
                "basket_up_20_in_5", "basket_down_20_in_5", "basket_up_50_in_40",
                "basket_down_50_in_40", "advance_vs_decline", "above_below_ma"]
    parts = []
    for key in exported:
        body = out[key].split("\nSELECT ", 1)[1] if key not in ("closers_with_rvol", "etf_closers_with_rvol") \
            else out[key].rsplit("\nSELECT ", 1)[1]
        parts.append(f"SELECT '{key}' AS report_id, count(*) AS row_count FROM (SELECT {body})")
    out["report_manifest"] = with_(STOCKS + ETFS + BASKET, "\nUNION ALL\n".join(parts))
    out["recent_rank"] = with_(STOCKS, "SELECT symbol, date, row_number() OVER "
                                       "(PARTITION BY symbol ORDER BY date DESC) AS row_num FROM s_feat")
    return out


def movers_sql(k: int, thr: float, up: bool, table: str) -> str:
    """A SELECT (no WITH) over a feature table: each symbol's newest row with the
    close ``k`` rows older taken by ``lead`` on the newest-first order."""
    ratio = "close / NULLIF(close_then, 0) - 1"
    cond = f"{ratio} > {thr}" if up else f"{ratio} < -{thr}"
    return f"""SELECT symbol, {R(f'({ratio}) * 100', 1)} AS pct_change_{k}, close, rvol, pct_change,
       pct_open_to_close, ema_9, atr, rsi, volume, adv, tr_comp, pct_gap
FROM (
  SELECT *, lead(close, {k}) OVER newest_first AS close_then,
         lead(date, {k}) OVER newest_first AS date_then,
         rank() OVER newest_first AS pos
  FROM {table}
  WINDOW newest_first AS (PARTITION BY symbol ORDER BY date DESC))
WHERE pos = 1 AND date_then IS NOT NULL AND {cond}"""


OPEN_FOREVER = 2 ** 62


def study_ctes(sp: StudyParams = STUDY_PARAMS) -> list[str]:
    syms = ", ".join(f"'{s}'" for s in sp.symbols)
    h = sp.max_hold_bars
    return [
        f"""win AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS n FROM s_feat
  WHERE adv > {sp.min_adv} AND date > DATE '{sp.start_exclusive}' AND date < DATE '{sp.end_exclusive}'
    AND symbol IN ({syms}))""",
        f"""sig AS (
  SELECT symbol, date AS signal_date, n AS signal_bar FROM win
  WHERE range_pct > {sp.min_range_pct} AND rvol > {sp.min_rvol} AND adv > {sp.min_adv}
    AND pct_gap > {sp.min_gap} AND open > ema_9 AND n - 1 >= {sp.warmup_bars})""",
        f"""sig_custom AS (
  SELECT symbol, date AS signal_date, n AS signal_bar FROM win
  WHERE tr_comp > 1.1 AND range_pct > 0.5 AND n - 1 >= {sp.warmup_bars})""",
        """ent AS (
  SELECT s.*, e.date AS entry_date, e.open AS entry_px, e.low AS entry_low, e.n AS e_n
  FROM sig s LEFT JOIN win e ON e.symbol = s.symbol AND e.n = s.signal_bar + 1)""",
        f"""dec AS (
  SELECT t.symbol, t.signal_bar, min(b.n) AS d_n
  FROM ent t JOIN win b ON b.symbol = t.symbol AND b.n BETWEEN t.e_n + 1 AND t.e_n + {h}
  WHERE b.low < t.entry_low OR b.n - t.e_n >= {h}
  GROUP BY t.symbol, t.signal_bar)""",
        f"""lab AS MATERIALIZED (
  SELECT t.symbol, t.signal_date, t.signal_bar, t.entry_date, t.entry_px,
         CAST(coalesce(d.d_n, {OPEN_FOREVER}) AS BIGINT) AS decision_bar,
         x.date AS exit_date, x.open AS exit_px,
         CAST(x.n - t.e_n AS INTEGER) AS bars_held,
         CASE WHEN x.n IS NULL THEN 'open' WHEN db.low < t.entry_low THEN 'stop' ELSE 'time' END AS exit_reason
  FROM ent t LEFT JOIN dec d ON d.symbol = t.symbol AND d.signal_bar = t.signal_bar
  LEFT JOIN win db ON db.symbol = t.symbol AND db.n = d.d_n
  LEFT JOIN win x ON x.symbol = t.symbol AND x.n = d.d_n + 1)""",
        """ks AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY signal_bar) AS k
  FROM lab WHERE entry_date IS NOT NULL)""",
        """walk AS (
  SELECT symbol, k, TRUE AS taken, decision_bar AS free_from FROM ks WHERE k = 1
  UNION ALL
  SELECT s.symbol, s.k, s.signal_bar >= w.free_from,
         CASE WHEN s.signal_bar >= w.free_from THEN s.decision_bar ELSE w.free_from END
  FROM walk w JOIN ks s ON s.symbol = w.symbol AND s.k = w.k + 1)""",
        f"""trades AS MATERIALIZED (
  SELECT ks.symbol, signal_date, entry_date, entry_px, exit_date, exit_px, bars_held, exit_reason,
         CASE WHEN exit_px IS NOT NULL
              THEN exit_px * {D(1 - sp.commission)} / (entry_px * {D(1 + sp.commission)}) - 1 END AS return_pct
  FROM ks JOIN walk ON ks.symbol = walk.symbol AND ks.k = walk.k WHERE walk.taken)""",
    ]


def _summary_sql(sp: StudyParams) -> str:
    r = "return_pct"
    growth = f"exp(sum(ln(1 + {r})))"
    return ", ".join([
        f"count({r}) AS trades",
        f"CAST(count_if({r} IS NULL) AS BIGINT) AS open_trades",
        f"CAST(count_if({r} > 0) AS BIGINT) AS wins",
        f"{R(f'count_if({r} > 0) / NULLIF(count({r}), 0)', 6)} AS win_rate",
        f"{R(f'avg({r})', 6)} AS avg_return",
        f"{R(f'max({r})', 6)} AS best_return",
        f"{R(f'min({r})', 6)} AS worst_return",
        f"{R(f'{growth} - 1', 6)} AS compounded_return",
        f"{R(f'{D(sp.cash)} * {growth}', 2)} AS final_value",
    ])


def _exits_sql(decide: str, signals: str) -> str:
    """label_exits with a decision bar that a correlated search gives."""
    return f""", ent2 AS (
  SELECT s.*, e.date AS entry_date, e.open AS entry_px, e.low AS entry_low, s.signal_bar + 1 AS e_n
  FROM {signals} s LEFT JOIN win e ON e.symbol = s.symbol AND e.n = s.signal_bar + 1),
dec2 AS ({decide})
SELECT t.symbol, t.signal_date, t.signal_bar, t.entry_date, t.entry_px,
  CAST(coalesce(d.d_n, {OPEN_FOREVER}) AS BIGINT) AS decision_bar, x.date AS exit_date, x.open AS exit_px,
  CAST(x.n - t.e_n AS INTEGER) AS bars_held, CASE WHEN x.n IS NULL THEN 'open' ELSE 'stop' END AS exit_reason
FROM ent2 t LEFT JOIN dec2 d ON d.symbol = t.symbol AND d.signal_bar = t.signal_bar
LEFT JOIN win x ON x.symbol = t.symbol AND x.n = d.d_n + 1"""


STOP_SQL = f"""SELECT t.symbol, t.signal_bar, min(b.n) AS d_n FROM ent2 t JOIN win b ON b.symbol = t.symbol
  WHERE b.n > t.e_n AND b.low < t.entry_low * {D(0.9)} GROUP BY ALL"""
TRAILING_SQL = f"""SELECT symbol, signal_bar, min(n) AS d_n FROM (
  SELECT t.symbol, t.signal_bar, b.n, b.low, max(b.high) OVER (PARTITION BY t.symbol, t.signal_bar ORDER BY b.n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM ent2 t JOIN win b ON b.symbol = t.symbol AND b.n >= t.e_n) WHERE low < top * {D(1 - 0.3)} GROUP BY ALL"""


def _statistics_sql(sp: StudyParams) -> str:
    return f""", n AS (
  SELECT symbol, count(*) AS bars, arg_min(close, n) AS first_close, arg_max(close, n) AS last_close FROM win GROUP BY symbol),
tk AS (SELECT ks.* FROM ks JOIN walk ON ks.symbol = walk.symbol AND ks.k = walk.k WHERE walk.taken),
pt AS (
  SELECT symbol, decision_bar + 1 AS bar, exit_px * {D(1 - sp.commission)} / (entry_px * {D(1 + sp.commission)}) - 1 AS r
  FROM tk WHERE exit_px IS NOT NULL),
curve AS (
  SELECT symbol, bar, ln(1 + r) AS g FROM pt UNION ALL SELECT symbol, 1, CAST(0 AS DOUBLE) FROM n),
grown AS (SELECT *, sum(g) OVER (PARTITION BY symbol ORDER BY bar) AS growth FROM curve),
peaks AS (SELECT *, max(growth) OVER (PARTITION BY symbol ORDER BY bar) AS top FROM grown),
ages AS (
  SELECT *, max(CASE WHEN growth >= top THEN bar END) OVER past AS since, lag(growth < top) OVER (PARTITION BY symbol ORDER BY bar) AS was_below
  FROM peaks WINDOW past AS (PARTITION BY symbol ORDER BY bar ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
per_curve AS (
  SELECT symbol, max(top) AS top, max(1 - exp(growth - top)) AS drawdown,
    max(CASE WHEN growth < top OR was_below THEN bar - since ELSE 0 END) AS longest,
    arg_max(CASE WHEN growth < top THEN since ELSE -1 END, bar) AS open_since FROM ages GROUP BY symbol),
per_r AS (
  SELECT symbol, sum(CASE WHEN r > 0 THEN r END) AS gains, sum(CASE WHEN r < 0 THEN -r END) AS losses,
    sqrt(count(*)) * avg(r) / NULLIF(stddev_samp(r), 0) AS sqn FROM pt GROUP BY symbol),
per_trade AS (
  SELECT tk.symbol, count(*) AS trades, sum(coalesce(bars_held, bars - signal_bar)) AS held, avg(bars_held) AS mean_held,
    max(bars_held) AS max_bars_held FROM tk JOIN n ON n.symbol = tk.symbol GROUP BY tk.symbol)
SELECT n.symbol, CAST(coalesce(trades, 0) AS BIGINT) AS trades, {R('CAST(coalesce(held, 0) AS DOUBLE) / bars', 6)} AS exposure,
  {R('mean_held', 6)} AS avg_bars_held, max_bars_held, {R('gains / NULLIF(losses, 0)', 6)} AS profit_factor, {R('sqn', 6)} AS sqn,
  {R('last_close / NULLIF(first_close, 0) - 1', 6)} AS buy_and_hold, {R(f'{D(sp.cash)} * exp(top)', 2)} AS peak_value,
  {R('drawdown', 6)} AS max_drawdown,
  CAST(greatest(longest, CASE WHEN open_since >= 0 THEN bars - open_since ELSE 0 END) AS BIGINT) AS max_drawdown_bars
FROM n LEFT JOIN per_trade ON per_trade.symbol = n.symbol LEFT JOIN per_curve ON per_curve.symbol = n.symbol
LEFT JOIN per_r ON per_r.symbol = n.symbol"""


def study_sql(sp: StudyParams = STUDY_PARAMS) -> dict[str, str]:
    base = STOCKS + study_ctes(sp)
    return {
        "label_exits_custom": with_(base, _exits_sql(STOP_SQL, "sig")),
        "label_exits_trailing": with_(base, _exits_sql(TRAILING_SQL, "sig_custom")),
        "trade_statistics": with_(base, _statistics_sql(sp)),
        "liquid_window": with_(base, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM win"),
        "publish_clustered": with_(base, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM win"),
        "distinct_symbols": with_(base, "SELECT DISTINCT symbol FROM win"),
        "entry_signals": with_(base, "SELECT symbol, signal_date, signal_bar FROM sig"),
        "entry_signals_custom": with_(base, "SELECT symbol, signal_date, signal_bar FROM sig_custom"),
        "label_exits": with_(base, "SELECT * FROM lab"),
        "non_overlapping_trades": with_(base, "SELECT ks.* EXCLUDE (k) FROM ks JOIN walk "
                                              "ON ks.symbol = walk.symbol AND ks.k = walk.k WHERE walk.taken"),
        "trades_ranked": with_(base, "SELECT * FROM trades"),
        "trade_summary": with_(base, f"SELECT symbol, {_summary_sql(sp)} FROM trades GROUP BY symbol"),
        "trade_summary_csv": with_(base, f"SELECT symbol, {_summary_sql(sp)} FROM trades GROUP BY symbol"),
        "trade_summary_all": with_(base, f"SELECT {_summary_sql(sp)} FROM trades"),
    }


def _money(expr: str, places: int) -> str:
    return f"CASE WHEN ({expr}) IS NOT NULL THEN format('{{:,.{places}f}}', {expr}) END"


IDEAS = f"""ideas AS (
  SELECT idea_id, CASE WHEN idea_id % 10 = 0 THEN 'abc' ELSE '100000' END AS portfolio,
         '0.01' AS risk, close AS entry, low AS stop, high AS target
  FROM (SELECT row_number() OVER (ORDER BY symbol) AS idea_id, close, low, high
        FROM s_feat WHERE {LATEST}))"""

SIZED = """sized AS (
  SELECT idea_id, valid AND risk_ps IS DISTINCT FROM 0 AS valid, amount AS risk_amount, profit_ps AS profit_per_share,
         risk_ps AS risk_per_share, by_risk, entry, pf,
         CASE WHEN by_risk * entry > pf THEN pf / NULLIF(entry, 0) ELSE by_risk END AS shares
  FROM (SELECT *, amount / NULLIF(risk_ps, 0) AS by_risk FROM (
    SELECT idea_id, entry, TRY_CAST(portfolio AS DOUBLE) AS pf,
           TRY_CAST(portfolio AS DOUBLE) IS NOT NULL AND TRY_CAST(risk AS DOUBLE) IS NOT NULL AS valid,
           CASE WHEN TRY_CAST(portfolio AS DOUBLE) IS NOT NULL AND TRY_CAST(risk AS DOUBLE) IS NOT NULL
                THEN TRY_CAST(portfolio AS DOUBLE) * TRY_CAST(risk AS DOUBLE) END AS amount,
           abs(entry - target) AS profit_ps, abs(entry - stop) AS risk_ps
    FROM ideas)))"""


def sizing_sql() -> dict[str, str]:
    base = STOCKS + [IDEAS, SIZED]
    sized_cols = f"""idea_id, valid, risk_amount, profit_per_share, risk_per_share,
  {R('profit_per_share / NULLIF(risk_per_share, 0)', 1)} AS rr_ratio, shares,
  {R('shares * entry', 2)} AS total_cost, {R('shares * profit_per_share', 2)} AS total_profit,
  {R('shares * risk_per_share', 2)} AS total_risk"""
    return {
        "risk_amount": with_(base, f"""SELECT idea_id, portfolio, risk,
  TRY_CAST(portfolio AS DOUBLE) IS NOT NULL AND TRY_CAST(risk AS DOUBLE) IS NOT NULL AS valid,
  TRY_CAST(portfolio AS DOUBLE) * TRY_CAST(risk AS DOUBLE) AS risk_amount,
  coalesce({_money('TRY_CAST(portfolio AS DOUBLE) * TRY_CAST(risk AS DOUBLE)', 2)}, 'Invalid input.')
    AS risk_amount_label
FROM ideas"""),
        "size_positions": with_(base, f"SELECT {sized_cols} FROM sized"),
        "position_labels": with_(base, f""", s2 AS (SELECT {sized_cols} FROM sized)
SELECT idea_id, {_money(R('shares', 0), 0)} AS shares_label,
  {_money('total_cost', 2)} AS total_cost_label, {_money('total_profit', 2)} AS total_profit_label,
  {_money('total_risk', 2)} AS total_risk_label,
  CASE WHEN rr_ratio IS NOT NULL THEN format('{{:.1f}}', rr_ratio) END AS rr_label
FROM s2"""),
    }


def source_sql() -> dict[str, str]:
    uni = f"""SELECT 'SP_500' AS universe, p_brand AS symbol FROM part
UNION SELECT 'BASKET', p_brand FROM part
  WHERE TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) BETWEEN 1 AND {BASKET_MAX_BRAND}
UNION SELECT 'BASKET', p_type FROM part WHERE p_type IN {BASKET_TYPES_SQL}
UNION SELECT 'ETF', p_type FROM part"""
    sp = STUDY_PARAMS
    return {
        "session_date": """SELECT event_id, CAST(ts AS DATE) AS utc_date,
  CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS session_date FROM events""",
        "universe_counts": f"SELECT universe, count(DISTINCT symbol) AS n_symbols FROM ({uni}) GROUP BY universe",
        "universe_filter": with_(STOCKS, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM s_feat WHERE {BASKET_FILTER}"),
        "scan_bars": with_(bars_ctes("s_", "p_brand"),
                           f"SELECT * FROM s_bars WHERE date >= DATE '{sp.start_exclusive}' "
                           f"AND date <= DATE '{sp.end_exclusive}' AND {BASKET_FILTER}"),
        "basket_features": with_(BASKET, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM b_feat"),
        "features_with_gaps": with_(features_ctes("g_", "p_brand", gaps=True),
                                    f"SELECT {', '.join(FEATURE_COLUMNS)} FROM g_feat"),
        "sql_report": with_(STOCKS, "SELECT " + ", ".join([
            _count("pct_change > 0", "advances"), _count("pct_change < 0", "declines"),
            _count("pct_change = 0", "no_change")]) + f" FROM s_feat WHERE {LATEST}"),
        "normalise_bars": with_(bars_ctes("s_", "p_brand"), """SELECT symbol,
  CAST(timezone('America/New_York', to_timestamp(d * 86400 + (d % 24) * 3600)) AS DATE) AS date,
  open, high, low, CASE WHEN d % 24 <> 5 THEN close END AS close, volume
FROM (SELECT *, date - DATE '1970-01-01' AS d FROM s_bars)"""),
        "true_range": with_(STOCKS[:3], """SELECT symbol, date,
  greatest(high - low, abs(high - pc), abs(low - pc)) AS true_range FROM s_f1"""),
        "custom_indicator": with_(STOCKS, "SELECT symbol, date, sma_50, sma_200 FROM s_feat"),
        "custom_recursive": with_(STOCKS, "SELECT symbol, date, ema_9, ema_21, rsi FROM s_feat"),
        "publish_roundtrip": with_(STOCKS, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM s_feat"),
        "publish_current": with_(STOCKS, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM s_feat"),
        "publish_manifest": with_(STOCKS + ETFS, """SELECT universe, CAST(year(date) AS INTEGER) AS year, count(*) AS rows,
  count(DISTINCT (symbol, date)) AS keys, min(date) AS first_date, max(date) AS last_date
FROM (SELECT 'SP_500' AS universe, symbol, date FROM s_feat UNION ALL SELECT 'ETF', symbol, date FROM e_feat) GROUP BY ALL"""),
        "newest_date": with_(STOCKS, "SELECT max(date) AS date FROM s_feat"),
        "publish_check": with_(STOCKS, """SELECT count(*) AS rows_computed, count(*) AS rows_written,
  count(DISTINCT (symbol, date)) AS distinct_keys FROM s_feat"""),
        "preview": with_(STOCKS, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM s_feat ORDER BY symbol, date LIMIT 10"),
    }
