"""Entry/exit rule study over the feature table.

The reference runs a bar-by-bar broker simulation per symbol.  What it
computes is an event study: which bars fire the entry rule, where each trade
exits, and the per-symbol outcome.  Here every step is a DataFrame plan:

* T1 filter (pushed into the scan), then bar numbers over the surviving rows;
* T2 entry predicate as a Column;
* T3 exits from a bounded look-ahead frame (the next ``max_hold + 2`` bars),
  evaluated in (symbol, block) partitions with look-ahead and look-back halos;
* T4 one open trade per symbol: blocks of bars as maps from the state before
  them (how many more bars a trade stays open) to the state after them, which
  compose, so every block is folded alone from its entry state;
* T5-T7 returns and grouped aggregates.

Fills follow the market-order convention: a signal on bar s enters at the
open of bar s+1 (bar e); the exit is decided on bar d, the first bar after e
whose low is under e's low, or the bar ``max_hold`` bars after e; the trade
leaves at the open of bar d+1.  A new signal is taken from bar d on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions.numeric import rnd
from marketframe.operators.finite import entry_states
from marketframe.operators.search import next_below
from marketframe.operators.sequence import halo_blocks, number_rows, prefix
from marketframe.schema import FEATURE_COLUMNS, StudyParams
from marketframe.session import materialize

P = StudyParams()
OPEN_FOREVER = 2 ** 62  # decision bar of a trade that never exits


def liquid_window(features: DataFrame, p: StudyParams = P) -> DataFrame:
    """Liquid bars strictly inside the date window, study symbols."""
    return features.filter(
        (F.col("adv") > p.min_adv)
        & (F.col("date") > F.lit(p.start_exclusive).cast("date"))
        & (F.col("date") < F.lit(p.end_exclusive).cast("date"))
        & F.col("symbol").isin(list(p.symbols))
    ).select(*FEATURE_COLUMNS)


def entry_rule(p: StudyParams = P) -> Column:
    """Strong close on volume, gapping up, opening above the 9-bar EMA."""
    return ((F.col("range_pct") > p.min_range_pct) & (F.col("rvol") > p.min_rvol)
            & (F.col("adv") > p.min_adv) & (F.col("pct_gap") > p.min_gap)
            & (F.col("open") > F.col("ema_9")))


def numbered_window(features: DataFrame, p: StudyParams = P, chunk: Column | None = None) -> DataFrame:
    """Study rows with ``bar_no`` = position in the symbol's filtered series;
    ``chunk`` is the calendar unit of the numbering (default: year)."""
    return number_rows(liquid_window(features, p), "symbol", "date", F.year("date") if chunk is None else chunk)


def entry_signals(features: DataFrame, p: StudyParams = P, rule: Column | None = None) -> DataFrame:
    """(symbol, signal_date, signal_bar) where ``rule``, a predicate on
    the feature columns (default: ``entry_rule``), holds.  No signal before the
    ``warmup_bars``-th bar (0-based), where the strategy starts deciding."""
    bars = numbered_window(features, p)
    return bars.filter((entry_rule(p) if rule is None else rule) & (F.col("bar_no") - 1 >= p.warmup_bars)).select(
        "symbol", F.col("date").alias("signal_date"), F.col("bar_no").alias("signal_bar"))


def label_exits(features: DataFrame, p: StudyParams = P, block_size: int = 4096,
                rule: Column | None = None) -> DataFrame:
    """Every signal with its entry, exit decision and exit fill.

    Columns: symbol, signal_date, signal_bar, entry_date, entry_px, decision_bar,
    exit_date, exit_px, bars_held, exit_reason (stop / time / open).
    """
    return labelled_signals(features, p, block_size, rule)


def labelled_signals(features: DataFrame, p: StudyParams = P, block_size: int = 4096,
                     rule: Column | None = None) -> DataFrame:
    """label_exits; the input of ``non_overlapping_trades``."""
    ahead = p.max_hold_bars + 2
    bars = numbered_window(features, p)
    fire = (entry_rule(p) if rule is None else rule) & (F.col("bar_no") - 1 >= p.warmup_bars)
    blocked = halo_blocks(bars.select("symbol", "date", "bar_no", "open", "low", fire.alias("fire")),
                          "bar_no", block_size, before=0, after=ahead)
    w = Window.partitionBy("symbol", "block").orderBy("bar_no")
    fired = F.col("fire").cast("int")
    flagged = blocked.select("*", F.max(fired).over(w.rowsBetween(-ahead, 0)).alias("near"))
    # Only signals and the bars right after them need to be looked at further.
    nxt = F.collect_list(F.struct("bar_no", "date", "open", "low")).over(w.rangeBetween(1, ahead))
    sig = (flagged.filter(F.col("near") == 1).select("*", nxt.alias("f"))
           .filter((F.col("halo") == 0) & F.col("fire")))

    f = F.col("f")
    entry = F.get(f, 0)
    n = F.size(f)
    cands = F.when(n >= 2, F.filter(
        F.sequence(F.lit(1), n - 1),
        lambda j: (F.get(f, j)["low"] < entry["low"]) | (j >= p.max_hold_bars)))
    dj = F.get(cands, 0)
    exit_bar = F.get(f, dj + 1)
    decided = dj.isNotNull()
    filled = decided & exit_bar.isNotNull()
    reason = (F.when(~filled, F.lit("open"))
              .when(F.get(f, dj)["low"] < entry["low"], F.lit("stop"))
              .otherwise(F.lit("time")))
    return sig.select(
        "symbol",
        F.col("date").alias("signal_date"),
        F.col("bar_no").alias("signal_bar"),
        entry["date"].alias("entry_date"),
        entry["open"].alias("entry_px"),
        F.when(decided, F.col("bar_no") + 1 + dj).otherwise(F.lit(OPEN_FOREVER)).alias("decision_bar"),
        F.when(filled, exit_bar["date"]).alias("exit_date"),
        F.when(filled, exit_bar["open"]).alias("exit_px"),
        F.when(filled, dj + 1).alias("bars_held"),
        reason.alias("exit_reason"),
    )


@dataclass(frozen=True)
class ExitRule:
    """U4: a user's way out.  A trade is decided on the first bar after its
    entry bar whose ``watched`` price is under the stop, and, with
    ``max_hold_bars``, on that many bars after entry at the latest.

    The stop is ``level``, a column over the entry bar's features (default:
    the entry low).  With ``trailing`` it follows the price instead: that
    fraction under the highest high from the entry bar to the bar before."""

    level: Column | None = None
    watched: str = "low"
    trailing: float | None = None
    max_hold_bars: int | None = None


def label_exits_custom(features: DataFrame, exits: ExitRule, p: StudyParams = P, rule: Column | None = None,
                       block: int = 256, group: int = 256) -> DataFrame:
    """Every signal of ``rule`` with the exit that ``exits`` gives,
    however far away; columns as in ``label_exits``.

    The decision bar is a next-smaller-element search over blocks of bars
    (``operators.search``).  A trailing stop is hit from bar k at the first
    bar under k's own level, and from the entry at the earliest such bar of
    any k from the entry on: a running minimum from the series' end."""
    bars = numbered_window(features, p)
    fire = (entry_rule(p) if rule is None else rule) & (F.col("bar_no") - 1 >= p.warmup_bars)
    level = F.col("low") if exits.level is None else exits.level
    if exits.trailing is not None:
        level = F.col("high") * (1 - exits.trailing)
    keep = bars.select("symbol", "date", "bar_no", "open", F.col(exits.watched).alias("watched"), level.alias("level"),
                       fire.alias("fire"))
    bars = materialize(keep)

    w = Window.partitionBy("symbol", "block").orderBy("bar_no")
    nxt = F.lead(F.struct("date", "open", "bar_no", "level")).over(w)
    placed = halo_blocks(bars, "bar_no", 4096, before=0, after=1).withColumn("e", nxt)
    signals = placed.filter((F.col("halo") == 0) & F.col("fire")).select(
        "symbol", F.col("date").alias("signal_date"), F.col("bar_no").alias("signal_bar"), F.col("e.date").alias("entry_date"),
        F.col("e.open").alias("entry_px"), (F.col("bar_no") + 1).alias("entry_bar"), F.col("e.level").alias("level"))
    series = bars.select("symbol", "bar_no", "watched")
    if exits.trailing is None:
        found = next_below(signals, series, "symbol", "entry_bar", "level", "bar_no", "watched", "stop_bar", block, group)
    else:
        every = next_below(bars.select("symbol", "bar_no", "level"), series, "symbol", "bar_no", "level", "bar_no", "watched",
                           "hit", block, group)
        back = prefix(materialize(every.withColumn("_back", -F.col("bar_no"))), "symbol", "_back",
                      F.floor(F.col("_back") / 4096), {"neg": ("max", -F.col("hit"))})
        first_hit = back.select("symbol", F.col("bar_no").alias("entry_bar"), (-F.col("neg")).alias("stop_bar"))
        found = signals.join(first_hit, ["symbol", "entry_bar"], "left")

    last = bars.groupBy("symbol").agg(F.max("bar_no").alias("last_bar"))
    found = found.join(last, "symbol")
    limit = F.lit(None).cast("long")
    if exits.max_hold_bars is not None:
        limit = F.col("entry_bar") + exits.max_hold_bars
        limit = F.when(limit <= F.col("last_bar"), limit)
    found = found.withColumn("decided", F.least("stop_bar", limit)).withColumn(
        "exit_bar", F.coalesce(F.col("decided"), F.col("last_bar")) + 1)
    out = found.join(bars.select("symbol", F.col("bar_no").alias("exit_bar"), F.col("date").alias("exit_date"),
                                 F.col("open").alias("exit_px")), ["symbol", "exit_bar"], "left")
    filled = F.col("decided").isNotNull() & F.col("exit_date").isNotNull()
    return out.select(
        "symbol", "signal_date", "signal_bar", "entry_date", "entry_px",
        F.coalesce("decided", F.lit(OPEN_FOREVER)).alias("decision_bar"), "exit_date", "exit_px",
        F.when(filled, (F.col("exit_bar") - F.col("entry_bar")).cast("int")).alias("bars_held"),
        F.when(~filled, "open").when(F.col("decided") == F.col("stop_bar"), "stop").otherwise("time").alias("exit_reason"))


def non_overlapping_trades(labelled: DataFrame, p: StudyParams = P, block_bars: int = 256) -> DataFrame:
    """T4: keep a signal only when no earlier kept trade is still open at it
    (signal_bar >= decision_bar of the last kept trade); a signal on the last
    bar opens nothing.

    A trade decides at most ``max_hold_bars + 1`` bars after its signal, or
    never (the data ends), so the state before a bar is one of a few: how many
    more bars are closed, or closed for good.  Each block of ``block_bars``
    bars is the map from its entry state to its exit state; composed maps give
    every block its entry state, and the block's own signals are then walked
    from there.  A list holds the signals of one block at most.
    ``labelled`` comes from ``labelled_signals``.
    """
    span = p.max_hold_bars + 1
    if block_bars < span:
        raise ValueError("a block must be as long as the longest trade")
    cols = [c for c in labelled.columns if c != "symbol"]
    # The order key first: signals of a block are walked by bar.
    cols.sort(key=lambda c: c != "signal_bar")
    sig = labelled.select(F.struct(*cols).alias("s")).dtypes[0][1]
    blocks = materialize(
        labelled.filter(F.col("entry_date").isNotNull())
        .groupBy("symbol", F.floor((F.col("signal_bar") - 1) / block_bars).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("sigs")))
    # free_from: the first bar at which a signal is taken again.
    first, size = f"(block * {block_bars} + 1)", span + 2
    free_from = f"IF({{0}} = {size - 1}, {OPEN_FOREVER}L, {first} + {{0}})"
    ends = (f"aggregate(sigs, transform(sequence(0, {size - 1}), r -> {free_from.format('r')}), (acc, s) -> "
            "transform(acc, f -> IF(s.signal_bar >= f, s.decision_bar, f)))")
    state = f"IF(f = {OPEN_FOREVER}L, {size - 1}, CAST(greatest(0L, f - ({first} + {block_bars})) AS int))"
    maps = blocks.selectExpr("symbol", "block", f"transform({ends}, f -> {state}) AS map")
    entered = blocks.join(entry_states(maps, "symbol", "block", size, absorbing=True), ["symbol", "block"])
    walk = (f"aggregate(sigs, named_struct('f', {free_from.format('state')}, 'kept', CAST(array() AS array<{sig}>)), "
            "(acc, s) -> IF(s.signal_bar >= acc.f, "
            "named_struct('f', s.decision_bar, 'kept', concat(acc.kept, array(s))), acc)).kept")
    kept = entered.selectExpr("symbol", f"explode({walk}) AS t")
    return kept.select("symbol", *[F.col(f"t.{c}").alias(c) for c in labelled.columns if c != "symbol"])


def with_returns(trades: DataFrame, p: StudyParams = P) -> DataFrame:
    """T5: return net of commission on both sides (null while open)."""
    c = p.commission
    ret = F.col("exit_px") * (1 - c) / (F.col("entry_px") * (1 + c)) - 1
    return trades.select(
        "symbol", "signal_date", "entry_date", "entry_px", "exit_date", "exit_px",
        F.col("bars_held").cast("int").alias("bars_held"), "exit_reason",
        F.when(F.col("exit_px").isNotNull(), ret).alias("return_pct"))


def trades(features: DataFrame, p: StudyParams = P, rule: Column | None = None) -> DataFrame:
    return with_returns(non_overlapping_trades(labelled_signals(features, p, rule=rule), p), p)


def trades_ranked(features: DataFrame, p: StudyParams = P) -> DataFrame:
    """Trades by return, best first."""
    return trades(features, p).orderBy(F.desc("return_pct"), "symbol", "entry_date")


def _summary_aggs(p: StudyParams) -> list[Column]:
    r = F.col("return_pct")
    closed = F.count(r)
    growth = F.exp(F.sum(F.log1p(r)))
    return [
        closed.alias("trades"),
        F.count_if(r.isNull()).alias("open_trades"),
        F.count_if(r > 0).alias("wins"),
        rnd(F.try_divide(F.count_if(r > 0), closed), 6).alias("win_rate"),
        rnd(F.avg(r), 6).alias("avg_return"),
        rnd(F.max(r), 6).alias("best_return"),
        rnd(F.min(r), 6).alias("worst_return"),
        rnd(growth - 1, 6).alias("compounded_return"),
        rnd(F.lit(p.cash) * growth, 2).alias("final_value"),
    ]


def trade_summary(features: DataFrame, p: StudyParams = P) -> DataFrame:
    """One row per symbol: trades, wins, win rate, mean / best / worst
    return, compounded return and the value of ``cash`` traded through them."""
    return trades(features, p).groupBy("symbol").agg(*_summary_aggs(p))


def trade_summary_all(features: DataFrame, p: StudyParams = P) -> DataFrame:
    """The same figures over all symbols' trades together."""
    return trades(features, p).agg(*_summary_aggs(p))


def trade_statistics(features: DataFrame, p: StudyParams = P, rule: Column | None = None,
                     chunk_bars: int = 4096) -> DataFrame:
    """Per symbol of the study window, the figures of its equity curve
    and trades: exposure (share of bars with an open trade), mean and longest
    holding, profit factor, system quality number, return of buying and
    holding, the curve's peak value, largest drawdown from a peak, and the
    most bars between a peak and its recovery (or the window's end).

    The curve starts with ``cash`` on bar 1 and has a point at each exit; its
    growth is a running sum, its peaks running maxima, all in chunks of bars."""
    kept = materialize(non_overlapping_trades(labelled_signals(features, p, rule=rule), p))
    bars = numbered_window(features, p).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.min_by("close", "bar_no").alias("first_close"),
        F.max_by("close", "bar_no").alias("last_close"))
    c = p.commission
    ret = F.col("exit_px") * (1 - c) / (F.col("entry_px") * (1 + c)) - 1
    points = kept.filter(F.col("exit_px").isNotNull()).select("symbol", (F.col("decision_bar") + 1).alias("bar"), ret.alias("r"))
    chunk = F.floor(F.col("bar") / chunk_bars)
    growth = materialize(prefix(points, "symbol", "bar", chunk, {"growth": ("sum", F.log1p("r"))}))
    tops = materialize(prefix(growth, "symbol", "bar", chunk, {"top": ("max", F.col("growth"))}))
    peak = F.greatest("top", F.lit(0.0))
    at_peak = F.col("growth") >= peak
    curve = prefix(tops, "symbol", "bar", chunk, {"seen": ("max", F.col("bar")), "peak_bar": ("max", F.when(at_peak, F.col("bar")))},
                   current=False)
    since = F.coalesce("peak_bar", F.lit(1))  # the start is the first peak
    below = ~at_peak | (F.coalesce("seen", F.lit(1)) > since)
    per_curve = curve.groupBy("symbol").agg(
        F.max("growth").alias("top"), F.max(1 - F.exp(F.col("growth") - peak)).alias("drawdown"),
        F.max(F.when(below, F.col("bar") - since)).alias("longest"),
        F.max_by(F.when(~at_peak, since), "bar").alias("open_since"),
        F.sum(F.when(F.col("r") > 0, F.col("r"))).alias("gains"), F.sum(F.when(F.col("r") < 0, -F.col("r"))).alias("losses"),
        (F.sqrt(F.count("r")) * F.try_divide(F.avg("r"), F.stddev_samp("r"))).alias("sqn"))
    held = F.coalesce(F.col("bars_held").cast("long"), F.col("bars") - F.col("signal_bar"))
    per_trade = kept.join(bars.select("symbol", "bars"), "symbol").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"), F.sum(held).alias("held"), F.avg("bars_held").alias("mean_held"),
        F.max("bars_held").alias("max_bars_held"))
    out = bars.join(per_trade, "symbol", "left").join(per_curve, "symbol", "left")
    return out.select(
        "symbol", F.coalesce("trades", F.lit(0).cast("long")).alias("trades"),
        rnd(F.coalesce("held", F.lit(0)) / F.col("bars"), 6).alias("exposure"),
        rnd("mean_held", 6).alias("avg_bars_held"), "max_bars_held",
        rnd(F.try_divide("gains", "losses"), 6).alias("profit_factor"), rnd("sqn", 6).alias("sqn"),
        rnd(F.try_divide("last_close", "first_close") - 1, 6).alias("buy_and_hold"),
        rnd(F.lit(p.cash) * F.exp(F.greatest(F.coalesce("top", F.lit(0.0)), F.lit(0.0))), 2).alias("peak_value"),
        rnd(F.coalesce("drawdown", F.lit(0.0)), 6).alias("max_drawdown"),
        F.greatest(F.coalesce("longest", F.lit(0).cast("long")), F.col("bars") - F.col("open_since")).alias("max_drawdown_bars"))


def run(features: DataFrame, p: StudyParams = P, rule: Column | None = None) -> dict[str, DataFrame]:
    """The whole study under ``rule`` (default: ``entry_rule``): trades are written once (a table under the checkpoint
    folder) and the ranked list and both summaries read that table."""
    t = materialize(trades(features, p, rule))
    return {
        "trades_ranked": t.orderBy(F.desc("return_pct"), "symbol", "entry_date"),
        "trade_summary": t.groupBy("symbol").agg(*_summary_aggs(p)),
        "trade_summary_all": t.agg(*_summary_aggs(p)),
    }
