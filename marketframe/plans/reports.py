"""End-of-day reports (R1-R16) over a feature table.

Each report is a function ``features -> DataFrame``.  The "latest session"
filter is either an uncorrelated scalar subquery (one small aggregate, run
once per query) or, in ``all_reports``, a literal computed once and shared by
all reports so that it also prunes files.  Top-k reports plan as
``TakeOrderedAndProject``: every task keeps k rows, so no full sort happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions.numeric import div, rnd
from marketframe.operators.sequence import number_rows
from marketframe.schema import FEATURE_COLUMNS, ReportParams
from marketframe.session import materialize

P = ReportParams()


def latest_date(features: DataFrame) -> Column:
    """max(date) as a scalar-subquery column."""
    return features.select(F.max("date")).scalar()


def latest_session(features: DataFrame, as_of: DataFrame | Column | str | None = None) -> DataFrame:
    """Rows of the newest session.  ``as_of`` may be another feature table
    (its newest date is used: ETFs filtered on the stocks' last session), a
    column or a literal date."""
    if as_of is None:
        d = latest_date(features)
    elif isinstance(as_of, DataFrame):
        d = latest_date(as_of)
    elif isinstance(as_of, str):
        d = F.lit(as_of).cast("date")
        if "year" in features.columns:
            # partition pruning on a published table: read one year folder
            features = features.filter(F.col("year") == int(as_of[:4]))
    else:
        d = as_of
    return features.filter(F.col("date") == d)


def closers_with_rvol(features: DataFrame, params: ReportParams = P,
                      as_of=None) -> DataFrame:
    """Strong or weak closes on above-normal volume, by rvol."""
    p = params
    cond = (((F.col("range_pct") > p.closer_high) | (F.col("range_pct") < p.closer_low))
            & (F.col("rvol") > p.min_rvol) & (F.col("adv") > p.min_adv))
    return (latest_session(features, as_of).filter(cond)
            .orderBy(F.desc("rvol"), F.asc("symbol")).select(*FEATURE_COLUMNS))


def _count_if(cond: Column, name: str) -> Column:
    # SUM(CASE WHEN c THEN 1 ELSE 0 END): null over no rows, like SQL.
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long").alias(name)


def advance_vs_decline(features: DataFrame, as_of=None) -> DataFrame:
    """Advances, declines and unchanged on the latest session."""
    c = F.col("pct_change")
    return latest_session(features, as_of).agg(
        _count_if(c > 0, "advances"), _count_if(c < 0, "declines"), _count_if(c == 0, "no_change"))


MA_COLUMNS = [("ema_9", "9_ema"), ("ema_21", "21_ema"), ("sma_50", "50_sma"), ("sma_200", "200_sma")]


def above_below_ma(features: DataFrame, as_of=None) -> DataFrame:
    """Closes above / below each moving average on the latest session."""
    aggs = []
    for col, label in MA_COLUMNS:
        aggs.append(_count_if(F.col("close") > F.col(col), f"over_{label}"))
        aggs.append(_count_if(F.col("close") < F.col(col), f"under_{label}"))
    return latest_session(features, as_of).agg(*aggs)


TOP_COLUMNS = {
    "rvol": ["symbol", "rvol", "close", "pct_change", "pct_open_to_close", "pct_gap", "tr_comp", "volume"],
    "tr_comp": ["symbol", "tr_comp", "close", "pct_change", "pct_open_to_close", "pct_gap", "rvol", "volume"],
    "pct_open_to_close": ["symbol", "close", "pct_change", "pct_open_to_close", "pct_gap", "rvol",
                          "tr_comp", "volume"],
}


def top_k(features: DataFrame, by: str, descending: bool = True, k: int | None = None,
          as_of=None, params: ReportParams = P) -> DataFrame:
    """K rows of the latest session ranked by ``by`` (nulls last when
    descending, first when ascending), ties broken by symbol."""
    key = F.desc(by) if descending else F.asc(by)
    return (latest_session(features, as_of).orderBy(key, F.asc("symbol")).limit(
        params.top_n if k is None else k)
            .select(*TOP_COLUMNS[by]))


def top_rvol(features, as_of=None, params: ReportParams = P):
    return top_k(features, "rvol", True, as_of=as_of, params=params)


def top_tr_comp(features, as_of=None, params: ReportParams = P):
    return top_k(features, "tr_comp", True, as_of=as_of, params=params)


def gainers(features, as_of=None, params: ReportParams = P):
    return top_k(features, "pct_open_to_close", True, as_of=as_of, params=params)


def losers(features, as_of=None, params: ReportParams = P):
    return top_k(features, "pct_open_to_close", False, as_of=as_of, params=params)


MOVER_COLUMNS = ["close", "rvol", "pct_change", "pct_open_to_close", "ema_9", "atr", "rsi",
                 "volume", "adv", "tr_comp", "pct_gap"]


def recent_rank(features: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Row number of each bar counted from the symbol's newest bar.

    Computed as (bars of the symbol) - (position from the oldest) + 1 from
    per-(symbol, ``chunk``) counts (default: year), so no task holds a whole symbol."""
    numbered = number_rows(features.select("symbol", "date"), "symbol", "date",
                           F.year("date") if chunk is None else chunk, total="_n")
    return numbered.select("symbol", "date", (F.col("_n") - F.col("bar_no") + 1).alias("row_num"))


def newest_bars(features: DataFrame, k: int = 41) -> DataFrame:
    """The newest ``k`` bars of each symbol with their number from the newest.

    The limit runs in every task before the shuffle (WindowGroupLimit), so
    only k rows per symbol per task move.  All movers can share this table."""
    w = Window.partitionBy("symbol").orderBy(F.desc("date"))
    return features.select("symbol", *MOVER_COLUMNS, F.row_number().over(w).alias("row_num")).filter(F.col("row_num") <= k)


def movers(features: DataFrame, sessions: int, threshold: float, up: bool) -> DataFrame:
    """Symbols whose newest close moved more than ``threshold``
    (a fraction) against the close ``sessions`` bars earlier.

    Each symbol uses its own newest bar (no date filter).  The two rows are
    paired by a conditional aggregate instead of a self-join.  Symbols with
    fewer than K+1 bars drop out.  ``features`` may be a feature table or the
    result of ``newest_bars``.
    """
    k = sessions + 1
    newest = features if "row_num" in features.columns else newest_bars(features, k)
    paired = newest.filter(F.col("row_num").isin(1, k)).groupBy("symbol").agg(
        F.max(F.when(F.col("row_num") == 1, F.struct(*MOVER_COLUMNS))).alias("r1"),
        F.max(F.when(F.col("row_num") == k, F.col("close"))).alias("close_k"),
    ).filter(F.col("close_k").isNotNull() & F.col("r1").isNotNull())
    ratio = div(F.col("r1.close"), F.col("close_k")) - 1
    cond = ratio > threshold if up else ratio < -threshold
    name = f"pct_change_{sessions}"
    pct = rnd(ratio * 100, 1).alias(name)
    out = paired.filter(cond).select(
        "symbol", pct, *[F.col(f"r1.{c}").alias(c) for c in MOVER_COLUMNS])
    return out.orderBy(F.desc(name) if up else F.asc(name), F.asc("symbol"))


def up_20_in_5(f):
    return movers(f, 5, 0.20, True)


def down_20_in_5(f):
    return movers(f, 5, 0.20, False)


def up_50_in_40(f):
    return movers(f, 40, 0.50, True)


def down_50_in_40(f):
    return movers(f, 40, 0.50, False)


# Report ids of the two exported books by sheet name.
STOCK_BOOK = {
    "Highest RVOL": "top_rvol", "Outlier Moves": "top_tr_comp", "Gainers": "gainers",
    "Losers": "losers", "+20% in 5 sessions": "up_20_in_5", "-20% in 5 sessions": "down_20_in_5",
    "+50% in 40 sessions": "up_50_in_40", "-50% in 40 sessions": "down_50_in_40",
    "SW Closers (SP500)": "closers_with_rvol", "SW Closers (ETF)": "etf_closers_with_rvol",
}
BASKET_BOOK = {
    "+20% in 5 sessions": "basket_up_20_in_5", "-20% in 5 sessions": "basket_down_20_in_5",
    "+50% in 40 sessions": "basket_up_50_in_40", "-50% in 40 sessions": "basket_down_50_in_40",
}


# Reports that the daily run prints; written as a third book.
BREADTH_BOOK = {"Advance vs decline": "advance_vs_decline", "Above and below MAs": "above_below_ma"}


def all_reports(stocks: DataFrame, etfs: DataFrame, basket: DataFrame,
                params: ReportParams = P, as_of: str | None = None) -> dict[str, DataFrame]:
    """The sixteen reports.  ``as_of`` (the stocks' newest date as a literal,
    computed once by the caller) replaces the per-query subquery.  The eight
    movers share two small tables of newest bars, written once."""
    d = as_of if as_of is not None else stocks
    out = {
        "closers_with_rvol": closers_with_rvol(stocks, params, as_of=d),
        "etf_closers_with_rvol": closers_with_rvol(etfs, params, as_of=d),
        "advance_vs_decline": advance_vs_decline(stocks, as_of=d),
        "above_below_ma": above_below_ma(stocks, as_of=d),
        "top_rvol": top_rvol(stocks, as_of=d, params=params),
        "top_tr_comp": top_tr_comp(stocks, as_of=d, params=params),
        "gainers": gainers(stocks, as_of=d, params=params),
        "losers": losers(stocks, as_of=d, params=params),
    }
    for prefix, table in (("", stocks), ("basket_", basket)):
        newest = materialize(newest_bars(table))
        out |= {f"{prefix}up_20_in_5": up_20_in_5(newest), f"{prefix}down_20_in_5": down_20_in_5(newest),
                f"{prefix}up_50_in_40": up_50_in_40(newest), f"{prefix}down_50_in_40": down_50_in_40(newest)}
    return out


def export_frame(report_id: str, df: DataFrame) -> DataFrame:
    """Shape a report for export: the closers sheets drop date and open."""
    if report_id in ("closers_with_rvol", "etf_closers_with_rvol"):
        return df.drop("date", "open")
    return df
