"""Position sizing for a table of trade ideas.

The reference is a desktop form for one idea at a time; the arithmetic is a
narrow projection, so a whole table of ideas is sized in one pass.  Inputs
``portfolio`` and ``risk`` are text, as typed into the form: text that does
not parse gives ``valid = false`` and null results ("Invalid input.").
A stop equal to the entry (zero risk per share) gives ``valid = false`` and
null results instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions.numeric import div, rnd
from marketframe.operators.sequence import number_rows
from marketframe.session import materialize

INVALID = "Invalid input."
DEFAULT_PORTFOLIO = "100000"
DEFAULT_RISK = "0.01"


def _money(c: Column, places: int) -> Column:
    return F.format_number(c, places)


def risk_amount(ideas: DataFrame) -> DataFrame:
    """Portfolio x risk fraction, with the bad-text branch."""
    pf = F.col("portfolio").try_cast("double")
    rk = F.col("risk").try_cast("double")
    valid = pf.isNotNull() & rk.isNotNull()
    amount = F.when(valid, pf * rk)
    return ideas.select(
        "idea_id", "portfolio", "risk", valid.alias("valid"), amount.alias("risk_amount"),
        F.when(valid, _money(amount, 2)).otherwise(F.lit(INVALID)).alias("risk_amount_label"))


def size_positions(ideas: DataFrame) -> DataFrame:
    """Per-share profit and risk, reward/risk, share count capped by
    the portfolio, and the trade's cost, profit and risk."""
    pf = F.col("portfolio").try_cast("double")
    rk = F.col("risk").try_cast("double")
    parsed = pf.isNotNull() & rk.isNotNull()
    amount = F.when(parsed, pf * rk)
    entry, stop, target = F.col("entry"), F.col("stop"), F.col("target")
    profit_ps = F.abs(entry - target)
    risk_ps = F.abs(entry - stop)
    by_risk = div(amount, risk_ps)
    valid = parsed & F.coalesce(risk_ps != 0, F.lit(True))
    shares = F.when(by_risk * entry > pf, div(pf, entry)).otherwise(by_risk)
    return ideas.select(
        "idea_id", valid.alias("valid"), amount.alias("risk_amount"),
        profit_ps.alias("profit_per_share"), risk_ps.alias("risk_per_share"),
        rnd(div(profit_ps, risk_ps), 1).alias("rr_ratio"),
        shares.alias("shares"),
        rnd(shares * entry, 2).alias("total_cost"),
        rnd(shares * profit_ps, 2).alias("total_profit"),
        rnd(shares * risk_ps, 2).alias("total_risk"),
    )


def position_labels(ideas: DataFrame) -> DataFrame:
    """Display strings (shares to 0 places, money to 2, thousands separators)."""
    s = size_positions(ideas)
    return s.select(
        "idea_id",
        _money(rnd("shares", 0), 0).alias("shares_label"),
        _money("total_cost", 2).alias("total_cost_label"),
        _money("total_profit", 2).alias("total_profit_label"),
        _money("total_risk", 2).alias("total_risk_label"),
        F.when(F.col("rr_ratio").isNotNull(),
               F.format_string("%.1f", F.col("rr_ratio"))).alias("rr_label"),
    )


def ideas_from_session(session: DataFrame, bad_every: int = 10) -> DataFrame:
    """Test input: one idea per bar of a session (entry = close, stop = low,
    target = high, default portfolio and risk); every ``bad_every``-th idea
    gets an unparsable portfolio.  Ideas are numbered in symbol order: dealt
    by symbol range, counted per range, offsets added."""
    ranged = materialize(session.select("symbol", "close", "low", "high", F.lit(0).alias("_all"))
                         .repartitionByRange("symbol").withColumn("_range", F.spark_partition_id()))
    numbered = number_rows(ranged, "_all", "symbol", F.col("_range"), out="idea_id")
    return numbered.select(
        F.col("idea_id").cast("long").alias("idea_id"), "close", "low", "high").select(
        "idea_id",
        F.when(F.col("idea_id") % bad_every == 0, F.lit("abc"))
         .otherwise(F.lit(DEFAULT_PORTFOLIO)).alias("portfolio"),
        F.lit(DEFAULT_RISK).alias("risk"),
        F.col("close").alias("entry"), F.col("low").alias("stop"), F.col("high").alias("target"))
