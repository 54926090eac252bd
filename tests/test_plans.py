"""Layer 4: plan shape.  No Python in the native path, top-k and per-symbol
limits pushed before the shuffle, filters reaching the Parquet scan."""

from pyspark.sql import functions as F

from marketframe.plans import reports as R
from marketframe.plans.pipeline import Inputs
from marketframe.plans import study as T

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_is_native(spark):
    from marketframe.operators.features import with_sequence_columns
    from marketframe.schema import FeatureParams
    inp = Inputs(spark, SF)
    p = plan(inp.stocks)
    assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p
    # the window pass runs on (symbol, block), never on symbol alone
    d, w = with_sequence_columns(inp.stock_bars, FeatureParams())
    wp = plan(d.select("*", F.lag("close").over(w)))
    assert "hashpartitioning(symbol" in wp and "Python" not in wp


def test_movers_limit_per_symbol_before_shuffle(spark):
    p = Inputs(spark, SF).stocks
    df = R.down_20_in_5(p)
    df._jdf.queryExecution().optimizedPlan()
    txt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in txt


def test_top_k_is_take_ordered(spark):
    f = spark.createDataFrame([("a", "2001-01-01", 1.0)], "symbol string, d string, rvol double") \
             .select("symbol", F.col("d").cast("date").alias("date"), "rvol",
                     *[F.lit(0.0).alias(c) for c in ["close", "pct_change", "pct_open_to_close",
                                                      "pct_gap", "tr_comp", "volume"]])
    assert "TakeOrderedAndProject" in plan(R.top_rvol(f, as_of="2001-01-01"))


def test_study_filter_pushed_to_scan(spark, tmp_path):
    from marketframe.plans import publish as PB
    inp = Inputs(spark, SF)
    v = PB.publish_features(inp.stocks, str(tmp_path / "feat"), "SP_500", "t")
    f = PB.read_features(spark, v, "SP_500")
    p = plan(T.liquid_window(f))
    pushed = p[p.index("PushedFilters"):]
    assert "GreaterThan(adv," in pushed and "GreaterThan(date," in pushed


def test_feature_windows_share_one_shuffle_and_sort(spark, monkeypatch):
    import re

    import marketframe.operators.features as FE
    import marketframe.session as S
    from marketframe.operators.features import build_features
    seen = []
    orig = S.materialize

    def spy(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return orig(df)

    import marketframe.operators.scan as SC
    monkeypatch.setattr(S, "materialize", spy)
    monkeypatch.setattr(FE, "materialize", spy)
    monkeypatch.setattr(SC, "materialize", spy)
    build_features(Inputs(spark, SF).stock_bars)
    windowed = next(p for p in seen if "lag(close" in p)
    block_exchanges = re.findall(r"Exchange hashpartitioning\(symbol#\d+, block#\d+L?", windowed)
    block_sorts = re.findall(r"Sort \[symbol#\d+ ASC NULLS FIRST, block#\d+L? ASC", windowed)
    assert len(block_exchanges) == 1 and len(block_sorts) == 1
    assert windowed.count("Window [") >= 4
    assert "hashpartitioning(symbol#" in windowed and "Python" not in windowed
    # no exchange on symbol alone feeds the per-bar windows
    assert not re.search(r"Window \[lag.*\n\s*\+- Sort \[symbol#\d+ ASC NULLS FIRST, date", windowed)


def test_movers_share_one_scan_per_table(spark, monkeypatch, tmp_path):
    f = spark.createDataFrame([("a", "2001-01-01")], "symbol string, d string").select(
        "symbol", F.col("d").cast("date").alias("date"), *[F.lit(1.0).alias(c) for c in dict.fromkeys(
            R.MOVER_COLUMNS + ["open", "high", "low", "dtr", "ema_21", "sma_50", "sma_200", "range_pct", "trend_strength"])])
    seen = []
    orig = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df: seen.append(df) or orig(df))
    reps = R.all_reports(f, f, f)
    assert len(seen) == 2
    names = [k for k in reps if "_in_" in k]
    assert len(names) == 8
    assert all("WindowGroupLimit" not in reps[k]._jdf.queryExecution().optimizedPlan().toString() for k in names)
