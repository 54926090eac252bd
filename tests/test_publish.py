"""Publishing: versions, per-universe overwrite, checks and preview."""

import os

from pyspark.sql import functions as F

from marketframe.plans import publish as PB
from marketframe.plans.pipeline import Inputs

SF = "/root/testdata/sf0.001"


def test_publish_roundtrip_and_check(spark, tmp_path):
    inp = Inputs(spark, SF)
    root = str(tmp_path / "feat")
    v = PB.publish_features(inp.stocks, root, "SP_500", "v1")
    PB.publish_features(inp.etfs, root, "ETF", "v1")
    back = PB.read_features(spark, v, "SP_500")
    chk = PB.publish_check(inp.stocks, back).collect()[0]
    assert chk.rows_computed == chk.rows_written == chk.distinct_keys > 0
    prev = PB.preview(back).collect()
    assert len(prev) == 10 and [r.symbol for r in prev] == sorted(r.symbol for r in prev)
    years = sorted(d for d in os.listdir(f"{v}/universe=SP_500") if d.startswith("year="))
    assert years[0] == "year=1995"
    # re-publishing one universe replaces it and leaves the other one alone
    PB.publish_features(inp.stocks.filter(F.year("date") >= 2000), root, "SP_500", "v1")
    again = sorted(d for d in os.listdir(f"{v}/universe=SP_500") if d.startswith("year="))
    assert again[0] == "year=2000"
    assert PB.read_features(spark, v, "ETF").count() == inp.etfs.count()


def test_report_files_and_manifest(spark, tmp_path):
    from marketframe.plans import reports as R
    inp = Inputs(spark, SF)
    reps = {"gainers": R.gainers(inp.stocks), "losers": R.losers(inp.stocks)}
    paths = PB.write_reports(reps, str(tmp_path / "rep"), "2001-11-04", "sp500", fmt="csv")
    out = spark.read.option("header", True).csv(str(tmp_path / "rep/run_date=2001-11-04/book=sp500/report=gainers"))
    assert out.count() == reps["gainers"].count()
    man = {r.report_id: r.row_count for r in PB.report_manifest(spark, paths, "csv").collect()}
    assert man == {"gainers": reps["gainers"].count(), "losers": reps["losers"].count()}


def test_run_daily(spark, tmp_path):
    from marketframe.plans.daily import run_daily
    from marketframe.sources.testdata import REPORT_PARAMS
    inp = Inputs(spark, SF)
    out = run_daily(spark, inp.stock_bars, inp.etf_bars, inp.basket_bars, inp.universes, str(tmp_path / "job"),
                    REPORT_PARAMS, version="t")
    assert out["run_date"] == "2001-11-04"
    man = {r.report_id: r.row_count for r in out["manifest"].collect()}
    assert len(man) == 16 and man["down_20_in_5"] == 14 and man["advance_vs_decline"] == 1
    basket = PB.read_features(spark, out["version_path"], "BASKET")
    only = basket.select("symbol").distinct().join(
        PB.read_features(spark, out["version_path"], "SP_500").select("symbol").distinct(), "symbol", "left_anti")
    names = {r.symbol for r in only.collect()}
    assert len(names) == 2  # basket symbols that are no stocks
    moved = spark.read.parquet(out["paths"]["basket_down_20_in_5"]).union(spark.read.parquet(out["paths"]["basket_up_20_in_5"]))
    assert names & {r.symbol for r in moved.collect()}
    sheet = spark.read.parquet(str(tmp_path / "job/reports/run_date=2001-11-04/book=stocks/report=closers_with_rvol"))
    assert "date" not in sheet.columns and "open" not in sheet.columns
    assert sheet.select("rvol").collect() == sorted(sheet.select("rvol").collect(), reverse=True)


def test_incomplete_load_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([("A", 1), ("A", 1)], "symbol string, date int")
    with pytest.raises(PB.LoadError):
        PB.assert_loaded(2, df)  # not a key
    with pytest.raises(PB.LoadError):
        PB.assert_loaded(2, df.distinct())  # a row is missing
    PB.assert_loaded(1, df.distinct())
