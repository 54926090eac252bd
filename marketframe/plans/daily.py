"""The end-of-day job in one call: publish features, run and export reports.

Mirrors the daily flow of the reference (reload the feature tables, check the
load, run the report queries, write the report books) as Spark jobs:

1. each universe's bars are restricted to its members; their features are
   built, written under a new version, checked, and committed together;
2. the newest stock session is read from the version's manifest (a single
   date) and shared by the latest-session reports, so they prune to one year
   folder;
3. the sixteen reports run on the published tables and are written as files
   under ``reports/run_date=<yyyy-MM-dd>/book=<stocks|basket|breadth>/report=<id>``;
4. a manifest (report id, row count) is counted from the written files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketframe.operators.features import build_features
from marketframe.plans import publish as PB
from marketframe.plans import reports as R
from marketframe.plans import versions as V
from marketframe.schema import FeatureParams, ReportParams
from marketframe.sources.universe import members, restrict_to_universe

BOOKS = {"stocks": R.STOCK_BOOK, "basket": R.BASKET_BOOK, "breadth": R.BREADTH_BOOK}


def run_daily(spark: SparkSession, stock_bars: DataFrame, etf_bars: DataFrame, basket_bars: DataFrame,
              universes: DataFrame, out_root: str, report_params: ReportParams = ReportParams(),
              feature_params: FeatureParams = FeatureParams(), version: str | None = None,
              fmt: str = "parquet") -> dict:
    root = f"{out_root}/features"
    version = V.publish(spark, root, {
        universe: build_features(restrict_to_universe(bars, members(universes, universe)), feature_params)
        for universe, bars in (("SP_500", stock_bars), ("ETF", etf_bars), ("BASKET", basket_bars))}, version)
    vpath = f"{root}/version={version}"
    tables = {universe: PB.read_features(spark, vpath, universe) for universe in ("SP_500", "ETF", "BASKET")}

    # One value to the driver, from the manifest: the run date, also used as a literal filter.
    run_date = V.newest_date(spark, root, "SP_500", version).first()["date"].isoformat()
    reps = R.all_reports(tables["SP_500"], tables["ETF"], tables["BASKET"], report_params, as_of=run_date)
    paths = {}
    for book, sheets in BOOKS.items():
        frames = {rid: R.export_frame(rid, reps[rid]) for rid in sheets.values()}
        paths |= PB.write_reports(frames, f"{out_root}/reports", run_date, book, fmt)
    return {"version_path": vpath, "run_date": run_date, "paths": paths,
            "manifest": PB.report_manifest(spark, paths, fmt)}
