"""Benchmark: the daily job at one scale factor.

Steps timed (seconds, wall clock, including result collection):
  resample_bars   ticks (lineitem x part) -> daily bars, stocks and ETFs
  features        bars -> 22-column feature tables, published as Parquet
  <report ids>    each of the sixteen reports over the published tables
  study_trades    rule study: signals, exits, non-overlap, returns (written once)
  trades_ranked, trade_summary, trade_summary_all   read from the trade table
  size_positions  sizing of one idea per latest-session bar

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_EVENT_LOG_DIR (optional: write Spark's event log there, for stage
     and task times without the UI).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketframe.plans import publish as PB  # noqa: E402
from marketframe.plans import reports as R  # noqa: E402
from marketframe.plans import sizing as Z  # noqa: E402
from marketframe.plans import study as T  # noqa: E402
from marketframe.plans.pipeline import Inputs  # noqa: E402
from marketframe.session import ensure_checkpoint_dir, get_session  # noqa: E402
from marketframe.sources.testdata import REPORT_PARAMS, STUDY_PARAMS  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "8g"}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app="marketframe-bench",
                        extra=extra)
    # the session's spark.checkpoint.dir, or a folder in its warehouse
    root = ensure_checkpoint_dir(spark)
    spark.range(1000).selectExpr("sum(id)").collect()  # session start-up, not timed
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    inp = Inputs(spark, sf_dir)
    # The two universes are independent: their jobs are submitted together
    # from two driver threads and share the executors.
    pool = ThreadPoolExecutor(max_workers=2)

    def both(f, g):
        a, b = pool.submit(f), pool.submit(g)
        return a.result(), b.result()

    # Bars are written once; features read them back (lineage cut).
    bars_dir = f"{root}/bench-bars"
    timed("basket_bars", lambda: inp.basket_bars.write.mode("overwrite").parquet(f"{bars_dir}/basket"))
    timed("resample_bars", lambda: both(
        lambda: inp.stock_bars.write.mode("overwrite").parquet(f"{bars_dir}/stocks"),
        lambda: inp.etf_bars.write.mode("overwrite").parquet(f"{bars_dir}/etf")))
    from marketframe.operators.features import build_features
    from marketframe.sources.bars import scan_bars
    stock_bars = scan_bars(spark, f"{bars_dir}/stocks")
    etf_bars = scan_bars(spark, f"{bars_dir}/etf")

    feat_root = f"{root}/bench-features"
    version = "bench"

    timed("features", lambda: both(
        lambda: PB.publish_features(build_features(stock_bars), feat_root, "SP_500", version),
        lambda: PB.publish_features(build_features(etf_bars), feat_root, "ETF", version)))
    vpath = f"{feat_root}/version={version}"
    stocks = PB.read_features(spark, vpath, "SP_500")
    etfs = PB.read_features(spark, vpath, "ETF")
    timed("basket_features", lambda: PB.publish_features(
        build_features(scan_bars(spark, f"{bars_dir}/basket")), feat_root, "BASKET", version))
    basket = PB.read_features(spark, vpath, "BASKET")

    as_of = timed("latest_date", lambda: str(stocks.agg({"date": "max"}).first()[0]))
    reports = timed("newest_bars", lambda: R.all_reports(stocks, etfs, basket, REPORT_PARAMS, as_of=as_of))
    rows = {}
    for rid, df in reports.items():
        rows[rid] = len(timed(rid, df.collect))
    study = timed("study_trades", lambda: T.run(stocks, STUDY_PARAMS))
    for k, df in study.items():
        rows[k] = len(timed(k, df.collect))
    ideas = Z.ideas_from_session(R.latest_session(stocks, as_of))
    rows["size_positions"] = len(timed("size_positions", Z.size_positions(ideas).collect))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "daily_job_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": sf, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
