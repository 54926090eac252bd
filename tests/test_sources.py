import datetime

from pyspark.sql import functions as F

from marketframe.schema import RAW_BARS_SCHEMA
from marketframe.sources import normalise_bars, resample_bars, session_date
from marketframe.sources.universe import restrict_to_universe, universe_counts, universe_table


def test_normalise_bars_uses_exchange_date(spark):
    ts = [datetime.datetime(2024, 1, 2, 3, 0), datetime.datetime(2024, 1, 2, 21, 0),
          datetime.datetime(2024, 7, 2, 3, 30)]
    raw = spark.createDataFrame(
        [("A", t, 1.0, 2.0, 0.5, float("nan"), 10.0, 5.0, 1.0) for t in ts], RAW_BARS_SCHEMA)
    out = normalise_bars(raw).orderBy("date").collect()
    # 03:00 UTC is the previous evening in New York (EST in winter, EDT in summer)
    assert [r.date for r in out] == [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2),
                                     datetime.date(2024, 7, 1)]
    assert out[0].close is None and "vwap" not in normalise_bars(raw).columns


def test_session_date_on_naive_timestamps(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 3, 10, 4, 30),)], "ts timestamp_ntz")
    assert session_date(df, "ts", "d").first().d == datetime.date(2024, 3, 9)


def test_resample_open_close_by_order(spark):
    ticks = spark.createDataFrame(
        [("A", 3, 10.0, 1.0), ("A", 1, 12.0, 2.0), ("A", 2, 9.0, 3.0), ("B", 1, 5.0, 1.0)],
        "symbol string, ts long, px double, qty double")
    bars = {r.symbol: r for r in resample_bars(ticks, F.lit("2024-01-02").cast("date"),
                                               order=F.col("ts")).collect()}
    a = bars["A"]
    assert (a.open, a.high, a.low, a.close, a.volume) == (12.0, 12.0, 9.0, 10.0, 6.0)
    assert bars["B"].open == bars["B"].close == 5.0


def test_universes(spark):
    u = universe_table(spark, {"X": ["A", "B", "B"], "Y": ["C"]})
    assert {r.universe: r.n_symbols for r in universe_counts(u).collect()} == {"X": 2, "Y": 1}
    df = spark.createDataFrame([("A", 1), ("C", 2), ("D", 3)], "symbol string, v int")
    assert restrict_to_universe(df, ["A", "D"]).count() == 2
    assert restrict_to_universe(df, u.filter("universe = 'Y'")).count() == 1


def test_session_date_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.range(1).select(F.timestamp_seconds(F.lit(1704175200)).alias("ts"))  # 2024-01-02 06:00 UTC
            assert session_date(df, "ts", "d").first().d == datetime.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_long_symbol_list(spark):
    df = spark.createDataFrame([("A", 1), ("S7", 2)], "symbol string, v int")
    assert [r.v for r in restrict_to_universe(df, [f"S{i}" for i in range(5000)]).collect()] == [2]


def test_resample_is_hash_aggregated(spark):
    from marketframe.sources import testdata as td
    plan = td.bars(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan
    assert plan.count("lineitem.parquet") == 1
