"""The SQL texts give the rows of the DataFrame reports."""

import datetime

import numpy as np
import pytest

from marketframe.plans import reports as R
from marketframe.plans import sql_reports as S
from marketframe.schema import FEATURES_SCHEMA, ReportParams

P = ReportParams(min_adv=0.2)


def table(spark, seed, symbols, days):
    rng = np.random.default_rng(seed)
    rows = [(s, datetime.date(2001, 1, 1) + datetime.timedelta(days=d),
             *[None if rng.uniform() < 0.1 else float(np.round(rng.normal(0, 1), 2)) if k < 3 else float(rng.uniform(0, 2))
               for k in range(20)]) for s in symbols for d in range(days)]
    return spark.createDataFrame(rows, FEATURES_SCHEMA).cache()


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_texts_equal_reports(spark):
    stocks, etfs, basket = table(spark, 1, "abcdefghijklmnop", 50), table(spark, 2, "XYZ", 50), table(spark, 3, "abcXqrst", 45)
    S.register(spark, {"stocks": stocks, "etfs": etfs, "basket": basket})
    want, texts = R.all_reports(stocks, etfs, basket, P), S.report_texts(P)
    assert sorted(want) == sorted(texts) and len(texts) == 16
    for name, text in texts.items():
        got = spark.sql(text)
        assert sorted(got.columns) == sorted(want[name].columns), name
        assert rows(got) == rows(want[name]), name
    # functions are for users too
    assert spark.sql("SELECT count(*) FROM stocks_top('-volume', 3)").first()[0] == 3
    assert spark.sql("SELECT max(place) FROM basket_top('pct_gap', 2)").first()[0] in (None, 2)


def test_limits_run_before_the_shuffle(spark):
    S.register(spark, {"stocks": table(spark, 1, "abcdefgh", 50)})
    texts = S.report_texts(P)
    plan = lambda name: spark.sql(texts[name])._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan("up_20_in_5")
    assert "Limit 10" in plan("top_rvol").replace("LocalLimit", "Limit").replace("GlobalLimit", "Limit")
    for name in texts:
        if not name.startswith(("etf", "basket")):
            assert "Join" not in plan(name)


@pytest.fixture(autouse=True)
def _names_go(spark):
    yield
    for name in S.BOOKS.values():
        spark.catalog.dropTempView(name)
