"""Layer 2: registered queries against the DuckDB oracle on the test tables."""

import datetime
import math
import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from marketframe.operators.features import build_features
from marketframe.schema import FEATURE_COLUMNS, FeatureParams
from marketframe.sources import testdata as td
from marketframe import oracle

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables missing")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return v.date().isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["lineitem", "part", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_features_small_blocks_match_oracle(spark, duck):
    """Many blocks and scan chunks per symbol (~1,500 bars each)."""
    f = build_features(td.bars(spark, SF), FeatureParams(block_size=256, scan_chunk=64)).toPandas()
    want = duck.execute(oracle.with_(oracle.STOCKS, f"SELECT {', '.join(FEATURE_COLUMNS)} FROM s_feat")).df()
    assert _rows(f) == _rows(want)


@pytest.mark.parametrize("key", ["closers_with_rvol", "down_20_in_5", "basket_up_50_in_40", "losers",
                                 "label_exits", "trade_summary", "position_labels", "session_date", "features_with_gaps"])
def test_registered_queries(spark, duck, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_every_query_has_oracle():
    own = {k for k in E.queries() if not re.match(r"op\d+_|pipeline$", k)}
    assert own <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["symbol", "pct_change_5"]
    assert df.count() == 14
