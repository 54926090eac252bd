"""Z-ordered versions: the same rows, and fewer files for date and symbol filters."""

import datetime
import glob

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketframe.plans import versions as V
from marketframe.plans.layout import coordinates, interleave, z_ordered
from marketframe.plans.publish import publish_features
from marketframe.schema import FEATURE_COLUMNS, FEATURES_SCHEMA

SYMBOLS, DAYS = 64, 360


@pytest.fixture(scope="module")
def features(spark):
    """64 symbols with a bar a day, and one more with half as many again in all."""
    n = SYMBOLS * DAYS
    x = spark.range(n + n // 2).withColumns({
        "symbol": F.when(F.col("id") < n, F.format_string("S%02d", F.col("id") % SYMBOLS)).otherwise("HOT"),
        "date": F.date_add(F.lit("2001-01-01").cast("date"), ((F.col("id") / SYMBOLS).cast("int") % DAYS).cast("int"))})
    rest = [(F.xxhash64("id", F.lit(f.name)) % 1000).cast(f.dataType).alias(f.name)
            for f in FEATURES_SCHEMA.fields if f.name not in ("symbol", "date")]
    return x.select("symbol", "date", *rest).select(*FEATURE_COLUMNS).cache()


def spans(path):
    """(first date, last date, first symbol, last symbol) of every row group."""
    out = []
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            d, s = (meta.row_group(g).column(at[c]).statistics for c in ("date", "symbol"))
            out.append((d.min, d.max, s.min, s.max))
    return out


def read(groups, first, last, symbols=None):
    return sum(a <= last and b >= first and (symbols is None or any(lo <= s <= hi for s in symbols)) for a, b, lo, hi in groups)


def test_interleave(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 1024, (200, 2))]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", interleave(F.col("a"), F.col("b")).alias("z")).collect()
    for r in got:
        bits = "".join(x + y for x, y in zip(f"{r.a:010b}", f"{r.b:010b}", strict=True))
        assert r.z == int(bits, 2)


def test_coordinates_follow_the_rows(spark, features):
    rows = features.withColumn("year", F.year("date"))
    got = {r.symbol: r.at for r in coordinates(rows, "symbol", F.substring("symbol", 1, 2), "at", 10).collect()}
    counts = sorted((r.symbol, r["count"]) for r in features.groupBy("symbol").count().collect())
    before, total = 0, sum(n for _, n in counts)
    for symbol, n in counts:
        assert got[symbol] == before * 1024 // total
        before += n


def test_same_rows(spark, features):
    odd = features.limit(50).union(features.limit(3)).union(  # repeated rows, and one without a symbol
        features.limit(1).withColumn("symbol", F.lit(None).cast("string")).select(*FEATURE_COLUMNS))
    for table in (features, odd, features.limit(0)):
        got = z_ordered(table, 700).select(*FEATURE_COLUMNS)
        assert got.exceptAll(table).isEmpty() and table.exceptAll(got).isEmpty()


def test_filters_read_fewer_row_groups(spark, features, tmp_path):
    plain = publish_features(features, str(tmp_path), "X", "date", rows_per_file=540)
    z = publish_features(features, str(tmp_path), "X", "z", layout="z", rows_per_file=540)
    by_date, by_z = spans(plain), spans(z)
    n = len(by_z)
    assert 64 <= n <= 70 and 64 <= len(by_date) <= 70
    day = lambda k: datetime.date(2001, 1, 1) + datetime.timedelta(days=k)
    study = ["S05", "S20", "S21"]
    # Symbols inside a long date range.  Sorted by date, every file in the range is read.
    assert read(by_date, day(30), day(330), study) >= 0.8 * n
    assert read(by_z, day(30), day(330), study) <= 0.45 * n
    # One symbol over all days; a small multiple of sqrt(n) files.
    assert read(by_date, day(0), day(DAYS), ["S40"]) == len(by_date) and read(by_z, day(0), day(DAYS), ["S40"]) < n / 3
    # P5: the newest session; date order reads fewer, but far from all are read here either.
    assert read(by_date, day(359), day(359)) <= 2 and read(by_z, day(359), day(359)) < n / 3


def test_a_clustered_version_is_checked_and_committed(spark, features, tmp_path):
    root = str(tmp_path)
    table = features.where("symbol <> 'HOT'")
    version = V.publish(spark, root, {"X": table}, layout="z", rows_per_file=2000)
    assert V.current_version(spark, root) == version
    V.verify(spark, root)
    assert V.manifest(spark, root).first().rows == SYMBOLS * DAYS
    got = V.read_current(spark, root, "X").drop("year")
    assert got.exceptAll(table).isEmpty() and got.count() == SYMBOLS * DAYS
    with pytest.raises(ValueError):
        publish_features(table, root, "X", layout="other")
