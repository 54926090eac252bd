"""Publishing the feature table and report outputs.

The reference truncates a MySQL table and appends in batches of 1,000 rows,
so readers can see an empty or half-loaded table.  Here each universe is a
directory ``<root>/universe=<U>/`` written with a static overwrite of that
directory only (``year`` partitions inside), under a new version folder per
run; readers pass the version they want.  Files are sorted by (date, symbol)
so row-group statistics prune date filters; the layout ``z`` prunes by date and
by symbol (see ``layout``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.plans.layout import ROWS_PER_FILE, z_ordered
from marketframe.schema import FEATURES_SCHEMA, FEATURE_COLUMNS


def publish_features(features: DataFrame, root: str, universe: str, version: str | None = None,
                     observation: Observation | None = None, layout: str = "date",
                     rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write one universe of the feature table; returns the version path.

    Rows of a year come together (one file for daily bars of ~500 symbols);
    AQE splits a year that is too large for a task.  ``layout`` is ``date``,
    where no file holds more than ``rows_per_file`` rows, or ``z``, where files
    hold about as many (their ranges come from a sample) and at most twice that.  ``observation`` receives
    the number of rows computed (``rows``) from the same pass."""
    version = version or uuid.uuid4().hex[:12]
    path = f"{root}/version={version}/universe={universe}"
    out = features.select(*FEATURE_COLUMNS)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    if layout == "z":
        dealt, most = z_ordered(out, rows_per_file), 2 * rows_per_file
    elif layout == "date":
        most = rows_per_file
        dealt = out.withColumn("year", F.year("date")).hint("rebalance", "year").sortWithinPartitions("year", "date", "symbol")
    else:
        raise ValueError(f"no layout named {layout}")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", most).partitionBy("year").parquet(path)
    return f"{root}/version={version}"


STORED_SCHEMA = T.StructType(FEATURES_SCHEMA.fields + [T.StructField("year", T.IntegerType(), True)])


def read_features(spark: SparkSession, version_path: str, universe: str) -> DataFrame:
    """The published table of one universe: the 22 feature columns plus the
    ``year`` partition column (a date filter that also names the year prunes
    whole folders; see ``reports.latest_session``)."""
    df = spark.read.schema(STORED_SCHEMA).parquet(f"{version_path}/universe={universe}")
    return df.select(*FEATURE_COLUMNS, "year")


def publish_check(computed: DataFrame, written: DataFrame) -> DataFrame:
    """Rows computed, rows read back, distinct (symbol, date) keys."""
    rows_computed = computed.select(F.count(F.lit(1))).scalar()
    return written.agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.count_distinct("symbol", "date").alias("distinct_keys"),
    ).select(rows_computed.alias("rows_computed"), "rows_written", "distinct_keys")


class LoadError(RuntimeError):
    """A published table differs from what was computed."""


def assert_loaded(rows_computed: int, written: DataFrame) -> None:
    """Every computed row was written, and (symbol, date) is a key."""
    r = written.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol", "date").alias("keys")).first()
    if not rows_computed == r["rows"] == r["keys"]:
        raise LoadError(f"{rows_computed} rows computed, {r['rows']} written, {r['keys']} distinct keys")


def preview(features: DataFrame, n: int = 10) -> DataFrame:
    """First n rows by (symbol, date)."""
    return features.orderBy("symbol", "date").limit(n)


def register_tables(tables: dict[str, DataFrame]) -> None:
    """S3: name tables for SQL text (``spark.sql``) in their session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """One report as Parquet or CSV with a header; returns ``path``.
    A sorted report is written in its order, one file per range of rows."""
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)
    return path


def write_reports(reports: dict[str, DataFrame], root: str, run_date: str, book: str,
                  fmt: str = "parquet") -> dict[str, str]:
    """Write each report under run_date=/book=/report=; returns the paths."""
    return {rid: write_report(df, f"{root}/run_date={run_date}/book={book}/report={rid}", fmt)
            for rid, df in reports.items()}


def report_manifest(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """(report_id, row_count), counted from the written files."""
    out = None
    for rid, path in paths.items():
        df = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(rid).alias("report_id"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
