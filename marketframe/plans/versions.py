"""Committed versions of the feature tables.

A version is written to a folder of its own, checked, described by a manifest
and then committed; only the commit makes it current.  Layout under ``root``::

    version=<id>/universe=<U>/year=<Y>/*.parquet   the rows
    manifests/version=<id>/*.parquet               one row per universe and year
    commits/<number>                               a file that holds <id>

The manifest has rows, checksum, and the first and last date of each (universe,
year), all read from the files.  The checksum is a sum of row hashes: it does
not depend on order or files, and a changed, lost or doubled row changes it.
While a universe is written, count and checksum of what was computed are
observed in the same pass; ``publish`` commits only if the files agree and
(symbol, date) is a key.

A commit is a rename to the next free number, which fails if that number is
taken, so two writers can't both win; the newest number is current.  A writer
that dies before it leaves a folder that nobody reads.  Readers resolve the
current version once and keep reading its folder; ``retire`` removes all but
the newest committed versions.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketframe.plans.publish import LoadError, publish_features, read_features
from marketframe.schema import FEATURE_COLUMNS

MANIFEST = ("universe string, year int, rows long, keys long, checksum decimal(38,0), first_date date, last_date date")


def row_checksum(columns: list[str] = FEATURE_COLUMNS) -> Column:
    """Sum of the rows' hashes, free of overflow."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def describe(spark: SparkSession, root: str, version: str, universe: str) -> DataFrame:
    """The manifest rows of a universe, computed from its files."""
    stored = read_features(spark, f"{root}/version={version}", universe)
    return stored.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol", "date").alias("keys"), row_checksum().alias("checksum"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).select(F.lit(universe).alias("universe"), "year", "rows", "keys", "checksum", "first_date", "last_date")


def write_version(spark: SparkSession, root: str, tables: dict[str, DataFrame], version: str | None = None,
                  **layout) -> str:
    """Write and check every universe, and the manifest; not yet current.
    ``layout`` and ``rows_per_file`` are those of ``publish_features``."""
    version = version or uuid.uuid4().hex[:12]
    parts = []
    for universe, features in tables.items():
        computed = Observation()
        watched = features.select(*FEATURE_COLUMNS).observe(
            computed, F.count(F.lit(1)).alias("rows"), row_checksum().alias("checksum"))
        publish_features(watched, root, universe, version, **layout)
        part = describe(spark, root, version, universe).collect()  # a row per year
        parts += part
        want, rows = computed.get, sum(r.rows for r in part)
        if (rows, sum(int(r.checksum) for r in part)) != (want["rows"], int(want["checksum"])):
            raise LoadError(f"{universe}: {want['rows']} rows computed, {rows} written, or their values differ")
        if any(r.rows != r["keys"] for r in part):
            raise LoadError(f"{universe}: (symbol, date) is not a key")
    spark.createDataFrame(parts, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/version={version}")
    return version


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], version: str | None = None, **layout) -> str:
    """Write, check and commit; returns the version, which is now current."""
    version = write_version(spark, root, tables, version, **layout)
    commit(spark, root, version, check=False)  # its files were read a moment ago
    return version


def commit(spark: SparkSession, root: str, version: str, check: bool = True) -> int:
    """Make a written version current; returns the commit's number."""
    if check:
        verify(spark, root, version)
    files, path = _files(spark, root)
    draft = path(f"{root}/commits/.{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    parents = _array(spark, jvm.org.apache.hadoop.fs.Options.CreateOpts, [jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()])
    out = files.create(draft, flags, parents)
    out.write(bytearray(version.encode()))
    out.close()
    while True:
        number = max(commits(spark, root), default=0) + 1
        try:
            files.rename(draft, path(f"{root}/commits/{number:012d}"),
                         _array(spark, jvm.org.apache.hadoop.fs.Options.Rename, []))
            return number
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass()):
                raise  # else another writer took the number


def commits(spark: SparkSession, root: str) -> dict[int, str]:
    """Commit number -> version; empty before the first one."""
    files, path = _files(spark, root)
    if not files.util().exists(path(f"{root}/commits")):
        return {}
    schema = StructType([StructField("value", StringType())])
    rows = (spark.read.schema(schema).option("wholetext", True).text(f"{root}/commits")
            .select("value", F.col("_metadata.file_name").alias("name")).collect())
    return {int(r.name): r.value for r in rows}


def current_version(spark: SparkSession, root: str) -> str:
    """The version that readers should see."""
    known = commits(spark, root)
    if not known:
        raise LookupError(f"nothing is committed under {root}")
    return known[max(known)]


def read_current(spark: SparkSession, root: str, universe: str) -> DataFrame:
    """The current feature table of a universe, with its ``year`` folders."""
    return read_features(spark, f"{root}/version={current_version(spark, root)}", universe)


def manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, root)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/version={version}")


def verify(spark: SparkSession, root: str, version: str | None = None) -> None:
    """Recompute the manifest from the files; LoadError names what differs."""
    version = version or current_version(spark, root)
    said = {(r.universe, r.year): r for r in manifest(spark, root, version).collect()}
    found = {(r.universe, r.year): r for u in sorted({u for u, _ in said}) for r in describe(spark, root, version, u).collect()}
    wrong = sorted(k for k in said.keys() | found.keys() if said.get(k) != found.get(k))
    if wrong:
        raise LoadError(f"version {version} differs from its manifest in " + ", ".join(f"{u} {y}" for u, y in wrong))


def newest_date(spark: SparkSession, root: str, universe: str, version: str | None = None) -> DataFrame:
    """A1/P5: max(date) from the manifest's zone maps; no data file is read."""
    return manifest(spark, root, version).where(F.col("universe") == universe).agg(F.max("last_date").alias("date"))


def retire(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Remove all committed versions but the ``keep`` newest; returns them.
    Folders of writers that have not committed are left alone."""
    if keep < 1:
        raise ValueError("the current version must stay")
    known = commits(spark, root)
    newest: list[str] = []
    for number in sorted(known, reverse=True):
        if known[number] not in newest:
            newest.append(known[number])
    files, path = _files(spark, root)
    for version in newest[keep:]:
        # The commits first: a reader that comes now no longer finds the version.
        for number in (n for n, v in known.items() if v == version):
            files.delete(path(f"{root}/commits/{number:012d}"), False)
        for folder in (f"manifests/version={version}", f"version={version}"):
            files.delete(path(f"{root}/{folder}"), True)
    return newest[keep:]


def _files(spark: SparkSession, root: str):
    """Hadoop's file context of ``root`` (local, HDFS or object store) and its paths."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hadoop.Path(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    return context, hadoop.Path


def _array(spark: SparkSession, kind, items: list):
    out = spark.sparkContext._gateway.new_array(kind, len(items))
    for i, x in enumerate(items):
        out[i] = x
    return out
