"""The corpus pipeline: five stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept; ``run`` writes every stage's result as a table and reads it for the next.
All stages but the last return the columns of documents.

Ids that are null or repeated: near duplicates and mixture decide by a key of
their own per (id, text), so different texts under one id are different
documents and texts without an id are grouped like all others; rows equal in id
and text are one document.  Null and empty texts: language drops them; the other
stages keep them (linked with nothing, of size 0, one piece of length 1).  Ties go
to the smaller id, then to the key.  Very long texts are read whole by all
stages.  Extra columns travel along, whatever their names, except ``_key``,
``_odd``, ``_sha``, ``_copies`` and ``_copy``.  All stages take empty tables.

Near duplicates share 80% of their five-word shingles; shorter shingles would
catch more edited copies (``op9_superminhash`` takes two words) and also more
texts that only share a style.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm import dedup, langid, mixing, packing, pii
from marketframe.llm.common import documents, stored

#: SQL can't express the trained stages; tests compare with brute force.
ORACLE_SQL = None


#: Parts that the keys of repeated ids are numbered in.
PARTS = 4096


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique ``_key``: the id where it is unique, else a number
    below all ids for each (id, text); rows equal in both become one."""
    odd = stored(docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
                 .select(F.col("doc_id").alias("_odd")), "repeated-ids")
    same = F.col("doc_id").eqNullSafe(F.col("_odd"))
    plain = docs.join(odd, same, "left_anti").withColumn("_key", F.col("doc_id").cast("long"))
    rows = docs.join(odd, same, "left_semi").withColumn("_sha", F.sha2("text", 256))
    # Distinct pairs, dealt by hash: a third of all rows under one id are spread.
    below = min(0, docs.agg(F.min("doc_id")).first()[0] or 0)
    part = F.pmod(F.xxhash64("_id", "_s"), F.lit(PARTS))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_id", "_s")).cast("long")
    pairs = rows.select(F.col("doc_id").alias("_id"), F.col("_sha").alias("_s")).distinct().withColumn("_part", part)
    numbers = stored(pairs.select("_id", "_s", (F.lit(below) - rank * PARTS - F.col("_part")).alias("_key")), "row-keys")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (rows.join(numbers, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_sha").eqNullSafe(F.col("_s")))
           .groupBy("_key").agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*", "_key"))
    return plain.unionByName(one)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or without a likely language; what is
    likely comes from the scores of all labelled documents held out of training."""
    model = langid.train(docs)
    return langid.accepted(docs, model, langid.thresholds(docs, model), langid.KNOWN_LETTERS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group; one
    without an id stays only where none of its group has one."""
    rows = keyed(docs)
    found = dedup.groups(rows.select(F.col("_key").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key"))
    kept = found.join(rows.select("_key", "doc_id"), "_key").groupBy("component_id").agg(first.alias("m")).select("m._key")
    return rows.join(kept, "_key", "left_semi").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in angle brackets."""
    return pii.masked(docs, pii.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that the sources meet their word targets."""
    rows = keyed(docs)
    mixed = mixing.mix(rows.select(F.col("_key").alias("doc_id"), "text", "source")).where("copies > 0")
    return rows.join(mixed.select(F.col("doc_id").alias("_key"), F.col("copies").alias("_copies")), "_key").select(
        *docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).drop("_copy")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' token pieces into sequences of 1024 ids."""
    _, placed = packing.pack(docs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("sequences", sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
