"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import (dedup, fingerprints, knn, langid, licenses, mixing, packing, pii, resampling, sharding,
                             token_output, toxicity, whitening)
from marketframe.llm.common import documents, fold, scratch_path


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.detect(docs, pii.train(docs))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs)).select(
        "doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, placed = packing.pack(documents(spark, sf_dir))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op8_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.write(documents(spark, sf_dir), scratch_path(spark, "token-files"))
    return token_output.read(spark, path)


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.groups(documents(spark, sf_dir), words=2, percent=80)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return knn.top_k(table, F.col("vec_id") % 50 == 0)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = wide.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", "explained",
                       F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                       F.get("explained", "at").alias("explained"), "identity_error")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_mixing, op3_pii, op4_langid, op5_toxicity, op6_winnowing, op7_packing,
                                        op8_range_coder, op9_superminhash, op10_topk, op11_resampling,
                                        op12_licenses, op13_whitening)}
