"""Token ids as files of independently coded blocks, in ascending id order.

Documents are dealt by id range; each task tokenizes its ranges in order and
codes the ids into blocks of about ``BLOCK_IDS`` (see range_coder).  A file is a
Parquet table with one row per block: range and block number, the documents'
ids and lengths, and the coded bytes.  Blocks can be decoded alone; a damaged
one raises.  Documents are never split over blocks.

Edge cases: a null text is empty; every document ends with the end id; a null
id comes first; rows with the same id are ordered by text; an empty table gives
files without blocks; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm import range_coder
from marketframe.llm.common import id_key, id_ranges, slices, text_slices
from marketframe.llm.tokens import default_path, encoder

END_ID = 1
BLOCK_IDS = 1 << 20
#: Bytes of text that are tokenized at a time.
SLICE = 6_000_000
FILE = "range int, block int, n_ids long, doc_ids array<long>, lengths array<long>, coded binary"
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
_NAMES = ["range", "block", "n_ids", "doc_ids", "lengths", "coded"]


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
          block_ids: int = BLOCK_IDS, per_partition: int = 4) -> str:
    """Tokenize, code and write all documents; returns ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path("word_bpe_49k.json")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_key().alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    found = id_ranges(rows, parts * per_partition)
    if found is None:
        spark.createDataFrame([], FILE).write.parquet(path)
        return path
    dealt = rows.withColumn("range", found[0]).repartition(parts, "range").sortWithinPartitions("range", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        vocabulary = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        at, block, ids, docs_in, filled = None, 0, [], [], 0
        end = np.array([end_id], enc.dtype)

        def flush() -> pa.RecordBatch:
            x = np.concatenate(ids)
            row = (at, block, len(x), docs_in, [len(i) + 1 for i in ids[::2]], range_coder.encode(x, vocabulary, end_id))
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], names=_NAMES)

        for b in text_slices(batches, 2048, SLICE):
            new = enc.encode(b.column("text").to_pylist())
            for r, doc_id, x in zip(b.column("range").to_pylist(), b.column("doc_id").to_pylist(), new, strict=True):
                if ids and (r != at or filled + len(x) >= block_ids):
                    yield flush()
                    block, ids, docs_in, filled = block + 1, [], [], 0
                if r != at:
                    at, block = r, 0
                ids += [x, end]
                docs_in.append(doc_id)
                filled += len(x) + 1
        if ids:
            yield flush()

    dealt.select("range", "doc_id", "text").mapInArrow(run, FILE).write.parquet(path)
    return path


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids as binary, little-endian
    unsigned 32-bit) of every document, decoded from the files."""
    blocks = spark.read.schema(FILE).parquet(path)
    heads = blocks.select("range", "block", "n_ids")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per id range
    ranges = heads.groupBy("range").agg(F.sum("n_ids").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(ranges, "range").select(
        "range", "block", (F.col("before") + F.col("inside")).alias("first"))

    names = ["range", "block", "doc_id", "at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 4] + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            r, block, doc_ids, lengths, coded = (b.column(c)[0].as_py() for c in
                                                 ("range", "block", "doc_ids", "lengths", "coded"))
            ids = range_coder.decode(coded).astype("<u4")
            ends = np.cumsum(lengths)
            if ends[-1] != len(ids):
                raise range_coder.CorruptBlock("lengths don't add up")
            raw = [ids[e - n:e].tobytes() for e, n in zip(ends, lengths, strict=True)]
            n = len(doc_ids)
            out = [[r] * n, [block] * n, doc_ids, ends - lengths, lengths, [zlib.crc32(x) for x in raw]]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out + [raw] * with_ids, types, strict=True)], names=names)

    fields = "range int, block int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    docs = blocks.select("range", "block", "doc_ids", "lengths", "coded").mapInArrow(run, fields)
    return docs.join(starts, ["range", "block"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
