"""Importance resampling of documents towards a target distribution.

An untrained pre-tokenizer of the ``tokenizers`` library (a regex split over
text whose ASCII letters are lower-cased) returns each text's words with their
offsets.  Windows of 1 to ``max_words`` consecutive offset pairs are the
features; a feature's bucket is the CRC-32 of its words, joined by one space,
modulo ``buckets``.  The bucket histograms of all documents and of the target
give every bucket a gain, the smoothed log ratio of its shares in thousandths;
a document's weight is the mean gain of its features, rounded down.  Adding
Gumbel noise that depends on the id alone and taking the highest scores draws
documents without replacement, likelier the nearer they are to the target.

The split runs once per text: the buckets of a text are stored (two bytes per
feature), and the histogram and the weights are read off them.  The driver
gets the histograms (``buckets`` rows) and no more.  Ranks come from one count
per score, an integer of fewer than about 110,000 values, and a numbering
inside each score, so no task sorts all documents.

Edge cases: a null or empty text has no features and weight 0; long texts are
split ``PIECE`` characters at a time, between words; a null id draws its noise
from the text ``null``; equal scores rank by id (null first), then by features,
weight and text hash; rows that repeat count and rank as rows of their own; an
empty target or an empty table of documents is fine (gains from the smoothing
alone, an empty result); other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import slices, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Characters that one call of the pre-tokenizer gets, cut between words.
PIECE = 1 << 16
#: Words whose bucket a task remembers.
MEMO = 500_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words_with_offsets(text: str, splitter, piece: int = PIECE) -> Iterator[tuple[str, tuple[int, int]]]:
    """The words of a lower-cased text and where they start and end."""
    at, n = 0, len(text)
    while at < n:
        gap = _GAP.search(text, at + piece) if at + piece < n else None
        end = gap.start() if gap else n
        for word, (a, b) in splitter.pre_tokenize_str(text[at:end]):
            yield word, (at + a, at + b)
        at = end


def feature_buckets(text: str | None, splitter, buckets: int, max_words: int, memo: dict,
                    piece: int = PIECE) -> tuple[int, array]:
    """Number of words and the bucket of every feature of a text."""
    out, runs, count = array("I"), [], 0
    for word, _ in words_with_offsets((text or "").translate(_LOWER), splitter, piece):
        count += 1
        if max_words == 1:
            bucket = memo.get(word)
            if bucket is None:
                if len(memo) >= MEMO:
                    memo.clear()
                bucket = memo[word] = zlib.crc32(word.encode()) % buckets
            out.append(bucket)
            continue
        # A window grows by one word: its checksum continues the shorter one's.
        code = word.encode()
        runs = [zlib.crc32(code)] + [zlib.crc32(b" " + code, c) for c in runs[:max_words - 1]]
        out.extend(c % buckets for c in runs)
    return count, out


def _featurize(buckets: int, max_words: int, piece: int, names: list[str], schema: pa.Schema):
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split
        splitter = Split(Regex(WORD), "removed", invert=True)
        memo: dict = {}
        for b in slices(batches):
            counts, packed = [], []
            for text in b.column("text").to_pylist():
                n, found = feature_buckets(text, splitter, buckets, max_words, memo, piece)
                counts.append(n)
                packed.append(np.frombuffer(found, "<u4").astype(kind).tobytes())
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                                             schema=schema)
    return run


def features(docs: DataFrame, buckets: int = BUCKETS, max_words: int = 1, piece: int = PIECE,
             keys: tuple[str, ...] = ()) -> DataFrame:
    """n_words and the packed buckets of each text, with the columns ``keys``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T
    rows = docs.select(*keys, "text")
    fields = [rows.schema[k] for k in keys]
    out = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])
    return rows.mapInArrow(_featurize(buckets, max_words, piece, list(keys), to_arrow_schema(out)), out)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; ``buckets`` longs on the driver."""
    kind = _kind(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for b in batches:
            for packed in b.column("buckets"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    out = np.zeros(buckets, "int64")
    for r in featured.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[r[0]] = r[1]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    b = float(len(source))
    s, t = float(source.sum()) + b, float(target.sum()) + b
    return np.array([math.floor(1000 * math.log((float(y) + 1) * s / ((float(x) + 1) * t)))
                     for x, y in zip(source, target)], "int64")


def _weigh(gain: np.ndarray, kind: str, names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, weight = [], []
            for packed in b.column("buckets"):
                at = np.frombuffer(packed.as_buffer(), kind)
                n.append(len(at))
                weight.append(int(gain[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(n, pa.int64()), pa.array(weight, pa.int64())], schema=schema)
    return run


def noise(seed: str = SEED) -> Column:
    """Gumbel noise in thousandths from 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, max_words: int = 1, seed: str = SEED, piece: int = PIECE) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight, score, rank of every
    document; rank is null where the document is not drawn.  ``percent`` of
    the documents with ``least_words`` or more are drawn."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    featured = stored(features(keyed, buckets, max_words, piece, ("doc_id", "text_key")), "resample-features")
    gain = gains(histogram(featured, buckets), histogram(features(target, buckets, max_words, piece), buckets))

    names = ["doc_id", "text_key", "n_words"]
    out = T.StructType([*[featured.schema[c] for c in names], T.StructField("n_features", T.LongType()),
                        T.StructField("weight", T.LongType())])
    weighed = featured.mapInArrow(_weigh(gain, _kind(buckets), names, to_arrow_schema(out)), out)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(seed)), "resample-scores")

    able = F.col("n_words") >= least_words
    per_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # One row per score; the rows themselves are numbered score by score.
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ahead = per_score.select("score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("ahead"),
                             F.floor(F.sum("n").over(everything) * percent / 100).alias("draw"))
    placed = scored.join(ahead, "score", "left")
    among = able & (F.col("ahead") < F.col("draw"))
    place = F.col("ahead") + F.row_number().over(
        Window.partitionBy("score").orderBy("doc_id", "n_features", "weight", "text_key"))
    columns = ["doc_id", "text_key", "n_words", "n_features", "weight", "score"]
    first = placed.where(among).withColumn("place", place).select(
        *columns, F.when(F.col("place") <= F.col("draw"), F.col("place")).alias("rank"))
    rest = placed.where(~F.coalesce(among, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.unionByName(rest)


def drawn(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """The drawn rows of ``docs``, whole, with their weight, score and rank."""
    key = F.struct("doc_id", F.col("text_key"))
    nth = lambda order: F.row_number().over(Window.partitionBy("_key").orderBy(order))
    picked = (resampled.where("rank is not null").select(key.alias("_key"), "weight", "score", "rank")
              .withColumn("_nth", nth("rank")))
    rows = (docs.withColumn("_key", F.struct("doc_id", F.xxhash64("text").alias("text_key")))
            .withColumn("_nth", nth(F.xxhash64(*docs.columns))).alias("d"))
    same = F.col("d._key").eqNullSafe(F.col("p._key")) & (F.col("d._nth") == F.col("p._nth"))
    return rows.join(picked.alias("p"), same).select(
        *[F.col(f"d.`{c}`") for c in docs.columns if c not in ("weight", "score", "rank")],
        "p.weight", "p.score", "p.rank")
