"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and skip-grams (one word left out),
by presence, over the whole text.  FTRL-proximal keeps a learning rate per
coordinate and L1 zeroes the rest, so the model that is broadcast holds only
the features that survived.  It is fitted on a bounded sample: at most
``PER_LABEL`` rows for each label value (in ``SLICES`` slices by hash of the id,
the lowest hashes of each) outside the held-out fold, so both labels weigh the same,
and of these, by hash, as many as fit into ``SAMPLE_BYTES`` of features per label
(one that does not is passed over).

Edge cases: null and empty texts have no features and get the score of the
bias alone; labels that are null are left out; without labels of both values
every score is 0; long texts are hashed piecewise; repeated rows are scored
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import fold, slices, stored

BITS = 22
PER_LABEL = 4000
SAMPLE_BYTES = 64 << 20
SLICES = 8
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
WORD = re.compile(r"\w+")
PIECE = 1 << 20
MEMO = 300_000
_K = [np.uint32(k) for k in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)]


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


_HASH = _WordHash()


def features(text: str | None) -> np.ndarray:
    """Feature numbers of a text, as they come (repeats included)."""
    out = []
    tail: list[int] = []
    for part in _pieces(text or ""):
        ids = tail + list(map(_HASH.__getitem__, WORD.findall(part.lower())))
        h = np.array(ids, "<u4")
        new = len(ids) - len(tail)
        if new:
            one, two, skip = h * _K[0], h[:-1] * _K[1] + h[1:] * _K[2], h[:-2] * _K[3] + h[2:] * _K[4]
            out += [one[-new:], two[-new:] if len(two) else two, skip[-new:] if len(skip) else skip]
        tail = ids[-2:]
    if not out:
        return np.zeros(0, "<u4")
    x = np.concatenate(out)
    x ^= x >> np.uint32(15)
    return (x * _K[0]) >> np.uint32(32 - BITS)


def _pieces(text: str) -> Iterator[str]:
    """Pieces of about PIECE characters that end between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            m = re.compile(r"\W").search(text, end)
            end = m.start() if m else len(text)
        yield text[at:end]
        at = end


@dataclass
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, "float32")
        w[self.index] = self.weight
        return w


def fit(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> Model | None:
    """FTRL-proximal over sparse rows of distinct feature numbers."""
    if len(set(labels)) < 2:
        return None
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0
        return w

    counts = np.bincount(labels, minlength=2)
    importance = counts.max() / np.maximum(counts, 1)
    for _ in range(epochs):
        for x, y in zip(rows, labels, strict=True):
            i = np.append(x, bias)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - y) * importance[y]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    alive = np.flatnonzero(np.abs(z[:bias]) > L1)
    return Model(alive.astype("<u4"), weights(alive).astype("float32"), float(weights(np.array([bias]))[0]))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL) -> DataFrame:
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 0)).select(
        "doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))
    # Each label in slices of few enough rows that every task keeps only those before the shuffle.
    each = -(-per_label // SLICES)
    rank = F.row_number().over(Window.partitionBy("y", "slice").orderBy("h", "doc_id"))
    ids = (known.withColumn("slice", F.pmod("h", F.lit(SLICES))).withColumn("r", rank)
           .where(F.col("r") <= each).select("doc_id", "y", "h"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = [np.unique(features(t)).astype("<u4").tobytes() for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("h"), b.column("y"), pa.array(x, pa.binary())], names=["h", "y", "x"])

    # At most per_label ids for each of two labels.
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("h", "y", "text")
    return chosen.mapInArrow(extract, "h long, y int, x binary")


def within(rows: DataFrame, total: int = SAMPLE_BYTES) -> DataFrame:
    """The rows of a stored sample that a byte budget per label has room for.
    The driver sees sizes first, at most ``PER_LABEL`` or so for each label."""
    left, out = {0: total, 1: total}, []
    sizes = rows.select("h", "y", F.octet_length("x").alias("b"), F.xxhash64("x").alias("which")).distinct()
    for r in sorted(sizes.collect()):
        if r.b <= left[r.y]:
            left[r.y] -= r.b
            out.append((r.h, r.y, r.which))
    taken = rows.sparkSession.createDataFrame(out, "h long, y int, which long")
    return rows.withColumn("which", F.xxhash64("x")).join(F.broadcast(taken), ["h", "y", "which"]).dropDuplicates(["h", "y", "which"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL,
          total: int = SAMPLE_BYTES) -> Model | None:
    rows = within(stored(training_rows(docs, labels, label, per_label), "toxicity-sample"), total)
    sample = sorted((r.h, r.y, bytes(r.x)) for r in rows.collect())
    return fit([np.frombuffer(s[2], "<u4") for s in sample], [s[1] for s in sample])


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with ``score``, the probability of label 1."""
    x = docs.select(*keep, F.col("text").alias("_text"))
    if model is None:
        return x.drop("_text").withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the surviving features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = shared.value.dense(), shared.value.bias
        for b in slices(batches):
            out = []
            for t in b.column("_text").to_pylist():
                f = features(t)
                f = np.unique(f[dense[f] != 0])
                out.append(1 / (1 + np.exp(-np.clip(bias + float(dense[f].sum()), -35, 35))))
            yield pa.record_batch([*[b.column(c) for c in keep], pa.array(out, pa.float64())],
                                  names=[*keep, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.drop("_text").schema)
    return x.mapInArrow(run, f"{fields}, score double")
