"""Best-fit packing with certified bounds.

Documents become token pieces of at most ``CAPACITY`` ids; only longer ones
are cut, the remainder first.  Full pieces are sequences by themselves.  The
others are dealt to partitions of about ``PART`` pieces; each is packed by
best-fit decreasing, and dual feasible functions give a lower bound on the
sequences it needs.  Where the two agree the partition is certified optimal.
Partitions with a gap release the sequences with more room than average;
these meet those of other partitions in new ones, and best-fit decreasing runs
again; a new packing is kept only where it needs fewer sequences.

Scale: the ids are written once, with their pieces; packing moves only
lengths and piece numbers.  A partition's work does not grow with the input.

Edge cases: a null text is empty; every document ends with the end id, so an
empty text is one piece of length 1; long texts give many pieces; repeated
rows are packed separately (pieces have a number of their own); a null id is
carried through; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import stored, text_slices
from marketframe.llm.tokens import default_path, encoder

CAPACITY = 1024
END_ID = 2
PART = 50_000
ROUNDS = 2
PLACED = ("uid long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, "
          "certified boolean")


def pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 and the ids themselves
    (binary, little-endian unsigned, 16 bits where the vocabulary allows)."""
    path = path or default_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in text_slices(batches):
            out: list[tuple] = []
            encoded = enc.encode([t or "" for t in b.column("text").to_pylist()])
            for doc_id, body in zip(b.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.append(body, np.array([end_id], enc.dtype))
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                for k, end in enumerate(ends):
                    start = 0 if k == 0 else end - capacity
                    x = ids[start:end]
                    out.append((doc_id, k, start, end - start, zlib.crc32(x.astype("<u4").tobytes()), x.tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE_TYPES, strict=True)],
                                  names=_PIECE_NAMES)

    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = x.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return cut.select(F.monotonically_increasing_id().alias("uid"), "*")


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best of two families of dual feasible functions.

    ``f_t``: above capacity - t counts as a whole sequence, below t as nothing.
    ``u_k``: ``floor((k + 1) x) / k``, or x where (k + 1) x is whole."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype("int64")
    size = np.arange(capacity + 1)
    n, mass = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(mass[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):
        top = capacity - t
        total = int(n[-1] - n[top]) * capacity + int(mass[top] - mass[t - 1])
        best = max(best, -(-total // capacity))
    for k in range(1, 33):
        whole = (size * (k + 1)) % capacity == 0
        value = np.where(whole, size * k, (size * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence number and offset of each piece, and the sequences used.

    Open sequences are kept by the room they have left; bit r of ``rooms``
    says that some have r, so the tightest fit is the lowest set bit."""
    order = np.argsort(-lengths, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    seq, offset = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            s = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, s = capacity, used
            used += 1
        seq[i], offset[i] = s, capacity - room
        by_room[room - size].append(s)
        rooms |= 1 << (room - size)
    return seq, offset, used


def _packed(pdf: pd.DataFrame, group: int, level: int, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values("uid", ignore_index=True)
    lengths = pdf["length"].to_numpy("int64")
    seq, offset, used = best_fit_decreasing(lengths, capacity)
    old = pdf["sequence_id"].nunique() if level else used + 1
    if used < old:  # else the packing that the pieces came with stays
        pdf["sequence_id"] = (np.int64(level * (1 << 24) + group) << 32) + seq
        pdf["offset"] = offset
    pdf["certified"] = min(used, old) == lower_bound(lengths, capacity)
    return pdf


def place(table: DataFrame, capacity: int = CAPACITY, part: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """Sequence and offset of every piece of a stored piece table."""
    rows = table.select("uid", "doc_id", "piece", "start", "length", "ids_crc32",
                        F.lit(None).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                        F.lit(True).alias("certified"))
    full = rows.where(F.col("length") == capacity).withColumn("sequence_id", -F.col("uid") - 1)
    placed = _round(rows.where(F.col("length") < capacity), F.xxhash64("uid"), 0, capacity, part)
    for level in range(1, rounds + 1):
        room = placed.groupBy("sequence_id", "certified").agg((capacity - F.sum("length")).alias("room"))
        gap = room.where(~F.col("certified"))
        mean = gap.agg(F.avg("room")).first()[0]
        if mean is None:
            break
        free = gap.where(F.col("room") >= mean).select(F.col("sequence_id").alias("released"))
        x = placed.join(free, F.col("sequence_id") == F.col("released"), "left")
        again = x.where(F.col("released").isNotNull()).drop("released")
        stay = x.where(F.col("released").isNull()).drop("released")
        # Whole sequences travel, so a pool can tell whether it needs fewer.
        placed = stored(stay.union(_round(again, F.xxhash64("sequence_id"), level, capacity, part)), "placed")
    return full.union(placed)


def _round(rows: DataFrame, key, level: int, capacity: int, part: int) -> DataFrame:
    groups = max(1, -(-rows.count() // part))
    dealt = rows.withColumn("grp", F.pmod(key, F.lit(groups)))

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _packed(pdf.drop(columns="grp"), int(k[0]), level, capacity)

    return stored(dealt.groupBy("grp").applyInPandas(run, PLACED), "packed")


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY,
         part: int = PART, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The stored pieces with their ids, and the place of each piece."""
    table = stored(pieces(docs, path, end_id, capacity), "pieces")
    return table, place(table, capacity, part, rounds)


def sequences(table: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed output: sequence_id, offset, doc_id, piece, length, ids."""
    return placed.select("uid", "sequence_id", "offset").join(
        table.select("uid", "doc_id", "piece", "length", "ids"), "uid").drop("uid")
