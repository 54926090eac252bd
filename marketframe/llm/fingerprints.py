"""Document fingerprints by winnowing.

Rolling hashes of all ``GRAM``-character grams; from each window of ``WINDOW``
consecutive hashes the smallest is kept, the rightmost one on ties, with its
position.  Two texts that share ``GRAM + WINDOW - 1`` = 19 characters share a
fingerprint entry, so a text of 28 or more is always like its edited one;
shared passages below ``GRAM`` characters never match.

The neighbour job (each document with the next one in descending id) moves
the texts once, range-partitioned by id, and streams each range in order.  A
range's last document also needs the first one of the range below, so that
one document is sent to both ranges.

Edge cases: a null text is empty; the empty text has an empty fingerprint; a
text shorter than a gram is one gram; two empty fingerprints have likeness 1;
a null id comes last; rows with the same id are ordered by text; a single
document is its own next one; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import id_key, id_ranges, slices

GRAM = 12
WINDOW = 8
PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.ones(1, "<u8")
_INVERSE = np.ones(1, "<u8")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    global _POWERS, _INVERSE
    while len(_POWERS) < n:
        m = len(_POWERS)
        _POWERS = np.concatenate([_POWERS, _POWERS * (_POWERS[-1:] * _BASE)])
        _INVERSE = np.concatenate([_INVERSE, _INVERSE * (_INVERSE[-1:] * _BACK)])
        assert len(_POWERS) == 2 * m
    return _POWERS[:n], _INVERSE[:n]


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hash of every gram: prefix sums of ``code * base^i``, shifted back."""
    up, down = _powers(len(codes))
    total = np.zeros(len(codes) + 1, "<u8")
    np.cumsum((codes.astype("<u8") + np.uint64(1)) * up, out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:len(codes) - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(32)


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """Selected entries as ``hash << 32 | position``, in order of position."""
    if not text:
        return np.zeros(0, "<u8")
    n = len(text)
    if n < gram:
        text, gram = text.ljust(gram, "\0"), gram
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return gram_hashes(codes, gram) << np.uint64(32)
    kept = []
    step = max(PIECE, 4 * (gram + window))
    # Pieces overlap so that every window lies whole in one of them.
    for at in range(0, max(1, n - gram - window + 2), step):
        codes = np.frombuffer(text[at:at + step + gram + window - 2].encode("utf-32-le", "surrogatepass"), "<u4")
        h = gram_hashes(codes, gram)
        where = np.arange(at, at + len(h), dtype="<u8")
        # Smallest hash first, then the largest position.
        low = h << np.uint64(32) | (np.uint64(0xFFFFFFFF) - where)
        width = min(window, len(low))
        done = 1
        while done < width:
            jump = min(done, width - done)
            low = np.minimum(low[:-jump], low[jump:])
            done += jump
        kept.append(low[np.append(True, low[1:] != low[:-1])])
    low = np.concatenate(kept)
    low = low[np.append(True, low[1:] != low[:-1])]
    return (low & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF)))


def as_text(entries: np.ndarray) -> str:
    """Base64 of 5 bytes per entry: hash, then how far its position lies behind
    the one before (the first: behind -1), at most ``WINDOW``."""
    packed = np.empty((len(entries), 5), "u1")
    packed[:, :4] = (entries >> np.uint64(32)).astype(">u4").view("u1").reshape(-1, 4)
    steps = np.diff((entries & np.uint64(0xFFFFFFFF)).astype("int64"), prepend=-1)
    assert not len(steps) or steps.max() < 256
    packed[:, 4] = steps
    return base64.b64encode(packed.tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the hashes, positions aside."""
    a, b = np.unique(a >> np.uint64(32)), np.unique(b >> np.uint64(32))
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the start of the next one."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def fingerprint(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with the ``fingerprint`` of each text."""
    x = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [as_text(winnow(t)) for t in b.column("_text").to_pylist()]
            yield pa.record_batch([*[b.column(c) for c in keep], pa.array(out, pa.string())],
                                  names=[*keep, "fingerprint"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.drop("_text").schema)
    return x.mapInArrow(run, f"{fields}, fingerprint string")


def with_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness
    to each other and to the next document's, in descending id."""
    spark = docs.sparkSession
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_key().alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    found = id_ranges(rows, parts * per_partition)
    if found is None:
        return spark.createDataFrame([], schema)
    number, width = found
    rows = rows.withColumn("range", number)
    heads = {r["range"]: r["top"] for r in rows.groupBy("range").agg(F.max("key").alias("top")).collect()}
    filled = sorted(heads)
    above = dict(zip(filled, filled[1:] + filled[:1], strict=True))  # who needs a range's first document
    tops = F.array(*[F.lit(heads.get(i)).cast("long") for i in range(width)])
    needs = F.array(*[F.lit(above.get(i, -1)) for i in range(width)])
    at_range = F.col("range") + 1
    home = F.struct(F.col("range").alias("to"), F.lit(0).alias("guest"))
    guest = F.struct(F.element_at(needs, at_range).alias("to"), F.lit(1).alias("guest"))
    sent = rows.withColumn("go", F.explode(F.when(F.col("key") == F.element_at(tops, at_range), F.array(home, guest))
                                           .otherwise(F.array(home))))
    dealt = (sent.select("doc_id", "key", "text", "go.to", "go.guest").repartition(parts, "to")
             .sortWithinPartitions("to", "guest", F.desc("key"), "text"))
    return dealt.select("to", "guest", "doc_id", "text").mapInArrow(_stream, schema)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # the last row and its fingerprint
    for b in slices(batches):
        out = []
        for to, guest, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if guest and (held is None or held[0] != to):
                continue  # a further row with the id of the range's first
            entries = winnow(text)
            if held is not None and held[0] == to:
                out.append(_row(held, text, entries))
            held = None if guest else (to, doc_id, text, entries)
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                  names=names)


def _row(held: tuple, following: str, next_entries: np.ndarray) -> tuple:
    _, doc_id, text, entries = held
    changed = edited(text, following)
    other = winnow(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(entries), as_text(other), likeness(entries, other), likeness(entries, next_entries))
