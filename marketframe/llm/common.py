"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.session import ensure_checkpoint_dir

#: Rows that a task turns into numpy arrays at a time.
SLICE_ROWS = 64


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so that
    later steps neither recompute it nor depend on an executor's local disk."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a task works on few rows at a time, whatever
    the batch size of the session and however long the texts are."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows and about ``size``
    bytes of the column ``text``, for work that gains by more texts at a time.
    A longer text is a slice by itself."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False), dtype="int64")
        at = 0
        while at < b.num_rows:
            room = size + (ends[at - 1] if at else 0)
            n = min(rows, max(1, int(np.searchsorted(ends, room, "right")) - at))
            yield b.slice(at, n)
            at += n


def fold(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out of training.  A null
    id counts as held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5, F.lit(0))


def id_key() -> Column:
    """doc_id as a sort key; a null id comes before all others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def id_ranges(rows: DataFrame, count: int) -> tuple[Column, int] | None:
    """The number of the id range that a row's ``key`` lies in, and how many
    ranges there are: about ``count`` of near equal row counts.  The driver
    gets count - 1 cut points.  None if there are no rows."""
    at = [i / count for i in range(1, count)] or [0.5]
    cuts = rows.agg(F.percentile_approx("key", at, 100 * count)).first()[0]
    if cuts is None:
        return None
    cuts = sorted(set(cuts))
    # Two short look-ups instead of one long one.
    step = max(1, int(len(cuts) ** 0.5))
    fine = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    block = F.size(F.filter(F.array(*[F.lit(c[0]) for c in fine]), lambda c: c <= F.col("key")))
    lists = F.array(*[F.array(*[F.lit(x) for x in c]) for c in fine])
    inner = F.size(F.filter(F.element_at(lists, F.greatest(block, F.lit(1))), lambda c: c <= F.col("key")))
    number = F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inner).cast("int")
    return number, len(cuts) + 1
