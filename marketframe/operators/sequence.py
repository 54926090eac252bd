"""Per-symbol sequence positions without putting a whole symbol in one task.

A symbol's bars form one ordered series.  ``Window.partitionBy('symbol')``
would send the whole series of a symbol to one task, so one heavy symbol
would bound the job.  Instead:

* ``number_rows`` gives every row its 1-based position in its series from
  per-(symbol, chunk) counts: the counts table is tiny, its prefix sums are
  joined back, and the running count runs per (symbol, chunk) only
  (``running_count`` does the same for any flag).
* ``halo_blocks`` cuts each series into blocks of fixed length and copies
  the last ``before`` rows of a block into the next block (and/or the first
  ``after`` rows into the previous one).  Sliding windows over
  ``partitionBy(symbol, block)`` then see every row they need, and the copies
  are dropped afterwards.  Extra volume: (before + after) / block_size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_count(df: DataFrame, key: str, order: str, chunk: Column, flag: Column,
                  out: str, total: str | None = None) -> DataFrame:
    """Add ``out`` = number of rows of the same key, up to and including this
    one in ``order``, for which ``flag`` is true.

    ``chunk`` must be monotone in ``order`` (e.g. the year of the date); it
    bounds the rows one window partition holds.  Per-(key, chunk) totals are
    a tiny table whose prefix sums are joined back; the running count itself
    runs per (key, chunk).  With ``total`` set, also add the key's total.
    A row without key or chunk (no date, say) is an error, not left out.
    """
    d = df.withColumn("_chunk", chunk).withColumn("_flag", F.when(flag, 1).otherwise(0).cast("long"))
    counts = d.groupBy(key, "_chunk").agg(F.sum("_flag").alias("_n"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(key), F.col("_chunk"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if total:
        cols.append(F.sum("_n").over(Window.partitionBy(key)).alias(total))
    offsets = counts.select(*cols)
    in_chunk = (Window.partitionBy(key, "_chunk").orderBy(order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    error = F.raise_error(F.lit(f"a row without {key} or {order} has no place in a series"))
    offset = F.when(F.col("_off").isNull(), error).otherwise(F.col("_off"))
    return (
        d.join(offsets, [key, "_chunk"], "left")
        .withColumn(out, offset + F.sum("_flag").over(in_chunk))
        .drop("_off", "_chunk", "_flag")
    )


def prefix(df: DataFrame, key: str, order: str, chunk: Column, values: dict[str, tuple[str, Column]],
           current: bool = True) -> DataFrame:
    """Add running aggregates of each key's series in ``order``: for every
    ``name: (kind, column)`` the ``sum`` or ``max`` of the column over the rows
    up to this one (without it, unless ``current``); null before any value.

    As in ``running_count``, ``chunk`` bounds a window partition, and the
    totals per (key, chunk), a small table, give what stands before a chunk."""
    kinds = {"sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)), "max": (F.max, lambda a, b: F.greatest(a, b))}
    d = df.withColumn("_chunk", chunk).withColumns({f"_v_{n}": c for n, (_, c) in values.items()})
    totals = d.groupBy(key, "_chunk").agg(*[kinds[k][0](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in values.items()])
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(key, "_chunk", *[kinds[k][0](f"_t_{n}").over(earlier).alias(f"_b_{n}") for n, (k, _) in values.items()])
    frame = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if current else -1)
    out = d.join(before, [key, "_chunk"]).select(
        *df.columns, *[kinds[k][1](F.col(f"_b_{n}"), kinds[k][0](f"_v_{n}").over(frame)).alias(n) for n, (k, _) in values.items()])
    return out


def number_rows(df: DataFrame, key: str, order: str, chunk: Column,
                out: str = "bar_no", total: str | None = None) -> DataFrame:
    """Add ``out`` = position (1-based) of each row within ``key`` by ``order``
    (see ``running_count``; every row counts)."""
    return running_count(df, key, order, chunk, F.lit(True), out, total)


def halo_blocks(df: DataFrame, index: str, block_size: int, before: int, after: int = 0) -> DataFrame:
    """Assign ``block`` = (index - 1) div block_size and add halo copies.

    Output column ``halo``: 0 for the row's own block, -1 for a copy serving
    as look-back of the next block, +1 for a copy serving as look-ahead of the
    previous block.  Requires before, after < block_size.
    """
    if before >= block_size or after >= block_size:
        raise ValueError("halo must be shorter than a block")
    pos = F.col(index) - 1
    blk = F.floor(pos / block_size).cast("long")
    off = pos - blk * block_size
    own = F.struct(blk.alias("block"), F.lit(0).alias("halo"))
    copies = [own]
    if before > 0:
        copies.append(F.when(off >= block_size - before,
                             F.struct((blk + 1).alias("block"), F.lit(-1).alias("halo"))))
    if after > 0:
        copies.append(F.when((off < after) & (blk > 0),
                             F.struct((blk - 1).alias("block"), F.lit(1).alias("halo"))))
    placed = F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())).alias("_placed")
    return df.select("*", placed).select("*", "_placed.block", "_placed.halo").drop("_placed")
