"""Next smaller element: the first later bar whose value lies under a level.

``next_below`` answers many such questions on long series, however far the
answer lies, without a frame that reaches that far.  The series is cut into
blocks of ``block`` rows with their minima, and those into super-blocks of
``SUPER`` blocks.  A question is first put to its own block; what is left over
goes to the minima of the blocks after it in its super-block, then to the
minima of the later super-blocks, and at last to the rows of the one block
that must hold the answer.  Every step is a join on (key, block) or
(key, super-block) that adds at most one row per question; the lists it looks
through have a bounded length (per key, one entry per block x ``SUPER`` rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.session import materialize

BLOCK = 256
SUPER = 256


def next_below(questions: DataFrame, series: DataFrame, key: str, after: str, level: str, index: str, value: str,
               out: str, block: int = BLOCK, group: int = SUPER) -> DataFrame:
    """Add ``out``: the smallest ``index`` above ``after`` at which ``value``
    is under ``level``; null if there is none, or no level.

    ``index`` numbers the rows of a key from 1; missing values are under
    nothing."""
    rows = series.select(key, F.col(index).alias("_i"), F.col(value).alias("_v"))
    blocks = materialize(rows.groupBy(key, _part(F.col("_i"), block).alias("_b")).agg(
        F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_rows"), F.min("_v").alias("_low")))
    supers = materialize(blocks.groupBy(key, F.floor(F.col("_b") / group).alias("_s")).agg(
        F.array_sort(F.collect_list(F.struct("_b", "_low"))).alias("_blocks"), F.min("_low").alias("_low")))
    tops = supers.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_s", "_low"))).alias("_supers"))

    at, wanted = F.col(after), F.col(level)
    q = questions.withColumn("_b", _part(at, block)).withColumn("_s", F.floor(F.col("_b") / group))
    q = q.join(blocks.select(key, "_b", "_rows"), [key, "_b"], "left").withColumn("_own", _first_row(at, wanted)).drop("_rows")
    # Answers settled so far keep their block as the key of later joins: no null keys meet in one task.
    q = q.join(supers.select(key, "_s", "_blocks"), [key, "_s"], "left").withColumn(
        "_near", F.get(F.filter("_blocks", lambda x: (x["_b"] > F.col("_b")) & (x["_low"] < wanted)), 0)["_b"]).drop("_blocks")
    settled = F.col("_own").isNotNull() | F.col("_near").isNotNull()
    q = q.join(tops, key, "left").withColumn(
        "_far", F.get(F.filter("_supers", lambda x: (x["_s"] > F.col("_s")) & (x["_low"] < wanted)), 0)["_s"]).drop("_supers")
    q = q.withColumn("_s", F.when(settled, F.col("_s")).otherwise(F.coalesce("_far", F.col("_s"))))
    q = q.join(supers.select(key, "_s", "_blocks"), [key, "_s"], "left").withColumn(
        "_there", F.get(F.filter("_blocks", lambda x: x["_low"] < wanted), 0)["_b"]).drop("_blocks")
    found_in = F.when(F.col("_own").isNotNull(), None).otherwise(
        F.coalesce("_near", F.when(F.col("_far").isNotNull(), F.col("_there"))))
    q = q.withColumn("_in", found_in).withColumn("_b", F.coalesce("_in", F.col("_b")))
    q = q.join(blocks.select(key, "_b", "_rows"), [key, "_b"], "left")
    answer = F.coalesce("_own", F.when(F.col("_in").isNotNull(), _first_row(at, wanted)))
    return q.select(*questions.columns, answer.alias(out))


def _part(index: Column, size: int) -> Column:
    return F.floor((index - 1) / size)


def _first_row(after: Column, level: Column) -> Column:
    return F.get(F.filter("_rows", lambda x: (x["_i"] > after) & (x["_v"] < level)), 0)["_i"]
