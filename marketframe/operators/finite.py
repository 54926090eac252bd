"""Finite-state scans: which state enters each block of a long series.

A rule that walks over a series with a small set of states 0..size-1 (say, how
many more bars a trade stays open) can't start in the middle, but a block of
the series can be summed up without knowing its entry state: as the map from
every entry state to the exit state it leads to.  Maps compose, so the entry
states follow from a fold over maps: blocks inside super-blocks of ``SUPER``
blocks, super-blocks per key.  Each block is then walked alone from its entry
state.  No list grows with a block's or super-block's part of the series.

Blocks in which nothing happens may be missing.  Over a gap every state falls
back to 0, except the last one if it is ``absorbing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUPER = 256


def entry_states(maps: DataFrame, key: str, block: str, size: int, absorbing: bool = False,
                 group: int = SUPER) -> DataFrame:
    """(key, block, state): the state that enters each block, 0 at the start.

    ``maps`` has one row per (key, block) with ``map``, an array of ``size``
    ints: the exit state for each entry state."""
    runs = maps.select(key, F.col(block).cast("long").alias("first"), F.col(block).cast("long").alias("last"), "map")
    runs = runs.withColumn("_super", F.floor(F.col("first") / group))
    within, supers = _compose(runs, [key, "_super"], size, absorbing)
    over, _ = _compose(supers.select(key, "first", "last", "map"), [key], size, absorbing)
    # The start is state 0; a super-block's entry state picks from the maps before its blocks.
    entered = over.select(key, F.floor(F.col("first") / group).alias("_super"), F.get("before", 0).alias("_enter"))
    return within.join(entered, [key, "_super"]).select(
        key, F.col("first").alias(block), F.get("before", F.col("_enter")).alias("state"))


def _compose(runs: DataFrame, by: list[str], size: int, absorbing: bool) -> tuple[DataFrame, DataFrame]:
    """Compose the runs (first, last, map) of each group in order: the map
    from the group's entry to each run (``before``), and each group as a run."""
    rest = f"IF(i = {size - 1}, i, 0)" if absorbing else "0"
    enter = f"IF(run.first > acc.last + 1, {rest}, i)"
    start = f"transform(sequence(0, {size - 1}), i -> i)"
    fold = (f"aggregate(runs, named_struct('map', {start}, 'last', CAST(NULL AS bigint), "
            "'out', CAST(array() AS array<struct<first: bigint, before: array<int>>>)), (acc, run) -> named_struct("
            f"'map', transform(acc.map, i -> run.map[{enter}]), 'last', run.last, "
            f"'out', concat(acc.out, array(named_struct('first', run.first, 'before', transform(acc.map, i -> {enter})))))) AS f")
    listed = runs.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first", "last", "map"))).alias("runs"))
    folded = listed.selectExpr(*by, "runs[0].first AS first", fold)
    before = folded.select(*by, F.explode("f.out").alias("e")).select(*by, "e.first", "e.before")
    return before, folded.select(*by, "first", F.col("f.last").alias("last"), F.col("f.map").alias("map"))
