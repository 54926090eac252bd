"""Composed finite-state maps against a plain walk over all blocks."""

import random

from pyspark.sql import functions as F

from marketframe.operators.finite import entry_states


def walk(rows, size, absorbing):
    """rows: {block: map} -> {block: entry state}."""
    out, state, last = {}, 0, None
    for b in sorted(rows):
        if last is not None and b > last + 1 and not (absorbing and state == size - 1):
            state = 0
        out[b] = state
        state, last = rows[b][state], b
    return out


def test_entry_states_equal_a_walk(spark):
    rng = random.Random(3)
    for absorbing in (False, True):
        size, data, want = 5, [], {}
        for key in "abc":
            blocks = sorted(rng.sample(range(400), 150))
            rows = {b: [rng.randrange(size - 1) for _ in range(size)] for b in blocks}
            if absorbing:
                for m in rows.values():
                    m[-1] = size - 1
                rows[blocks[-20]] = [size - 1] * size
            data += [(key, b, m) for b, m in rows.items()]
            want.update({(key, b): s for b, s in walk(rows, size, absorbing).items()})
        maps = spark.createDataFrame(data, "symbol string, block long, map array<int>")
        got = entry_states(maps, "symbol", "block", size, absorbing, group=16)
        assert {(r.symbol, r.block): r.state for r in got.collect()} == want


def test_no_list_per_key(spark):
    maps = spark.range(2000).select(F.lit("a").alias("symbol"), F.col("id").alias("block"), F.array(F.lit(0)).alias("map"))
    plan = entry_states(maps, "symbol", "block", 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "_super" in plan


def test_empty(spark):
    maps = spark.createDataFrame([], "symbol string, block long, map array<int>")
    assert entry_states(maps, "symbol", "block", 3).count() == 0
