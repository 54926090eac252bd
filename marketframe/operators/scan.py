"""Recursive exponential means as a parallel scan of native columns.

Spark has no recursive window function.  The recurrence
    y_t = r * y_{t-1} + u_t        (r = 1 - alpha)
is linear, so over a chunk of consecutive bars
    y = r^k * c + loc,   loc = r^k * sum_i u_i * r^(-k_i)
where k counts the chunk's bars so far and c is y at the end of the previous
chunk.  ``loc`` is a running sum per chunk; the carries c come from a fold of
chunk summaries and are joined back.  A chunk holds at most ``chunk`` bars, so
r^(-k) stays finite; all inputs are non-negative, so the sums do not cancel.

A recurrence may skip bars (``valid`` false, e.g. a missing close): such a bar
neither decays nor adds, and shows the value before it.  Rate 1 is a running
sum, which also counts the valid bars.

The fold composes: a run of bars acts on the state before it as
``y -> r^n y + l``.  Chunks are composed inside their block, blocks inside
super-blocks of ``SUPER`` blocks, super-blocks per key, so that no list grows
with the bars of a block or super-block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.session import materialize

SUPER = 256


@dataclass(frozen=True)
class Recurrence:
    name: str                    # output column
    rate: float                  # r = 1 - alpha
    u: Column                    # input term at each bar
    valid: Column | None = None  # bars that count; None: all


def chunk_of(index: str, block: str, chunk: int, block_size: int) -> Column:
    """Index of the scan chunk inside its block."""
    pos = F.col(index) - 1
    return (F.floor(pos / chunk) - F.col(block) * (block_size // chunk)).cast("int")


def linear_scan(df: DataFrame, specs: list[Recurrence], key: str, block: str, index: str,
                chunk: int, block_size: int, sub_col: str | None = None) -> DataFrame:
    """Evaluate each recurrence in ``specs``; adds one column per spec.

    ``df`` must hold each (key, block) group whole (rows of other blocks,
    e.g. halo copies, removed) with ``index`` the 1-based position in the
    key's series; ``block_size`` must be a multiple of ``chunk``.  The per-row
    running sums are written once, before the plan forks into the carry fold
    and the final per-row pass.  Pass ``sub_col`` when ``df`` already carries
    ``chunk_of(...)`` (and is sorted by it), so that the scan reuses the
    existing sort.
    """
    if block_size % chunk:
        raise ValueError("block_size must be a multiple of the scan chunk")
    for s in specs:
        # r^-chunk must stay well inside the double range (~1e308).
        if not 0.0 < s.rate <= 1.0 or -math.log(s.rate) * chunk > 600:
            raise ValueError(f"scan chunk {chunk} too long for rate {s.rate}")
    if sub_col is None:
        d = df.withColumn("_sub", chunk_of(index, block, chunk, block_size))
    else:
        d = df.withColumnRenamed(sub_col, "_sub")
    running = (Window.partitionBy(key, block, "_sub").orderBy(index)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = F.lit(True)
    d = d.select("*", *[F.count_if(s.valid if s.valid is not None else every).over(running).alias(f"_k_{s.name}")
                        for s in specs])
    d = d.select("*", *[_local(s, running).alias(f"_loc_{s.name}") for s in specs])
    d = materialize(d)

    last = F.max_by(F.struct(*[F.struct(F.col(f"_k_{s.name}").alias("n"), F.col(f"_loc_{s.name}").alias("l")).alias(s.name)
                               for s in specs]), F.col(index))
    summary = d.groupBy(key, block, "_sub").agg(last.alias("x"))
    # A few rows per block; written so that its size is known when the join is planned.
    carries = materialize(_carries(summary, specs, key, block))
    out = d.join(carries, [key, block, "_sub"]).select("*", *[
        (F.col(f"_loc_{s.name}") + F.pow(F.lit(s.rate), F.col(f"_k_{s.name}")) * F.col(f"_c.{s.name}")).alias(s.name)
        for s in specs
    ])
    return out.drop("_c", "_sub", *[f"{p}{s.name}" for s in specs for p in ("_k_", "_loc_")])


def _local(s: Recurrence, running) -> Column:
    k = F.col(f"_k_{s.name}")
    u = s.u if s.valid is None else F.when(s.valid, s.u)
    if s.rate == 1.0:
        return F.coalesce(F.sum(u).over(running), F.lit(0.0))
    total = F.sum(u * F.pow(F.lit(s.rate), -k)).over(running)
    return F.coalesce(F.pow(F.lit(s.rate), k) * total, F.lit(0.0))


def _carries(summary: DataFrame, specs: list[Recurrence], key: str, block: str) -> DataFrame:
    """(key, block, _sub, _c): the state that enters each chunk."""
    chunks, blocks = _compose(summary, specs, [key, block], "_sub")
    blocks = blocks.withColumn("_super", F.floor(F.col(block) / SUPER))
    within, supers = _compose(blocks, specs, [key, "_super"], block)
    over, _ = _compose(supers, specs, [key], "_super")
    state = within.withColumnRenamed("before", "b").join(over.withColumnRenamed("before", "s"), [key, "_super"])
    state = chunks.join(state, [key, block])

    def enter(s: Recurrence) -> str:
        def step(name: str, c: str) -> str:
            return f"({name}.{s.name}.l + pow({s.rate!r}D, {name}.{s.name}.n) * {c})"
        return f"'{s.name}', " + step("before", step("b", f"s.{s.name}.l"))

    return state.selectExpr(key, block, "_sub", f"named_struct({', '.join(map(enter, specs))}) AS _c")


def _compose(runs: DataFrame, specs: list[Recurrence], group: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """Compose the runs ``x`` of each group in order: what stands before each
    run (columns of ``group``, ``order``, ``before``), and each group's whole (``x``)."""
    kind = "struct<" + ", ".join(f"`{s.name}`: struct<n: bigint, l: double>" for s in specs) + ">"
    at = dict(runs.dtypes)[order]
    # SQL text: one parse instead of a call to the JVM per operator.
    zero = ", ".join(f"'{s.name}', named_struct('n', 0L, 'l', 0.0D)" for s in specs)
    then = ", ".join(f"'{s.name}', named_struct('n', acc.x.{s.name}.n + run.x.{s.name}.n, 'l', "
                     f"pow({s.rate!r}D, run.x.{s.name}.n) * acc.x.{s.name}.l + run.x.{s.name}.l)" for s in specs)
    fold = (f"aggregate(runs, named_struct('x', named_struct({zero}), 'out', "
            f"cast(array() as array<struct<at: {at}, before: {kind}>>)), (acc, run) -> named_struct("
            f"'x', named_struct({then}), 'out', concat(acc.out, array(named_struct('at', run.at, 'before', acc.x))))) AS f")

    listed = runs.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), "x"))).alias("runs"))
    folded = listed.selectExpr(*group, fold)
    before = folded.select(*group, F.explode("f.out").alias("e")).select(
        *group, F.col("e.at").alias(order), F.col("e.before").alias("before"))
    return before, folded.select(*group, F.col("f.x").alias("x"))
