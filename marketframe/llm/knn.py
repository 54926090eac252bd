"""Exact top-k by inner product with a Voronoi kNN join.

Pivots are unit vectors, spread over a bounded sample by a few rounds of
spherical k-means; every vector lies in the cell of the pivot at the smallest
angle.  First each query meets the rows of its own cell.  That gives every
query cell a bound: the least of its queries' k-th best scores, each over the
query's norm.  With ``r``, the largest angle of a query in the cell to its
pivot, no data row can have more than ``|s| cos(max(0, a(s, pivot) - r))`` of
that.  A row goes to a group of query cells only if this reaches the bound of
one of them; the groups are solved locally and the lists merged with those of
the first pass.

Vectors in clusters travel to few groups.  Vectors without clusters (unit
vectors in all directions of many dimensions) can't be ruled out by any
angle to a pivot; then the join is one of blocks of queries and rows.

Scale: pivots and summaries are bounded by ``MOST_PIVOTS``, their sample by
``SAMPLE_BYTES``.  Cells and groups are cut by hash into blocks of about
``BLOCK_BYTES`` on either side, as many as a cell has rows and as travel to a
group, so a cell that holds a third of all rows is many tasks.

Edge cases: vectors that are null or hold a null or non-finite component, and
rows without an id, take no part; shorter vectors count as padded with zeros;
a query id that is repeated is asked once (its first vector in array order);
rows that share the query's id are its own and no candidates; ties go to the
smaller id; zero vectors score 0 with all; an empty table gives an empty result;
other columns are ignored.  Scores are exact while sums of products stay below
2^53.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from marketframe.llm.common import stored

LEAST_PIVOTS, MOST_PIVOTS = 64, 1024
#: Sampled rows for each pivot, and the bytes that the sample may have.
PER_PIVOT = 16
SAMPLE_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20
GROUP_QUERIES = 1_000
#: Slack for rounding, of angles (radians) and of their cosines.
SLACK = 1e-6
PAIRS = "query_id long, vec_id long, score long"


def vectors(table: DataFrame, scale: float = 256.0, vec: str = "embedding") -> DataFrame:
    """vec_id and the integer vector of every row that takes part."""
    x = F.col(vec)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return (table.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(F.forall(x, finite))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v")))


def _matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def _angles(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Angles to the pivots; a zero vector is at a right angle to all."""
    return np.arccos(np.clip(_unit(v) @ pivots.T, -1, 1))


def spread_pivots(sample: np.ndarray, count: int, least: int, rounds: int = 5) -> np.ndarray:
    """Unit pivots by spherical k-means.  One with fewer than ``least`` sampled
    rows goes: its cell would have no k-th best score to offer."""
    u = _unit(sample[(sample != 0).any(1)])
    if not len(u):
        return np.eye(1, sample.shape[1])
    pivots = np.unique(u[:count], axis=0)
    for _ in range(rounds):
        cell = (u @ pivots.T).argmax(1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, u)
        has = np.bincount(cell, minlength=len(pivots)) > 0
        pivots = np.where((has & (sums != 0).any(1))[:, None], _unit(sums), pivots)
    held = np.bincount((u @ pivots.T).argmax(1), minlength=len(pivots))
    return pivots[held >= min(least, held.max())]


def _to_cells(pivots: np.ndarray, dim: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _matrix(b["v"], dim)
            angle = _angles(v, pivots)
            cell = angle.argmin(1)
            yield b.assign(cell=cell.astype("int32"), angle=angle[np.arange(len(b)), cell], norm=np.sqrt((v * v).sum(1)))
    return run


def deal_groups(pivots: np.ndarray, counts: dict[int, int], groups: int) -> dict[int, int]:
    """The group of each query cell: dealt along a walk to the nearest next
    pivot, so that a group's cells lie close together and hold like counts."""
    near = pivots @ pivots.T
    group_of, at, left, filled, group = {}, min(counts), set(counts), 0, 0
    share = sum(counts.values()) / groups
    while left:
        left.discard(at)
        group_of[at] = group
        filled += counts[at]
        if filled >= share * (group + 1) and group < groups - 1:
            group += 1
        if left:
            at = min(left, key=lambda c: (-near[at, c], c))
    return group_of


class Reach:
    """Which rows can still reach the bound of a query cell of a group."""

    def __init__(self, pivots: np.ndarray, summaries: list, group_of: dict[int, int], groups: int):
        """``summaries``: (cell, largest angle, bound)."""
        self.cell, self.angle, self.bound = (np.array(c) for c in zip(*summaries, strict=True))
        self.pivots = pivots[self.cell]
        self.member = np.zeros((len(self.cell), groups), "float32")
        self.member[np.arange(len(self.cell)), [group_of[c] for c in self.cell.tolist()]] = 1

    def __call__(self, v: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """rows x groups; a row's own cell has been solved already."""
        cos = np.cos(np.maximum(0, _angles(v, self.pivots) - self.angle - SLACK))
        norm = np.sqrt((v * v).sum(1))[:, None]
        may = norm * (cos + SLACK) >= self.bound
        may &= cell[:, None] != self.cell[None, :]
        return may.astype("float32") @ self.member > 0


def _blocked(rows: DataFrame, key: str, own: str, own_parts: dict[int, int], other: str, other_parts: dict[int, int]) -> DataFrame:
    """Rows with their block ``own`` by hash and one copy for each block
    ``other`` that their cell or group (``key``) has on the other side."""
    parts = [(int(c), int(own_parts[c]), int(other_parts[c])) for c in own_parts if c in other_parts]
    sizes = rows.sparkSession.createDataFrame(parts, f"{key} int, _own int, _other int")
    return (rows.join(F.broadcast(sizes), key)  # at most one row per pivot
            .withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), "_own").cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_other") - 1))).drop("_own", "_other"))


def _solved(asked: DataFrame, data: DataFrame, key: str, ask_parts: dict, data_parts: dict, dim: int, k: int,
            same_cell: bool) -> DataFrame:
    def solve(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        return best_pairs(q["vec_id"].to_numpy(), _matrix(q["v"], dim), s["vec_id"].to_numpy(), _matrix(s["v"], dim), k,
                          None if same_cell else (q["cell"].to_numpy(), s["cell"].to_numpy()))

    on = [key, "block", "chunk"]
    a = _blocked(asked, key, "block", ask_parts, "chunk", data_parts)
    d = _blocked(data, key, "chunk", data_parts, "block", ask_parts)
    return a.groupBy(*on).cogroup(d.groupBy(*on)).applyInPandas(solve, PAIRS)


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int | None = None,
          chunk: int | None = None, group_queries: int = GROUP_QUERIES, report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every query row.

    ``report``, if given, gets the number of ``rows``, of ``groups`` and of
    (row, group) pairs ``travelling`` in the second pass."""
    spark = table.sparkSession
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pts = stored(vectors(table, scale), "knn-points")
    stats = pts.agg(F.max(F.size("v")).alias("dim"), F.count("*").alias("n")).first()
    if not stats.n:
        return nothing
    dim = max(stats.dim, 1)
    count = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(stats.n)))
    size = max(1, min(PER_PIVOT * count, SAMPLE_BYTES // (8 * dim)))
    picked = pts.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(size).collect()
    piv = spread_pivots(_matrix([r.v for r in picked], dim), max(1, min(count, size // 2)), k + 1)

    shape = "vec_id long, v array<double>, cell int, angle double, norm double"
    data = stored(pts.mapInPandas(_to_cells(piv, dim), shape), "knn-data").select("vec_id", "v", "cell")
    asked = pts.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(asked.mapInPandas(_to_cells(piv, dim), shape), "knn-queries")
    cells = {r.cell: r for r in asked.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("angle").alias("angle")).collect()}
    if not cells:
        return nothing
    rows_of = {r.cell: r.n for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    # First pass: every query against its own cell.
    block = chunk or max(1000, BLOCK_BYTES // (8 * dim))
    parts = lambda sizes: {c: -(-n // block) for c, n in sizes.items()}
    ask_parts = parts({c: r.n for c, r in cells.items()})
    home = _solved(asked, data, "cell", ask_parts, parts(rows_of), dim, k, True)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda p: p.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    home = stored(ranked(home).drop("rank"), "knn-home")
    kth = home.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
    # Too short a list, or a query without a direction: every row can join.
    own = F.coalesce(F.col("kth") / F.when(F.col("norm") > 0, F.col("norm")), F.lit(-math.inf))
    bound = (asked.select(F.col("vec_id").alias("query_id"), "cell", "norm").join(kth, "query_id", "left")
             .groupBy("cell").agg(F.min(own).alias("bound")).collect())
    bounds = {r.cell: r.bound for r in bound}

    # Second pass: the rows of other cells that can still reach a bound.
    n_queries = sum(r.n for r in cells.values())
    groups = min(len(cells), max(1, -(-n_queries // group_queries)))
    group_of = deal_groups(piv, {c: r.n for c, r in cells.items()}, groups)
    reach = Reach(piv, [(c, r.angle, bounds[c]) for c, r in cells.items()], group_of, groups)
    shared = spark.sparkContext.broadcast(reach)  # at most one entry per pivot

    def count_travelling(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(groups, "int64")
        for b in batches:
            total += shared.value(_matrix(b["v"], dim), b["cell"].to_numpy()).sum(0)
        yield pd.DataFrame({"g": np.arange(groups, dtype="int32"), "n": total})

    def travel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            may = shared.value(_matrix(b["v"], dim), b["cell"].to_numpy())
            for g in np.flatnonzero(may.any(0)).tolist():
                yield b[may[:, g]].assign(g=np.int32(g))

    counted = data.mapInPandas(count_travelling, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    going = {r.g: r.n for r in counted if r.n}
    if report is not None:
        report.update(rows=stats.n, groups=groups, travelling=sum(going.values()))
    found = home
    if going:
        homes = spark.createDataFrame(list(group_of.items()), "cell int, g int")
        of_group = asked.join(F.broadcast(homes), "cell").select("vec_id", "v", "cell", "g")
        in_group = {g: 0 for g in range(groups)}
        for c, g in group_of.items():
            in_group[g] += cells[c].n
        far = data.mapInPandas(travel, "vec_id long, v array<double>, cell int, g int")
        found = home.unionByName(_solved(of_group, far, "g", parts(in_group), parts(going), dim, k, False))
    return ranked(found).select("query_id", "rank", "vec_id", "score")


def best_pairs(q_id, q, s_id, s, k: int, cells: tuple | None = None, rows: int = 256) -> pd.DataFrame:
    """The k best of ``s`` for each row of ``q``, by score, then smaller id;
    with ``cells`` (of q, of s) only pairs from different ones."""
    order = np.argsort(s_id, kind="stable")
    s_id, s = s_id[order], s[order]
    out = []
    for at in range(0, len(q) if len(s) else 0, rows):
        score = np.rint(q[at:at + rows] @ s.T)
        score[q_id[at:at + rows, None] == s_id[None, :]] = -np.inf
        if cells is not None:
            score[cells[0][at:at + rows, None] == cells[1][order][None, :]] = -np.inf
        width = min(k, score.shape[1])
        # Stable choice: all above the k-th score, then its ties by position.
        kth = -np.partition(-score, width - 1, axis=1)[:, width - 1]
        for i, row in enumerate(score):
            above = np.flatnonzero(row > kth[i])
            ties = np.flatnonzero(row == kth[i])[:width - len(above)]
            take = np.concatenate([above, ties])
            take = take[np.isfinite(row[take])]
            out.append(pd.DataFrame({"query_id": q_id[at + i], "vec_id": s_id[take],
                                     "score": row[take].astype("int64")}))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return pd.concat(out, ignore_index=True)
