"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words.  A document's expected copies grow with
its length class (``4 + bits of its word count``), scaled per source so that
the expected words meet the target and no document has more than
``MAX_COPIES``.  The whole part of the expected copies is certain.  For the
rest, documents are ranked by random odds divided by inclusion odds,
``u/(1-u) / (p/(1-p))``, and taken in that order until the source's words
meet its target; the last one taken is the one that brings them nearest, and
one more document per source is turned over if that brings them nearer still.

Scale: the text is read once.  Sums per (source, class) and per (source, rank
bucket) combine before the shuffle; only the one bucket where a source's sum
crosses its target, about 1/4096 of its rows, is sorted row by row, so a
source with a third of all rows is never sorted in one task.

Edge cases: a null text has size 0; a null source is a source (last in code
point order); documents of size 0 take 0 words; repeated rows draw the same
random number and are each counted; an empty table gives an empty result;
other columns are ignored.  Reruns agree: the draw is a hash of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import stored

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
SEED = "mix-1:"
WORD = r"[^\x20\x09-\x0D]+"


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first 52 bits of md5(seed, id)."""
    h = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """``source, source_size`` -> with ``target``: all words shared by weight,
    at most ``cap`` times a source's words, the excess reshared by weight.

    Sources in ascending ``cap * size / weight`` fill up first, so the capped
    ones are a prefix of that order (one row per source here)."""
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    up = Window.orderBy("per_weight", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    x = (sizes.withColumn("rank", F.row_number().over(by_name) - 1)
         .withColumn("w", w).withColumn("ceiling", F.col("source_size") * cap)
         .withColumn("per_weight", F.col("ceiling") / F.col("w"))
         .withColumn("total", F.sum("source_size").over(whole))
         .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(up), F.lit(0.0)))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("ceiling").over(up), F.lit(0)))
         .withColumn("capped", F.col("left") / F.col("w_left") >= F.col("per_weight")))
    free = ~F.col("capped")
    share = (F.first(F.when(free, F.col("left") / F.col("w_left")), ignorenulls=True)
             .over(Window.partitionBy(F.lit(1)).orderBy("per_weight", "rank")
                   .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return x.select("source", "source_size", F.when(F.col("capped"), F.col("ceiling").cast("double"))
                    .otherwise(share * F.col("w")).alias("target"))


def rates(strata: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """``source, class, words, target`` -> with certain copies ``whole``, the
    inclusion probability ``p`` of one more, and the words ``open`` that the
    sampling has to find in the source.  One row per source and class."""
    g = (F.col("class") + 4).cast("double")
    longer = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("source")
    x = (strata.withColumn("left", F.col("target") - cap * F.coalesce(F.sum("words").over(longer), F.lit(0)))
         .withColumn("mass", F.sum(g * F.col("words")).over(rest))
         .withColumn("capped", F.coalesce(F.try_divide("left", "mass") * g >= cap, F.lit(True))))
    scale = (F.first(F.when(~F.col("capped"), F.try_divide("left", "mass")), ignorenulls=True)
             .over(Window.partitionBy("source").orderBy(F.desc("class"))
                   .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    x = x.withColumn("m", F.when(F.col("capped"), F.lit(float(cap))).otherwise(F.greatest(scale * g, F.lit(0.0))))
    x = x.withColumn("whole", F.floor("m")).withColumn("p", F.col("m") - F.floor("m"))
    return x.withColumn("open", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(whole)).select(
        "source", "class", "whole", "p", "open")


def pareto_rank(u: Column, p: Column) -> Column:
    """The order variable on (0, 1): q / (1 + q) for q = odds(u) / odds(p)."""
    q = (u / (1 - u)) / (p / (1 - p))
    return q / (1 + q)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: int = MAX_COPIES, buckets: int = BUCKETS,
        extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken (and the
    columns named in ``extra``) of every document; copies may be 0."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), *extra)
    rows = rows.withColumn("class", F.length(F.bin("size"))).withColumn("u", uniform(F.col("doc_id")))
    rows = stored(rows, "mix-rows")
    strata = stored(rows.groupBy("source", "class").agg(F.sum("size").alias("words")), "mix-strata")
    sizes = strata.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = stored(targets(sizes, weights, cap), "mix-targets")
    per = rates(_with(strata, goal, "source"), cap)
    per = stored(_with(per, goal, "source"), "mix-rates")

    x = _with(rows, per, "source", "class")
    in_draw = (F.col("p") > 0) & (F.col("open") > 0) & (F.col("size") > 0)
    z = F.when(in_draw, pareto_rank(F.col("u"), F.col("p")))
    x = x.withColumn("z", z).withColumn(
        "bucket", F.when(F.col("z").isNotNull(), F.least(F.floor(F.col("z") * buckets), F.lit(buckets - 1))))
    sums = x.where("bucket is not null").groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.first("open").alias("open"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
            .where("before < open and before + words >= open")
            .select("source", F.col("bucket").alias("edge"), "before"))
    edge = stored(edge, "mix-edges")
    x = _with(x, edge, "source", how="left")
    at_edge = F.col("bucket") == F.col("edge")
    # Without an edge the whole draw stays below the target.
    inner = x.where(F.coalesce(~at_edge, F.lit(True))).withColumn(
        "more", F.coalesce(F.col("bucket") < F.coalesce(F.col("edge"), F.lit(buckets)), F.lit(False)))
    order = Window.partitionBy("source").orderBy("z", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    border = x.where(at_edge).withColumn("more", passed + F.col("size") / 2 <= F.col("open"))
    both = stored(inner.unionByName(border), "mix-drawn")
    both = _with(both, _last_flip(both), "source", how="left")
    flip = F.coalesce(F.col("z").eqNullSafe(F.col("flip.z")) & F.col("doc_id").eqNullSafe(F.col("flip.doc_id"))
                      & F.col("flip.off").isNotNull(), F.lit(False))
    copies = F.col("whole") + (F.col("more") != flip).cast("long")
    return both.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                       (F.col("size") * copies).alias("taken"), *extra)


def _last_flip(drawn: DataFrame) -> DataFrame:
    """Per source the one document whose draw, turned over, brings the words
    nearest to the target, if that is nearer than they are.  Long documents at
    the border of a small source would otherwise leave a visible gap."""
    off = (drawn.groupBy("source").agg(F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).alias("got"),
                                       F.first("open", ignorenulls=True).alias("goal"))
           .select("source", (F.col("got") - F.col("goal")).alias("off_by")))
    x = _with(drawn.where("z is not null").select("source", "doc_id", "size", "z", "more"), off, "source")
    after = F.abs(F.col("off_by") + F.when(F.col("more"), -F.col("size")).otherwise(F.col("size")))
    return (x.withColumn("off", after).where(F.col("off") < F.abs("off_by"))
            .groupBy("source").agg(F.min(F.struct("off", "z", "doc_id")).alias("flip")))


def _with(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on keys that may be null; Spark broadcasts the small side only
    when its measured size allows."""
    r = right.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns])
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = c if on is None else on & c
    return left.join(r, on, how).drop(*[f"_{k}" for k in keys])
