"""Sharding over fixed virtual slots.

Every record hashes into one of ``SLOTS`` virtual slots, once and for all.  A
small versioned table maps slots to shards; shards are balanced by editing
that table, never by rehashing records.  Bytes per slot are aggregated with a
map-side combine, so the driver sees at most ``SLOTS`` rows at any input size.

Edge cases: a null text has size 8 and a null crc; a record with a null id is
hashed by its size and crc; repeated rows each get a place of their own; an
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.common import scratch_path, stored

SLOTS = 8192
SHARDS = 24
ROW_OVERHEAD = 8


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of each record."""
    text = F.col("text").cast("binary")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long")
    out = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"))
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(
        F.xxhash64("size", "text_crc32"))
    return out.withColumn("vslot", F.pmod(key, F.lit(slots)).cast("int"))


def slot_totals(recs: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each virtual slot; at most ``slots`` rows reach the driver."""
    size, rows = [0] * slots, [0] * slots
    for r in recs.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r.vslot], rows[r.vslot] = r.b, r.n
    return size, rows


def rebalance(shard_of: list[int], size: list[int], shards: int) -> list[int]:
    """Edit a slot-to-shard map so that the shards' bytes come near each other.

    Shards above the mean give up their smallest slots until they are at most
    at the mean; the slots given up go, largest first, to the lightest shard.
    Then the heaviest shard moves or swaps a slot with the lightest while that
    narrows their gap.  Slots that need not move stay."""
    new = list(shard_of)
    load, own = [0] * shards, [[] for _ in range(shards)]
    pool = []
    for slot, s in enumerate(new):
        if s < shards:
            load[s] += size[slot]
            own[s].append(slot)
        else:
            pool.append(slot)
    mean = sum(size) / shards
    for s in range(shards):
        for slot in sorted((x for x in own[s] if size[x]), key=lambda x: (size[x], x)):
            if load[s] <= mean:
                break
            load[s] -= size[slot]
            pool.append(slot)
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(pool, key=lambda x: (-size[x], x)):
        b, s = heapq.heappop(heap)
        new[slot] = s
        load[s] = b + size[slot]
        heapq.heappush(heap, (load[s], s))
    return _narrow(new, size, load)


def _narrow(shard_of: list[int], size: list[int], load: list[int], rounds: int = 400) -> list[int]:
    own: list[set[int]] = [set() for _ in load]
    for slot, s in enumerate(shard_of):
        if size[slot]:
            own[s].add(slot)
    for _ in range(rounds):
        hi = max(range(len(load)), key=load.__getitem__)
        lo = min(range(len(load)), key=load.__getitem__)
        gap = load[hi] - load[lo]
        if 1000 * gap * len(load) <= sum(load):  # near enough: each move costs a slot's data
            break
        best = min(((abs(gap - 2 * size[x]), x, -1) for x in own[hi]), default=(gap, -1, -1))
        light = sorted(own[lo], key=lambda x: (size[x], x))
        j = 0
        for x in sorted(own[hi], key=lambda x: (size[x], x)):  # pairs whose difference is nearest gap / 2
            while j < len(light) and 2 * (size[x] - size[light[j]]) > gap:
                j += 1
            for y in light[max(0, j - 1):j + 1]:
                best = min(best, (abs(gap - 2 * (size[x] - size[y])), x, y))
        if best[0] >= gap:
            break
        _, x, y = best
        shard_of[x] = lo
        own[hi].discard(x)
        own[lo].add(x)
        if y >= 0:
            shard_of[y] = hi
            own[lo].discard(y)
            own[hi].add(y)
        moved = size[x] - (size[y] if y >= 0 else 0)
        load[hi] -= moved
        load[lo] += moved
    return shard_of


def store_map(spark: SparkSession, root: str, version: int, shard_of: list[int],
              first_place: list[int]) -> str:
    """Write one version of the slot map; versions are never overwritten."""
    rows = [(i, s, p) for i, (s, p) in enumerate(zip(shard_of, first_place, strict=True))]
    path = f"{root}/version={version}"
    spark.createDataFrame(rows, "vslot int, shard int, first_place long").coalesce(1).write.parquet(path)
    return path


def newest_version(spark: SparkSession, root: str) -> int | None:
    """The newest version whose writer finished; None in a folder without one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    done = hadoop.Path(f"{root}/version=*/_SUCCESS")
    files = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
    found = [int(f.getPath().getParent().getName().split("=")[1]) for f in files or []]
    return max(found, default=None)


def load_map(spark: SparkSession, root: str, version: int) -> list[int]:
    """The shard of each virtual slot in one version."""
    rows = spark.read.schema("vslot int, shard int").parquet(f"{root}/version={version}").collect()
    return [r.shard for r in sorted(rows)]


def first_places(shard_of: list[int], rows: list[int], shards: int) -> list[int]:
    """Rows of the same shard that stand in earlier virtual slots."""
    seen, out = [0] * shards, []
    for s, n in zip(shard_of, rows, strict=True):
        out.append(seen[s])
        seen[s] += n
    return out


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_root: str | None = None) -> DataFrame:
    """Place each record: shard and gapless place ``slot`` within the shard.

    The newest version of the map under ``map_root`` is edited for these
    documents' bytes and the edit written as the next version; a folder without
    a map gets version 0, which deals slots in turn, first.  ``shards`` may
    differ from the old map's; slots of shards that no longer exist are dealt
    anew, a new shard takes over slots.  The result reads the version it wrote
    (``slots`` rows, hence a broadcast)."""
    spark = docs.sparkSession
    recs = stored(records(docs, slots), "shard-records")
    size, rows = slot_totals(recs, slots)
    root = map_root or scratch_path(spark, "slot-map")
    newest = newest_version(spark, root)
    if newest is None:
        start, newest = [i % shards for i in range(slots)], 0
        store_map(spark, root, 0, start, first_places(start, rows, shards))
    else:
        start = load_map(spark, root, newest)
        if len(start) != slots:
            raise ValueError(f"the map has {len(start)} slots, not {slots}: records can't be hashed anew")
    edited = rebalance(start, size, shards)
    path = store_map(spark, root, newest + 1, edited, first_places(edited, rows, shards))
    slot_map = F.broadcast(spark.read.schema("vslot int, shard int, first_place long").parquet(path))
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")) - 1
    return (recs.withColumn("place", place).join(slot_map, "vslot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first_place") + F.col("place")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "vslot"))
