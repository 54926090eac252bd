import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marketframe.llm import mixing, sharding
from llm_rows import doc_rows


def test_every_row_has_a_place(odd_docs):
    out = sharding.shard(odd_docs, shards=3, slots=16).collect()
    assert len(out) == len(doc_rows())
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = sorted((i is not None, i, len((t or "").encode()) + 8, -1 if t is None else zlib.crc32(t.encode()))
                  for i, t, *_ in doc_rows())
    got = sorted((r.doc_id is not None, r.doc_id, r.size, -1 if r.text_crc32 is None else r.text_crc32) for r in out)
    assert got == want


def test_empty_table_has_no_places(no_docs):
    assert sharding.shard(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0


def test_shards_are_near_equal(spark, sf_dir):
    out = sharding.shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=8)
    sizes = [r.b for r in out.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8


def test_rebalance_moves_little():
    size = [100 + i % 7 for i in range(240)]
    start = sharding.rebalance([i % 4 for i in range(240)], size, 4)
    grown = sharding.rebalance(start, size, 5)
    load = [sum(s for s, g in zip(size, grown, strict=True) if g == k) for k in range(5)]
    assert max(load) - min(load) <= 7
    assert sum(a != b for a, b in zip(start, grown, strict=True)) <= 240 // 2  # rehashing would move four in five


def test_map_versions_are_kept(spark, odd_docs, tmp_path):
    sharding.shard(odd_docs, shards=3, slots=16, map_root=str(tmp_path / "map"))
    versions = spark.read.parquet(str(tmp_path / "map")).groupBy("version").count().collect()
    assert sorted((r.version, r["count"]) for r in versions) == [(0, 16), (1, 16)]


def test_the_newest_map_is_edited_for_new_data(spark, tmp_path):
    root, rows = str(tmp_path / "map"), [(i, "x" * (i % 50)) for i in range(3000)]
    assert sharding.newest_version(spark, root) is None
    place = lambda n, shards: {r.doc_id: r.shard for r in sharding.shard(
        spark.createDataFrame(rows[:n], "doc_id long, text string"), shards, 256, root).collect()}
    first = place(2000, 6)
    again = place(2000, 6)
    assert again == first  # nothing to mend, so nothing moves
    grown = place(3000, 6)
    assert sharding.newest_version(spark, root) == 3
    assert sum(grown[i] != first[i] for i in first) < 0.2 * len(first)
    wider = place(3000, 7)
    assert set(wider.values()) == set(range(7))
    assert sum(wider[i] != grown[i] for i in grown) < 0.35 * len(grown)  # rehashing would move six in seven
    fewer = place(3000, 5)
    assert set(fewer.values()) == set(range(5))
    (tmp_path / "map" / "version=9").mkdir()  # a writer that was stopped
    assert sharding.newest_version(spark, root) == 5
    with pytest.raises(ValueError):
        sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 6, 128, root)


def test_whole_copies_get_no_more(spark):
    """A source that meets its target with whole copies has nobody to draw."""
    one = spark.createDataFrame([(i, "a b c " * 20 if i % 4 else "", "s") for i in range(10)], "doc_id long, text string, source string")
    assert {r.copies for r in mixing.mix(one).where("size > 0").collect()} == {1}
    rows = [(i, "a b c", "a") for i in range(4)] + [(10 + i, "w " * 50, "b") for i in range(40)]
    two = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.copies for r in two if r.source == "a"} == {3} and max(r.copies for r in two) == 3


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while True:
        rest = total - sum(target.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40}, {"a": 1, "b": 1, "c": 900, "d": 2, "e": 3},
                                   {"x": 0, "y": 7}, {"z": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_mix_meets_targets_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    one = mixing.mix(docs).toPandas().sort_values("doc_id", ignore_index=True)
    two = mixing.mix(docs.repartition(5)).toPandas().sort_values("doc_id", ignore_index=True)
    assert one.equals(two)
    assert (one.taken <= 3 * one["size"]).all()
    for _, g in one.groupby("source"):
        assert g.taken.sum() == pytest.approx(g.target.iloc[0], rel=0.02)
        assert g.source_size.iloc[0] == g["size"].sum()


def test_mix_odd_rows(odd_docs):
    out = mixing.mix(odd_docs).collect()
    assert len(out) == len(doc_rows())
    assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in out)


def test_inclusion_follows_probability(spark):
    """Longer classes have more expected copies; draws come near them."""
    rows = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.repeat(F.lit("w "), 4)).otherwise(
            F.repeat(F.lit("w "), 64)).alias("text"), F.lit("a").alias("source"))
    other = spark.range(20000, 40000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 30).alias("text"),
                                             F.lit("b").alias("source"))
    out = mixing.mix(rows.union(other)).where("source = 'b' or source = 'a'").groupBy("source", "size").agg(
        F.avg("copies").alias("c"), F.first("target").alias("t"), F.first("source_size").alias("n")).collect()
    by = {(r.source, r["size"]): r for r in out}
    short, long = by["a", 4].c, by["a", 64].c
    assert short < long
    assert long / short == pytest.approx((4 + 7) / (4 + 3), rel=0.1)
