"""Importance resampling against a plain loop over all documents."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketframe.llm import resampling as R
from marketframe.llm.common import documents

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]) for i in range(len(w)) for k in range(1, longest + 1) if i + k <= len(w)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, percent=10, least=20, buckets=10_000, longest=1, seed="2024"):
    """docs: (doc_id, text) -> sorted (doc_id, n_features, weight, score, rank)."""
    s = Counter(bucket(f, buckets) for _, t in docs for f in runs(t, longest)[1])
    t = Counter(bucket(f, buckets) for x in target for f in runs(x, longest)[1])
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in s}
    rows = []
    for doc_id, text in docs:
        n, fs = runs(text, longest)
        weight = sum(gain[bucket(f, buckets)] for f in fs) // len(fs) if fs else 0
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32))), None, n])
    able = [r for r in rows if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = place
    return sorted([tuple(r[:5]) for r in rows], key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=repr)


def texts(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("longest,buckets,piece", [(1, 10_000, R.PIECE), (3, 97, 50), (2, 70_000, 10)])
def test_equals_brute_force(spark, sf_dir, longest, buckets, piece):
    docs, target = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute(texts(docs), [r.text for r in target.collect()], 25, 20, buckets, longest)
    out = R.resample(docs, target, 25, 20, buckets, longest, piece=piece)
    assert got(out) == want
    assert any(r[4] for r in want)


def test_odd_rows(spark, odd_docs):
    target = odd_docs.where("doc_id in (1, 8)").select("text")
    want = brute(texts(odd_docs), [r.text for r in target.collect()], 60, 3, 50)
    out = R.resample(odd_docs, target, 60, 3, 50)
    assert got(out) == want
    again = R.resample(odd_docs.repartition(7), target, 60, 3, 50)
    assert got(again) == want


def test_empty_tables(spark, no_docs, odd_docs):
    assert R.resample(no_docs, no_docs).count() == 0
    out = R.resample(odd_docs, no_docs, 50, 3)
    assert got(out) == brute(texts(odd_docs), [], 50, 3)


def test_offsets_and_long_texts(spark):
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    splitter = Split(Regex(R.WORD), "removed", invert=True)
    text = ("ein wört 12—x, \U0001f600y z\n" * 400 + "a" * 3000 + " ende").translate(LOWER)
    want = [(m.group(), m.span()) for m in WORD.finditer(text)]
    for piece in (1, 17, 1000, R.PIECE):
        assert list(R.words_with_offsets(text, splitter, piece)) == want


def test_a_million_words(spark):
    docs = spark.createDataFrame([(1, "wort und zahl 7 " * 250_000), (2, "kurz " * 30)], "doc_id long, text string")
    rows = {r.doc_id: r for r in R.resample(docs, docs, 100).collect()}
    assert rows[1].n_features == 1_000_000 and rows[2].n_features == 30
    assert sorted(r.rank for r in rows.values()) == [1, 2]


def test_drawn_rows_are_whole_and_near_the_target(spark):
    near = [(i, f"alpha beta gamma delta {i} " * 5, "x", 0.5) for i in range(100)]
    far = [(1000 + i, f"omega psi chi phi {i} " * 5, "y", 0.5) for i in range(900)]
    docs = spark.createDataFrame(near + far + near[:3], "doc_id long, text string, source string, score double")
    target = spark.createDataFrame([("alpha beta gamma delta " * 50,)], "text string")
    out = R.resample(docs, target)
    rows = R.drawn(docs, out)
    assert rows.count() == 100 and set(docs.columns) - {"score"} < set(rows.columns)
    assert sorted(r["rank"] for r in rows.collect()) == list(range(1, 101))
    assert rows.where(F.col("source") == "x").count() > 70
