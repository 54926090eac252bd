import random

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from marketframe.llm import dedup, fingerprints, knn
from llm_rows import doc_rows


def shingle_set(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))


def brute_groups(rows, words, percent=80):
    sets = {i: shingle_set(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, size, edits, length=120):
    """Copies of one text, each with its own number of changed words."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for k in range(size):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_groups_equal_brute_force(spark, words, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 16)
    rng = random.Random(words)
    texts = family(rng, 60, 14) + family(rng, 10, 6) + family(rng, 5, 30) + ["same text here"] * 20 + ["one", "one", "", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in dedup.groups(df, words).collect()}
    want = brute_groups(rows, words)
    assert got == want
    assert len({c for _, c in want.values()}) > 5


def test_blocks_of_large_buckets_are_groups_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 16)
    monkeypatch.setattr(dedup, "BIN_ROWS", 32)
    sizes, apply = [], GroupedData.applyInPandas

    def seen(self, func, schema):
        sizes.append(self.count().agg(F.max("count")).first()[0] or 0)
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", seen)
    rng = random.Random(15)
    rows = list(enumerate(family(rng, 150, 50) + family(rng, 20, 10)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in dedup.groups(df, 2).collect()}
    assert got == brute_groups(rows, 2)
    # Two blocks of 16 rows on average, or small buckets of 32 rows with their askers.
    assert 0 < max(sizes) <= 150


def test_groups_odd_rows(odd_docs, no_docs):
    out = dedup.groups(odd_docs, 2).collect()
    assert len(out) == len(doc_rows())
    by = {r.doc_id: r for r in out if r.doc_id not in (None, 9)}
    assert by[1].component_id == by[2].component_id == 1 and by[1].kept and not by[2].kept
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[3].kept and by[5].component_id == 5
    assert by[7].component_id == 6
    assert all(r.kept and r.component_id is None for r in out if r.doc_id is None)
    assert dedup.groups(no_docs).count() == 0


def test_signature_estimates_and_definition():
    rng = np.random.default_rng(7)
    sets = []
    for share in (0.2, 0.5, 0.8, 0.95):
        common = rng.integers(0, 2**63, int(400 * share)).astype("<u8")
        rest = [rng.integers(0, 2**63, int(200 * (1 - share))).astype("<u8") for _ in range(2)]
        sets += [np.unique(np.concatenate([common, r])) for r in rest]
    sig = dedup.signatures(sets)
    for i in range(0, len(sets), 2):
        a, b = sets[i], sets[i + 1]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sig[i] == sig[i + 1]).mean() - true) < 0.1
    # Element by element, as the method is defined.
    few = sets[0][:20]
    want = np.full(dedup.REGISTERS, np.uint64(2**64 - 1))
    for x in few:
        p = np.arange(dedup.REGISTERS)
        for j in range(dedup.REGISTERS):
            rnd = int(dedup._mixed(np.array([x]) + np.full(1, j + 1, "<u8") * dedup._GOLD)[0])
            k = j + ((rnd >> 32) * (dedup.REGISTERS - j) >> 32)
            p[j], p[k] = p[k], p[j]
            want[p[j]] = min(want[p[j]], np.uint64(j << 32 | rnd & 0xFFFFFFFF))
    assert (dedup.signatures([few])[0] == want).all()
    assert (dedup.signatures([np.zeros(0, "<u8")]) == np.uint64(2**64 - 1)).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[200 + i] for i in range(50)} == {100}
    assert got[300] == got[301] == 300


def brute_winnow(text, gram, window):
    if not text:
        return []
    codes = np.array([ord(c) for c in text.ljust(gram, "\0")], "<u4")
    h = [int(x) for x in fingerprints.gram_hashes(codes, gram)]
    w, out = min(window, len(h)), set()
    for i in range(len(h) - w + 1):
        low = min(h[i:i + w])
        out.add((max(j for j in range(i, i + w) if h[j] == low), low))
    return [low << 32 | j for j, low in sorted(out)]


@pytest.mark.parametrize("text", ["", "a", "abc" * 7, "a" * 200, "the quick brown fox " * 20, "é\U0001f600x" * 60])
def test_winnowing_equals_its_definition(text, monkeypatch):
    assert [int(x) for x in fingerprints.winnow(text, 5, 8)] == brute_winnow(text, 5, 8)
    monkeypatch.setattr(fingerprints, "PIECE", 1)  # many overlapping pieces
    assert [int(x) for x in fingerprints.winnow(text, 5, 8)] == brute_winnow(text, 5, 8)


def test_shared_passages_share_an_entry():
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choices("abcdefghijklm ", k=n))
    for _ in range(50):
        passage = letters(fingerprints.GRAM + fingerprints.WINDOW - 1)
        a, b = (fingerprints.winnow(letters(rng.randrange(300)) + passage + letters(rng.randrange(300))) for _ in range(2))
        assert fingerprints.likeness(a, b) > 0


def test_short_texts_are_like_their_edited_ones():
    rng = random.Random(16)
    letters = lambda n: "".join(rng.choices("abcdefghijklm ", k=n))
    for n in [*range(28, 231)] * 2:
        text, following = letters(n), letters(n)
        e = fingerprints.edited(text, following)
        assert fingerprints.likeness(fingerprints.winnow(text), fingerprints.winnow(e)) > 0


@pytest.mark.parametrize("n", [0, 5, 40, 3000])
def test_fingerprint_text_holds_hashes_and_positions(n):
    import base64
    entries = fingerprints.winnow("".join(random.Random(n).choices("abcd ", k=n)))
    raw = np.frombuffer(base64.b64decode(fingerprints.as_text(entries)), "u1").reshape(-1, 5)
    hashes = raw[:, :4].copy().view(">u4").reshape(-1).astype("<u8")
    positions = np.cumsum(raw[:, 4], dtype="int64") - 1
    assert (hashes << np.uint64(32) | positions.astype("<u8")).tolist() == entries.tolist()


def test_gram_hash_depends_on_the_gram_only():
    codes = np.array([ord(c) for c in "xyzabcdefgabcdefgq"], "<u4")
    h = fingerprints.gram_hashes(codes, 7)
    assert h[3] == h[10] and len(set(h.tolist())) == len(h) - 1


@pytest.mark.parametrize("parts", [1, 3])
def test_neighbours(spark, parts):
    rng = random.Random(9)
    rows = [(i * 3 % 101, "".join(rng.choices("abcde fgh", k=rng.randrange(400)))) for i in range(101)] + [(500, None)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprints.with_next(df).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    order = sorted(rows, reverse=True)
    import hashlib
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        e = fingerprints.edited(t, n)
        k = len(t) // 3
        assert e == t[:len(t) - k] + n[:k]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == fingerprints.as_text(fingerprints.winnow(t))
        assert r.edited_fingerprint == fingerprints.as_text(fingerprints.winnow(e))
        assert r.near_edited == pytest.approx(fingerprints.likeness(fingerprints.winnow(t), fingerprints.winnow(e)))
        assert r.near_next == pytest.approx(fingerprints.likeness(fingerprints.winnow(t), fingerprints.winnow(n)))


def test_neighbours_odd_rows(spark, odd_docs, no_docs):
    assert fingerprints.with_next(odd_docs).count() == len(doc_rows())
    assert fingerprints.with_next(no_docs).count() == 0
    assert fingerprints.fingerprint(odd_docs).count() == len(doc_rows())
    one = fingerprints.with_next(spark.createDataFrame([(5, "abcdef" * 50)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def brute_top(rows, k, is_query):
    v = {}
    out = []
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            v.setdefault(i, []).append(np.floor(np.array(e, "float64") * 256))
    for q in sorted(v):
        if is_query(q):
            x = min(v[q], key=lambda a: a.tolist())
            best = sorted((-int(x @ y), i) for i, ys in v.items() if i != q for y in ys)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("case", ["plain", "ties", "few"])
def test_top_k_equals_brute_force(spark, case):
    rng = np.random.default_rng(10)
    n = 4 if case == "few" else 400
    centre = rng.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + 0.3 * rng.normal(size=8)).astype("float32").tolist()) for i in range(n)]
    if case == "ties":
        rows = [(i, rows[0][1] if i % 3 else e) for i, e in rows]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 6), (1002, [float("nan")] * 8), (None, [1.0] * 8),
             (1003, [float("inf")] * 8), (1004, [0.0] * 8), (1005, [-1.0] * 8), (1005, [-1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)).repartition(3)
    got = knn.top_k(df, F.col("vec_id") % 5 == 0, pivots=12, chunk=90, group_queries=20)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, lambda q: q % 5 == 0)


def test_clustered_vectors_travel_to_few_groups(spark):
    rng = np.random.default_rng(12)
    centre = rng.normal(size=(41, 16))
    norm = rng.uniform(0.5, 2, size=3000)  # unlike norms, so that angles alone decide nothing
    rows = [(i, (norm[i] * (centre[i % 41] + 0.15 * rng.normal(size=16))).astype("float32").tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    report = {}
    got = knn.top_k(df, F.col("vec_id") % 5 == 0, pivots=64, chunk=500, group_queries=30, report=report)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, lambda q: q % 5 == 0)
    assert report["rows"] == 3000 and report["groups"] >= 15
    assert report["travelling"] < 0.25 * report["rows"] * report["groups"]


def test_a_cell_with_a_third_of_all_rows_is_many_groups(spark, monkeypatch):
    sizes = []
    rng = np.random.default_rng(13)
    rows = [(i, (rng.normal(size=8) if i % 3 else np.full(8, 0.7)).astype("float32").tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)

    seen = GroupedData.cogroup

    def counted(self, other):
        sizes.append(other.count().agg(F.max("count")).first()[0] or 0)
        return seen(self, other)

    monkeypatch.setattr(GroupedData, "cogroup", counted)
    got = knn.top_k(df, F.col("vec_id") % 50 == 0, pivots=16, chunk=60, group_queries=5)
    # Blocks are by hash of the id, so none has many more rows than asked for.
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, lambda q: q % 50 == 0)
    assert 0 < max(sizes) < 120


def test_pivots_are_spread():
    rng = np.random.default_rng(14)
    centre = np.eye(6)
    sample = np.concatenate([c + 0.05 * rng.normal(size=(50, 6)) for c in centre] + [np.zeros((5, 6)), [[-1.0] * 6]])
    rng.shuffle(sample)
    piv = knn.spread_pivots(sample, 30, 6)
    assert np.allclose((piv * piv).sum(1), 1) and ((centre @ piv.T).max(1) > 0.95).all()
    assert not (piv @ -np.ones(6) > 2).any()  # the lone row is no pivot
    assert len(knn.spread_pivots(np.zeros((4, 6)), 3, 1)) == 1


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_k(df, F.col("vec_id") % 50 == 0).count() == 0
    none = spark.createDataFrame([(1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert knn.top_k(none, F.col("vec_id") % 50 == 0).count() == 0


def test_word_hashes_tell_words_apart_wherever_they_stand():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 9)).astype("u1")) for _ in range(3000)]
    words += [b"x" * n for n in (63, 64, 65, 200)] + [b"x" * 64 + b"y", b"\xc3\xa9"]
    one = {w: int(dedup.word_hashes(w)[0]) for w in words}
    assert len(set(one.values())) == len(one)
    text = b"\n\t ".join(words) + b" "
    assert dedup.word_hashes(text).tolist() == [one[w] for w in words]
    assert dedup.word_hashes(b" \r\n").tolist() == dedup.word_hashes(b"").tolist() == []


def test_pieces_and_chunks_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 3000} v{i}" for i in range(5000)) + " " + "z" * 700
    whole = dedup.shingles(text, 3)
    sets = [whole, whole[:40], whole[:0], whole[:150], whole[100:900]]
    sig = dedup.signatures(sets)
    monkeypatch.setattr(dedup, "PIECE", 50)
    monkeypatch.setattr(dedup, "CHUNK", 64)
    monkeypatch.setattr(dedup, "SPARSE_STEPS", 2)
    assert (dedup.shingles(text, 3) == whole).all() and (dedup.signatures(sets) == sig).all()


def test_a_million_words_stay_in_bounded_memory():
    import tracemalloc

    text = " ".join(map(str, range(1_000_000)))
    tracemalloc.start()
    found = dedup.shingles(text, 2)
    dedup.signatures([found])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 999_999 and peak < 100e6
