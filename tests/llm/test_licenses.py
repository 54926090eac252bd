"""License spans against a plain walk over each text."""

import re

import pytest
from pyspark.sql import functions as F

from marketframe.llm import licenses as L

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text):
    """(n_words, n_base, first, last, base_labels, labels, score, spans)."""
    w = words(text)
    base, labels, score, spans, starts = set(), set(), 0.0, 0, []
    for t in L.TEMPLATES:
        tw = words(t.text)
        if t.kind != "notice":
            at = [i for i in range(len(w) - len(tw) + 1) if w[i:i + len(tw)] == tw]
            spans += len(at)
            if at:
                labels.add(t.label)
                score = 1.0
            if t.kind == "base":
                starts += at
                base |= {t.label} if at else set()
            continue
        votes = {}
        for p in range(len(w) - 2):
            for q in range(len(tw) - 2):
                if w[p:p + 3] == tw[q:q + 3]:
                    votes.setdefault(p - q, set()).add(q)
        groups, before = [], None
        for d in sorted(votes):
            if before is None or d - before > L.SHIFT:
                groups.append(set())
            groups[-1] |= {x for q in votes[d] for x in (q, q + 1, q + 2)}
            before = d
        for g in groups:
            cover = len(g) / len(tw)
            if cover >= L.LEAST_COVER:
                spans += 1
                labels.add(t.label)
                score = max(score, cover)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, spans)


MIT, APACHE = L.TEMPLATES[8].text, L.TEMPLATES[9].text
TEXTS = [
    "Released under the MIT License.", "mit mit license license MIT LICENSE", "the general public license license",
    "general public", "license", None, "", " ,.;", MIT, MIT.upper() + " and more " + MIT,
    MIT.replace("free of charge", "wholly free of any charge"), " ".join(MIT.split()[:12]), " ".join(MIT.split()[3:]),
    APACHE.replace("without warranties", "x y z without any warranties") + " Apache License, mit\nlicense",
    "Apache-License apache_license Apache  License", "Licensed under CC BY-NC 4.0.", "Ünïcödé mıt license MİT License",
    "word " * 3000 + "mit license " * 40 + APACHE + " rest " * 3000,
]


def result(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                               "labels", "score", "spans").collect()], key=repr)


@pytest.mark.parametrize("piece", [L.PIECE, 1000, 7, 1])
def test_equals_a_walk_over_each_text(spark, piece):
    texts = TEXTS if piece > 7 else TEXTS[:-1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = sorted([(i, *brute(t)) for i, t in enumerate(texts)], key=repr)
    assert result(L.scan(docs, piece=piece)) == want


def test_odd_rows_keep_to_themselves(spark, odd_docs, no_docs):
    assert result(L.scan(odd_docs)) == sorted([(r.doc_id, *brute(r.text)) for r in odd_docs.collect()], key=repr)
    assert L.scan(no_docs).count() == 0
    same = spark.createDataFrame([(1, "MIT License"), (1, "MIT License"), (None, "mit license mit license")],
                                 "doc_id long, text string")
    assert [r[2] for r in result(L.scan(same))] == [1, 1, 2]


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "MIT License")], "doc_id long, text string")
    seen = []
    stored = L.stored
    try:
        L.stored = lambda df, name: seen.append(df) or stored(df, name)
        out = L.scan(docs)
    finally:
        L.stored = stored
    for df in (*seen, out):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|MapPartitions", plan)
    assert "BroadcastHashJoin" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_spans_name_their_place(spark):
    docs = spark.createDataFrame([(5, "one two " + MIT + " three")], "doc_id long, text string")
    spans = L.spans(L.matches(docs)).where(F.col("kind") == "notice").collect()
    n = len(words(MIT))
    assert [(r.label, r.first_word, r.last_word, r.cover) for r in spans] == [("mit", 2, 1 + n, 1.0)]


def test_a_very_long_text(spark):
    body = "some words of prose here " * 400_000
    docs = spark.createDataFrame([(1, body + "MIT License " + body + "apache license")], "doc_id long, text string")
    r = L.scan(docs).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (4_000_004, 2, 2_000_000, 4_000_002)
