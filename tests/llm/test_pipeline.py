"""The pipeline's stages against brute force on a small table."""

import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from marketframe.llm import pii
from marketframe.llm.common import stored
from marketframe.llm.tokens import default_path
from llm_rows import doc_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_kept(rows, words=5):
    """Smallest id of each group of texts with similarity 0.8 or more."""
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()

    sets, group = {i: shingles(t) for i, t in rows}, {}
    for i in sorted(sets):
        near = {group[j] for j in group
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        g = min(near, default=i)
        group[i] = g
        group = {k: g if v in near else v for k, v in group.items()}
    return {i for i, g in group.items() if i == g}


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(12)
    vocab = {"en": "the and of to in that with from they have", "de": "der die und nicht mit ein auf sich dem ist"}
    rows = []
    for i in range(90):
        lang = "en" if i % 3 else "de"
        words = [rng.choice(vocab[lang].split()) + rng.choice(["", "s", "en", "er", "ly"]) for _ in range(rng.randrange(30, 90))]
        if i % 5 == 0:
            words.insert(9, "+1 (415) 555-2671")
        rows.append([i, " ".join(words), lang, f"s{i % 4}"])
    for i in range(12):  # copies and near copies
        t = rows[i][1].split(" ")
        if i % 2:
            t[len(t) // 2] = "changed"
        rows.append([100 + i, " ".join(t), rows[i][2], "s1"])
    rows += [[200, "12345 --- !!!", "en", "s0"], [201, "", None, "s0"], [202, None, None, None]]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)


def test_stages_equal_brute_force(spark, table):
    names = [n for n, _ in cp.STAGES]
    assert names == ["language", "near_duplicates", "personal_data", "mixture", "sequences"]
    assert cp.ORACLE_SQL is None
    docs, seen = table, {}
    for name, stage in cp.STAGES:
        before = docs
        docs = stored(stage(spark, docs, ""), name)
        seen[name] = (before, docs)
        if name != "sequences":
            assert docs.columns == table.columns

    before, after = (x.collect() for x in seen["language"])
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {200, 201, 202}

    before, after = (x.collect() for x in seen["near_duplicates"])
    assert {r.doc_id for r in after} == brute_kept([(r.doc_id, r.text) for r in before])
    assert len(after) < len(before)

    before, after = ({r.doc_id: r for r in x.collect()} for x in seen["personal_data"])
    model = pii.train(seen["personal_data"][0])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.text == pii.mask(before[i].text, model) and r.n_chars == len(r.text)
    assert any("<phone>" in r.text for r in after.values())
    assert not any("555-2671" in r.text for r in after.values())

    before, after = seen["mixture"]
    sizes = {r.doc_id: (len(r.text.split()), r.source) for r in before.collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert max(copies.values()) <= 3
    total, by, weight = sum(n for n, _ in sizes.values()), Counter(), {}
    for k, s in enumerate(sorted({s for _, s in sizes.values()})):
        weight[s] = (5, 2, 1)[k % 3]
    own = Counter()
    for i, (n, s) in sizes.items():
        own[s] += n
        by[s] += n * copies[i]
    target, free = {}, set(own)
    while free:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * own[s]} or free
        target |= {s: min(share[s], 3 * own[s]) for s in over}
        free -= over
        if not any(share[s] > 3 * own[s] for s in over):
            break
    for s in own:
        assert by[s] == pytest.approx(target[s], rel=0.1)

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    mixed, pieces = (x.collect() for x in seen["sequences"])
    ids = Counter()
    for r in mixed:
        ids[r.doc_id] += len(tok.encode(r.text, add_special_tokens=False).ids) + 1
    got, fill = Counter(), Counter()
    for r in pieces:
        got[r.doc_id] += r.length
        fill[r.sequence_id] += r.length
    assert got == ids and max(fill.values()) <= 1024


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    docs = odd_docs
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), name)
    assert 0 < docs.count() <= 4 * len(doc_rows())
    docs = no_docs
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_repeated_and_missing_ids_lose_no_text(spark):
    rng = random.Random(31)
    text = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    rows = [(1, text[0]), (1, text[1]), (1, text[1]), (2, text[2]), (None, text[2]), (None, text[3]), (None, text[3]),
            (None, text[4]), (3, text[5]), (-7, None), (4, ""), (5, text[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", 7) for i, t in rows], SCHEMA).repartition(4)
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in cp.near_duplicates(spark, docs, "").collect()), key=str)
    want = [(1, text[0]), (1, text[1]), (2, text[2]), (None, text[3]), (None, text[4]), (3, text[5]), (-7, None), (4, "")]
    assert kept == sorted(((i is None, i or 0, t) for i, t in want), key=str)
    keys = [r._key for r in cp.keyed(docs).collect()]
    assert len(set(keys)) == len(keys) == 10
    mixed = Counter((r.doc_id, r.text) for r in cp.mixture(spark, docs, "").collect())
    assert set(mixed) >= {(i, t) for i, t in rows if t} and max(mixed.values()) <= 3


def test_language_stage_drops_what_is_no_language(spark, sf_dir):
    rng = random.Random(17)

    def words(letters, count=40):
        return " ".join("".join(rng.choices(letters, k=rng.randrange(2, 9))) for _ in range(count))

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*SCHEMA.replace(",", "").split()[::2])
    first = docs.where("lang is not null and n_chars > 300").orderBy("doc_id").limit(30).collect()
    short = [" ".join(r.text.split()[:8]) for r in first if " ".join(r.text.split()[:8]).replace(" ", "").replace(".", "").isalpha()]
    odd = [words([chr(0x430 + i) for i in range(32)]) for _ in range(10)]
    odd += [words([chr(0x4E00 + i) for i in range(3000)]) for _ in range(10)]
    odd += [words("abcdefghijklmnopqrstuvwxyz") for _ in range(10)] + [words("0123456789abcdef") for _ in range(10)]
    rows = [(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(short + odd)]
    kept = cp.language(spark, docs.union(spark.createDataFrame(rows, SCHEMA).select(*docs.columns)), "")
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert len(short) > 5 and {10**6 + i for i in range(len(short))} <= ids
    assert not {10**6 + i for i in range(len(short), len(rows))} & ids
    real = docs.where("lang is not null and text rlike '[a-z]'").count()
    assert sum(i < 10**6 for i in ids) >= 0.97 * real
