import random
import re
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import langid, pii, toxicity
from marketframe.llm.common import documents, fold
from llm_rows import doc_rows


def test_language_held_out(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    out = langid.identify(docs, langid.train(docs), ("doc_id", "lang")).where(fold() == 0)
    r = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"),
                F.max("score").alias("hi")).first()
    assert r.a > 0.97 and 0 <= r.lo and r.hi <= 1


def test_kernel_sums_fold_into_one_matrix():
    """Scores by the folded matrix equal those by landmark kernels."""
    random.seed(1)
    texts = ["".join(random.choices("abcdefgh " if i % 2 else "stuvwxyz ", k=200)) for i in range(40)]
    langs = ["a" if i % 2 else "s" for i in range(40)]
    bits = []
    for t in texts:
        row = np.zeros(langid.WIDTH, "u1")
        langid.mark(t, row)
        bits.append(np.packbits(row).tobytes())
    model = langid.fit(bits, langs, landmarks=10)
    best, score = model.predict(texts)
    assert [model.langs[b] for b in best] == langs and (score > 0.6).all()

    def grams(t, n):
        return {t[i:i + n] for i in range(len(t) - n + 1)}

    def kernel(x, z):
        return np.mean([len(grams(x, n) & grams(z, n)) / (len(grams(x, n)) * len(grams(z, n))) ** 0.5 for n in (1, 2, 3)])

    x = langid.presence(texts[:6])
    exact = np.array([[kernel(a, b) for b in texts[:6]] for a in texts[:6]])
    assert np.abs(x @ x.T - exact).max() < 0.02  # hash collisions only


def test_language_odd_rows(odd_docs, no_docs):
    out = langid.identify(odd_docs, langid.train(odd_docs)).collect()
    assert len(out) == len(doc_rows())
    und = [r for r in out if r.lang_pred == "und"]
    assert len(und) == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in doc_rows())
    assert all(r.score == 0 for r in und)
    assert langid.identify(no_docs, langid.train(no_docs)).count() == 0
    assert langid.train(no_docs) is None
    kept = langid.accepted(odd_docs, langid.train(odd_docs), 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == len(doc_rows()) - len(und)


def test_long_text_marks_like_its_grams(monkeypatch):
    text = "abc défg hij klmnop " * 40
    whole, cut = np.zeros(langid.WIDTH, "u1"), np.zeros(langid.WIDTH, "u1")
    langid.mark(text, whole)
    monkeypatch.setattr(langid, "PIECE", 50)
    langid.mark(text, cut)
    assert (whole == cut).all()


def test_toxicity_learns_words(spark):
    random.seed(2)
    words = ["".join(random.choices("abcdefghij", k=4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        t = random.choices(words, k=60)
        y = int(i % 3 == 0)
        if y:
            t[random.randrange(60)] = random.choice(["scum", "fool"])
        rows.append((i, " ".join(t)))
        labels.append((i, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = toxicity.score(docs, model).join(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id").where(fold() == 0)
    wrong = out.where((F.col("score") >= 0.5) != (F.col("toxic") == 1)).count()
    assert wrong <= 0.05 * out.count()
    assert len(model.index) < 3000  # L1 keeps few features


def test_ftrl_equals_a_plain_loop():
    """Coordinate by coordinate, as the update is defined."""
    rng = random.Random(21)
    rows = [np.array(sorted(rng.sample(range(40), rng.randrange(1, 9))), "<u4") for _ in range(300)]
    labels = [int(3 in x or rng.random() < 0.1) for x in rows]
    model = toxicity.fit(rows, labels, epochs=3)
    z, n, bias = {}, {}, "bias"
    weigh = [max(labels.count(0), labels.count(1)) / labels.count(y) for y in (0, 1)]

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2
        return -(zi - (toxicity.L1 if zi > 0 else -toxicity.L1)) / rate

    for _ in range(3):
        for x, y in zip(rows, labels, strict=True):
            w = {i: weight(i) for i in [*x.tolist(), bias]}
            g = (1 / (1 + np.exp(-sum(w.values()))) - y) * weigh[y]
            for i, wi in w.items():
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - old ** 0.5) / toxicity.ALPHA * wi
    want = {i: weight(i) for i in z if i != bias and weight(i)}
    assert model.index.tolist() == sorted(want) and 3 in want and len(want) < 40
    assert model.weight == pytest.approx([want[i] for i in sorted(want)], rel=1e-5)
    assert model.bias == pytest.approx(weight(bias))


def test_toxicity_sample_keeps_to_its_bytes(spark):
    rows = [(h, y, bytes(4 * (h % 5 + 1))) for h in range(20) for y in (0, 1)] + [(0, 1, bytes(4))]
    df = spark.createDataFrame(rows, "h long, y int, x binary")
    got = toxicity.within(df, 40).collect()
    for y in (0, 1):
        assert 36 <= sum(len(r.x) for r in got if r.y == y) <= 40
    assert toxicity.within(df, 10**6).count() == 40


def test_ridge_equals_the_normal_equations():
    """Scores equal those of a weighted ridge regression on kernel values
    through the landmarks, solved another way."""
    random.seed(22)
    texts = ["".join(random.choices(("abcdefgh ", "stuvwxyz ", "ijklmnab ")[i % 3], k=80)) for i in range(45)]
    langs = [("a", "s", "i")[i % 3] for i in range(45)]
    bits = []
    for t in texts:
        row = np.zeros(langid.WIDTH, "u1")
        langid.mark(t, row)
        bits.append(np.packbits(row).tobytes())
    best, score = langid.fit(bits, langs, landmarks=12).predict(texts)
    x = langid.presence(texts).astype("float64")
    k, kz = x @ x[:12].T, x[:12] @ x[:12].T
    names = sorted(set(langs))
    y = np.array([[1.0 if g == n else -1.0 for n in names] for g in langs])
    w = np.array([1 / langs.count(g) for g in langs]) / len(names)
    # min over a, b: sum w (y - K a - b)^2 + ridge a' Kz a, as one linear system.
    one = np.column_stack([k, np.ones(len(k))])
    penalty = np.zeros((13, 13))
    penalty[:12, :12] = langid.RIDGE / len(names) * 0.1 * kz
    a = np.linalg.lstsq((one * w[:, None]).T @ one + penalty, (one * w[:, None]).T @ y, rcond=None)[0]
    margin = one @ a
    assert (best == margin.argmax(1)).all()
    assert score == pytest.approx(np.clip((1 + margin.max(1)) / 2, 0, 1), abs=1e-3)


def test_language_sample_is_drawn_in_slices(spark):
    docs = spark.createDataFrame([(i, "en" if i % 4 else "de") for i in range(4000)], "doc_id long, lang string")
    got = langid.lowest(docs, 100).groupBy("lang").agg(F.count("*").alias("n"), F.max("r").alias("r")).collect()
    assert {(r.lang, r.n, r.r) for r in got} == {("en", 104, 13), ("de", 104, 13)}


def test_language_learns_from_every_row(spark):
    """The model and the thresholds are those of all rows, not only of the
    candidates for landmarks, however the rows are dealt."""
    random.seed(31)
    text = {g: ["".join(random.choices(abc, k=random.randint(5, 90))) + ("q" if i % 9 == 8 else "") for i in range(300)]
            for g, abc in (("a", "abcdefgh "), ("s", "stuvwbcd "))}
    rows = [(i, g, text[g][i // 2]) for i in range(600) for g in "as"[i % 2]]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    fitted = [r for r in docs.where(fold() != 0).collect() if langid.has_letters(r.text)]
    bits = langid.landmark_rows(docs, 8, 8)
    sums = langid.training_sums(docs, bits)
    assert {g: s.n for g, s in sums.items()} == {g: sum(r.lang == g for r in fitted) for g in "as"}
    packed = [x.tobytes() for x in np.packbits(langid.marked([r.text for r in fitted]), axis=1)]
    direct: dict = {}
    langid.add(direct, langid.Landmarks(bits), langid.unpacked(packed), [r.lang for r in fitted])
    model, other = langid.train(docs, 8, 8), langid.train(docs.repartition(2), 8, 8)
    for m in (langid.solve(bits, direct), other):
        assert (m.weights == model.weights).all() and (m.bias == model.bias).all() and (m.known == model.known).all()
    assert model.known_letters("q") == 1
    held = [r.text for r in docs.where(fold() == 0).collect()]
    least = langid.thresholds(docs, model)
    for k, n in enumerate(langid.LENGTHS[:4]):
        cut = [t[:max(n, 4)] for t in held if len(t) >= n]
        own = model.predict([t for t in cut if langid.has_letters(t)])[1]
        assert least[k] == pytest.approx(0.5 + (np.quantile(own, langid.QUANTILE) - 0.5) / 2, abs=1 / langid.STEPS)


def test_language_thresholds_count_every_held_out_row(spark):
    """A share of low scores shows in the threshold wherever their ids hash."""
    random.seed(32)
    model = langid.Model(["a", "s"], np.zeros((langid.WIDTH, 2), "float32"), np.array([0.8, -0.8]))
    model.weights[:langid.SPACES[1], 0] = -4 * langid.presence(["z"])[0, :langid.SPACES[1]]
    docs = spark.createDataFrame([(i, "a", "zzzz") for i in range(4000)], "doc_id long, lang string, text string")
    seen = langid.lowest(docs.where(fold() == 0), 300).select("doc_id")
    plain = seen.withColumn("lang", F.lit("a")).withColumn("text", F.lit("abcd"))
    least = langid.thresholds(docs.join(seen, "doc_id", "left_anti").unionByName(plain), model)
    low = float(model.predict(["zzzz"])[1][0])
    assert low < 0.9 and least[0] == pytest.approx(min(1, 0.5 + (low - 0.5) / 2), abs=1e-3)


def test_counted_quantile():
    values = np.random.default_rng(3).integers(0, 20, 137)
    counts = sorted(zip(*(x.tolist() for x in np.unique(values, return_counts=True))))
    for q in (0, 0.01, 0.3, 0.5, 1):
        assert langid.counted_quantile(counts, q) == pytest.approx(np.quantile(values, q))


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, y) for i, y in [(1, 1), (2, 0), (6, None), (None, 1), (8, 0), (13, 1), (14, 0)]],
                                   "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels)
    out = toxicity.score(odd_docs, model).collect()
    assert len(out) == len(doc_rows()) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.train(odd_docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(odd_docs, None).collect()} == {0.0}
    assert toxicity.score(no_docs, model).count() == 0


def test_long_texts_have_the_same_features(monkeypatch):
    text = "one two three four five six " * 50
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    assert sorted(toxicity.features(text).tolist()) == sorted(whole.tolist())
    assert len(toxicity.features(None)) == len(toxicity.features("")) == 0


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((k, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    random.seed(3)
    alphabet = "ab1234567890..@@+-- ()_%é"
    for _ in range(4000):
        t = "".join(random.choices(alphabet, k=random.randrange(60)))
        assert pii.base_spans(t) == brute_spans(t), t
    for t in ["a@b.c_d@e.f", "x@@y.z", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "+1 (555) 555-0100.", "1" * 50_000,
              "a" * 50_000 + "@", "0" * 6000 + "1.2.3.4"[1:]]:
        if len(t) < 1000:
            assert pii.base_spans(t) == brute_spans(t), t
        else:
            pii.base_spans(t)


def test_field_matches_enumeration_on_a_tree():
    rng = np.random.default_rng(4)
    n = pii.Nodes([(0, 1)] * 4, rng.integers(0, 8, (4, 3)), np.array([0, 2, 0, 0]), np.array([False, True, False, False]),
                  np.array([[0, 1], [1, 2]]), np.array([[1, 3]]))
    model = pii.Model(rng.normal(size=(8, 5)), rng.normal(size=(5, 5)), (lambda a: a + a.T)(rng.normal(size=(5, 5))))
    weight = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        if y[1] != 2:
            continue
        s = sum(model.unary[n.features[i], y[i]].sum() for i in range(4))
        s += model.chain[y[0], y[1]] + model.chain[y[1], y[2]] + model.skip[y[1], y[3]]
        for i in range(4):
            weight[i, y[i]] += np.exp(s)
    want = weight / weight.sum(1, keepdims=True)
    assert np.abs(pii.marginals(n, model, rounds=200, damping=0.0) - want).max() < 1e-6


def trained():
    rng = random.Random(5)
    sample = []
    for _ in range(200):
        num = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        card = "4111111111111111" if rng.random() < 0.5 else "x"
        t = f"call +1 {num} now " + "x " * 5 + f"{rng.randrange(10)} of {rng.randrange(99)} and {card}, end"
        sample.append(pii.training_nodes(t))
    return pii.fit(sample)


def test_field_adds_what_a_pattern_swallowed():
    model = trained()
    assert pii.find("nothing here but 7 of 12 things", model) == ([], [])
    text = "call +1 (415) 555-2671 4111111111111111 now. 12 of 40"
    base, added = pii.find(text, model)
    assert base == [] and [(pii.KINDS[k], text[s:e]) for k, s, e in added] == [
        ("phone", "+1 (415) 555-2671"), ("card", "4111111111111111")]
    base, added = pii.find("call +1 (415) 555-2671 now. 12 of 40", model)
    assert [k for k, *_ in base] == [3] and added == []


def test_skip_edges_spread_a_label():
    """A doubtful number far from its full form takes that one's label."""
    model = trained()
    n = pii.nodes("card 4111111111111111 here " + "word " * 50 + "4111-1111-1111-1111x again", [(2, 5, 21)])
    assert n.skip.tolist() == [[0, 1]] and n.observed.tolist() == [True, False]
    alone = pii.Nodes(n.spans, n.features, n.label, n.observed, n.chain, n.skip[:0])
    assert pii.marginals(n, model)[1, 3] > pii.marginals(alone, model)[1, 3]


def test_a_number_repeated_far_away_keeps_its_label():
    model = trained()
    text = "call +1 (415) 555-2671 now. " + " ".join("so on 14155552671x and" for _ in range(50))
    n = pii.nodes(text, pii.base_spans(text))
    p = pii.marginals(n, model)
    assert len(n.skip) > 40 and p.shape == (len(n.spans), 5) and np.allclose(p.sum(1), 1)


def test_training_reads_whole_texts(spark):
    text = " ".join(f"item {i}" for i in range(300)) + " call +1 (415) 555-2671 now"
    n = pii.training_nodes(text)
    assert len(n.spans) == 303 and n.observed[-3:].all()
    docs = spark.createDataFrame([(i, text) for i in range(20)] + [(50, "x 9 " * 2000), (None, text), (3, "other 5")],
                                 "doc_id long, text string")
    got = pii.sample(docs, 30, 5 * len(text)).collect()
    assert len(got) == 5 and len({r.doc_id for r in got}) == 5 and 50 not in {r.doc_id for r in got}
    assert len(pii.sample(docs, 30).collect()) == 21


def test_long_tables_of_numbers_stay_in_bounded_memory():
    import tracemalloc

    rng = random.Random(23)
    text = " ".join(str(rng.randrange(10**6, 10**9)) for _ in range(200_000))
    model = trained()
    n = pii.nodes(text, [])
    tracemalloc.start()
    p = pii.marginals(n, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert p.shape == (200_000, 5) and peak < 150e6


def test_pii_odd_rows(odd_docs, no_docs):
    model = pii.train(odd_docs)
    out = pii.detect(odd_docs, model).collect()
    assert len(out) == len(doc_rows())
    texts = {i: t for i, t, *_ in doc_rows() if i == 14}
    r = next(r for r in out if r.doc_id == 14)
    want = brute_spans(texts[14])
    assert (r.n_email, r.n_phone) == (1, 1)
    assert r.base_sha256 == hashlib.sha256(pii.digest(want).encode()).hexdigest()
    assert set(pii.digest(want).split(",")) <= set(r.spans.split(","))
    assert pii.detect(no_docs, pii.train(no_docs)).count() == 0
    assert pii.mask("mail a@b.example now", None) == "mail <email> now" and pii.mask(None, None) is None
    masked = pii.masked(odd_docs, model)
    assert masked.columns == odd_docs.columns and masked.count() == len(doc_rows())


@pytest.mark.parametrize("text", ["", "no signs at all", "+", "@", "9"])
def test_texts_without_spans(text):
    assert pii.find(text, None) == ([], [])
