import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketframe.llm import packing, range_coder, token_output, tokens
from marketframe.llm.common import text_slices
from marketframe.llm.tokens import PieceEncoder, default_path
from llm_rows import doc_rows

ODD = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb \n c\t\td  e", "x y z", "don't  <|endoftext|> stop", "  \n a\tb",
       "Σας ΣΑΣ", "foo, bar!!. baz_. A.B, c", "É.\nÀ, x", "naïve, <|ENDOFTEXT|> x", "İstanbul", "fooİ, barİ. İ\nİ.",
       'a"b', " '  's",
       "it's. ok, 3.5, x.", "...\n, .", "é. É, x", "z" * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(name, spark, sf_dir):
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for got, text in zip(ours.encode(texts), texts, strict=True):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_texts_encode_alike(name):
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    rng = random.Random(6)
    texts = ["".join(rng.choices("ab .,\n'\tÉé9_!-|", weights=[6, 6, 6, 2, 2, 1, 1, .3, 1, 1, 1, 1, 1, 1, 1], k=rng.randrange(40)))
             for _ in range(3000)]
    for got, text in zip(ours.encode(texts), texts, strict=True):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_words_go_straight_to_the_model(name, monkeypatch):
    """Latin words, with signs or without, never take the slow steps; their ids
    are those of whole encoding, as are those of words next to the rule."""
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    rng = random.Random(7)
    letters = "abcdefgXYZ\u00e9\u00df\u00ff\u00f8\u0105\u017f\u01c6\u0233"
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 14))) + rng.choice(["", "", "###", "!?", "'", "_", "."]) for _ in range(500)]
    odd = ["\u0130a", "a\u0301", "\u212b", "a's", "a'", "\u00b5", "\u00aa", "\ufb01x", "\u01c5", "x9", "\u00d7", "<|a", "a<|", "\u0149"]
    texts = [" ".join(words[:250]), "\n".join(words[250:]), *odd, *[" " + w for w in odd]]
    for got, text in zip(ours.encode(texts), texts, strict=True):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]
    slow = []
    monkeypatch.setattr(ours, "_encode_pieces", lambda pieces: slow.extend(pieces) or [(p, b"") for p in pieces])
    ours.encode(["hello h\u00e9llo wonderful###\nfine, words."])
    assert slow == [","]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_slice_looks_up_each_piece_once(name, monkeypatch):
    """Pieces that repeat within a slice cost one look-up, and new words one call of the library."""
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    asked = []
    known = ours._known
    monkeypatch.setattr(ours, "_known", lambda pieces: asked.extend(pieces) or known(pieces))
    texts = ["a word or a word, or", "", "word\tor", "or a\0word", "word or", "  a  word", " \u00e9t\u00e9!! a_b"] * 3
    got = ours.encode(texts)
    assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == len(set(asked)) and asked.count(" or") == 1
    assert ours.encode([]) == [] and [x.tolist() for x in ours.encode(["", ""])] == [[], []]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_known_pieces_cost_no_call_and_the_memo_is_bounded(name, monkeypatch):
    """Only pieces that the memo lacks become strings; a full memo keeps those used last."""
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    monkeypatch.setattr(tokens, "MEMO", 40)
    asked = []
    known = ours._known
    monkeypatch.setattr(ours, "_known", lambda pieces: asked.extend(pieces) or known(pieces))
    rng = random.Random(8)
    kept = "some words stay, and stay"
    for i in range(30):
        texts = [kept, "", " ".join("".join(rng.choices("abcd\u00e9", k=5)) for _ in range(12)), "y" * 100]
        if i == 7:
            texts.append(" ".join("".join(rng.choices("abcd", k=6)) for _ in range(90)))
        got = ours.encode(texts)
        assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(ours.pieces) == len(ours.raw) == len(ours.used) <= 40
        assert ("y" * 100 in ours.pieces.to_pylist()) is False
    assert asked.count(" words") == 1 and asked.count("y" * 100) == 30


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_are_cut_wherever_it_is_safe(name, monkeypatch):
    """Runs of white space or signs elsewhere in a text don't keep the rest of it in larger pieces."""
    from tokenizers import Tokenizer
    plain, ours = Tokenizer.from_file(default_path(name)), PieceEncoder(default_path(name))
    asked = []
    known = ours._known
    monkeypatch.setattr(ours, "_known", lambda pieces: asked.extend(pieces) or known(pieces))
    texts = ["a.  b,\nc!. d\u00e9. \u0436. \u4e2d, \U0001f600. e_. f\u0301. x", ". x\n. y", "\n", ".", ". "]
    got = ours.encode(texts)
    assert [x.tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted(["a", ".", "  b", ",", "\n", "c!.", " d\u00e9", " \u0436", " \u4e2d", " \U0001f600.", " e_.",
                                    " f\u0301.", " x", " y", " "])


def test_text_slices_are_bounded():
    import pyarrow as pa
    texts = ["abc", None, "x" * 50, "", "\u00e9" * 5, "abcdefghij", "k", None]
    batch = pa.record_batch([pa.array(texts), pa.array(range(8))], names=["text", "n"])
    got = [b.column("n").to_pylist() for b in text_slices([batch, batch.slice(0, 0)], rows=3, size=12)]
    assert got == [[0, 1], [2], [3, 4], [5, 6, 7]]
    assert [b.num_rows for b in text_slices([batch], rows=3)] == [3, 3, 2]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 255, 256, 257, 1000, 5000, 40_000])
@pytest.mark.parametrize("top", [1, 3, 49_408])
def test_coder_round_trip(n, top):
    x = np.random.default_rng(n + top).integers(0, top, n)
    block = range_coder.encode(x, 49_408, 1)
    assert (range_coder.decode(block) == x).all()
    if n >= 1000 and top <= 3:
        assert len(block) < n / 2


def test_coder_looks_up_each_step_once(monkeypatch):
    """The model is asked once per segment (coding) or step (decoding), and
    learns nothing from the last segment; carries run over many words."""
    calls = {"look_up": 0, "learn": 0}
    for name in calls:
        plain = getattr(range_coder._Model, name)

        def counted(*args, name=name, plain=plain):
            calls[name] += 1
            return plain(*args)
        monkeypatch.setattr(range_coder._Model, name, counted)
    x = np.minimum(np.random.default_rng(5).geometric(0.02, 30_000), 49_000)
    segments = range_coder._plan(len(x))[1]
    block = range_coder.encode(x, 49_408, 1)
    assert calls == {"look_up": len(segments), "learn": len(segments) - 1}
    assert (range_coder.decode(block) == x).all()
    assert calls == {"look_up": len(segments) + sum(p for *_, p in segments), "learn": 2 * (len(segments) - 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=600))
def test_coder_round_trip_small(ids):
    assert range_coder.decode(range_coder.encode(np.array(ids, "int64"), 10, 1)).tolist() == ids


def test_words_are_stored_as_the_decoder_takes_them():
    """A block has no table of lanes; one that lacks a word, or has one more, is damaged."""
    x = np.zeros(1 << 16, "int64")
    block = range_coder.encode(x, 49_408, 1)
    lanes = range_coder._plan(len(x))[0]
    assert len(block) < 26 + 9 * lanes
    assert (range_coder.decode(block) == x).all()
    with pytest.raises(range_coder.CorruptBlock):
        range_coder.decode(block[:-2])
    with pytest.raises(range_coder.CorruptBlock):
        range_coder.decode(block + b"\0\0")


def test_every_damaged_byte_is_found():
    """Also one that the ids don't depend on, as in a lane's last word."""
    block = range_coder.encode(np.arange(600) % 7, 100, 1)
    for at in range(len(block) - 60, len(block)):
        with pytest.raises(range_coder.CorruptBlock):
            range_coder.decode(block[:at] + bytes([block[at] ^ 1]) + block[at + 1:])


def test_damage_is_found():
    block = bytearray(range_coder.encode(np.arange(2000) % 37, 100, 1))
    for at in range(0, len(block), 61):
        broken = bytearray(block)
        broken[at] ^= 0x10
        with pytest.raises(range_coder.CorruptBlock):
            range_coder.decode(bytes(broken))
    with pytest.raises(range_coder.CorruptBlock):
        range_coder.decode(bytes(block[:-3]))
    with pytest.raises(range_coder.CorruptBlock):
        range_coder.decode(b"")


def whole_ids(name, end_id, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_path(name))
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, end_id], "<u4") for x in texts]


def test_files_give_back_all_ids(spark, odd_docs, tmp_path):
    path = token_output.write(odd_docs, str(tmp_path / "t"), block_ids=50)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, bytes(r.ids), r.doc_id)
                 for r in token_output.read(spark, path, with_ids=True).collect())
    rows = sorted(((i is not None, i or 0, t or "") for i, t, *_ in doc_rows()))
    ids = whole_ids("word_bpe_49k.json", 1, [t for *_, t in rows])
    start = 0
    assert len(got) == len(rows)
    for (known, i, _), x, g in zip(rows, ids, got, strict=True):
        assert g == (start, len(x), zlib.crc32(x.tobytes()), x.tobytes(), i if known else None)
        start += len(x)


def test_no_documents_no_ids(spark, no_docs, tmp_path):
    assert token_output.read(spark, token_output.write(no_docs, str(tmp_path / "t"))).count() == 0
    assert packing.pack(no_docs)[1].count() == 0


def test_packing_tiles_every_document(odd_docs):
    table, placed = packing.pack(odd_docs, capacity=64, part=5)
    got = packing.sequences(table, placed).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at and 0 < r.length <= 64 and len(r.ids) == 2 * r.length
            at += r.length
        assert at <= 64
    want = sorted((i is not None, i or 0, x.astype("<u2").tobytes()) for (i, t, *_), x in zip(
        doc_rows(), whole_ids("byte_bpe_50k.json", 2, [t for _, t, *_ in doc_rows()]), strict=True))
    # Rows that repeat an id are told apart by their piece numbers' order in the table.
    parts = {}
    for r in placed.select("uid", "doc_id", "piece", "start", "length").join(
            table.select("uid", "ids"), "uid").orderBy("uid").collect():
        if r.piece == 0:
            parts.setdefault(r.doc_id, []).append(b"")
        parts[r.doc_id][-1] += bytes(r.ids)
        if r.piece:
            assert r.length == 64
    assert sorted((i is not None, i or 0, x) for i, v in parts.items() for x in v) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=9))
def test_bound_and_best_fit(lengths):
    x = np.array(lengths)
    seq, offset, used = packing.best_fit_decreasing(x, 64)
    fill = {}
    for s, o, n in sorted(zip(seq.tolist(), offset.tolist(), lengths, strict=True)):
        assert fill.get(s, 0) == o
        fill[s] = o + n
    assert len(fill) == used and max(fill.values()) <= 64

    def least(items, bins):
        if not items:
            return len(bins)
        best, seen = 99, set()
        for i, b in enumerate(bins):
            if b + items[0] <= 64 and b not in seen:
                seen.add(b)
                best = min(best, least(items[1:], [*bins[:i], b + items[0], *bins[i + 1:]]))
        return min(best, least(items[1:], [*bins, items[0]])) if len(bins) < used else best

    optimum = least(sorted(lengths, reverse=True), [])
    assert packing.lower_bound(x, 64) <= optimum <= used


def test_certified_partitions_meet_their_bound(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 60 + 1)) for i in range(400)], "doc_id long, text string")
    table, placed = packing.pack(docs, capacity=64, part=100)
    rows = placed.collect()
    used = len({r.sequence_id for r in rows})
    bound = packing.lower_bound(np.array([r.length for r in rows]), 64)
    assert bound <= used <= 1.03 * bound + 1
