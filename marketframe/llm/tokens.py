"""Token ids of whole texts with a memo of pieces.

A slice of texts is cut into pieces by its bytes and Arrow numbers the distinct
ones; the ``tokenizers`` library encodes each of these once; a bounded memo, two
Arrow arrays that are looked up in one call, keeps pieces for the next slices.
Texts are cut only where both supported kinds of tokenizer (byte-level BPE
with the usual split pattern, and word BPE that drops white space) always
start a new token: before white space, around a single line feed, and between a
letter or digit and one last full stop or comma before white space.  Texts with other
white space are encoded whole.  Where the tokenizer lower-cases, pieces are
lower-cased first, but for texts with a letter whose case depends on context;
texts with a letter whose lower case ends with a sign are encoded whole.
Pieces of Latin letters and ASCII signs after them, which are always one or two
words that no normalizer changes, go straight to the library's model, many in
one call; others go through all its steps.
The ids equal those of encoding each text by itself.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO = 400_000
#: Pieces that one call of the library encodes.
CALL = 512
LONG_PIECE = 64
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: White space other than space and line feed, and the mark that ends a text.
_NOT_CUT = "\0" + _SPACES
#: Letters and digits, by code point.
_ALNUM = np.array([chr(c).isalnum() for c in range(1 << 16)])
#: A letter whose lower case depends on its place, and one whose lower case ends with a sign.
_SIGMA, _DOTTED = "\u03a3", "\u0130"

#: Pieces that the model takes by itself: a word of Latin letters up to U+024F, and signs.
_LATIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")
#: A letter before signs.
_SIGNED = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f](?=[!-/:-@\\[-`{-~])")
#: The characters by which byte-level models know zero (here the mark after a word), the space and the bytes above ASCII.
_MARK = "\u0100"
_ALPHABET = np.arange(256, dtype="<u2")
_ALPHABET[:2], _ALPHABET[0x20], _ALPHABET[0x80:0xA1], _ALPHABET[0xAD] = ord(_MARK), 0x120, np.arange(0x122, 0x143), 0x143


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _before(u: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points, below 65536, of the characters before the places; 0 for others."""
    b1, b2, b3 = (u[np.maximum(at - k, 0)].astype("int64") for k in (1, 2, 3))
    two = (b2 & 31) << 6 | b1 & 63
    three = (b3 & 15) << 12 | (b2 & 63) << 6 | b1 & 63
    longer = np.where(b2 >= 0xC0, two, np.where((b3 >= 0xE0) & (b3 < 0xF0), three, 0))
    return np.where(b1 < 0x80, b1, longer)


def _starts(u: np.ndarray) -> np.ndarray:
    """Where the pieces of UTF-8 texts start, each text ending with a zero
    byte, which is a piece by itself."""
    zero, line = u == 0, u == 10
    white = line | (u == 32)
    cut = zero.copy()
    cut[0] = True
    cut[1:] |= zero[:-1] | white[1:] & ~white[:-1]
    alone = line[1:-1] & ~white[:-2] & ~white[2:]
    cut[2:] |= alone
    cut[1:2] |= line[:1] & ~white[1:2]
    sign = (u == 46) | (u == 44)
    at = np.flatnonzero(sign[1:-1] & white[2:]) + 1
    cut[at[_ALNUM[_before(u, at)]]] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.lower = self.tokenizer.normalizer is not None and "Lowercase" in str(self.tokenizer.normalizer)
        # Takes words that are parted already.  Where the last token of a word has
        # a suffix, this shows its end; else a mark does that merges with nothing.
        self.words = Tokenizer(self.tokenizer.model)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        suffix = self.tokenizer.model.end_of_word_suffix
        self.parted = bool(suffix)
        if suffix:
            self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(_MARK)
            self.last = np.array([t.endswith(suffix) for t in tokens])
        else:
            self.last = np.array([_MARK in t for t in tokens])
        self.straight = self._takes_words()
        # The memo: pieces, their ids, and the slice that last held each.
        self.pieces, self.raw = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.slice = np.zeros(0, "int64"), 0

    def _takes_words(self) -> bool:
        """Whether the model by itself gives the ids of whole encoding for words
        with each of the letters and signs that it would be given."""
        if any("<|" not in t.content for t in self.tokenizer.get_added_tokens_decoder().values()):
            return False
        if not (self.parted or self.last.sum() == 1):
            return False
        letters = [c for c in map(chr, range(0x250)) if _LATIN.fullmatch(c) and (not self.lower or c.islower())]
        signs = [c for c in map(chr, range(0x80)) if _LATIN.fullmatch("a" + c) and not c.isalpha()]
        words = [f"{space}{c}a{c}e" for c in letters for space in ("", " ")] + [f" a{c}{d}" for c in signs for d in signs]
        found = dict(self._straight(words))
        return all(found[w] == np.array(e.ids, self.dtype).tobytes()
                   for w, e in zip(words, self.tokenizer.encode_batch(words, add_special_tokens=False), strict=True))

    def _straight(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids, by the model alone, of those pieces that it can take, with a
        mark between words and after each piece."""
        done = [*compress(pieces, map(_LATIN.fullmatch, pieces))]
        if self.lower:
            done = [p for p in done if p.islower()]
        step = len(done) + 1 if self.parted else CALL
        texts = []
        for at in range(0, len(done), step):
            text = _SIGNED.sub("\\g<0>\1", "\0".join([*done[at:at + step], ""]))
            texts.append(np.frombuffer((text.replace(" ", "") if self.lower else text).encode(), "u1"))
        if not texts:
            return iter(())
        found = self.words.encode_batch_fast([_ALPHABET[t].tobytes().decode("utf-16-le") for t in texts],
                                             add_special_tokens=False)
        ids, raw = np.array([*itertools.chain(*(e.ids for e in found))], self.dtype), np.concatenate(texts)
        last = self.last[ids]
        if self.parted:
            ends = np.flatnonzero(last) + 1
        else:
            ids, ends = ids[~last], np.flatnonzero(last) - np.arange(last.sum())
        return self._raw(done, ends[raw[raw < 2] == 0], ids)

    def _prepared(self, text: str) -> str | None:
        """The text as it is cut; None if it is encoded whole."""
        if "<|" in text or self.lower and _DOTTED in text:
            return None
        for c in _NOT_CUT:
            if c in text:
                return None
        return text.lower() if self.lower and _SIGMA not in text else text

    def _encode_pieces(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each piece with its ids, all from one call of the library, which
        tells the word that an id belongs to.  Pieces of a space and letters
        are one word each, so they are given as one text; others word by word."""
        words = [p for p in pieces if p[:1] == " " and p[1:].isalpha()]
        e = self.tokenizer.encode("".join(words), add_special_tokens=False)
        if e.word_ids and e.word_ids[-1] == len(words) - 1:
            yield from self._by_word(words, e)
            known = set(words)
            pieces = [p for p in pieces if p not in known]
        yield from self._by_word(pieces, self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False))

    def _by_word(self, pieces: list[str], e) -> Iterator[tuple[str, bytes]]:
        count = np.bincount(np.array(e.word_ids, "int64"), minlength=len(pieces))
        return self._raw(pieces, np.cumsum(count), e.ids)

    def _raw(self, pieces: list[str], ends: np.ndarray, ids: list[int] | np.ndarray) -> Iterator[tuple[str, bytes]]:
        raw = np.array(ids, self.dtype).tobytes()
        ends = (ends * np.dtype(self.dtype).itemsize).tolist()
        return zip(pieces, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=False)

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that the memo doesn't have, from the library."""
        new = dict(self._straight(pieces)) if self.straight else {}
        rest = [p for p in pieces if p not in new] if len(new) < len(pieces) else []
        for at in range(0, len(rest), CALL):
            new.update(self._encode_pieces(rest[at:at + CALL]))
        return [*map(new.__getitem__, pieces)]

    def _ids(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of distinct pieces: from the memo, or else from the library."""
        place = pc.index_in(pieces, value_set=self.pieces)
        missing = place.is_null()
        place = place.fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
        new = np.flatnonzero(missing.to_numpy(zero_copy_only=False))
        self.slice += 1
        self.used[place[np.delete(np.arange(len(place)), new)]] = self.slice
        if not len(new):
            return self.raw.take(pa.array(place))
        added = pieces.take(pa.array(new))
        ids = pa.array(self._known(added.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        place[new] = len(self.raw) + np.arange(len(new))
        found = pa.concat_arrays([self.raw, ids]).take(pa.array(place))
        short = pc.less_equal(pc.utf8_length(added), LONG_PIECE)
        self._keep(added.filter(short), ids.filter(short))
        return found

    def _keep(self, pieces: pa.LargeStringArray, raw: pa.LargeBinaryArray) -> None:
        """Add new pieces to the memo; a full one keeps the half used last."""
        if len(self.pieces) + len(pieces) > MEMO:
            last = pa.array(np.sort(np.argsort(-self.used, kind="stable")[:MEMO // 2]))
            self.pieces, self.raw, self.used = self.pieces.take(last), self.raw.take(last), self.used[last.to_numpy()]
            pieces, raw = pieces[:MEMO // 2], raw[:MEMO // 2]
        self.pieces, self.raw = pa.concat_arrays([self.pieces, pieces]), pa.concat_arrays([self.raw, raw])
        self.used = np.append(self.used, np.full(len(pieces), self.slice))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        if not texts:
            return []
        ready = [*map(self._prepared, texts)]
        whole = [i for i, t in enumerate(ready) if t is None]
        for i in whole:
            ready[i] = ""
        data = "\0".join([*ready, ""]).encode()
        u = np.frombuffer(data, "u1")
        starts = _starts(u)
        cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(u))), pa.py_buffer(data))
        coded = cut.dictionary_encode()
        # Zero bytes have no ids.
        pieces = coded.dictionary
        end = pieces.index("\0").as_py()
        known = self._ids(pa.concat_arrays([pieces[:end], pieces[end + 1:]]))
        known = pa.concat_arrays([known[:end], pa.array([b""], known.type), known[end:]])
        taken = known.take(coded.indices)
        size = np.dtype(self.dtype).itemsize
        ends = np.frombuffer(taken.buffers()[1], "int64", len(taken) + 1, taken.offset * 8)
        ids = np.frombuffer(taken.buffers()[2] or b"", self.dtype)
        bounds = (ends[np.append(0, np.flatnonzero(u[starts] == 0))] // size).tolist()
        out = [ids[a:b] for a, b in itertools.pairwise(bounds)]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, self.dtype)
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of a file, kept by the Python worker between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
