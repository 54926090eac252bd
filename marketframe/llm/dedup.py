"""Near-duplicate groups by SuperMinHash.

A document's set is its distinct ``words``-word shingles.  SuperMinHash gives
each element a random permutation of the registers, laid out step by step
(Fisher-Yates); in step j the element offers the rank ``j + r`` to the next
register of its permutation.  Ranks of one element are correlated, which
lowers the estimator's variance, and once all registers of a set hold a rank
below j + 1 no later step can change it, so the steps stop early.

1. Equal sets form one class each (hash aggregation); its smallest id stands
   for it from here on, so copies cost one row each.
2. ``BANDS`` bands of ``ROWS`` registers become bucket keys.  At similarity 0.8
   two sets share no bucket with probability (1 - 0.8^6)^48 < 5e-7.
3. In each bucket every member is paired with the member of highest degree
   (its buckets' sizes summed), a star instead of all pairs: the least edited
   copy of a family is near to most of it.  Pairs are confirmed on full sets.
4. Linked documents are grouped (large-star / small-star union-find on tables).
5. Only where a bucket still holds several groups, members outside its largest
   group are compared with all members of other groups, block by block, on
   presence bits, which rule out a pair only where it can't be a link.  Of
   the rest, first the likeliest pair for each document and other group is
   confirmed on full sets and the groups joined, then all that are left.

Edge cases: null texts and texts without words have an empty set and are
linked with nothing; fewer words than a shingle are one shingle; rows without
an id stand alone and are kept; ids are taken as unique, rows that repeat an
id count as one document; ties (equal sets, equally near hubs) go to the
smaller id; very long texts are hashed ``PIECE`` bytes and laid out ``CHUNK``
elements at a time; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import slices, stored

BANDS = 48
ROWS = 6
REGISTERS = BANDS * ROWS
#: Members of a bucket, or rows of small buckets, that one task compares at a time.
BLOCK = 2048
BIN_ROWS = 8192
_GOLD = np.uint64(0x9E3779B97F4A7C15)


#: Words up to this many bytes are hashed together, longer ones by themselves.
LONG_WORD = 64
#: Elements of one set that are laid out at a time, and steps before a table of them is.
CHUNK = 1 << 16
SPARSE_STEPS = 12
#: Sets below this size take many steps, so a task lays out this many of them together.
SMALL = 160
TOGETHER = 256
#: Bytes of a text that are hashed at a time, cut between words.
PIECE = 1 << 18
_BLANK = re.compile(rb"[\t-\r ]")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.frombuffer(hashlib.shake_256(b"bytes").digest(8 * 256), "<u8")
_PLACES = np.frombuffer(hashlib.shake_256(b"places").digest(8 * LONG_WORD), "<u8") | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word, a piece of the text at a time."""
    out, at = [], 0
    while at < len(text):
        gap = _BLANK.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        out.append(_piece_hashes(text[at:end]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, "<u8")


def _piece_hashes(text: bytes) -> np.ndarray:
    """The sum of a random number per byte times a random odd number per
    place; a long word's hash is a digest."""
    raw = np.frombuffer(text, "u1")
    inside = np.flatnonzero(~_SPACE[raw])
    if not len(inside):
        return np.zeros(0, "<u8")
    first = np.append(0, np.flatnonzero(np.diff(inside) > 1) + 1)
    size = np.diff(np.append(first, len(inside)))
    starts = inside[first]
    place = inside - np.repeat(starts, size)
    longest = size.max()
    if longest > LONG_WORD:
        np.minimum(place, LONG_WORD - 1, out=place)
    h = np.add.reduceat(_CODES[raw[inside]] * _PLACES[place], first) + size.astype("<u8")
    for i in np.flatnonzero(size > LONG_WORD) if longest > LONG_WORD else ():
        word = text[starts[i]:starts[i] + size[i]]
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles (A-Z lower-cased; words
    end at ASCII white space, as bytes.split() has it)."""
    ids = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(ids):
        return ids
    n = min(words, len(ids))
    h = np.full(len(ids) - n + 1, n, "<u8")
    for j in range(n):
        h = h * _GOLD + ids[j:len(ids) - n + 1 + j]
    h = np.sort(_mixed(h))
    return h[np.append(True, h[1:] != h[:-1])]


def signatures(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash registers of each set: step in the high half, random rank
    in the low half of a 64-bit number.  Empty sets keep all bits set.

    Large sets go chunk by chunk against the registers found so far, so that
    later chunks stop after few steps and memory stays bounded."""
    best = np.full((len(sets), m), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, max(map(len, sets), default=0), CHUNK):
        part = [s[at:at + CHUNK] for s in sets]
        _lay_out(np.concatenate(part), np.repeat(np.arange(len(sets)), [len(p) for p in part]), best)
    return best


def _lay_out(x: np.ndarray, doc: np.ndarray, best: np.ndarray) -> None:
    """Offer the ranks of elements ``x`` of the sets ``doc`` to the registers.

    A permutation starts as the identity and changes by one exchange a step.
    The exchanges so far (place ``swaps[i]`` now holds ``held[i]``) say what
    stands at a place; elements that need more than ``SPARSE_STEPS`` steps,
    those of small sets, get their permutations written out."""
    m = best.shape[1]
    flat = best.reshape(-1)
    swaps, held, order = [], [], None
    alive, going = np.unique(doc), np.zeros(len(best), bool)
    for j in range(m):
        if j:
            alive = alive[best[alive].max(1) >= np.uint64(j << 32)]
            going[:] = False
            going[alive] = True
            active = going[doc]
            left = np.count_nonzero(active)
            if not left:
                return
            if left < 0.7 * len(x):
                x, doc = x[active], doc[active]
                swaps, held = [k[active] for k in swaps], [d[active] for d in held]
                order = None if order is None else order[active]
        rnd = _mixed(x + np.full(1, j + 1, "<u8") * _GOLD)
        k = (((rnd >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)) + np.uint64(j)).astype("<u2")
        if j < SPARSE_STEPS:
            register, here = k.copy(), np.full(len(x), j, "<u2")
            for at, value in zip(swaps, held, strict=True):
                np.copyto(register, value, where=at == k)
                np.copyto(here, value, where=at == j)
            swaps.append(k)
            held.append(here)
        else:
            each = np.arange(len(x))
            if order is None:
                order = np.empty((len(x), m), "<u2")
                order[:] = np.arange(m, dtype="<u2")
                for at, value in zip(swaps, held, strict=True):
                    order[each, at] = value
                swaps, held = [], []
            register = order[each, k]
            order[each, k] = order[:, j]
        place = doc * m + register
        # Ranks of an earlier step are lower than any of this one.
        open_ = np.flatnonzero(flat[place] >= np.uint64(j << 32))
        np.minimum.at(flat, place[open_], np.uint64(j << 32) | (rnd[open_] & np.uint64(0xFFFFFFFF)))


def compact(registers: np.ndarray) -> np.ndarray:
    """16 bits of each register; bucket keys use these."""
    return (_mixed(registers) & np.uint64(0xFFFF)).astype("<u2")


def signature_table(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key, signature and presence bits of every row."""
    def rows(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sig = compact(signatures(sets))
        keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                pa.array(keys, pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary()),
                                pa.array([presence(s) for s in sets], pa.binary())],
                               names=["doc_id", "n_shingles", "set_key", "sig", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small: list[tuple] = []
        for b in slices(batches, 32):
            large = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = shingles(text, words)
                (small if len(found) < SMALL else large).append((doc_id, found))
            if large:
                yield rows(*map(list, zip(*large, strict=True)))
            if len(small) >= TOGETHER:
                yield rows(*map(list, zip(*small, strict=True)))
                small = []
        if small:
            yield rows(*map(list, zip(*small, strict=True)))

    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return x.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary, bits binary")


def _buckets(reps: DataFrame) -> DataFrame:
    """key and doc_id for each band of each signature."""
    key = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                      lambda b: F.xxhash64(b, F.substring("sig", b * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    return reps.select("doc_id", F.explode(key).alias("key"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have ``100 * common >= percent * union``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None  # rows of one b come together
        for batch in slices(batches):
            out_a, out_b = [], []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
                if b != last:
                    last, of_last = b, shingles(tb, words)
                s = shingles(ta, words)
                small, large = sorted((len(s), len(of_last)))
                if 100 * small < percent * large:
                    continue
                common = len(np.intersect1d(s, of_last, assume_unique=True))
                if common and 100 * common >= percent * (small + large - common):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.record_batch([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for all nodes with a link.

    Alternating large-star and small-star steps on stored tables; what reaches
    the driver is a count and a checksum per round."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mixed_buckets(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """Bucket members with their group, of buckets that hold several groups;
    ``main`` is a bucket's largest group, ``blocks`` its number of blocks."""
    named = stored(buckets.join(groups, F.col("doc_id") == F.col("node"), "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("grp")), "bucket-groups")
    per = named.groupBy("key", "grp").agg(F.count("*").alias("n"))
    mixed = per.groupBy("key").agg(F.max(F.struct("n", "grp")).alias("top"), F.sum("n").alias("n"),
                                   F.count("*").alias("groups")).where("groups > 1")
    mixed = mixed.select("key", F.col("top.grp").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    return stored(named.join(mixed, "key"), "mixed-buckets")


def _left_over(buckets: DataFrame, groups: DataFrame, reps: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of different groups that share a bucket and that their
    presence bits do not rule out; if ``best``, the likeliest one for each
    document and other group, else all."""
    rows = _mixed_buckets(buckets, groups)
    bins = max(1, -(-rows.count() // BIN_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    outer = rows.where("grp <> main")
    # Side 0: members outside the main group, for each block of members; side 1: all members.
    asks = outer.select("key", "blocks", "doc_id", "grp", F.col("block").alias("bo"),
                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bm"), F.lit(0).alias("side"))
    outer_blocks = outer.select("key", F.col("block").alias("bo")).distinct()
    has = rows.join(outer_blocks, "key").select("key", "blocks", "doc_id", "grp", "bo", F.col("block").alias("bm"),
                                                F.lit(1).alias("side"))
    # Small buckets share a bin; a pair of blocks of a large one is a group of its own.
    small = F.col("blocks") == 1
    own = [F.when(~small, F.col(c)).alias(f"own_{c}") for c in ("key", "bo", "bm")]
    place = F.when(small, F.pmod(F.xxhash64("key"), F.lit(bins)))
    members = asks.union(has).withColumn("bin", place).join(reps.select("doc_id", "n_shingles", "bits"), "doc_id")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": [], "grp": [], "off": []}, dtype="int64")]
        for _, part in pdf.groupby(["key", "bo", "bm"], sort=False):
            ask, has = part[part["side"] == 0], part[part["side"] == 1]
            if len(ask) and len(has):
                out.append(near_pairs(ask, has, percent, best))
        return pd.concat(out)

    pairs = members.groupBy("bin", *own).applyInPandas(compare, "a long, b long, grp long, off long")
    if best:
        pairs = pairs.groupBy("a", "grp").agg(F.min(F.struct("off", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def presence(shingle_set: np.ndarray) -> bytes:
    """One bit per hash value, 8 to 16 bits per shingle (a power of two)."""
    size = 1 << max(6, (8 * len(shingle_set) - 1).bit_length())
    bits = np.zeros(size, "u1")
    bits[(shingle_set & np.uint64(size - 1)).astype("intp")] = 1
    return np.packbits(bits).tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def near_pairs(ask: pd.DataFrame, has: pd.DataFrame, percent: int, best: bool) -> pd.DataFrame:
    """Pairs of different groups that may reach ``percent``: a bit that only
    one of two sets has stands for at least one element that the other lacks,
    so more such bits than the similarity allows rule a pair out for certain."""
    out = [[], [], [], []]
    by_size = []
    for width, h in has.groupby(has["bits"].str.len()):
        by_size.append((np.frombuffer(b"".join(h["bits"]), "<u8").reshape(len(h), width // 8), h["doc_id"].to_numpy(),
                        h["grp"].to_numpy(), h["n_shingles"].to_numpy()))
    for doc, grp, n, bits in zip(ask["doc_id"], ask["grp"], ask["n_shingles"], ask["bits"], strict=True):
        own = np.frombuffer(bits, "<u8")[None, :]
        found = []
        for theirs, ids, groups_, sizes in by_size:
            ok = (groups_ != grp) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
            if ok.any():
                words = min(own.shape[1], theirs.shape[1])
                differ = np.bitwise_count(_folded(theirs[ok], words) ^ _folded(own, words)).sum(1, dtype="int64")
                off = differ * (100 + percent) - (sizes[ok] + n) * (100 - percent)
                may = off <= 0
                found.append((ids[ok][may], groups_[ok][may], off[may]))
        if found:
            b, g, off = (np.concatenate(c) for c in zip(*found, strict=True))
            if best and len(b):
                order = np.lexsort((b, off, g))
                take = order[np.append(True, g[order][1:] != g[order][:-1])]
                b, g, off = b[take], g[take], off[take]
            for column, v in zip(out, ([doc] * len(b), b, g, off), strict=True):
                column.extend(v)
    return pd.DataFrame(dict(zip(("a", "b", "grp", "off"), out, strict=True)), dtype="int64")


def groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    sigs = stored(signature_table(docs, words), "signatures")
    real = sigs.where("doc_id is not null and n_shingles > 0")
    classes = stored(real.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(real.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
                  .select("doc_id", "n_shingles", "sig", "bits").dropDuplicates(["doc_id"]), "representatives")
    keys = _buckets(reps)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(keys.join(shared, "key"), "buckets")
    degree = buckets.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    ranked = buckets.select("key", "doc_id").join(degree, "doc_id")
    hub = ranked.groupBy("key").agg(F.max(F.struct("degree", -F.col("doc_id"))).alias("h")).select(
        "key", (-F.col("h.col2")).alias("b"))
    stars = buckets.join(hub, "key").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    stars = stored(stars, "stars")
    near = buckets.select("doc_id").distinct()
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(near, "doc_id", "left_semi")
                   .dropDuplicates(["doc_id"]), "texts")
    links = stored(confirmed(stars, texts, words, percent), "links")
    found = stored(components(links), "groups")
    for best in (True, False):  # the likeliest pairs first, then all that are left
        rest = stored(_left_over(buckets, found, reps, percent, best), "left-over")
        links = stored(links.union(confirmed(rest, texts, words, percent)), "links")
        found = stored(components(links), "groups")
    own = sigs.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    out = own.join(found, F.col("rep") == F.col("node"), "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    comp = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))
