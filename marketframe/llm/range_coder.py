"""Range coding of token ids with order-0 to order-2 id predictions.

Model.  The order-2 table (hash of the last two ids) and the order-1 table
(last id) each predict one id, with a confidence that grows with hits.  An id
is coded as "the order-2 prediction", "the order-1 prediction" or else by its
order-0 frequency.  The first two probabilities mix three adaptive estimates:
hits seen with this pair of confidences, with the order-2 confidence alone,
and with the order-1 confidence alone.

Coder.  A block is cut into lanes that are coded in step, one numpy operation
for all lanes, each with a range coder of 48 bits that emits 16-bit words.  The
encoder keeps carries in its words and resolves them at the end of the block;
words are stored in the order in which the decoder takes them.
Tables and probabilities adapt between segments (4, 4, 8, ... up to ``STEP``
ids per lane); within one they are fixed, so the decoder has the same ones.
All arithmetic is on integers or on single IEEE operations.

Each block starts from empty tables and carries the crc32 of its ids and words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TKRC"
VERSION = 3
LANES = 4096
PER_LANE = 256
STEP = 64
TABLE_BITS = 18
SLOT_BITS = 18
TOTAL_BITS = 24
#: Steps whose intervals are found at a time.
ROWS = 8
CONFIDENCE = 16
_CONF_BITS, _CONF_MASK = 4, 15
_SPAN_BITS = SLOT_BITS + 2
LEAST_REST = 1 << (SLOT_BITS + 1)
_HEAD = struct.Struct("<4sHIIII")  # magic, version, ids, lanes, vocabulary, crc32
_FULL, _LEAST, _LOW = 1 << 48, 1 << 32, (1 << 32) - 1


class CorruptBlock(ValueError):
    pass


class _Model:
    def __init__(self, vocabulary: int):
        self.vocabulary = vocabulary
        self.count = np.zeros(vocabulary, "int64")
        # Predicted id * CONFIDENCE + confidence.
        self.order1, self.order2 = np.zeros(vocabulary, "int32"), np.zeros(1 << TABLE_BITS, "int32")
        self.seen = np.zeros(CONFIDENCE * CONFIDENCE * 2, "int64")
        self.hit2, self.hit1 = np.zeros_like(self.seen), np.zeros_like(self.seen)
        self._tables()

    def contexts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.astype("int64", copy=False), b.astype("int64", copy=False)
        return ((a * 0x9E3779B1 ^ b * 0x85EBCA6B) >> 7) & ((1 << TABLE_BITS) - 1)

    def look_up(self, a: np.ndarray, ctx2: np.ndarray) -> tuple:
        """Predictions, state number, and widths of both prediction intervals."""
        e1, e2 = self.order1[a], self.order2[ctx2]
        p1, p2 = e1 >> _CONF_BITS, e2 >> _CONF_BITS
        state = ((e2 & _CONF_MASK) << (_CONF_BITS + 1)) + ((e1 & _CONF_MASK) << 1) + (p1 == p2)
        both = self.widths[state]
        return p1, p2, state, both >> 32, both & 0xFFFFFFFF

    def _tables(self) -> None:
        total = int(self.count.sum())
        free = (1 << SLOT_BITS) - self.vocabulary
        freq = 1 + self.count * free // max(total, 1)
        freq[int(self.count.argmax())] += (1 << SLOT_BITS) - int(freq.sum())
        self.freq = freq
        self.span = np.cumsum(freq) - freq << _SPAN_BITS | freq
        shape = (CONFIDENCE, CONFIDENCE, 2)
        seen = self.seen.reshape(shape)

        def mixed(hits: np.ndarray, trials: np.ndarray) -> np.ndarray:
            part = [(hits.sum(ax, keepdims=True) + 0.4) / (trials.sum(ax, keepdims=True) + 1.0) for ax in (1, 0)]
            return (hits + 4.0 * part[0] + 4.0 * part[1]) / (trials + 8.0)

        two = mixed(self.hit2.reshape(shape), seen)
        one = mixed(self.hit1.reshape(shape), seen - self.hit2.reshape(shape))
        room = (1 << TOTAL_BITS) - LEAST_REST
        w2 = np.maximum((two * room).astype("int64"), 1)
        w2[0] = 0  # no order-2 prediction yet
        w1 = np.maximum((one * (room - w2)).astype("int64"), 1)
        w1[:, 0] = 0
        w1[1:, :, 1] = 0  # both predict the same id: one interval
        self.widths = (w2 << 32 | w1).reshape(-1)

    def slots(self) -> np.ndarray:
        """The id of each order-0 slot."""
        return np.repeat(np.arange(self.vocabulary, dtype="int32"), self.freq)

    def order0(self, x: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the ids' intervals in what the predictions leave."""
        both = self.span[x]
        first = both >> _SPAN_BITS
        both &= (1 << _SPAN_BITS) - 1
        both += first
        both *= rest
        both >>= SLOT_BITS
        first *= rest
        first >>= SLOT_BITS
        both -= first
        return first, both

    def intervals(self, x: np.ndarray, p1: np.ndarray, p2: np.ndarray, w2: np.ndarray, w1: np.ndarray) -> tuple:
        """Start and width of the ids' intervals."""
        known = w2 + w1
        begin, width = self.order0(x, (1 << TOTAL_BITS) - known)
        begin += known
        is1 = np.flatnonzero((x == p1) & (w1 > 0))
        begin[is1], width[is1] = w2[is1], w1[is1]
        is2 = np.flatnonzero((x == p2) & (w2 > 0))
        begin[is2], width[is2] = 0, w2[is2]
        return begin, width

    def learn(self, a: np.ndarray, ctx2: np.ndarray, ids: np.ndarray, found: tuple) -> None:
        """Take in a segment, ordered by step and lane, with what ``look_up`` found."""
        p1, p2, state, w2, w1 = found
        right1, right2 = (ids == p1) & (state >> 1 & _CONF_MASK > 0), (ids == p2) & (w2 > 0)
        n = len(self.seen)
        self.seen += np.bincount(state, minlength=n)
        self.hit2 += np.bincount(state[right2], minlength=n)
        self.hit1 += np.bincount(state[right1 & ~right2 & (w1 > 0)], minlength=n)
        self.count += np.bincount(ids, minlength=self.vocabulary)
        entry = (ids << _CONF_BITS | 1).astype("int32")
        for table, ctx, right in ((self.order1, a, right1), (self.order2, ctx2, right2)):
            conf = np.bincount(ctx, np.where(right, 1.0, -1.0), len(table)).astype("int32")
            conf += table & _CONF_MASK
            np.clip(conf, 0, CONFIDENCE - 1, out=conf)
            table &= ~_CONF_MASK
            table |= conf
            fresh = np.flatnonzero((conf == 0)[ctx] & ~right)
            table[ctx[fresh]] = entry[fresh]  # the last one wins
        self._tables()


def _plan(n: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Lanes, and (start, ids, ids per lane) of each segment."""
    lanes = max(1, min(LANES, -(-n // PER_LANE)))
    out, at, step = [], 0, 4
    while at < n:
        size = min(n - at, lanes * step)
        out.append((at, size, -(-size // lanes)))
        at += size
        if len(out) > 1:
            step = min(STEP, step * 2)
    return lanes, out


def _active(size: int, per_lane: int, t: int) -> int:
    """Lanes that have an id at step t; lane l holds ids l * per_lane onward."""
    return (size - t - 1) // per_lane + 1 if size > t else 0


def _steps(part: np.ndarray, per_lane: int) -> np.ndarray:
    """A segment by step and lane; zeros where the last lane has no id."""
    lanes = -(-len(part) // per_lane)
    x = np.zeros(lanes * per_lane, "int64")
    x[:len(part)] = part
    return np.ascontiguousarray(x.reshape(lanes, per_lane).T)


def encode(ids: np.ndarray, vocabulary: int, start_id: int) -> bytes:
    ids = np.asarray(ids, "int64")
    n = len(ids)
    lanes, plan = _plan(n)
    model = _Model(vocabulary)
    low, rng = np.zeros(lanes, "int64"), np.full(lanes, _FULL - 1)
    every = np.arange(lanes, dtype="uint16")
    # Words as they come, and whose they are; the decoder is three words ahead of each lane.
    whose, words = [every] * 3, [np.zeros(3 * lanes, "uint32")]
    for at, size, per_lane in plan:
        part = _steps(ids[at:at + size], per_lane)
        shape = part.shape
        before = np.concatenate([np.full((2, shape[1]), start_id), part])
        a, b, x = before[1:-1].ravel(), before[:-2].ravel(), part.ravel()
        ctx2 = model.contexts(a, b)
        found = p1, p2, _, w2, w1 = model.look_up(a, ctx2)
        for t in range(per_lane):
            if t % ROWS == 0:
                some = slice(t * shape[1], (t + ROWS) * shape[1])
                begin, width = (i.reshape(-1, shape[1]) for i in model.intervals(*(i[some] for i in (x, p1, p2, w2, w1))))
            k = _active(size, per_lane, t)
            r = rng[:k] >> TOTAL_BITS
            low[:k] += r * begin[t % ROWS, :k]  # bit 48 is a carry
            r *= width[t % ROWS, :k]
            rng[:k] = r
            who = np.flatnonzero(r < _LEAST)
            while len(who):
                lw = low[who]
                whose.append(who.astype("uint16"))
                words.append((lw >> 32).astype("uint32"))
                low[who] = (lw & _LOW) << 16
                rg = rng[who] << 16
                rng[who] = rg
                who = who[rg < _LEAST]
        if at + size < n:
            model.learn(a, ctx2, x, found)
    taken = sum(map(len, whose))
    for tail in (low >> 32, low >> 16 & 0xFFFF, low & 0xFFFF):
        whose.append(every)
        words.append(tail.astype("uint32"))
    order = np.argsort(np.concatenate(whose), kind="stable")
    words = np.concatenate(words)[order]
    carry = np.flatnonzero(words > 0xFFFF)
    while len(carry):
        words[carry] -= 1 << 16
        carry -= 1
        words[carry] += 1
        carry = carry[words[carry] > 0xFFFF]
    body = np.empty(taken, "<u2")
    at = np.flatnonzero(order < taken)
    body[order[at]] = words[at + 3]
    tail = struct.pack("<I", start_id) + (body.tobytes() if n else b"")
    return _HEAD.pack(MAGIC, VERSION, n, lanes if n else 0, vocabulary, _checksum(ids, tail)) + tail


def _checksum(ids: np.ndarray, tail: bytes) -> int:
    """Of the ids and of what follows the head of their block."""
    return zlib.crc32(tail, zlib.crc32(ids.astype("<u4").tobytes()))


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; raises CorruptBlock if it isn't whole."""
    try:
        magic, version, n, lanes, vocabulary, crc = _HEAD.unpack_from(block)
        (start_id,) = struct.unpack_from("<I", block, _HEAD.size)
    except struct.error as e:
        raise CorruptBlock("block is cut short") from e
    if magic != MAGIC or version != VERSION or (lanes, n) != (_plan(n)[0] if n else 0, n):
        raise CorruptBlock("not a block of this format")
    ids = np.zeros(n, "int64")
    if n:
        at = _HEAD.size + 4
        if (len(block) - at) % 2 or len(block) - at < 6 * lanes:
            raise CorruptBlock("block is cut short")
        _decode(ids, np.frombuffer(block, "<u2", offset=at), vocabulary, start_id)
    if _checksum(ids, block[_HEAD.size:]) != crc:
        raise CorruptBlock("checksum differs")
    return ids


def _decode(ids: np.ndarray, stream: np.ndarray, vocabulary: int, start_id: int) -> None:
    lanes, plan = _plan(len(ids))
    model = _Model(vocabulary)
    first = stream[:3 * lanes].astype("int64").reshape(3, lanes)
    code, pos = first[0] << 32 | first[1] << 16 | first[2], 3 * lanes
    rng = np.full(lanes, _FULL - 1)
    for at, size, per_lane in plan:
        shape = (per_lane, -(-size // per_lane))
        before = np.full((per_lane + 2, shape[1]), start_id)
        part, ctx = before[2:], np.empty(shape, "int64")
        slots = model.slots()
        found = [np.empty(shape, kind) for kind in ("int32", "int32", "int32", "int64", "int64")]
        for t in range(per_lane):
            k = _active(size, per_lane, t)
            a = before[t + 1, :k]
            ctx2 = model.contexts(a, before[t, :k])
            p1, p2, _, w2, w1 = row = model.look_up(a, ctx2)
            r = rng[:k] >> TOTAL_BITS
            # Whole numbers below 2^53: the float quotient has the exact floor.
            v = np.clip((code[:k] / r).astype("int64"), 0, (1 << TOTAL_BITS) - 1)  # a damaged block may leave the range
            known = w2 + w1
            rest = (1 << TOTAL_BITS) - known
            over = v - known
            slot = (((np.maximum(over, 0) + 1 << SLOT_BITS) - 1) / rest).astype("int64")
            x = slots[np.minimum(slot, (1 << SLOT_BITS) - 1)].astype("int64")
            begin, width = model.order0(x, rest)
            begin += known
            hit = np.flatnonzero(over < 0)
            if len(hit):
                h2 = w2[hit]
                is2 = v[hit] < h2
                x[hit] = np.where(is2, p2[hit], p1[hit])
                begin[hit] = np.where(is2, 0, h2)
                width[hit] = np.where(is2, h2, w1[hit])
            begin *= r
            code[:k] -= begin
            width *= r
            rng[:k] = width
            who = np.flatnonzero(width < _LEAST)
            while len(who):
                end = pos + len(who)
                if end > len(stream):
                    raise CorruptBlock("block is cut short")
                code[who] = code[who] << 16 | stream[pos:end]
                pos = end
                rg = rng[who] << 16
                rng[who] = rg
                who = who[rg < _LEAST]
            part[t, :k] = x
            if at + size < len(ids):
                ctx[t] = ctx2
                for all_rows, values in zip(found, row, strict=True):
                    all_rows[t] = values
        ids[at:at + size] = part.T.ravel()[:size]
        if at + size < len(ids):
            model.learn(before[1:-1].ravel(), ctx.ravel(), part.ravel(), tuple(f.ravel() for f in found))
    if pos != len(stream):
        raise CorruptBlock("block is too long")
