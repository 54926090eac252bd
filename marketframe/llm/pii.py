"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from the patterns below (leftmost, non-overlapping per kind,
failing matches dropped).  The field labels tokens (runs without ASCII white
space) as other, email, ip, card or phone.  Tokens without a digit, ``@`` or
``+`` can't be any of these kinds and are fixed to "other", so inference on
the remaining ones is exact for the whole text.  Neighbouring tokens share a
chain potential; tokens whose letters and digits repeat an earlier token's, or
end with the same ``SIMILAR`` digits, share a skip potential with the one
before, however far away.  Tokens in base spans are observed.  Loopy belief
propagation spreads their labels; what it labels besides becomes added spans.

Weights are fitted by pseudo-likelihood on a bounded sample of whole texts:
the ``SAMPLE_DOCS`` with such tokens and the lowest hash of the id, in that
order, as many as fit into ``SAMPLE_BYTES`` (one that does not is passed over),
with the base spans as labels (none is learned where a pattern ran over several
tokens and failed).

Edge cases: a null text is empty; a text without matches has no spans; long
texts are scanned whole, in time linear in their length, and inference holds a
few hundred bytes per token that no pattern decides; repeated rows get the
same spans; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 16 << 20
SIMILAR = 7
SURE = 0.7
BUCKETS = 1 << 10
#: Agreement of repeated tokens that the skip weights start from and are drawn
#: to; few texts of a sample repeat such tokens.
AGREEMENT = 2.0
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@+]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int, int]  # kind number, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern's leftmost matches, but in linear time: from each @ the
    local part reaches back to the last match, the domain forward."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [(0, s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def unclear_spans(text: str) -> list[tuple[int, int]]:
    """Failed matches that run over several tokens: a number and its neighbour
    taken together.  They say nothing about either, so no label is learned."""
    out = [m.span() for m in _CARD.finditer(text) if " " in m[0]]
    return out + [m.span() for m in _PHONE.finditer(text)]


@dataclass
class Nodes:
    """The tokens of a text that the field decides on."""
    spans: list[tuple[int, int]]
    features: np.ndarray  # nodes x features, numbers below BUCKETS
    label: np.ndarray  # base label, 0 where none
    observed: np.ndarray
    chain: np.ndarray  # pairs of nodes
    skip: np.ndarray


def _shape(token: str) -> str:
    s = re.sub(r"[0-9]", "9", token)
    s = re.sub(r"[^\W\d_]+", "a", s)
    return re.sub(r"9{4,}", "9*", s)[:24]


def _bucket(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode("utf-8", "surrogatepass"), digest_size=4).digest(),
                          "little") % BUCKETS


def nodes(text: str, base: list[Span]) -> Nodes | None:
    """Tokens, features, observed labels and edges of a text."""
    spans, at = [], 0
    while m := _SIGN.search(text, at):
        start = m.start()
        while start > 0 and not _SPACE.match(text, start - 1):
            start -= 1
        at = _NOT_SPACE.match(text, m.start()).end()
        spans.append((start, at))
    if not spans:
        return None
    label, observed = np.zeros(len(spans), "int64"), np.zeros(len(spans), bool)
    starts = [s for s, _ in spans]
    for kind, s, e in sorted(base, key=lambda x: -x[0]):
        i = max(0, int(np.searchsorted(starts, s, "right")) - 1)
        while i < len(spans) and spans[i][0] < e:
            if spans[i][1] > s:
                label[i], observed[i] = kind + 1, True
            i += 1
    features, chain, skip = [], [], []
    last: dict[str, int] = {}
    for i, (s, e) in enumerate(spans):
        token = text[s:e]
        digits = "".join(c for c in token if c in "0123456789")
        near = i > 0 and spans[i - 1][1] + 1 >= s
        if near:
            chain.append((i - 1, i))
        before = _shape(text[spans[i - 1][0]:spans[i - 1][1]]) if near else ""
        after = "near" if i + 1 < len(spans) and e + 1 >= spans[i + 1][0] else ""
        features.append([_bucket("bias"), _bucket("shape", _shape(token)), _bucket("digits", min(len(digits), 20)),
                         _bucket("signs", "@" in token, token[0] == "+", token.count(".") >= 3, "(" in token),
                         _bucket("luhn", 13 <= len(digits) <= 19 and luhn(digits)), _bucket("before", before, after)])
        keys = ["".join(c for c in token.lower() if c.isalnum())]
        if len(digits) >= SIMILAR:
            keys.append("#" + digits[-SIMILAR:])
        if len(digits) >= 4 or "@" in token:
            for j in {last[k] for k in keys if k in last}:
                skip.append((j, i))
            last.update((k, i) for k in keys)
    pairs = lambda p: np.array(p, "int64").reshape(-1, 2)
    return Nodes(spans, np.array(features, "int16"), label, observed, pairs(chain), pairs(skip))


@dataclass
class Model:
    unary: np.ndarray  # BUCKETS x labels
    chain: np.ndarray  # labels x labels, left to right
    skip: np.ndarray  # labels x labels, symmetric


def fit(sample: list[Nodes], steps: int = 150, rate: float = 0.5, ridge: float = 1e-3) -> Model | None:
    """Pseudo-likelihood: each token given its neighbours' labels; AdaGrad."""
    if not sample:
        return None
    size = len(LABELS)
    offset = np.cumsum([0] + [len(s.label) for s in sample])
    y = np.concatenate([s.label for s in sample])
    clear = y >= 0
    y = np.maximum(y, 0)
    x = np.concatenate([s.features for s in sample])
    chain = np.concatenate([s.chain + o for s, o in zip(sample, offset, strict=False)])
    skip = np.concatenate([s.skip + o for s, o in zip(sample, offset, strict=False)])
    chain, skip = (e[clear[e].all(1)] for e in (chain, skip))
    one = np.eye(size)[y]
    prior = [np.zeros((BUCKETS, size)), np.zeros((size, size)), AGREEMENT * np.eye(size)]
    params = [q.copy() for q in prior]
    past = [np.full_like(p, 1e-6) for p in params]
    for _ in range(steps):
        unary, c, k = params
        score = unary[x].sum(1)
        np.add.at(score, chain[:, 1], c[y[chain[:, 0]]])
        np.add.at(score, chain[:, 0], c.T[y[chain[:, 1]]])
        np.add.at(score, skip[:, 1], k[y[skip[:, 0]]])
        np.add.at(score, skip[:, 0], k[y[skip[:, 1]]])
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(1, keepdims=True)
        d = (p - one) * clear[:, None] / len(y)
        g = [ridge * (q - q0) / len(y) for q, q0 in zip(params, prior, strict=True)]
        for f in range(x.shape[1]):
            np.add.at(g[0], x[:, f], d)
        np.add.at(g[1], y[chain[:, 0]], d[chain[:, 1]])
        back = np.zeros((size, size))
        np.add.at(back, y[chain[:, 1]], d[chain[:, 0]])
        g[1] += back.T
        both = np.zeros((size, size))
        np.add.at(both, y[skip[:, 0]], d[skip[:, 1]])
        np.add.at(both, y[skip[:, 1]], d[skip[:, 0]])
        g[2] += (both + both.T) / 2
        for q, gq, h in zip(params, g, past, strict=True):
            h += gq * gq
            q -= rate * gq / np.sqrt(h)
    return Model(*params)


#: Edges whose messages are worked out at a time.
EDGES = 1 << 16


def _sums(own: np.ndarray, target: np.ndarray, message: np.ndarray) -> np.ndarray:
    """``own`` with every message added at its target."""
    return own + np.stack([np.bincount(target, message[:, k], len(own)) for k in range(own.shape[1])], 1)


def marginals(n: Nodes, model: Model, rounds: int = 30, damping: float = 0.5) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product messages.

    An observed node sends a constant, so it joins its neighbours' own scores;
    messages are kept between free nodes only."""
    size = len(LABELS)
    free = np.flatnonzero(~n.observed)
    own = np.concatenate([np.zeros((0, size))] + [model.unary[n.features[free[at:at + EDGES]]].sum(1) for at in range(0, len(free), EDGES)])
    number = np.full(len(n.observed), -1, "int32")
    number[free] = np.arange(len(free), dtype="int32")
    sources, targets, sent = [], [], []
    for edges, potential in ((n.chain, model.chain), (n.skip, model.skip)):
        for i, j, table in ((edges[:, 0], edges[:, 1], potential), (edges[:, 1], edges[:, 0], potential.T)):
            known = n.observed[i] & ~n.observed[j]
            own = _sums(own, number[j[known]], table[n.label[i[known]]])
            both = ~n.observed[i] & ~n.observed[j]
            sources.append(number[i[both]])
            targets.append(number[j[both]])
            sent.append(np.exp(table))
    if sum(map(len, sources)):
        source, target = np.concatenate(sources), np.concatenate(targets)
        ends = np.cumsum([0] + [len(x) for x in sources])
        # Each direction of an edge stands right after or before the other.
        back = np.concatenate([np.arange(ends[k], ends[k + 1], dtype="int32") for k in (1, 0, 3, 2)])
        message = np.zeros((len(source), size), "float32")
        for _ in range(rounds):
            belief, change = _sums(own, target, message), 0.0
            new = np.empty_like(message)
            for kind, table in enumerate(sent):
                for at in range(ends[kind], ends[kind + 1], EDGES):
                    part = slice(at, min(at + EDGES, ends[kind + 1]))
                    x = belief[source[part]] - message[back[part]]
                    x -= x.max(1, keepdims=True)
                    out = np.log(np.maximum(np.exp(x) @ table, 1e-300))
                    out -= np.log(np.exp(out - out.max(1, keepdims=True)).sum(1, keepdims=True)) + out.max(1, keepdims=True)
                    change = max(change, float(np.abs(out - message[part]).max()))
                    new[part] = damping * message[part] + (1 - damping) * out
            message = new
            if change < 1e-3:
                break
        own = _sums(own, target, message)
    own -= own.max(1, keepdims=True)
    p = np.eye(size)[n.label] * n.observed[:, None]
    p[free] = np.exp(own) / np.exp(own).sum(1, keepdims=True)
    return p


def find(text: str | None, model: Model | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the field adds, in code points."""
    text = text or ""
    base = base_spans(text) if _SIGN.search(text) else []
    n = nodes(text, base) if model is not None and _SIGN.search(text) else None
    if n is None or n.observed.all():
        return base, []
    p = marginals(n, model)
    label = np.where(p.max(1) >= SURE, p.argmax(1), 0)
    joined = {tuple(e) for e in n.chain.tolist()}
    added: list[Span] = []
    for i, kind in enumerate(label.tolist()):
        if not kind or n.observed[i]:
            continue
        s, e = n.spans[i]
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        if s == e:
            continue
        if added and (i - 1, i) in joined and not n.observed[i - 1] and label[i - 1] == kind:
            added[-1] = (kind - 1, added[-1][1], e)
        else:
            added.append((kind - 1, s, e))
    return base, added


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def training_nodes(text: str) -> Nodes | None:
    """Nodes with label -1 where the base leaves the label open."""
    n = nodes(text, base_spans(text))
    if n is not None:
        unclear = unclear_spans(text)
        for i, (s, e) in enumerate(n.spans):
            if not n.observed[i] and any(a < e and s < b for a, b in unclear):
                n.label[i] = -1
    return n


def sample(docs: DataFrame, size: int = SAMPLE_DOCS, total: int = SAMPLE_BYTES) -> DataFrame:
    """The texts that the weights are fitted on; at most ``size`` ids, each with
    its first text, and ``total`` bytes."""
    with_signs = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@+]"))
    row = with_signs.select("doc_id", F.xxhash64("doc_id").alias("h"), F.octet_length("text").alias("bytes"),
                            F.xxhash64("text").alias("which"))
    chosen, left = {}, total
    for r in row.orderBy("h", "doc_id", "which").limit(size).collect():
        if r.doc_id not in chosen and r.bytes <= left:
            chosen[r.doc_id] = r.which
            left -= r.bytes
    ids = docs.sparkSession.createDataFrame(list(chosen.items()), "doc_id long, which long")  # at most size rows
    found = with_signs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.where(F.xxhash64("text") == F.col("which")).select("doc_id", "text")


def train(docs: DataFrame, size: int = SAMPLE_DOCS) -> Model | None:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for doc_id, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                n = training_nodes(t or "")
                if n is not None:
                    out.append((doc_id, n.features.reshape(-1).tolist(), n.label.tolist(),
                                n.chain.reshape(-1).tolist(), n.skip.reshape(-1).tolist()))
            many = pa.list_(pa.int64())
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64(), many, many, many, many], strict=True)],
                                  names=["doc_id", "x", "y", "chain", "skip"])

    rows = sample(docs, size).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        extract, "doc_id long, x array<long>, y array<long>, chain array<long>, skip array<long>").collect()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id, r.x))
    return fit([Nodes([], np.array(r.x).reshape(len(r.y), -1), np.array(r.y), np.zeros(len(r.y), bool),
                      np.array(r.chain, "int64").reshape(-1, 2), np.array(r.skip, "int64").reshape(-1, 2))
                for r in rows])


def detect(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with base counts, base_sha256 and spans."""
    x = docs.select(*keep, F.col("text").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x 5 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            counts, sha, spans = [], [], []
            for t in b.column("_text").to_pylist():
                base, added = find(t, shared.value)
                counts.append([sum(k == i for k, _, _ in base) for i in range(len(KINDS))])
                sha.append(hashlib.sha256(digest(base).encode()).hexdigest())
                spans.append(digest(base + added))
            yield pa.record_batch([*[b.column(c) for c in keep], *[pa.array(c, pa.int64()) for c in zip(*counts, strict=True)],
                                   pa.array(sha), pa.array(spans)],
                                  names=[*keep, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.drop("_text").schema)
    return x.mapInArrow(run, f"{fields}, n_email long, n_ip long, n_card long, n_phone long, "
                             "base_sha256 string, spans string")


def mask(text: str | None, model: Model | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans become one, named after the first."""
    if text is None:
        return None
    base, added = find(text, model)
    out, at = [], 0
    for kind, s, e in sorted(base + added, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind]}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def masked(docs: DataFrame, model: Model | None) -> DataFrame:
    """documents with masked texts and their new n_chars."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            text = [mask(t, shared.value) for t in b.column("text").to_pylist()]
            new = {"text": text, "n_chars": [None if t is None else len(t) for t in text]}
            yield pa.record_batch([pa.array(new[c], b.column(c).type) if c in new else b.column(c) for c in names],
                                  names=names)

    return docs.mapInArrow(run, docs.schema)
