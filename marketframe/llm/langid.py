"""Language identification with string kernels.

Kernel: the blended spectrum of character n-grams (n = 1, 2, 3) by presence,
``k(x, z) = mean over n of |N_n(x) & N_n(z)| / sqrt(|N_n(x)| |N_n(z)|)``, n-grams
hashed into fixed spaces.  Training is one-versus-rest kernel ridge regression
on Nystroem landmarks, over every row with a known label outside the held-out
fold: tasks add up each language's kernel values and their products in whole
numbers, so the sums don't depend on how rows are dealt.  The landmarks are only
the basis of the regression: ``LANDMARKS`` of those rows, in turn from each language
and slice the lowest hashes of the id.  Since the kernel is linear in each
normalised presence vector, the landmark sums fold into one matrix per n, and
whole texts are scored as batched matrix products of presence rows.

A task and the driver hold LANDMARKS^2 numbers for each language.

The language column, source and id are never inputs of a prediction.

Edge cases: a null text or one without letters is ``und`` with score 0; without
a single training row every text is ``und`` with score 0; long texts are
hashed piecewise, in bounded memory; repeated rows are scored alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import fold, slices

UND = "und"
#: Hash space of the n-grams of each length.
SPACES = {1: 1 << 10, 2: 1 << 13, 3: 1 << 15}
WIDTH = sum(SPACES.values())
#: Rows per language that the landmarks are chosen from.
PER_LANG = 500
#: Slices by hash of the id that a language's candidates are drawn from, so that
#: no task ranks a whole language.
SLICES = 8
LANDMARKS = 256
RIDGE = 1e-2
PIECE = 1 << 20
#: Kernel values are summed as multiples of 1 / UNIT; products of 2^31 rows fit.
UNIT = 1 << 16
#: Rows of the matrix of products that travel together, and the number of
#: partial sums that a matrix is added up from last.
BAND, PARTIAL = 32, 64
#: A character is known if this share of a language's training rows have it.
KNOWN_ROWS = 1 / 500
#: Lengths in characters from which each rejection threshold holds, the quantile
#: of the held-out scores, and the steps that scores are counted in; a threshold
#: lies midway between the quantile and the least possible score.
LENGTHS = (0, 12, 24, 48, 96, 192)
QUANTILE = 0.01
STEPS = 1 << 14
#: Least share of a text's distinct letters that training texts have.
KNOWN_LETTERS = 0.5
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def mark(text: str, row: np.ndarray) -> None:
    """Set the presence entries of all n-grams of the lower-cased text."""
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at:at + PIECE + 2].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        start, h = 0, np.zeros(len(codes), "<u4")
        for n, space in SPACES.items():
            if len(codes) < n:
                break
            h = h[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:] * _MIX[n - 1]
            row[start + ((h * _MIX[2]) >> np.uint32(32 - space.bit_length() + 1))] = 1
            start += space


def presence(texts: list[str]) -> np.ndarray:
    """One row per text: presence of hashed n-grams, each n of unit length."""
    out = np.zeros((len(texts), WIDTH), "float32")
    for row, t in zip(out, texts, strict=True):
        mark(t, row)
    return normalised(out)


def normalised(rows: np.ndarray) -> np.ndarray:
    start = 0
    for space in SPACES.values():
        part = rows[:, start:start + space]
        part /= np.sqrt(np.maximum(part.sum(1, keepdims=True), 1) * len(SPACES))
        start += space
    return rows


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # WIDTH x languages
    bias: np.ndarray
    known: np.ndarray | None = None  # characters' entries that training rows have

    def known_letters(self, text: str) -> float:
        """Share of the text's distinct letters that training rows have."""
        letters = "".join(sorted({c for c in text.lower() if c.isalpha()}))
        row = np.zeros(WIDTH, "u1")
        mark(letters, row)
        own = row[:SPACES[1]] > 0
        return 1.0 if self.known is None else float((own & self.known).sum() / max(1, own.sum()))

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        margin = presence(texts) @ self.weights + self.bias
        best = margin.argmax(1)
        return best, np.clip((1 + margin[np.arange(len(best)), best]) / 2, 0, 1)


def unpacked(bits: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(bits), "u1").reshape(len(bits), -1), axis=1, count=WIDTH)


class Landmarks:
    """Kernel values of presence rows with the landmarks, the same to the last
    bit whichever rows are given together: common n-grams are counted."""

    def __init__(self, bits: list[bytes]):
        self.parts = []
        start, rows = 0, unpacked(bits)
        for space in SPACES.values():
            part = rows[:, start:start + space]
            used = np.flatnonzero(part.any(0))
            self.parts.append((start, space, used + start, np.ascontiguousarray(part[:, used].T, "float32"),
                               np.maximum(part.sum(1, dtype="int64"), 1)))
            start += space

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        out = 0.0
        for start, space, used, columns, size in self.parts:
            own = np.maximum(rows[:, start:start + space].sum(1, dtype="int64"), 1)
            both = rows[:, used].astype("float32") @ columns
            out = out + both.astype("float64") / np.sqrt(own[:, None] * size) / len(SPACES)
        return out


class Sums:
    """Of one language: training rows, rows with each character entry, sums of
    the kernel values (times UNIT, whole) and of their products."""

    def __init__(self, landmarks: int):
        self.n = 0
        self.known = np.zeros(SPACES[1], "int64")
        self.first = np.zeros(landmarks, "int64")
        self.second = np.zeros((landmarks, landmarks), "int64")

    def add(self, rows: np.ndarray, kernel: np.ndarray) -> None:
        whole = np.rint(kernel * UNIT)
        self.n += len(rows)
        self.known += rows[:, :SPACES[1]].sum(0, dtype="int64")
        self.first += whole.sum(0).astype("int64")
        self.second += (whole.T @ whole).astype("int64")  # exact: less than 2^53


def solve(bits: list[bytes], sums: dict[str, Sums], ridge: float = RIDGE) -> Model | None:
    """Ridge regression on the features of the landmarks ``bits``, in which each
    language weighs the same, whatever its share of the rows."""
    names = sorted(sums)
    if not names:
        return None
    known = np.max([sums[g].known >= max(1, KNOWN_ROWS * sums[g].n) for g in names], 0)
    if len(names) == 1:
        return Model(names, np.zeros((WIDTH, 1), "float32"), np.ones(1), known)
    rows = unpacked(bits)
    value, vec = np.linalg.eigh(Landmarks(bits).kernel(rows))
    keep = value > 1e-8 * value.max()
    root = vec[:, keep] / np.sqrt(value[keep])
    mean = np.array([sums[g].first / UNIT / sums[g].n for g in names]) @ root
    square = sum(sums[g].second / UNIT**2 / sums[g].n for g in names) / len(names)
    y = 2 * np.eye(len(names)) - 1
    x0, y0 = mean.mean(0), y.mean(0)
    both = mean.T @ y / len(names) - np.outer(x0, y0)
    beta = np.linalg.solve(root.T @ square @ root - np.outer(x0, x0) + ridge / len(names) * 1e-1 * np.eye(root.shape[1]), both)
    z = normalised(rows.astype("float32"))
    return Model(names, (z.T @ (root @ beta)).astype("float32"), y0 - x0 @ beta, known)


def fit(bits: list[bytes], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """The model of packed presence rows at hand, the first ``landmarks`` of which
    are the landmarks."""
    sums: dict[str, Sums] = {}
    basis = Landmarks(bits[:landmarks]) if bits else None
    for at in range(0, len(bits), 128):
        add(sums, basis, unpacked(bits[at:at + 128]), langs[at:at + 128])
    return solve(bits[:landmarks], sums, ridge)


def add(sums: dict[str, Sums], basis: Landmarks, rows: np.ndarray, langs: list[str]) -> None:
    kernel, own = basis.kernel(rows), np.array(langs, dtype=object)
    for g in set(langs):
        sums.setdefault(g, Sums(kernel.shape[1])).add(rows[own == g], kernel[own == g])


def lowest(known: DataFrame, per_lang: int) -> DataFrame:
    """doc_id, lang and rank r of the rows with the lowest hashes in each of a
    language's slices; every task keeps only such rows before the shuffle."""
    each = -(-per_lang // SLICES)
    rank = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("h", "doc_id"))
    return (known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
            .withColumn("slice", F.pmod("h", F.lit(SLICES))).withColumn("r", rank)
            .where(F.col("r") <= each).select("doc_id", "lang", "r"))


def labelled(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def marked(texts: list[str]) -> np.ndarray:
    rows = np.zeros((len(texts), WIDTH), "u1")
    for row, t in zip(rows, texts, strict=True):
        mark(t, row)
    return rows


def landmark_rows(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS) -> list[bytes]:
    """Packed presence rows of the landmarks.  Ids are ranked first
    (per-partition top rows only are shuffled), texts fetched after."""
    known = labelled(docs).where(fold() != 0)
    ids = lowest(known, per_lang).select("doc_id", "r").distinct()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            packed = [x.tobytes() for x in np.packbits(marked(texts), axis=1)]
            ok = [has_letters(t) for t in texts]
            yield pa.record_batch([b.column("r"), b.column("lang"), pa.array(packed, pa.binary()), pa.array(ok)],
                                  names=["r", "lang", "bits", "ok"])

    # At most per_lang ids for each language.
    chosen = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id")
    rows = chosen.select("r", "lang", "text").mapInArrow(bits, "r int, lang string, bits binary, ok boolean").where("ok")
    return [bytes(r.bits) for r in rows.orderBy("r", "lang", "bits").limit(landmarks).collect()]


PART = "lang string, band int, n long, numbers binary"


def _parts(sums: dict[str, Sums]) -> Iterator[pa.RecordBatch]:
    """Band -1 has the counts and sums, the others rows of the products."""
    for g, s in sums.items():
        bands = [np.concatenate([s.known, s.first]), *(s.second[at:at + BAND] for at in range(0, len(s.second), BAND))]
        for k, x in enumerate(bands):
            yield pa.record_batch([pa.array([g]), pa.array([k - 1], pa.int32()), pa.array([s.n]), pa.array([x.tobytes()])],
                                  names=["lang", "band", "n", "numbers"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the same language and band added up."""
    found: dict[tuple, list] = {}
    for b in batches:
        for lang, band, n, raw in zip(*(b.column(c).to_pylist() for c in ("lang", "band", "n", "numbers")), strict=True):
            own = found.setdefault((lang, band), [0, np.int64(0)])
            own[0] += n
            own[1] = own[1] + np.frombuffer(raw, "int64")
    for (lang, band), (n, x) in found.items():
        yield pa.record_batch([pa.array([lang]), pa.array([band], pa.int32()), pa.array([n]), pa.array([x.tobytes()])],
                              names=["lang", "band", "n", "numbers"])


def training_sums(docs: DataFrame, bits: list[bytes]) -> dict[str, Sums]:
    """The sums of every language over all its training rows."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # packed landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, sums = Landmarks(shared.value), {}
        for b in slices(batches):
            rows = [(t, g) for t, g in zip(*(b.column(c).to_pylist() for c in ("text", "lang")), strict=True) if has_letters(t)]
            if rows:
                add(sums, basis, marked([t for t, _ in rows]), [g for _, g in rows])
        yield from _parts(sums)

    parts = labelled(docs).where(fold() != 0).select("text", "lang").mapInArrow(run, PART)
    some = parts.repartition("lang", "band", F.spark_partition_id() % PARTIAL).mapInArrow(_added, PART)
    out: dict[str, Sums] = {}
    for r in some.repartition("lang", "band").mapInArrow(_added, PART).collect():
        own, x = out.setdefault(r.lang, Sums(len(bits))), np.frombuffer(r.numbers, "int64")
        if r.band < 0:
            own.n, own.known, own.first = r.n, x[:SPACES[1]], x[SPACES[1]:]
        else:
            own.second[r.band * BAND:(r.band + 1) * BAND] = x.reshape(-1, len(bits))
    return out


def train(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS) -> Model | None:
    bits = landmark_rows(docs, per_lang, landmarks)
    return solve(bits, training_sums(docs, bits)) if bits else None


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with ``lang_pred`` and ``score``."""
    x = docs.select(*keep, F.col("text").alias("_text"))
    if model is None:
        return x.drop("_text").withColumns({"lang_pred": F.lit(UND), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH x languages numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.langs, dtype=object)
        for b in slices(batches):
            texts = b.column("_text").to_pylist()
            real = np.array([has_letters(t) for t in texts])
            lang, value = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
            if real.any():
                best, s = m.predict([t for t, ok in zip(texts, real, strict=True) if ok])
                lang[real], value[real] = names[best], s
            yield pa.record_batch([*[b.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(value)],
                                  names=[*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.drop("_text").schema)
    return x.mapInArrow(score, f"{fields}, lang_pred string, score double")


def thresholds(docs: DataFrame, model: Model | None) -> np.ndarray:
    """The least score that is accepted from each of ``LENGTHS`` on, from all
    labelled rows of the held-out fold, cut to such lengths."""
    least = np.zeros(len(LENGTHS))
    if model is None:
        return least
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            for k, n in enumerate(LENGTHS):
                # As long as the shortest texts that the threshold holds for.
                cut = [t[:max(n, 4)] for t in texts if len(t) >= n]
                cut = [t for t in cut if has_letters(t)]
                if cut:
                    step = np.rint(shared.value.predict(cut)[1] * STEPS).astype("int64")
                    yield pa.record_batch([pa.array(np.full(len(cut), k)), pa.array(step)], names=["place", "step"])

    # At most STEPS + 1 counts for each length.
    counts = (labelled(docs).where(fold() == 0).select("text").mapInArrow(scores, "place long, step long")
              .groupBy("place", "step").count().collect())
    floor = 1 / len(model.langs)
    for k in range(len(LENGTHS)):
        own = sorted((r.step, r["count"]) for r in counts if r.place == k)
        if own:
            least[k] = min(1.0, floor + (counted_quantile(own, QUANTILE) / STEPS - floor) / 2)
    return least


def counted_quantile(counts: list[tuple[int, int]], q: float) -> float:
    """The quantile, as numpy's, of values that come with their counts."""
    value, count = np.array(counts).T
    ends = np.cumsum(count)
    at = q * (ends[-1] - 1)
    low, high = value[np.searchsorted(ends, [np.floor(at), np.ceil(at)], "right")]
    return float(low + (at - np.floor(at)) * (high - low))


def accepted(docs: DataFrame, model: Model | None, least: float | np.ndarray, letters: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has letters and, if there is a model, a
    language with a score of at least ``least`` (one number, or one for each
    of ``LENGTHS``) and at least the share ``letters`` of known letters."""
    limits = np.broadcast_to(least, len(LENGTHS))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            ok = np.array([has_letters(t) for t in texts])
            if shared.value is not None and ok.any():
                real = [t for t, x in zip(texts, ok, strict=True) if x]
                own = limits[np.searchsorted(LENGTHS, [len(t) for t in real], "right") - 1]
                likely = shared.value.predict(real)[1] >= own
                ok[ok] = likely & np.array([not letters or shared.value.known_letters(t) >= letters for t in real])
            yield b.filter(pa.array(ok))

    return docs.mapInArrow(keep, docs.schema)
