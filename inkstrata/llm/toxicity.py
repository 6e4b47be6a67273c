"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (with word bounds), hashed into one table; a window of words is their average; a softmax on it says toxic or not. Table and softmax are learned
together, on windows: first every window carries its text's label, then a toxic text answers by its most toxic
window alone. A text's logit is its largest window's, put on the scale of probabilities on labelled texts kept out
of the fit. Since the model is linear behind the average, scoring adds one number per subword; a misspelling
shares most n-grams with the word that it hides.

Learning reads a bounded sample: TRAIN_DOCS labelled texts, those of smallest id hash, whole up to TRAIN_WINDOWS windows
and that many windows of longer ones, drawn over the whole text. Scoring reads every text to its end, in pieces that
share the words of a window; memory is bounded by a piece, and by the longest word.

Defined results: null and empty texts, and texts without words, score 0.0; repeated rows get equal scores, as equal
texts do; null labels and labels of unknown texts are ignored; without usable labels every score is 0.0;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import _bytes as B
from inkstrata.llm._shared import tidy
from inkstrata.session import table

TRAIN_DOCS = 2000
#: Of a labelled text with more windows, so many are learned from, drawn by a hash over the whole text; and of a word so
#: many bytes.
TRAIN_WINDOWS, TRAIN_WORD = 2048, 256
BUCKETS = 1 << 18
DIM = 4
NGRAMS = (3, 4, 5, 6)
WINDOW = 12
#: Steps of the two phases, like RATE and WINDOW chosen by cross-validation within rows that are not held out.
STEPS = (60, 30)
RATE = 0.03
SEED = 7


def _spaced(texts: pa.Array) -> pa.Array:
    """Each text between two spaces: every word has its bounds in its own text."""
    return pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()).fill_null(""), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))


def subwords(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """First word of each text (and one more), word hashes, and (word, bucket) pairs of all subwords by n-gram length."""
    starts, ends, first = B.words(buf, offsets, B.NOT_ALNUM)
    hashes = B.word_hashes(buf, starts, ends)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    pairs = []
    short = np.flatnonzero(ends - starts < min(NGRAMS) - 2)  # too short for an n-gram: the word itself
    pairs.append((short, (B.mix(hashes[short]) >> shift).astype(np.int64)))
    i = 0
    while i < len(starts):  # by segments, whatever a text's length
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + B.SEGMENT, "right")))
        lo, hi = int(starts[i]) - 1, int(ends[j - 1]) + 1
        part = np.where(B.NOT_ALNUM[buf[lo:hi]], np.uint8(0x20), buf[lo:hi])
        n = hi - lo
        mark = np.zeros(n, np.int32)
        mark[starts[i:j] - 1 - lo] = 1
        word = np.cumsum(mark) - 1
        limit = (ends[i:j] - lo + 1)[word]
        with np.errstate(over="ignore"):
            up, down = B.powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(B.TABLE[part] * up[:n], out=sums[1:])
            for k in NGRAMS:
                at = np.flatnonzero(np.arange(k, n + 1) <= limit[: n - k + 1]) if n >= k else np.zeros(0, np.int64)
                grams = (sums[at + k] - sums[at]) * down[at]
                pairs.append((word[at].astype(np.int64) + i, (B.mix(grams + np.uint64(k)) >> shift).astype(np.int64)))
        i = j
    return first, hashes, pairs


@dataclass(frozen=True)
class Model:
    """Per bucket the difference of the two logits; slope and shift put a text's largest window on a probability."""

    weights: np.ndarray
    slope: float
    shift: float

    def logits(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The largest window's logit of each text; -inf without words."""
        first, hashes, pairs = subwords(buf, offsets)
        n = len(hashes)
        total, count = np.zeros(n), np.zeros(n)
        for word, bucket in pairs:
            total += np.bincount(word, self.weights[bucket], n)
            count += np.bincount(word, minlength=n)
        out = np.full(len(offsets) - 1, -np.inf)
        if not n:
            return out
        sums = np.concatenate([[0.0], np.cumsum(total / np.maximum(count, 1))])
        sizes = np.diff(first)
        last, begin = np.repeat(first[1:], sizes), np.repeat(first[:-1], sizes)
        i = np.arange(n)
        value = sums[np.minimum(i + WINDOW, last)] - sums[i]
        value[(i + WINDOW > last) & (i > begin)] = -np.inf
        some = sizes > 0
        out[some] = np.maximum.reduceat(value, first[:-1][some])
        return out

    def long_logit(self, buf: np.ndarray) -> float:
        """The largest window's logit of one spaced text, in pieces: each begins WINDOW - 1 words before its own."""
        out, begin = -np.inf, 0
        for _, end in B.cuts(buf, B.NOT_ALNUM):
            part = buf[begin : end + 1]  # with the delimiter that ends the last word
            starts = B.words(part, np.array([0, len(part)]), B.NOT_ALNUM)[0]
            if len(starts) < WINDOW and end < len(buf):
                continue  # too few words for a window yet
            out = max(out, float(self.logits(part, np.array([0, len(part)]))[0]))
            begin += int(starts[-min(WINDOW - 1, len(starts))]) - 1 if len(starts) else 0
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        buf, offsets = B.buffers(_spaced(texts))
        z = np.full(len(offsets) - 1, -np.inf)
        for i, j in B.blocks(offsets):
            part = B.LOWER[buf[offsets[i] : offsets[j]]]
            z[i:j] = self.long_logit(part) if j == i + 1 and len(part) > B.SEGMENT else self.logits(part, offsets[i : j + 1] - offsets[i])
        some = np.isfinite(z)
        z = np.where(some, z, 0.0)
        return np.where(some, np.round(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40))), 6), 0.0)


class _Adam:
    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.m, self.v, self.t = value, rate, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        self.value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Model:
    """Fit on four fifths of the texts, put on the scale of probabilities on the rest."""
    y = np.asarray(labels, np.int64)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, -40.0 if not y.any() else 40.0)
    rng = np.random.default_rng(seed)
    buf, offsets = B.buffers(_spaced(pa.array(texts, pa.large_string())), lower=True)
    starts, ends, first = B.words(buf, offsets, B.NOT_ALNUM)
    unique, at, word = np.unique(B.word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    word = word.astype(np.int32)
    # subwords of each distinct word once: what training holds follows the vocabulary of a bounded sample
    spelled = pa.array([buf[starts[i] : ends[i]].tobytes() for i in at], pa.binary()).cast(pa.string())
    pairs = subwords(*B.buffers(_spaced(spelled)))[2]
    owner = np.concatenate([w for w, _ in pairs]).astype(np.int32)
    bucket = np.concatenate([b for _, b in pairs]).astype(np.int32)
    del pairs
    order = np.argsort(owner, kind="stable")
    owner, bucket = owner[order], bucket[order]
    count = np.bincount(owner, minlength=len(unique)).astype(np.float32)
    begins = np.searchsorted(owner, np.arange(len(unique)))

    sizes = np.diff(first)
    windows = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(texts)), windows)
    w0 = np.concatenate([np.arange(a, b, WINDOW) for a, b in zip(first[:-1], first[1:])]) if windows.sum() else np.zeros(0, np.int64)
    lengths = np.diff(np.append(w0, len(starts)))
    held = rng.permutation(len(texts)) % 5 == 0

    # a subword's step is its gradient over the root of its frequency: chance in rare subwords moves them little
    table_ = rng.normal(0, 0.05, (DIM, BUCKETS)).astype(np.float32)
    pace = np.zeros_like(table_)
    root = np.sqrt(np.maximum(np.bincount(bucket, (np.bincount(word, minlength=len(unique)) / count)[owner], BUCKETS), 1)).astype(np.float32)
    softmax = _Adam(rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), 0.05)
    bias = _Adam(np.zeros(2, np.float32), 0.05)

    def forward() -> tuple[np.ndarray, np.ndarray]:
        x = np.empty((len(w0), DIM), np.float32)
        for d in range(DIM):
            vector = np.add.reduceat(table_[d][bucket], begins) / count
            x[:, d] = np.add.reduceat(vector[word], w0)
        z = x @ softmax.value + bias.value
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return x, p / p.sum(1, keepdims=True)

    def descend(weight: np.ndarray) -> None:
        x, p = forward()
        g = p.copy()
        g[np.arange(len(g)), y[doc]] -= 1
        g *= weight[:, None]
        dx = g @ softmax.value.T
        for d in range(DIM):
            dword = np.bincount(word, np.repeat(dx[:, d], lengths), len(unique)) / count
            pace[d] = 0.9 * pace[d] + np.bincount(bucket, dword[owner], BUCKETS).astype(np.float32) / root
        total = max(weight.sum(), 1)
        softmax.step(x.T @ g / total)
        bias.step(g.sum(0) / total)
        table_[:] -= RATE * pace

    fit = ~held[doc]
    for _ in range(STEPS[0]):
        descend(fit.astype(np.float32))
    for s in range(STEPS[1]):
        if s % 7 == 0:
            _, p = forward()
            top = np.full(len(texts), -1.0)
            np.maximum.at(top, doc, p[:, 1])
            # labels are noisy: a toxic text without a window above nearly all clean texts' windows hardly counts
            clear = top > np.quantile(top[(y == 0) & ~held & (top >= 0)], 0.95) if ((y == 0) & ~held & (top >= 0)).any() else top >= 0
            weight = np.where(y[doc] == 1, np.where(p[:, 1] >= top[doc], np.where(clear[doc], 12.0, 0.5), 0.0), 1.0) * fit
        descend(weight.astype(np.float32))

    weights = ((softmax.value[:, 1] - softmax.value[:, 0]) @ table_).astype(np.float32)
    del table_, pace, owner, bucket, word
    z = Model(weights, 1.0, 0.0).logits(buf, offsets)
    some = np.isfinite(z)
    if not some.any():
        return Model(weights, 0.0, -40.0)
    use = held & some if len(set(y[held & some].tolist())) > 1 else some
    slope, shift = _platt(z[use], y[use])
    return Model(weights, slope, shift)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve through (z, y), by Newton steps with a little ridge."""
    mean, scale = z.mean(), z.std() + 1e-9
    u = np.stack([(z - mean) / scale, np.ones_like(z)], 1)
    t = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(u @ t, -30, 30)))
        h = (u * (p * (1 - p))[:, None]).T @ u + np.diag([0.05, 1e-6])
        step = np.linalg.solve(h, u.T @ (p - y) + np.array([0.05 * t[0], 0]))
        t -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(t[0], 0.0) / scale
    return float(slope), float(t[1] - slope * mean)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drawn_windows(text: str | None) -> str | None:
    """text, or of one with more than TRAIN_WINDOWS windows that many, in order, drawn by a hash of their numbers."""
    if text is None or len(text) <= TRAIN_WINDOWS * WINDOW:
        return text
    buf = B.LOWER[np.frombuffer(text.encode(), np.uint8)]
    parts = [(lo, hi, len(B.words(buf[lo:hi], np.array([0, hi - lo]), B.NOT_ALNUM)[0])) for lo, hi in B.cuts(buf, B.NOT_ALNUM)]
    windows = -(-sum(n for *_, n in parts) // WINDOW)
    if windows <= TRAIN_WINDOWS and max((len(w) for w in text.split()), default=0) <= TRAIN_WORD:
        return text
    taken = np.zeros(windows, bool)
    with np.errstate(over="ignore"):
        taken[np.argsort(B.mix(np.arange(1, windows + 1, dtype=np.uint64) * B.BASE), kind="stable")[:TRAIN_WINDOWS]] = True
    out, before = [], 0
    for lo, hi, n in parts:
        starts, ends, _ = B.words(buf[lo:hi], np.array([0, hi - lo]), B.NOT_ALNUM)
        for k in np.flatnonzero(taken[(before + np.arange(n)) // WINDOW]).tolist():
            out.append(buf[lo + starts[k] : lo + min(ends[k], starts[k] + TRAIN_WORD)].tobytes().decode(errors="ignore"))
        before += n
    return " ".join(out)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = TRAIN_DOCS) -> list:
    """At most limit labelled ids that are not held out, those of smallest hash: (text, label) rows, none left out for its
    length; windows of very long texts are drawn where the texts are."""
    ids = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(limit)
    rows = docs.join(F.broadcast(ids), id_col).filter(F.col(text_col).isNotNull()).select(F.xxhash64(id_col).alias("k"), F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), "label")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("id"), pa.array([drawn_windows(t) for t in b.column("text").to_pylist()], pa.string()), b.column("label")], names=["k", "id", "text", "label"])

    return rows.mapInArrow(tidy(run), "k long, id string, text string, label int").orderBy("k", "id", "text").select("text", "label").limit(2 * limit).collect()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the score of every text."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1)))], names=[id_col, "score"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"`{id_col}` {kind}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = training_sample(docs, table(spark, sf_dir, "labels"))
    model = train([r.text for r in sample], [r.label for r in sample])
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict = {}
