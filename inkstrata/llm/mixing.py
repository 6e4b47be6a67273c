"""Mixing to target weights by soft membership.

A softmax on hashed words, fitted on a bounded sample of labelled texts, predicts each text's posterior over the
domains. Document rates r >= least (0, or what mix() is asked for) then minimise

    |sum_d r_d a_d - target|^2 + RIDGE * sum_d t_d (r_d - 1)^2,    a_d = t_d * posterior_d, token counts t as shares

where every rate follows from its posterior p and the residual e of the domain sums at the optimum, a few numbers:
r = max(least, 1 - p.e / RIDGE). e is the minimum of a strongly convex function of as many variables as there are
domains, found by Newton steps with a line search: each step is one aggregate over the table of posteriors, nothing
but domain sums reaches the driver, and rates are never stored between steps. The steps end where the projected
gradient of every rate is below TOLERANCE; if they do not get there, the fit fails.

Defined results: null and empty texts have no tokens, the posterior of the sample's shares and rate 1.0; repeated
rows get equal rates; null labels are ignored; a domain without labelled texts has no posterior and cannot be met;
without labelled texts at all every rate is 1.0; an empty table gives an empty result; other columns, whatever their names, pass
through mix() unchanged; texts of any length are read in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import _bytes as B
from inkstrata.llm._shared import tidy, written
from inkstrata.session import table

SAMPLE = 3000
BUCKETS = 1 << 15
STEPS = 40
RIDGE = 1e-4
TOLERANCE = 1e-9
#: Newton steps before the fit fails, and step lengths (halved each time) that one aggregate tries.
MAX_STEPS, LENGTHS = 200, 20


@dataclass(frozen=True)
class Classifier:
    """weights: bucket by domain; prior: the sample's log shares."""

    domains: tuple[str, ...]
    weights: np.ndarray
    prior: np.ndarray

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and its posterior."""
        n, z = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.domains)))
        for i, first, bucket in _bucketed(texts):
            size = np.diff(first)
            some = np.flatnonzero(size)
            n[i : i + len(size)] += size
            for k in range(len(self.domains) if len(some) else 0):
                z[i + some, k] += np.add.reduceat(self.weights[bucket, k].astype(np.float64), first[:-1][some])
        return n, _softmax(z / np.sqrt(np.maximum(n, 1))[:, None] + self.prior)


def _bucketed(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the first text, first word of each text (and one more), and the words' buckets, by blocks of texts; a
    text longer than a block comes in pieces."""
    buf, offsets = B.buffers(texts)
    for i, j in B.blocks(offsets):
        whole = B.LOWER[buf[offsets[i] : offsets[j]]]
        parts = [(0, len(whole))] if j > i + 1 or len(whole) <= B.SEGMENT else B.cuts(whole, B.WHITESPACE)
        for lo, hi in parts:
            at = offsets[i : j + 1] - offsets[i] if j > i + 1 else np.array([0, hi - lo])
            starts, ends, first = B.words(whole[lo:hi], at, B.WHITESPACE)
            yield i, first, _buckets(B.word_hashes(whole[lo:hi], starts, ends))


def counts_of(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The buckets of each text's words, and how many words each has: no more than BUCKETS numbers, whatever a text's length."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(texts))]
    for i, first, bucket in _bucketed(texts):
        for r in range(len(first) - 1):
            found, n = np.unique(bucket[first[r] : first[r + 1]], return_counts=True)
            held, m = out[i + r]
            if len(held):
                found, at = np.unique(np.concatenate([held, found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([m, n])).astype(np.int64)
            out[i + r] = (found, n)
    return out


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    return e / e.sum(1, keepdims=True) if len(z) else z


def fit_classifier(texts: list[str], labels: list[str]) -> Classifier:
    return fit_counts(counts_of(pa.array(texts, pa.large_string())), labels)


def fit_counts(counts: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Classifier:
    """A softmax on bucket counts, by momentum steps scaled by the root of a bucket's frequency."""
    domains = tuple(sorted(set(labels)))
    y = np.array([domains.index(x) for x in labels])
    sizes = np.array([len(b) for b, _ in counts])
    bucket, weight = (np.concatenate([c[i] for c in counts]) for i in (0, 1))
    some = sizes > 0
    begins = (np.cumsum(sizes) - sizes)[some]
    doc = np.repeat(np.arange(len(counts)), sizes)
    scale = 1 / np.sqrt(np.maximum(np.bincount(doc, weight, len(counts)), 1))
    prior = np.log(np.bincount(y, minlength=len(domains)) / len(y))
    root = np.sqrt(np.maximum(np.bincount(bucket, weight * scale[doc] ** 2, BUCKETS), 1e-3))
    w = np.zeros((BUCKETS, len(domains)))
    pace = np.zeros_like(w)
    hot = np.eye(len(domains))[y]
    for _ in range(STEPS):
        z = np.zeros((len(counts), len(domains)))
        for k in range(len(domains) if some.any() else 0):
            z[some, k] = np.add.reduceat(w[bucket, k] * weight, begins)
        g = (_softmax(z * scale[:, None] + prior) - hot) * scale[:, None]
        for k in range(len(domains)):
            pace[:, k] = 0.8 * pace[:, k] + np.bincount(bucket, g[doc, k] * weight, BUCKETS) / root
        w -= 0.01 * pace
    return Classifier(domains, w.astype(np.float32), prior)


def labelled_sample(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, domain: Column, limit: int = SAMPLE) -> list:
    """At most limit ids, those of smallest hash in the labelled table: rows of domain, and the buckets and counts of the
    whole text's words, made where the texts are. domain may read both tables."""
    ids = labelled.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col]).orderBy(F.xxhash64(id_col), id_col).limit(limit)
    rows = docs.join(F.broadcast(ids), id_col).select(F.xxhash64(id_col).alias("k"), F.xxhash64(text_col).alias("t"), F.col(text_col).cast("string").alias("text"), domain.alias("domain"))

    def run(batches):
        for b in batches:
            found = counts_of(b.column("text"))
            lists = [pa.array([c[i] for c in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("t"), b.column("domain"), *lists], names=["k", "t", "domain", "buckets", "counts"])

    counted = rows.filter("domain is not null").withColumn("t", F.coalesce("t", F.lit(0))).mapInArrow(tidy(run), "k long, t long, domain string, buckets array<long>, counts array<long>")
    return counted.orderBy("k", "t", "domain", "buckets").limit(2 * limit).collect()


def memberships(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens and posterior of every row, written."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for b in batches:
            n, p = classifier.posteriors(b.column(1))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * p.shape[1], pa.int32()), pa.array(np.round(p.reshape(-1), 9)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int64)), values], names=[id_col, "n_tokens", "posterior"])

    return written(docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"`{id_col}` {kind}, n_tokens long, posterior array<double>"), "memberships")


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, k)


def _rates(p: np.ndarray, e: np.ndarray, least: float) -> np.ndarray:
    """Rates of documents of posteriors p, at the residual e."""
    return np.maximum(least, 1 - p @ e / RIDGE)


def _sums(t: np.ndarray, p: np.ndarray, e: np.ndarray, least: float) -> np.ndarray:
    """Over documents: the function's value, the domain sums, and the outer products of the posteriors of free rates."""
    u = 1 - p @ e / RIDGE
    free = t * (u > least)
    value = RIDGE * t @ np.where(u > least, u**2 / 2, least * u - least**2 / 2)
    return np.concatenate([[value], (t * np.maximum(least, u)) @ p, ((free[:, None] * p).T @ p).reshape(-1)])


def fit_rates(member: DataFrame, target: np.ndarray, least: float = 0.0) -> np.ndarray:
    """The residual at the optimum; _rates() turns it into rates. target: expected tokens by domain over all tokens."""
    k = len(target)
    total = float(member.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return np.zeros(k)

    def summed(points: list[np.ndarray]) -> np.ndarray:
        def run(batches):
            sums = np.zeros((len(points), 1 + k + k * k))
            for b in batches:
                p, t = _matrix(b.column("posterior"), k), np.asarray(b.column("n_tokens")) / total
                sums += np.array([_sums(t, p, e, least) for e in points])
            from pyspark import TaskContext

            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([sums.reshape(-1).tolist()])], names=["part", "sums"])

        rows = member.select("n_tokens", "posterior").mapInArrow(tidy(run), "part long, sums array<double>").collect()
        return np.sum([r["sums"] for r in sorted(rows, key=lambda r: r["part"])], axis=0).reshape(len(points), -1)

    e, (s,) = np.zeros(k), summed([np.zeros(k)])
    for _ in range(MAX_STEPS):
        gradient = e + target - s[1 : k + 1]
        # p.gradient is what a free rate's own gradient is off by: posteriors sum to 1
        if np.abs(gradient).max() < TOLERANCE:
            return e
        step = -np.linalg.solve(np.eye(k) + s[k + 1 :].reshape(k, k) / RIDGE, gradient)
        value = s[0] + e @ e / 2 + target @ e
        points = [e + step / 2**i for i in range(LENGTHS)]
        found = summed(points)
        for i, (e, s) in enumerate(zip(points, found)):
            if s[0] + e @ e / 2 + target @ e <= value + 1e-4 / 2**i * (gradient @ step) + 1e-14 * (1 + abs(value)):
                break
    raise RuntimeError(f"rates did not converge: domain sums are off by {np.abs(gradient).max():.3g} after {MAX_STEPS} steps")


def rates(member: DataFrame, target: np.ndarray, least: float = 0.0) -> DataFrame:
    """member with rate."""
    e, k, columns = fit_rates(member, target, least), len(target), member.columns

    def run(batches):
        for b in batches:
            r = _rates(_matrix(b.column("posterior"), k), e, least)
            r = np.where(np.asarray(b.column("n_tokens")) > 0, np.round(r, 6), 1.0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(r)], names=[*columns, "rate"])

    return member.mapInArrow(tidy(run), ", ".join(f"`{c}` {t}" for c, t in member.dtypes) + ", rate double")


def mixed_rates(docs: DataFrame, labelled: DataFrame, domain: Column, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", cover: bool = False, least: float = 0.0) -> tuple[DataFrame, tuple[str, ...], np.ndarray]:
    """(id, n_tokens, posterior, rate), the domains, and the target shares. weights: wanted share of each domain.

    The total stays what it is; with cover it is the least at which no domain has to shrink. No rate is below least.
    """
    sample = labelled_sample(docs, labelled, id_col, text_col, domain)
    if not sample:
        plain = docs.select(id_col, F.lit(0).cast("long").alias("n_tokens"), F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"))
        return plain, (), np.zeros(0)
    classifier = fit_counts([(np.array(r["buckets"], np.int64), np.array(r["counts"], np.int64)) for r in sample], [r["domain"] for r in sample])
    member = memberships(docs, classifier, id_col, text_col)
    want = np.array([max(0.0, weights.get(d, 0.0)) for d in classifier.domains])
    target = want / want.sum() if want.sum() else np.full(len(want), 1 / len(want))
    if cover:
        row = member.agg(F.sum("n_tokens").alias("t"), *(F.sum(F.col("n_tokens") * F.col("posterior")[i]).alias(f"s{i}") for i in range(len(target)))).first()
        share = np.array([row[f"s{i}"] or 0.0 for i in range(len(target))]) / max(1, row["t"] or 0)
        target = target * max([s / w for s, w in zip(share, target) if w > 0 and s > 0], default=1.0)
    return rates(member, target, least), classifier.domains, target


def mix(docs: DataFrame, labelled: DataFrame, domain: Column, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text", least: int = 0, cover: bool = False) -> DataFrame:
    """docs with each row as often as its rate says: the fraction is rounded by a hash of the id; least: times at least,
    which the fit knows as a bound on the rates."""
    found, _, _ = mixed_rates(docs, labelled, domain, weights, id_col, text_col, cover, least)
    chance = F.pmod(F.xxhash64("id", F.lit("mix")), F.lit(1 << 20)) / F.lit(1 << 20)
    rates_of = found.select(F.col(id_col).alias("id"), "rate").groupBy("id").agg(F.max("rate").alias("rate"))
    times = rates_of.select("id", F.greatest(F.lit(least), F.floor(F.col("rate") + chance)).cast("int").alias("times"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("key"))
    joined = rows.join(times, F.col("key").eqNullSafe(F.col("id")), "left").withColumn("times", F.coalesce("times", F.lit(1))).filter("times > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


#: Production mix: prose by language, and little of what is labelled as low in quality.
WEIGHTS = {"en": 0.50, "fr": 0.18, "de": 0.18, "es": 0.12, "low": 0.02}


def production_domain() -> Column:
    return F.when(F.col("quality") == 0, "low").otherwise(F.col("lang"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, domains, target = mixed_rates(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality"), production_domain(), WEIGHTS)
    return found.select("doc_id", "n_tokens", "rate", *(F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)), *(F.lit(float(t)).alias(f"target_{d}") for d, t in zip(domains, target)))


QUERIES = {"op9_mixing": op9_mixing}
ORACLES: dict = {}
