import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstrata.llm import mixing as M

VOCAB = {"a": ["alpha", "amber", "arc"], "b": ["blue", "brick", "bend"], "c": ["cold", "clay", "cone"]}


def corpus(n=240, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        d = "aaaaabbc"[i % 8]
        words = list(rng.choice(VOCAB[d], int(rng.integers(5, 60))))
        if i % 7 == 0:
            words += list(rng.choice(VOCAB["c"], 10))
        rows.append((i, " ".join(words), d))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (3, rows[3][1], "x")], "doc_id long, text string, rate string").repartition(3)
    labelled = spark.createDataFrame([(i, d) for i, _, d in rows if i % 2] + [(5000, "a"), (None, "a")], "doc_id long, domain string")
    return rows, docs, labelled


def test_held_out_accuracy(tables):
    rows, _, _ = tables
    c = M.fit_classifier([t for i, t, _ in rows if i % 2], [d for i, _, d in rows if i % 2])
    _, p = c.posteriors(M.pa.array([t for i, t, _ in rows if not i % 2]))
    assert np.mean([c.domains[k] == d for k, (i, _, d) in zip(p.argmax(1), [r for r in rows if not r[0] % 2])]) > 0.9


def test_expected_totals_meet_targets(spark, tables):
    rows, docs, labelled = tables
    weights = {"a": 0.3, "b": 0.4, "c": 0.3}
    found, domains, target = M.mixed_rates(docs.select("doc_id", "text"), labelled, F.col("domain"), weights)
    out = found.collect()
    assert len(out) == len(rows) + 3 and domains == ("a", "b", "c") and all(r.rate >= 0 for r in out)
    total = sum(r.n_tokens for r in out)
    got = [sum(r.rate * r.n_tokens * r.posterior[k] for r in out) / total for k in range(3)]
    assert np.allclose(got, target, atol=2e-3) and np.allclose(target, [0.3, 0.4, 0.3])
    assert {r.rate for r in out if r.n_tokens == 0} == {1.0}
    assert len({(r.rate, tuple(r.posterior)) for r in out if r.doc_id == 3}) == 1


def test_projection_equals_dense_solution(spark, tables):
    _, docs, labelled = tables
    found, _, target = M.mixed_rates(docs.select("doc_id", "text"), labelled, F.col("domain"), {"b": 1.0})
    out = found.filter("n_tokens > 0").collect()
    t = np.array([r.n_tokens for r in out], float) / sum(r.n_tokens for r in out)
    p = np.array([r.posterior for r in out])
    r = np.ones(len(out))
    for _ in range(3000):
        r = np.maximum(0, r - (p @ ((t * r) @ p - target) + M.RIDGE * (r - 1)) / (1 + M.RIDGE))
    mine = np.array([x.rate for x in out])
    objective = lambda v: ((v * t) @ p - target) @ ((v * t) @ p - target) + M.RIDGE * t @ (v - 1) ** 2
    assert objective(mine) <= objective(r) + 2e-3


def optimum(t, p, target, least):
    """The least objective, and rates, by projected gradient steps without Spark."""
    r = y = np.maximum(least, np.ones(len(t)))
    for i in range(20_000):
        new = np.maximum(least, y - (p @ ((t * y) @ p - target) + M.RIDGE * (y - 1)) / (1 + M.RIDGE))
        y, r = new + 0.98 * (new - r), new
    return value(t, p, target, r), r


def value(t, p, target, r):
    e = (t * r) @ p - target
    return e @ e + M.RIDGE * t @ (r - 1) ** 2


def weakly_separable(spark, n=400, seed=2):
    """t, p and the table of members: the last domain is in every text, to a fifth or so."""
    rng = np.random.default_rng(seed)
    p = np.round(rng.dirichlet([2.0, 1.0, 0.8], n), 9)
    t = rng.integers(5, 400, n)
    member = spark.createDataFrame([(i, int(t[i]), [float(x) for x in p[i]]) for i in range(n)], "doc_id long, n_tokens long, posterior array<double>").repartition(3)
    return t / t.sum(), p, member


def test_fit_knows_the_least_rate(spark):
    t, p, member = weakly_separable(spark)
    target = np.array([0.6, 0.35, 0.05]) * (t @ p[:, 2] / 0.05)
    rate = {least: np.array([r.rate for r in M.rates(member, target, least).orderBy("doc_id").collect()]) for least in (0.0, 1.0)}
    best, _ = optimum(t, p, target, 1.0)
    assert rate[0.0].min() < 0.5 and rate[1.0].min() == 1
    bounded, cut = value(t, p, target, rate[1.0]), value(t, p, target, np.maximum(1, rate[0.0]))
    assert bounded < best + 0.5 * (cut - best)


def test_fit_ends_at_the_optimum(spark):
    t, p, member = weakly_separable(spark)
    for target, least in (([0.6, 0.38, 0.02], 0.0), ([0.0, 1.0, 0.0], 0.0), ([3.0, 1.75, 0.25], 1.0), ([0.5, 0.3, 0.2], 0.0)):
        r = np.array([r.rate for r in M.rates(member, np.array(target), least).orderBy("doc_id").collect()])
        best, _ = optimum(t, p, np.array(target), least)
        assert value(t, p, np.array(target), r) <= best + 1e-7


def test_fit_fails_loudly(spark, monkeypatch):
    _, _, member = weakly_separable(spark)
    monkeypatch.setattr(M, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="did not converge"):
        M.rates(member, np.array([0.6, 0.38, 0.02]))


def test_mix_takes_effect_and_keeps_columns(spark, tables):
    rows, docs, labelled = tables
    out = M.mix(docs, labelled, F.col("domain"), {"a": 0.2, "b": 0.4, "c": 0.4}, least=1, cover=True)
    assert out.columns == docs.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(n) == {i for i, _, _ in rows} | {900, 901} and max(n.values()) > 1


def test_empty_tables(spark, tables):
    _, docs, labelled = tables
    assert M.mix(docs.limit(0), labelled, F.col("domain"), {"a": 1.0}).count() == 0
    assert M.mix(docs, labelled.limit(0), F.col("domain"), {"a": 1.0}).count() == docs.count()


def _hash(word):
    """A word's hash by plain integers."""
    mask, base = 2**64 - 1, int(M.B.BASE)
    total = sum(int(M.B.TABLE[b]) * pow(base, i, 2**64) for i, b in enumerate(word)) & mask
    x = (total + len(word) * int(M.B.MULTS[2])) & mask
    for shift, mult in ((30, int(M.B.MULTS[0])), (27, int(M.B.MULTS[1])), (31, 1)):
        x = (x ^ (x >> shift)) * mult & mask
    return x


def test_posteriors_equal_brute_force():
    rows = corpus(60)
    c = M.fit_classifier([t for _, t, _ in rows], [d for _, _, d in rows])
    texts = ["alpha blue\tcold  CLAY", "", None, "x", rows[0][1], "\u00e9t\u00e9 amber"]
    n, p = c.posteriors(M.pa.array(texts))
    for text, size, mine in zip(texts, n, p):
        words = "".join(x.lower() if x.isascii() else x for x in text or "").split()
        z = sum((c.weights[_hash(w.encode()) >> (64 - M.BUCKETS.bit_length() + 1)].astype(float) for w in words), np.zeros(3)) / np.sqrt(max(1, len(words))) + c.prior
        assert size == len(words) and np.allclose(mine, np.exp(z) / np.exp(z).sum())


def test_long_texts_come_in_pieces(monkeypatch):
    rows = corpus(60)
    texts = [t for _, t, _ in rows] + ["", None, "w" * 500]
    whole = M.fit_classifier(texts, [d for _, _, d in rows] + ["a"] * 3)
    n, p = whole.posteriors(M.pa.array(texts))
    monkeypatch.setattr(M.B, "SEGMENT", 64)
    monkeypatch.setattr(M.B.blocks, "__defaults__", (64,))
    monkeypatch.setattr(M.B.cuts, "__defaults__", (64,))
    pieces = M.fit_classifier(texts, [d for _, _, d in rows] + ["a"] * 3)
    assert np.allclose(pieces.weights, whole.weights)
    again, q = pieces.posteriors(M.pa.array(texts))
    assert (again == n).all() and np.allclose(p, q)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "alpha", 3, "x", 9), (2, "blue", 4, "y", 8)], "doc_id long, text string, times int, id string, rate int")
    labelled = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, domain string")
    out = M.mix(docs, labelled, F.col("domain"), {"a": 0.5, "b": 0.5}, least=1)
    assert out.columns == docs.columns and set(out.collect()) == set(docs.collect())
