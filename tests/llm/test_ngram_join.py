import re
import time

import numpy as np
from pyspark.sql import functions as F

from inkstrata.llm import components as C
from inkstrata.llm import ngram_join as J


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    forest = C.Forest()
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                forest.union(a, b)
    return {i: (len(sets[i]), forest.find(i)) for i in ids}


def corpus(seed, groups=12, copies=9, words=70):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 40))
    texts = []
    for g in range(groups):
        base = list(rng.choice(vocabulary, int(rng.integers(5, words)))) + (passage if g % 3 == 0 else [])
        for _ in range(copies):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(len(t)))] = str(rng.choice(vocabulary))
            if rng.random() < 0.3:
                t = t[: -int(rng.integers(1, 4))]
            texts.append(" ".join(t))
    texts += [texts[0]] * 5 + ["", None, " \n ", "One two", "one TWO", "one", " ".join(passage), "É é" * 3]
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)) * 3 + 1, texts)]


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(4)
    for num, den in ((85, 100), (80, 100), (60, 100)):
        bands = J.size_bands(num, den, 5000)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
            drop_n = int(rng.integers(0, n // 4 + 1))
            b = np.unique(np.concatenate([a[drop_n:], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if len(b) and den * both >= num * (len(a) + len(b) - both):
                mine, theirs = J.part_keys(a, num, den, bands), J.part_keys(b, num, den, bands)
                shared = [(len(set(x.tolist()) & set(y.tolist())), max(p, q)) for x, p in mine for y, q in theirs]
                assert any(n >= sure for n, sure in shared)


def test_components_equal_brute_force(spark):
    for seed, (k, num, den), unit in ((1, (4, 85, 100), 2_000_000), (2, (5, 80, 100), 300), (3, (2, 60, 100), 2_000_000)):
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(3)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.ngram_components(docs, k=k, num=num, den=den, unit=unit).collect()}
        want = brute(rows, k, num, den)
        assert got == want, [(i, got[i], want[i]) for i in want if got.get(i) != want[i]][:5]


def test_search_finds_all_components_without_spark():
    for seed in range(12):
        rows = brute_rows = [(i, t) for i, t in corpus(seed, 6, 12, 40) if shingles(t, 3)]
        hashed = {}
        for i, t in rows:
            s = np.array(sorted({hash(x) & (2**63 - 1) for x in shingles(t, 3)}), np.uint64)
            hashed[i] = s
        order = sorted(hashed, key=lambda i: (len(hashed[i]), i))
        forest = C.Forest()
        for a, b in J.TOccurrence(order, [hashed[i] for i in order], 70, 100).links():
            assert forest.union(a, b)
        want = brute(brute_rows, 3, 70, 100)
        assert {i: forest.find(i) for i in order} == {i: want[i][1] for i in order}


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (7, "a b c d e"), (8, None)]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 2, 0), (1, 2, 1), (1, 2, 1), (7, 2, 1), (8, 0, 8)]
    assert J.ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_an_id_with_two_texts_hides_no_other(spark):
    base = " ".join(f"w{i}" for i in range(60))
    large = " ".join(f"v{i}" for i in range(300))
    rows = [(1, base), (1, large), (5, base + " tail"), (6, base + " tail end"), (9, large + " tail")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in J.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 57): 1, (1, 297): 1, (5, 58): 1, (6, 59): 1, (9, 298): 1}


def test_first_of_each_keeps_one_of_a_group(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(3, base, "x"), (5, base + " tail", "x"), (9, "other words here", "x"), (2, "", "x")]
    assert {r.doc_id for r in J.first_of_each(spark.createDataFrame(rows, "doc_id long, text string, n string")).collect()} == {2, 3, 9}


def test_long_chains_are_one_component(spark):
    edges = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(9000, 8000), (8000, 8000)], "a long, b long")).repartition(7)
    got = {r.node: r.label for r in C.components(edges).collect()}
    assert len(got) == 3003 and {got[i] for i in range(3001)} == {0} and got[9000] == 8000


def near_copies(seed, bases=1, copies=60, words=120, edits=14, vocabulary=4000):
    """Copies with up to so many words replaced: some link, many are alike but do not."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(bases):
        base = rng.integers(0, vocabulary, words)
        for _ in range(copies):
            t = base.copy()
            at = rng.integers(0, words, int(rng.integers(0, edits)))
            t[at] = rng.integers(0, vocabulary, len(at))
            texts.append(" ".join(f"w{x}" for x in t[: words - int(rng.integers(0, 3))]))
    return [(int(i) + 1, t) for i, t in zip(rng.permutation(len(texts)), texts)]


def in_order(rows, k):
    hashed = {i: np.array(sorted({hash(x) & (2**63 - 1) for x in shingles(t, k)}), np.uint64) for i, t in rows}
    order = sorted(hashed, key=lambda i: (len(hashed[i]), i))
    return order, [hashed[i] for i in order]


def test_differences_from_centres_lose_no_link():
    for seed in range(10):
        rows = near_copies(seed, bases=1 + seed % 4, copies=40 + 5 * seed, edits=8 + seed) + [(9000 + i, t) for i, t in corpus(seed, 4, 6, 40) if shingles(t, 4)]
        order, sets = in_order(rows, 4)
        want = {i: c for i, (_, c) in brute(rows, 4, 85, 100).items()}
        assert len(set(want.values())) > 10
        # without labels, and with some sets that are connected already
        rng = np.random.default_rng(seed)
        for labels in (None, [want[i] if rng.random() < 0.5 else i for i in order]):
            forest = C.Forest()
            for i, label in zip(order, labels or []):
                forest.union(i, label)
            for a, b in J.TOccurrence(order, sets, 85, 100, labels).links():
                assert forest.union(a, b)
            assert {i: forest.find(i) for i in order} == want


def test_many_near_copies_that_do_not_link_are_searched_fast():
    order, sets = in_order(near_copies(5, copies=900, words=390, edits=30), 4)
    began = time.process_time()
    found = list(J.TOccurrence(order, sets, 85, 100).links())
    assert time.process_time() - began < 8
    assert 100 < len(found) < 800


def test_large_groups_of_near_copies_meet_chunk_by_chunk(spark, monkeypatch):
    rows = near_copies(8, copies=120, edits=16) + [(1000 + i, t) for i, t in near_copies(9, copies=20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    searched, search = [], J.search_units

    def noted(units, *args):
        searched.append(units.agg(F.sum("n")).first()[0] or 0)
        return search(units, *args)

    monkeypatch.setattr(J, "search_units", noted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.ngram_components(docs, unit=5000).collect()}
    want = brute(rows, 4, 85, 100)
    assert got == want
    total = sum(n for n, _ in want.values())
    # chunks of half a unit, in up to two size bands, each with the others once
    assert len(searched) == 2 and searched[1] <= 2 * total * 2 * total / 5000
