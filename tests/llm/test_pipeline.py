import corpus_pipeline as P
import numpy as np


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choice(vocabulary, 40)) for _ in range(30)]
    rows = [(i, "\n".join([base[i % 30], " ".join(rng.choice(vocabulary, 60))]), "en", "s", 0) for i in range(40)]
    rows += [(100, rows[3][1], "en", "s", 0), (101, rows[4][1] + " tail", "en", "s", 0), (102, "", "en", "s", 0), (103, None, "en", "s", 0), (104, "%%% " * 60, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 5 and 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, str(tmp_path)), name)
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "pack_sequences":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert seen["quality_rules"] == set(range(40)) | {100, 101}
    assert 100 not in seen["dedup_lines"] and set(range(30)) <= seen["dedup_lines"]
    assert seen["near_duplicates"] >= set(range(30)) and seen["mix_sources"] == seen["near_duplicates"] == seen["pack_sequences"]
    assert P.run(spark, str(tmp_path)).count() == docs.count()


def test_exact_copy_with_a_short_line_leaves(spark, tmp_path):
    text = "Les.\n" + " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, " ".join(f"v{i}" for i in range(40)), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in P.dedup_lines(spark, docs, str(tmp_path)).collect()} == {1, 3}


def test_mix_has_the_production_weights(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    asked = []
    monkeypatch.setattr(P.mixing, "mix", lambda docs, labels, domain, weights, **options: asked.append(weights) or docs)
    P.mix_sources(spark, spark.range(1), str(tmp_path))
    assert asked == [P.mixing.WEIGHTS]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, words int, row int, times int, text2 string"


def edge_rows():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    prose = [" ".join(rng.choice(vocabulary, 50)) for _ in range(6)]
    long = "\n".join(" ".join(rng.choice(vocabulary, 80)) for _ in range(600))
    word = "x" * 300_000
    rows = [(1, prose[0]), (2, prose[1]), (2, prose[1]), (3, None), (4, ""), (5, " \n\t"), (6, long), (7, long + " end"), (8, prose[2] + " " + word), (9, prose[0]), (None, prose[3]), (11, prose[4] + "\n\n" + prose[5])]
    return [(i, t, "en", None if i == 1 else "s", len(t or ""), "i", 1, 2, 3, "t") for i, t in rows]


def test_every_stage_on_edge_cases(spark, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in (1, 2, 6)] + [(11, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    got = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got[name] = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
        assert all((r.id, r.words, r.row, r.times, r.text2) == ("i", 1, 2, 3, "t") for r in out.collect())
    ids = {k: [i for i, _ in v] for k, v in got.items()}
    assert ids["quality_rules"] == [0, 1, 2, 2, 6, 7, 9, 11]  # 8 is one word of 300,000 letters and little else
    assert ids["dedup_lines"] == [0, 1, 2, 2, 3, 4, 5, 6, 8, 11]
    assert ids["near_duplicates"] == [0, 1, 2, 2, 3, 4, 5, 6, 8, 11]
    assert set(ids["mix_sources"]) == {0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11}
    packed = P.pack_sequences(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11}


def test_every_stage_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def near_brute(rows, k=5):
    words = {i: (t or "").lower().split() for i, t in rows}
    sets = {i: {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set() for i, w in words.items()}
    first = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((first[i], first[j]))
                first = {x: a if y == b else y for x, y in first.items()}
    return {i for i in sets if first[i] == i}


def test_stages_equal_brute_force(spark, tmp_path):
    from tests.llm.test_line_dedup import WORD, grams
    from tests.llm.test_quality import brute as counts

    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(900)]
    base = ["\n".join(" ".join(rng.choice(vocabulary, int(rng.integers(3, 30)))) for _ in range(int(rng.integers(1, 6)))) for _ in range(25)]
    texts = [base[int(rng.integers(25))] for _ in range(60)]
    texts = [t if rng.random() < 0.4 else " ".join(w if rng.random() > 0.03 else "new" for w in t.split(" ")) for t in texts]
    rows = list(enumerate([*texts, "$$ %% ## " * 30, "same words here " * 30, None]))
    # quality rules
    kept = []
    for i, t in rows:
        n, chars, symbols, _, repeated = counts(t)
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        if n >= 20 and 100 * repeated <= 30 * n and 100 * symbols <= 20 * n and 2 * n <= chars <= 25 * n and not (len(lines) >= 4 and 100 * (len(lines) - len(set(lines))) > 50 * len(lines)):
            kept.append((i, t))
    # line dedup, short lines too
    first, after = {}, []
    for i, t in kept:
        for ln, x in enumerate(t.split("\n")):
            if WORD.search(x):
                first.setdefault(x, (i, ln))
    order = sorted(first, key=first.get)
    sets = [grams(x) or {tuple(WORD.findall(x))} for x in order]
    stay = {first[x] for b, x in enumerate(order) if not any(10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) for a in range(b))}
    for i, t in kept:
        lines = t.split("\n")
        left = [x for ln, x in enumerate(lines) if not WORD.search(x) or (i, ln) in stay]
        if len(left) == len(lines) or any(WORD.search(x) for x in left):
            after.append((i, "\n".join(left)))
    unique = near_brute(after)

    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    one = P.quality_rules(spark, docs, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in one.collect()) == kept
    two = P.dedup_lines(spark, one, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in two.collect()) == after
    assert {r.doc_id for r in P.near_duplicates(spark, two, str(tmp_path)).collect()} == unique
