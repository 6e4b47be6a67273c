import os
import re

import numpy as np

from inkstrata.llm import _shared as S
from inkstrata.llm import line_dedup as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(line):
    w = WORD.findall(line)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    first = {}
    for i, t in sorted(r for r in rows if r[0] is not None and r[1] is not None):
        for ln, x in enumerate(t.split("\n")):
            if len(WORD.findall(x)) >= 5:
                first.setdefault(x, (i, ln))
    order = sorted(first, key=first.get)
    sets = [grams(x) for x in order]
    gone = {x for b, x in enumerate(order) if any(10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) for a in range(b))}
    kept = {first[x] for x in order if x not in gone}
    return {i: [ln for ln, x in enumerate((t or "").split("\n")) if len(WORD.findall(x)) >= 5 and (i, ln) not in kept] for i, t in rows if i is not None}


def corpus(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [list(rng.choice(vocabulary, int(rng.integers(3, 60)))) for _ in range(14)]
    rows = []
    for d in rng.permutation(60):
        lines = []
        for _ in range(int(rng.integers(1, 9))):
            b = list(bases[int(rng.integers(14))])
            for _ in range(int(rng.integers(0, 3))):
                b[int(rng.integers(len(b)))] = str(rng.choice(vocabulary))
            lines.append(rng.choice([" ", "  ", "\t"]).join(b))
        rows.append((int(d) * 2, "\n".join([*lines, "", "short line"])))
    return [*rows, (500, None), (501, ""), (502, "\n\n"), (503, "a b c d e " * 4000)]


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, tokens string").repartition(3)
    got = D.dedup_lines(docs).collect()
    assert len(got) == len(rows) and all(r.tokens == "keep" for r in got)
    want = brute(rows)
    texts = dict(rows)
    for r in got:
        if r.doc_id is None:
            continue
        assert list(r["__removed"]) == want[r.doc_id], r.doc_id
        t = texts[r.doc_id]
        assert r.text == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(want[r.doc_id])))


def test_equals_brute_force(spark):
    for seed in (1, 2):
        check(spark, corpus(seed))


def test_frequency_classes_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(D, "slots", lambda *found: [int("".join(map(str, rng.integers(0, 8, 16))), 16) for _ in range(1 << (S.SLOT_BITS - 4))])
    check(spark, corpus(3))


def test_frequent_tokens_come_last(spark, monkeypatch):
    monkeypatch.setattr(D, "FREQUENT", 2)
    monkeypatch.setattr(D, "BLOCK", 3)
    check(spark, corpus(5))


def test_sketches_lose_no_match(spark):
    rng = np.random.default_rng(8)
    sets = [rng.integers(0, 2**60, int(rng.integers(1, 300))).tolist() for _ in range(30)]
    sets += [x[: len(x) - len(x) // 5] + rng.integers(0, 2**60, len(x) // 9).tolist() for x in sets]
    rows = {r.p: [r[c] for c in D.SKETCH_OF] for r in D.sketches(spark.createDataFrame(list(enumerate(sets)), "p long, x array<long>")).collect()}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            differ = sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(rows[i], rows[j]))
            assert differ <= len(set(x) ^ set(y))


def test_rounds_and_struct_places_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(D, "FEW", 0)
    monkeypatch.setattr(D, "ROUNDS", 3)
    monkeypatch.setattr(D.Places, "over", classmethod(lambda cls, docs, id_col, text_col: cls("bigint")))
    check(spark, corpus(6))


def test_any_id_kind(spark):
    line = "one two three four five six"
    docs = spark.createDataFrame([("b", line), ("a", f"x\n{line}"), (None, line)], "doc_id string, text string")
    assert {r.doc_id: list(r["__removed"]) for r in D.dedup_lines(docs).collect()} == {"a": [], "b": [0], None: []}
    far = spark.createDataFrame([(2**63 - 1, line), (-(2**63), f"x\n{line}")], "doc_id long, text string")
    assert {r.doc_id: list(r["__removed"]) for r in D.dedup_lines(far).collect()} == {-(2**63): [], 2**63 - 1: [0]}


def test_very_long_words(spark):
    import time

    word = "Aa0+" * 250_000
    rows = [(1, word), (2, f"{word} b\n{word} b c d e"), (3, f" {word} b c d  e\n" + "a b c d e " * 10)]
    began = time.time()
    got = {r.doc_id: list(r["__removed"]) for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), short=True).collect()}
    assert got == {1: [], 2: [], 3: [0]} and time.time() - began < 60


def test_clashing_columns(spark):
    line = "one two three four five six"
    docs = spark.createDataFrame([(1, line, 7, "x", "y"), (2, line, 8, "x", "y")], "doc_id long, text string, __kept int, id string, __n_lines string")
    got = {r.doc_id: (r.text, r["__kept"], r.id, r["__n_lines"]) for r in D.dedup_lines(docs).collect()}
    assert got == {1: (line, 7, "x", 1), 2: ("", 8, "x", 1)}


def test_repeated_rows_null_ids_and_empty_table(spark):
    line = "one two three four five six"
    rows = [(4, f"{line}\nx"), (4, f"{line}\nx"), (5, line), (None, line)]
    got = sorted((r.doc_id or 0, r.text) for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, line), (4, f"{line}\nx"), (4, f"{line}\nx"), (5, "")]
    assert D.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_collapse_where_asked_for(spark):
    line = "one two three four five six"
    rows = [(1, f"Les.\n{line}\na b c d\n\n"), (2, f"Les.\n{line}\na  b c d\n\nb a"), (3, "les.\nb a\nb a")]
    got = {r.doc_id: list(r["__removed"]) for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), short=True).collect()}
    assert got == {1: [], 2: [0, 1, 2], 3: [1, 2]}


def test_tokens_are_equal_where_shingles_are(spark):
    rng = np.random.default_rng(9)
    lines = [" ".join(rng.choice(["a", "b", "ab", "é"], int(rng.integers(1, 12)))) for _ in range(300)]
    docs = spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")
    each = D.Lines(docs, "doc_id", "text", 1, D.Places("bigint", 0, 1 << 20)).each()
    got = {r.line: r.x for r in D.with_tokens(each, "line").collect()}
    shingles = {x: grams(x) or {tuple(x.split(" "))} for x in lines}
    assert all(len(got[x]) == len(shingles[x]) for x in lines)
    assert len({t for x in lines for t in got[x]}) == len({g for x in lines for g in shingles[x]})


def test_few_tables_stand_beside_the_sets(spark, monkeypatch):
    """Prefixes, and postings that nothing shares, are deleted before the largest tables are made."""
    write, folder = D.written, S.shared_dir(spark).removeprefix("file://")
    before, beside = set(os.listdir(folder)) if os.path.isdir(folder) else set(), {}

    def listed(df, name):
        beside[name] = sorted(x.split("-")[1] for x in set(os.listdir(folder)) - before) if os.path.isdir(folder) else []
        return write(df, name)

    monkeypatch.setattr(D, "written", listed)
    D.dedup_lines(spark.createDataFrame(corpus(1), "doc_id long, text string")).count()
    assert beside["sets"] == ["hubs", "lines", "pairs", "places", "postings"]
