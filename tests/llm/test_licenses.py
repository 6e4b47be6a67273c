from inkstrata.llm import licenses as L


def words(text):
    return L.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w = words(text)
    places = [(i, label) for p, label in L.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


MIT = dict(L.TEMPLATES)["mit-text"]
TEXTS = [
    None,
    "",
    " .,; ",
    "GNU General Public License, the gnu general public licensed GNU GENERAL public License cc-by CC BY",
    "mit mit license license mit  License apache\nlicense ccby cc by by",
    "été mit lic ense MIT_License Àpache license",
    " ".join(["word"] * 30000) + " apache license " + "tail " * 10000 + "mit license",
    "before " + MIT + " after",
    "before " + MIT.replace("hereby", "now hereby").replace("without restriction", "with no restriction") + " after",
    " ".join(MIT.split()[:8]),
]


def test_base_places_equal_brute_force(spark):
    rows = [(i, t, "n") for i, t in enumerate([*TEXTS, TEXTS[3], TEXTS[3]])] + [(None, TEXTS[4], "n")]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string, hash string").repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        base = [s for s in r.spans if s.base]
        starts = [s.first_word for s in base]
        text = TEXTS[4] if r.doc_id is None else rows[r.doc_id][1]
        assert (r.n_words, len(base), min(starts, default=None), max(starts, default=None), sorted({s.label for s in base})) == brute(text), r.doc_id


def test_templates_are_found_with_changed_words(spark):
    got = {r.doc_id: {s.label: s for s in r.spans} for r in L.scan(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}
    assert got[7]["mit-text"].coverage == 1.0 and (got[7]["mit-text"].first_word, got[7]["mit-text"].last_word) == (1, len(words(MIT)))
    assert 0.6 < got[8]["mit-text"].coverage < 1.0
    assert "mit-text" not in got[9]


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
