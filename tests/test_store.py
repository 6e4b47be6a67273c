import pytest
from pyspark.sql import functions as F

from inkstrata import schemas
from inkstrata.operators import export, extract, pipeline, store
from inkstrata.sources.pages import parse_pages
from tests.test_sources import FULL


def empty(spark):
    return store.Store(*(schemas.empty(spark, n) for n in ("articles", "evidence", "versions")), fetch_log=schemas.empty(spark, "fetch_log"), merge_decisions=schemas.empty(spark, "merge_decisions"))


def drafts(spark, *rows):
    df = spark.createDataFrame([(i, u, s, t) for i, (u, s, t) in enumerate(rows)], "seq int, canonical_url string, source_id string, title string")
    kinds = [(f.name, f.dataType) for f in schemas.empty(df.sparkSession, "evidence").schema]
    one = F.struct(*(F.col("title").alias(n) if n == "extracted_text" else F.lit(None).cast(k).alias(n) for n, k in kinds))
    return df.select("seq", "canonical_url", "source_id", "title", *(F.lit(None).cast("string").alias(c) for c in ("author_hint", "published_at", "snippet")), F.array(one).cast(f"array<{schemas.EVIDENCE}>").alias("evidence"))


def state(s):
    return sorted((r.canonical_url, r.source_id, r.title, r.version) for r in s.articles.collect()), sorted((r.extracted_text, r.run_id) for r in s.evidence.collect())


def settled(s, folder, n):
    """Written and read again, as a run leaves it: plans of many runs never stack up."""
    store.commit(s, str(folder / "st"), n)
    return store.load(s.articles.sparkSession, str(folder / "st"))


def test_upsert_versions_and_rollback(spark, tmp_path):
    s = empty(spark)
    counts = []
    states = []
    for i, d in enumerate([[("u", "s", "A")], [("u", "s", "A")], [("u", "s", "B"), ("v", "s", "x")], [("u", "t", "A")]], 1):
        s = store.upsert(s, drafts(spark, *d), f"run-{i}", f"t{i}")
        counts.append(tuple(s.counts["changes"].first()))
        s = settled(s, tmp_path, i)
        states.append(state(s))
    assert counts == [(1, 0), (0, 0), (1, 1), (1, 0)]
    assert sorted((r.version, r.run_id) for r in s.versions.collect()) == [(1, "run-1"), (1, "run-3"), (1, "run-4"), (2, "run-3")]
    assert states[2] == ([("u", "s", "B", 2), ("v", "s", "x", 1)], [("B", "run-3"), ("x", "run-3")])
    back = store.rollback(s, "run-4")
    assert back.counts["articles_deleted"].first().n == 1
    back = settled(back, tmp_path, 5)
    assert state(back) == states[2]
    assert state(store.rollback(back, "run-3")) == states[1]
    assert state(store.rollback(s, "run-2")) == states[3]  # a run that changed nothing
    middle = store.rollback(s, "run-1")
    assert ("u", "s", "B", 2) in state(middle)[0]
    assert state(store.rollback(s, "none")) == states[3]


def test_drafts_of_one_key_apply_in_order(spark):
    s = store.upsert(empty(spark), drafts(spark, ("u", "s", "A"), ("u", "s", "A"), ("u", "s", "B"), ("u", "s", "A")), "r", "t")
    assert state(s)[0] == [("u", "s", "A", 3)] and sorted(r.version for r in s.versions.collect()) == [1, 2, 3]


def test_commit_and_load(spark, tmp_path):
    s = store.upsert(empty(spark), drafts(spark, ("u", "s", "A")), "r", "t")
    store.commit(s, str(tmp_path / "st"), 1)
    held = store.load(spark, str(tmp_path / "st"))
    store.commit(store.upsert(held, drafts(spark, ("u", "s", "B")), "r2", "t2"), str(tmp_path / "st"), 2)
    assert state(store.load(spark, str(tmp_path / "st")))[0] == [("u", "s", "B", 2)]
    runs = spark.createDataFrame([("r", "COMPLETED", None), ("q", "COMPLETED", "e")], "id string, status string, ended_at string")
    assert {tuple(r) for r in store.cancelled(runs, "r", "now").collect()} == {("r", "CANCELLED", "now"), ("q", "COMPLETED", "e")}


def test_extraction_and_coverage(spark):
    rows = parse_pages(spark.createDataFrame([(1, "https://s.test/a?utm_x=1", FULL), (2, "https://s.test/b", "<head><title>Only</title></head><p>body")], "page_id long, url string, html string"))
    got = {r.page_id: r for r in extract.extract(rows, "html:s", "run", "now").collect()}
    a = got[1]
    assert (a.title, a.author_hint, a.published_at, a.canonical_url) == ("Ld title", "Ann Lee", "2026-02-19T08:00:00+00:00", "https://s.test/canonical")
    assert [(e.claim_path, e.evidence_type, e.extracted_text) for e in a.evidence] == [("/title", "json_ld", "Ld title"), ("/author_hint", "json_ld", "Ann Lee, Bob"), ("/published_at", "json_ld", "2026-02-19T08:00:00Z")]
    assert (got[2].title, got[2].author_hint, got[2].snippet) == ("Only", None, "body")
    bare = spark.createDataFrame([("T", "A", "D", [("/title",)])], "title string, author_hint string, published_at string, evidence array<struct<claim_path:string>>")
    r = extract.enforce_coverage(bare).first()
    assert (r.title, r.author_hint, r.published_at, len(r.warnings)) == ("T", None, None, 2)


def test_export_stops_at_the_first_bad_row(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", "s", "x", 1, "2026-01-01T00:00:00+00:00", "t"), ("2", "b", "s", "x", 0, "t", "t"), ("3", "c", "s", "x", 1, "t", "t")], "id string, canonical_url string, source_id string, snippet string, version int, created_at string, updated_at string")
    with pytest.raises(ValueError, match="b .*version below 1"):
        export.export_jsonl(rows, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == 1 and '"canonical_url":"a"' in lines[0] and "00:00:00Z" in lines[0]
    assert export.export_jsonl(rows.filter("version > 0"), str(tmp_path / "ok")) == 2
    assert not [x for n in schemas.SCHEMAS for x in export.schema_problems(n)]


def test_sync(spark):
    feed = "<rss><item><link>https://s.test/1</link></item><item><link>https://s.test/2</link></item><item><link>https://s.test/3</link></item></rss>"
    seeds = spark.createDataFrame([("f", feed)], "seed string, body string")
    corpus = spark.createDataFrame([("https://s.test/1", FULL, 200, None), ("https://s.test/2", "<head><title>x</title></head><p>y", 404, None)], "url string, html string, status_code int, error_code string")
    done = pipeline.sync(empty(spark), seeds, "rss:s", corpus, "run-1", "now")
    r = done.run_log.first()
    assert (r.fetched_count, r.new_articles_count, r.updated_articles_count, r.error_count) == (3, 2, 0, 1)
    assert done.store.articles.count() == 2 and done.fetch_log.filter("error_code = 'FETCH_ERROR'").count() == 1
    assert pipeline.sync(done.store, seeds, "rss:s", corpus, "run-2", "now", dry_run=True).run_log.first().new_articles_count == 0
