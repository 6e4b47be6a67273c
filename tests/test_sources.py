import json
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from inkstrata.schemas import SCHEMAS
from inkstrata.sources import documents, feeds, pages

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><link>https://site.test/</link>
<item><title>a</title><link>https://site.test/1</link></item><item><link> https://site.test/2 </link></item><item><link>https://site.test/1</link></item><item><title>none</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x.test/abs/1</id><link href="http://x.test/pdf/1" title="pdf" rel="related"/><link href="http://x.test/abs/1v2" rel="alternate"/></entry>
<entry><id>http://x.test/abs/2</id><link href="http://x.test/pdf/2.pdf" type="application/pdf"/></entry></feed>"""
PAGE = '<html><body><a href="https://s.test/1">x</a><a HREF=" /rel ">y</a><a href="mailto:a@b">z</a><a>w</a><a href="https://s.test/1">again</a></body></html>'

FULL = """<html><head><title>Html  title</title><meta property="og:title" content="Og title"><meta name="author" content="Meta Author, Other"><meta name="author" content="Late">
<link rel="canonical" href="/canonical"><script type="application/ld+json">{"@context":"x","@graph":[{"@type":"Thing","name":"t"},{"@type":["NewsArticle"],"headline":"Ld title","author":[{"name":"Ann Lee"},"Bob"],"datePublished":"2026-02-19T08:00:00Z"}]}</script></head>
<body><p>First <b>bold</b> text</p><script>var t="</p>";</script><div>Second</div></body></html>"""


def found(spark, source, body, seed="file:/x"):
    return [r.url for r in feeds.discover(spark.createDataFrame([(seed, body)], "seed string, body string"), source).orderBy("pos").collect()]


def test_feeds(spark):
    assert found(spark, "rss:s", RSS) == ["https://site.test/1", "https://site.test/2"]
    assert found(spark, "rss:s", ATOM) == ["http://x.test/abs/1v2", "http://x.test/pdf/2.pdf"]
    blank = '<feed><entry><link href="https://s.test/blank" rel=" "/></entry><entry><link href="https://s.test/self" rel="self"/></entry></feed>'
    assert found(spark, "rss:s", blank) == ["https://s.test/blank"]
    assert found(spark, "arxiv:q", ATOM) == ["http://x.test/abs/1v2", "http://x.test/abs/2"]
    assert found(spark, "html:s", PAGE) == ["https://s.test/1"]
    assert found(spark, "html:s", PAGE, "https://s.test/d/") == ["https://s.test/1", "https://s.test/rel"]
    for bad in ("ftp:x", "rss"):
        with pytest.raises(ValueError):
            feeds.reader_of(bad)


def test_pages():
    p = pages.parse("https://s.test/a", FULL)
    assert (p["title"], p["html_title"], p["date_published"], p["canonical_url"]) == ("Ld title", "Html title", "2026-02-19T08:00:00+00:00", "https://s.test/canonical")
    assert p["author_names"] == ["Ann Lee", "Bob", "Meta Author", "Other"] and p["meta_tags"]["author"] == "Meta Author, Other"
    assert p["text"] == "First bold text\n\nSecond" and len(p["json_ld_blocks"]) == 3
    broken = pages.parse("u", '<title>T</title><script type="application/ld+json">{"a": </script><meta property="og:title" content="O"></head><p>x')
    assert (broken["title"], broken["json_ld_blocks"], broken["date_published"]) == ("O", [], None)
    assert pages.decode("é".encode("latin-1"), "text/html; charset=utf-8") == "é" and pages.parse("u", None)["text"] == ""
    assert pages.decode("é".encode(), "text/html; charset=no-such") == "é" and pages.decode("é".encode("cp1252"), "text/html; charset=cp1252") == "é"


def test_pages_edge_cases():
    edge = pages.parse("https://s.test/x", '<head><title>T</title><meta name="author" content="A One, B Two"><meta name="publish-date" content="2026-02-17"><meta name="date" content="2026-01-01"></head><div>\n<p>one</p>\n<p>two <b>in</b> line</p><table><tr><td>a</td><td>b</td></tr></table></div>')
    assert (edge["author_names"], edge["date_published"], edge["canonical_url"]) == (["A One", "B Two"], "2026-02-17T00:00:00", "https://s.test/x")
    assert edge["text"] == "one\n\ntwo in line\n\na b"
    assert pages.flat_blocks({"@graph": {"@type": "Article"}, "name": "n"}) == [{"name": "n"}]
    ld = '<script type="application/ld+json">{"@type":"Report","headline":"","name":" A\\n title ","datePublished":"bad","dateCreated":"2026-01-01"}</script>'
    got = pages.parse("u", ld)
    assert (got["title"], got["date_published"]) == ("A title", None)
    long = pages.parse("u", "<p>" + "alpha " * 500 + "</p>", limit=120)["text"]
    assert len(long) <= 121 and long.endswith("alpha\u2026") and pages.parse("u", "<p>" + "x" * 130 + "</p>", limit=120)["text"] == "x" * 120 + "\u2026"


def parsing_peak(pages_of_a_batch: int) -> int:
    """The most bytes that parsing one batch takes, and a check that all of its pages come out, in pieces."""
    schema = to_arrow_schema(StructType.fromDDL(f"__key long, {SCHEMAS['parsed']}"))
    n = pages_of_a_batch
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["https://s.test/a"] * n), pa.array([FULL + "<p>" + "x " * 800] * n), pa.nulls(n, pa.string())], names=["__key", "__url", "__body", "__type"])
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    peak = rows = 0
    for b in pages.parse_batches(schema)(iter([batch])):
        assert b.num_rows <= pages.PIECE_ROWS and b.schema == schema
        peak, rows = max(peak, pa.total_allocated_bytes() - held), rows + b.num_rows
    own = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n
    return peak + own


def test_parsing_takes_no_more_memory_for_more_pages():
    assert parsing_peak(4000) < 1.3 * parsing_peak(1000)


def test_parsed_records_of_pages_and_nulls(spark):
    rows = [(i, f"https://s.test/{i}", FULL if i % 3 else None) for i in range(700)] + [(None, None, "<title>x</title>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.asDict() for r in pages.parse_pages(df).collect()}
    assert len(got) == 701
    for k, u, h in rows:
        assert got[k] == {"page_id": k, **pages.parse(u, h)}


def test_pages_with_content_type(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>".encode("cp1252"), "text/html; charset=cp1252"), (2, "u", "<p>é</p>".encode(), None)], "page_id long, url string, html binary, kind string")
    assert [r.text for r in pages.parse_pages(df, content_type="kind").orderBy("page_id").collect()] == ["é", "é"]
    with pytest.raises(Exception, match="a search needs a text"):
        spark.createDataFrame([(" ",)], "q string").select(feeds.search_url(F.col("q"), strict=True)).collect()


def test_documents(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"generated_at": "x", "min_score": 0.6, "candidates": [{"id": "1", "from_author": {"id": "a", "canonical_name": "A"}, "to_author": {"id": "b", "canonical_name": "B"}, "score": 0.8, "decision": "accept"}]}))
    (tmp_path / "bad.json").write_text('{"candidates": 3}')
    (tmp_path / "s.json").write_text('[{"name": "n", "source_id": "rss:x", "seed": "y"}]')
    (tmp_path / "e.log").write_text('{"event_type": "cli_error", "run_id": ""}\n\nnot json\n[1]\n{"error_code": "BLOCKED_BY_ROBOTS", "run_id": "r"}\n')
    assert documents.read_review(spark, str(tmp_path / "r.json")).first().from_author.id == "a"
    with pytest.raises(Exception, match="list of candidates"):
        documents.read_review(spark, str(tmp_path / "bad.json")).collect()
    assert documents.read_sources(spark, str(tmp_path / "s.json")).count() == 1
    got = documents.read_events(spark, str(tmp_path / "e.log")).collect()
    assert [(r.event_type, r.run_id, r.error_code) for r in got] == [("cli_error", "", None), (None, "r", "BLOCKED_BY_ROBOTS")]
    assert set(SCHEMAS) >= {"articles", "evidence", "versions"}
