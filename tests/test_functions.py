import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkstrata.functions import dates, ids, text, urls

URLS = [
    ("  HTTP://Example.COM/A/B?utm_source=x&b=2&a=1&sid=9#frag", "https://example.com/a/b?a=1&b=2"), ("https://example.com", "https://example.com/"), ("http://a.b:80/x", "https://a.b/x"), ("https://a.b:443/x", "https://a.b/x"),
    ("http://a.b:8080/x?z=1&z=0", "https://a.b:8080/x?z=0&z=1"), ("ftp://a.b/C", "ftp://a.b/C"), ("https://a.b/p?UTM_Medium=1&PHPSESSID=2", "https://a.b/p"),
]


def col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_canonical_urls(spark):
    rows = col(spark, [u for u, _ in URLS]).select(urls.canonical_url(F.col("v")).alias("n"), urls.canonical_url_any("v").alias("p")).collect()
    for r, (u, want) in zip(rows, URLS):
        assert (r.n, r.p) == (want, want), u
    assert urls.canonical_text("https://user:pw@A.b/%41?k&x=%7E") == "https://a.b/%41?k=&x=~"
    assert col(spark, ["http://a.b:x/"]).select(urls.canonical_url_any("v")).first()[0] is None


def test_hosts_and_links(spark):
    df = col(spark, ["https://User@Ex_a.com:81/p", "/rel", "http://x/a.PDF", "mailto:a@b", None])
    got = df.select(urls.url_host(F.col("v")), urls.is_http_url(F.col("v")), urls.is_pdf_link(F.col("v")), urls.profile_host(F.col("v"))).collect()
    assert tuple(got[0]) == ("ex_a.com", True, False, "user@ex_a.com:81") and tuple(got[1])[:2] == ("", False) and got[2][2] and not got[3][1] and not got[4][1]
    r = spark.createDataFrame([("https://a.b/c/d", "../e?x#y"), ("https://a.b/c", "/z")], "b string, r string").select(urls.resolve("b", "r").alias("p"), urls.resolve_rooted(F.col("b"), F.col("r")).alias("n")).collect()
    assert r[0].p == "https://a.b/e?x#y" and r[1].p == r[1].n == "https://a.b/z"
    assert col(spark, ["a b~*é"]).select(urls.quote_plus(F.col("v"))).first()[0] == "a+b~%2A%C3%A9"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab \t\n \x1c\x85 é,|")), max_size=12), min_size=1, max_size=25))
def test_text_equals_python(spark, values):
    rows = col(spark, values).select(text.normalize_name(F.col("v")).alias("n"), text.paragraphs(F.col("v")).alias("p"), text.truncate(F.col("v"), 5).alias("t")).collect()
    for v, r in zip(values, rows):
        assert r.n == " ".join(v.lower().split())
        assert r.p == "\n\n".join(x for x in (" ".join(y.split()) for y in v.splitlines()) if x)
        head = v[:5]
        assert r.t == (v if len(v) <= 5 else (head.rsplit(" ", 1)[0] if " " in head else head).rstrip(" ") + "…")


def test_names_and_ids(spark):
    values = ["http://a", "é\U0001f600", ""]
    got = [r[0] for r in col(spark, values).select(ids.uuid5(F.col("v"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, v)) for v in values]
    r = spark.createDataFrame([("jon doe!", "jon doee"), ("ann", "bob"), ("", "")], "a string, b string").select(text.name_distance(F.col("a"), F.col("b"))).collect()
    assert [x[0] for x in r] == [0.125, 1.0, 0.0]
    assert [x[0] for x in col(spark, ["Ann Lee, Bob and Cy|Ann Lee", "Brand and"]).select(text.split_authors(F.col("v"))).collect()] == [["Ann Lee", "Bob", "Cy"], ["Brand"]]
    assert col(spark, [""]).select(ids.body_hash(F.encode("v", "UTF-8"))).first()[0] is None
    h = spark.createDataFrame([("a", None), ("a", "")], "title string, author_hint string").select(ids.content_hash(F.col("title"), F.col("author_hint"))).distinct().count()
    assert h == 2


def test_dates(spark):
    want = {"2026-02-17": "2026-02-17T00:00:00", "2026-02-19T08:00:00Z": "2026-02-19T08:00:00+00:00", "20260219T080000": "2026-02-19T08:00:00", "2026": None, "2026-W08-4": "2026-02-19T00:00:00", "nope": None, " ": None, None: None}
    got = [r[0] for r in col(spark, list(want)).select(dates.iso_date("v")).collect()]
    assert got == list(want.values())
    assert col(spark, ["2026-01-01T00:00:00+00:00"]).select(dates.exported(F.col("v"))).first()[0] == "2026-01-01T00:00:00Z"


def test_stored_instants_are_strict(spark):
    good = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("2026-01-01T02:00:00+02:00",), (None,)], "t string")
    assert [r[0] and r[0].isoformat() for r in good.select(F.date_format(dates.instant(F.col("t")), "yyyy-MM-dd HH").alias("x")).select(F.to_date("x", "yyyy-MM-dd HH")).collect()] == ["2026-01-01", "2026-01-01", None]
    with pytest.raises(Exception, match="no ISO date"):
        spark.createDataFrame([("yesterday",)], "t string").select(dates.instant(F.col("t"))).collect()
