import hashlib
import json

from inkstrata.operators.fetch import fetch

ROBOTS = "User-agent: *\nDisallow: /no"


def test_fetch_as_a_relation(spark):
    html = "text/html; charset=utf-8"
    answers = [
        ("https://a.test/ok", 200, None, html, b"body", None),
        ("https://a.test/same", 304, None, html, b"", None),
        ("https://a.test/empty", 200, None, html, b"", None),
        ("https://a.test/moved", 301, "/ok", html, b"", None),
        ("https://a.test/inside", 302, "http://in.test/x", html, b"", None),
        ("https://a.test/file", 302, "file:///etc", html, b"", None),
        ("https://a.test/slow", None, None, None, None, "timeout"),
        ("https://a.test/broken", None, None, None, None, "connection"),
        ("https://a.test/pdf", 200, None, "application/pdf", b"", None),
        ("https://a.test/json", 200, None, "application/json", b"x" * 2_000_001, None),
        ("https://a.test/no/x", 200, None, html, b"never", None),
        *[(f"https://a.test/r{i}", 302, f"r{i + 1}", html, b"", None) for i in range(6)],
        ("https://a.test/r6", 200, None, html, b"end", None),
    ]
    responses = spark.createDataFrame([(u, s, l, t, {"ETag": "1"}, b, f, 7) for u, s, l, t, b, f in answers], "url string, status_code int, location string, content_type string, headers map<string,string>, body binary, failure string, latency_ms int")
    extra = ["ftp://a.test/x", "https:///x", "http://in.test/y", "https://gone.test/", "https://s.test/q"]
    requests = spark.createDataFrame([(u,) for u in [a[0] for a in answers] + extra], "url string")
    hosts = spark.createDataFrame([("a.test", ["93.184.216.34"]), ("in.test", ["93.184.216.34", "fe80::1"]), ("gone.test", [])], "host string, ips array<string>")
    robots = spark.createDataFrame([("a.test", 200, None, ROBOTS), ("s.test", 503, None, None)], "host string, status_code int, failure string, body string")
    got = fetch(requests, responses, hosts, robots, "run", "now")
    log = {r.url: r for r in got.log.collect()}
    assert len(log) == requests.count()
    codes = {u.rpartition("/")[2]: r.error_code for u, r in log.items() if u.startswith("https://a.test")}
    assert codes == {"ok": None, "same": None, "empty": None, "moved": None, "inside": "REDIRECT_LIMIT", "file": "REDIRECT_LIMIT", "slow": "TIMEOUT", "broken": "FETCH_ERROR", "pdf": "BODY_TOO_LARGE", "json": "BODY_TOO_LARGE", "x": "BLOCKED_BY_ROBOTS", "r0": "REDIRECT_LIMIT", **{f"r{i}": None for i in range(1, 7)}}
    assert [log[u].error_code for u in extra] == ["SECURITY_BLOCKED", "FETCH_ERROR", "SECURITY_BLOCKED", "FETCH_ERROR", "FETCH_ERROR"]
    assert log["https://a.test/same"].bytes_received == 0 and log["https://a.test/ok"].bytes_received == 4 and log["https://a.test/pdf"].status_code is None
    docs = {r.url: r for r in got.docs.collect()}
    assert set(docs) == {u for u, r in log.items() if r.error_code is None}
    assert docs["https://a.test/same"].body_bytes is None and docs["https://a.test/same"].body_sha256 is None and docs["https://a.test/empty"].body_sha256 is None
    assert (docs["https://a.test/moved"].final_url, docs["https://a.test/moved"].body_sha256) == ("https://a.test/ok", hashlib.sha256(b"body").hexdigest())
    assert docs["https://a.test/r1"].final_url == "https://a.test/r6" and docs["https://a.test/ok"].headers == {"etag": "1"}
    assert [json.loads(r.line)["domain"] for r in got.events.collect()] == ["s.test"]
