import random

from pyspark.sql import functions as F

from inkstrata import schemas
from inkstrata.operators import canary, fetch_policy, resolution
from inkstrata.streaming import flows


def test_politeness_equals_the_recurrence(spark):
    rng = random.Random(1)
    rows = [(d, s, float(rng.randint(0, 60)), float(rng.choice([0, 5, 10]))) for d in "abc" for s in range(30)]
    got = {(r.d, r.s): r.start for r in fetch_policy.politeness(spark.createDataFrame(rows, "d string, s int, at double, gap double"), "d", ["s"], "at", F.col("gap")).collect()}
    due = {}
    for d, s, at, gap in rows:
        start = max(at, due.get(d, 0.0))
        assert got[d, s] == start
        due[d] = start + gap
    serial = fetch_policy.serial_schedule(spark.createDataFrame([(0, "a", 0.0, 5.0, 1.0), (1, "a", 0.0, 5.0, 1.0), (2, "b", 0.0, 5.0, 1.0)], "s int, d string, at double, gap double, took double"), "s", "d", "at", "gap", "took")
    assert [r.start for r in serial.orderBy("s").collect()] == [0.0, 5.0, 6.0]


def test_networks_limits_and_robots(spark):
    ips = ["10.1.2.3", "11.0.0.1", "172.16.0.1", "172.32.0.1", "169.254.169.254", "::1", "fe80::1", "2001:db8::1", "300.1.1.1", "x"]
    more = ["0:0:0:0:0:0:0:1", "::2", "::", "FEBF::1", "fec0::1", "fe7f::", "fdff:1::", "fe00::", "ff02::1", "1::ff02", "fe80::1%eth0", "::ffff:127.0.0.1", "fe80::1.2.3.4", "fe80:::1", "fe80::1::2", "1:2:3:4:5:6:7:8:9", "fe80:1:2:3:4:5:6:7", "fe80:1", ":fe80::1", "12345::", "g::", "", None]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    want = [True, False, True, False, True, True, True, False, False, False]
    assert [r[0] for r in df.select(fetch_policy.blocked_address("ip")).collect()] == want
    df = spark.createDataFrame([(i,) for i in ips + more], "ip string")
    native = [r.blocked for r in fetch_policy.block_ips(df, "ip").collect()]
    assert native == [bool(r[0]) for r in df.select(fetch_policy.blocked_address("ip")).collect()] and native[: len(ips)] == want
    kinds = spark.createDataFrame([("Text/HTML; charset=x",), ("application/json",), (None,), ("application/rss+xml",), ("text/plain",), ("application/pdf",), ("image/png",)], "t string").select(fetch_policy.body_limit(F.col("t"))).collect()
    assert [k[0] for k in kinds] == [5_000_000, 2_000_000, 500_000, 5_000_000, 2_000_000, 0, 500_000]
    robots = "User-agent: *\nDisallow: /no"
    r = spark.createDataFrame([(robots, "https://a/no/x", "bot"), (robots, "https://a/yes", "bot"), (None, "https://a/no", "bot")], "b string, u string, a string").select(fetch_policy.robots_allows("b", "u", "a")).collect()
    assert [x[0] for x in r] == [False, True, True]
    p = spark.createDataFrame([(200, None), (404, None), (503, None), (None, "timeout"), (301, None)], "s int, f string").select(fetch_policy.robots_policy(F.col("s"), F.col("f")).alias("p")).collect()
    assert [(x.p.mode, x.p.ttl, x.p.multiplier) for x in p] == [("parsed", 3600, 1.0), ("allow", 14400, 1.0), ("allow", 900, 2.0), ("allow", 3600, 1.0), ("allow", 3600, 1.0)]
    t = spark.createDataFrame([("a", 0.0, 10.0), ("a", 5.0, 10.0), ("a", 10.0, 10.0), ("a", 19.0, 10.0)], "d string, at double, ttl double")
    assert [r.miss for r in fetch_policy.cache_misses(t, "d", "at", "ttl").orderBy("at").collect()] == [True, False, True, False]


def forms(spark, networks) -> int:
    """How often the plan of a predicate on so many networks takes an address apart."""
    df = fetch_policy.block_ips(spark.createDataFrame([("::1",)], "ip string"), "ip", networks)
    return df._jdf.queryExecution().optimizedPlan().toString().count("split(")


def test_ip6_forms_are_made_once(spark):
    assert forms(spark, ["fe80::/10"]) == forms(spark, [f"{i:x}::1/128" for i in range(1, 40)])
    odd = ["fe80::1%", "fe80::1%a%b", "fe80::1%a/b", "::1\n", "1:2:3:4:5:6:7f1.2.3.4", "fe80::01.2.3.4", "ff02:0:0:0:0:0:0::", "ff02:0:0:0:0:0:0:0::", "::FFFF", "fc00:1:2:3:4:5:1.2.3.4", "::0001", "::1:"]
    df = spark.createDataFrame([(i,) for i in odd], "ip string")
    assert [r.blocked for r in fetch_policy.block_ips(df, "ip").collect()] == [bool(r[0]) for r in df.select(fetch_policy.blocked_address("ip")).collect()]
    few = spark.createDataFrame([("2001:db8::5",), ("2001:db9::",)], "ip string")
    assert [r.blocked for r in fetch_policy.block_ips(few, "ip", ["2001:db8::/29", "2001:db8::4/126"]).collect()] == [True, True]
    assert [r.blocked for r in fetch_policy.block_ips(few, "ip", ["2001:db8::4/126", "10.0.0.0/8"]).collect()] == [True, False]


def test_ip4_forms_are_made_once(spark):
    assert forms(spark, ["10.0.0.0/8"]) == forms(spark, [f"10.0.{i}.0/24" for i in range(40)]) <= 8
    odd = ["010.0.0.1", "10.0.0.1\n", " 10.0.0.1", "+10.0.0.1", "10.0.0", "10.0.0.1.", "10.0.0.256", "10.0.0.1%a", "10..0.1", "00.0.0.1", "0.0.0.0", "239.255.255.255", "240.0.0.0", "255.255.255.255", "1.2.3.4444444444444444444444"]
    df = spark.createDataFrame([(i,) for i in odd], "ip string")
    native = [r.blocked for r in fetch_policy.block_ips(df, "ip").collect()]
    assert native == [bool(r[0]) for r in df.select(fetch_policy.blocked_address("ip")).collect()] and sum(native) == 3
    assert [r.blocked for r in fetch_policy.block_ips(df, "ip", ["::/0"]).collect()] == [False] * len(odd)


def profiles(spark):
    rows = [("https://a.test/1", "s1", "Jon  Doe"), ("https://a.test/2", "s2", "jon doe"), ("https://a.test/3", "s3", "Jon Doee"), ("https://a.test/4", "s4", "Somebody Else"), ("https://b.test/1", "s5", "me@x.test"), ("https://c.test/1", "s6", "ME@x.test"), ("https://d.test/1", "s7", "  ")]
    return resolution.author_profiles(spark.createDataFrame(rows, "canonical_url string, source_id string, author_hint string"))


def test_candidates_and_review(spark):
    found = resolution.candidates(profiles(spark)).collect()
    scores = sorted((r.score, r.confidence, sorted((r.from_author.source_id, r.to_author.source_id))) for r in found)
    assert scores == [(0.6, "MEDIUM", ["s1", "s3"]), (0.6, "MEDIUM", ["s2", "s3"]), (0.8, "HIGH", ["s1", "s2"]), (1.0, "HIGH", ["s5", "s6"])]
    assert all(r.decision is None for r in found)
    df = spark.createDataFrame(found, resolution.candidates(profiles(spark)).schema)
    review = df.withColumn("decision", F.when(F.col("score") > 0.9, "ACCEPT ").when(F.col("score") > 0.7, "reject").when(F.col("to_author.source_id") == "s3", "what"))
    authors, decisions, tally = resolution.apply_review(review, schemas.empty(spark, "authors"), schemas.empty(spark, "merge_decisions"), "r1", "now")
    counts = {r.outcome: r["count"] for r in tally.collect()}
    assert counts["accept"] == 1 and counts["reject"] == 1 and sum(counts.values()) == 4
    assert authors.count() == 2 and decisions.count() == 1
    held = spark.createDataFrame(decisions.collect(), decisions.schema)
    _, again, tally = resolution.apply_review(review, authors, held, "r2", "now")
    assert again.count() == 1 and {r.outcome for r in tally.collect()} >= {"duplicate"}
    assert '"min_score":0.6' in resolution.review_document(df, "now").first().value


def test_alerts(spark):
    events = spark.createDataFrame([("cli_error", None, "r"), ("pipeline_url_error", None, None), ("x", "BLOCKED_BY_ROBOTS", "r")], "event_type string, error_code string, run_id string")
    rate = canary.error_rate(spark.createDataFrame([(0, 0)], "fetched int, errors int"))
    r = canary.alerts(rate.crossJoin(canary.event_counts(events))).first()
    assert (r.error_rate, r.exit_code, r.warning) == (0.0, 2, ["robots blocks"]) and r.critical == ["cli errors", "pipeline errors", "events without run id"]


def test_streams(spark, tmp_path):
    spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:01:00"), ("b", "2026-01-01 00:02:00")], "url string, t string").select("url", F.to_timestamp("t").alias("ts")).write.parquet(str(tmp_path / "in"))
    stream = flows.first_seen_stream(spark.readStream.schema("url string, ts timestamp").parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.url for r in spark.table("seen").collect()) == ["a", "b"]
