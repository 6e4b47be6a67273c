import json

from inkstrata import cli
from inkstrata.operators import canary, events, fetch_policy, store
from tests.test_sources import FULL

FEED = "<rss><item><link>https://s.test/1</link></item><item><link>https://s.test/2</link></item></rss>"


def test_all_commands(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr("inkstrata.session.get_session", lambda *a, **k: spark)
    monkeypatch.setattr(spark, "stop", lambda: None, raising=False)
    folder, feed, corpus = str(tmp_path / "st"), tmp_path / "feed.xml", str(tmp_path / "corpus")
    feed.write_text(FEED)
    other = FULL.replace("Ann Lee", "Ann  lee").replace("/canonical", "/two")
    spark.createDataFrame([("https://s.test/1", FULL, 200, None), ("https://s.test/2", other, 200, None)], "url string, html string, status_code int, error_code string").write.parquet(corpus)

    def run(*args):
        return cli.main([args[0], "--store", folder, *args[1:]]) if args[0] != "validate-schemas" else cli.main(list(args))

    assert run("validate-schemas") == 0
    for source, name in (("rss:s", "run-1"), ("rss:t", "run-2")):
        assert run("sync", "--source", source, "--seed", str(feed), "--corpus", corpus, "--run", name, "--now", "2026-01-01T00:00:00+00:00") == 0
    held = store.load(spark, folder)
    assert held.articles.count() == 4 and held.fetch_log.count() == 4 and {(r.id, r.status, r.new_articles_count) for r in held.run_log.collect()} == {("run-1", "COMPLETED", 2), ("run-2", "COMPLETED", 2)}
    assert not [n for n, gaps in store.foreign_key_errors(held).items() if gaps.count()]
    assert run("sync", "--source", "rss:t", "--seed", str(feed), "--corpus", corpus, "--run", "run-3", "--now", "n", "--dry-run") == 0
    assert store.load(spark, folder).run_log.count() == 2
    assert run("export", "--out", str(tmp_path / "out")) == 0 and len(spark.read.text(str(tmp_path / "out")).collect()) == 4
    assert run("review-queue", "--out", str(tmp_path / "queue"), "--now", "n") == 0
    document = json.loads(spark.read.text(str(tmp_path / "queue")).first().value)
    assert document["candidates"]
    for c in document["candidates"]:
        c["decision"] = "accept"
    document["candidates"].append({"id": "x", "decision": "perhaps"})
    (tmp_path / "review.json").write_text(json.dumps(document))
    assert run("review-apply", "--review", str(tmp_path / "review.json"), "--run", "run-4", "--now", "n") == 1
    held = store.load(spark, folder)
    assert held.merge_decisions.count() == len(document["candidates"]) - 1 and held.authors.count() >= 2
    assert all(r.evidence_ids for r in held.merge_decisions.collect())
    assert held.run_log.filter("id = 'run-4'").first().error_count == 1
    assert run("rollback", "--run", "run-2", "--now", "2026-02-02") == 0
    held = store.load(spark, folder)
    assert held.articles.count() == 2 and held.fetch_log.count() == 2 and held.run_log.filter("id = 'run-2'").first().status == "CANCELLED"
    assert run("rollback", "--run", "run-4", "--now", "n") == 0 and store.load(spark, folder).merge_decisions.count() == 0
    assert run("export", "--out", str(tmp_path / "out")) == 1 and "error" in capsys.readouterr().err


def test_limits_are_checked_at_the_start(monkeypatch, capsys):
    assert fetch_policy.limit_problems() == []
    monkeypatch.setattr(fetch_policy, "DEFAULT_BODY_LIMIT", 0)
    assert cli.main(["export", "--store", "x", "--out", "y"]) == 1 and "default body limit" in capsys.readouterr().err


def test_event_lines_and_report(spark):
    log = spark.createDataFrame([("i", "u", 200, 5, 9, None, "now", "r")], "id string, url string, status_code int, latency_ms int, bytes_received long, error_code string, created_at string, run_id string")
    assert json.loads(events.fetch_lines(log).first().line) == {"id": "i", "url": "u", "status_code": 200, "latency_ms": 5, "bytes_received": 9, "error_code": None, "timestamp": "now", "run_id": "r"}
    line = log.select(events.event_line("cli_done", log.run_id, log.created_at, command=log.url).alias("x")).first().x
    assert json.loads(line) == {"event_type": "cli_done", "level": "info", "timestamp": "now", "run_id": "r", "command": "u"} and list(json.loads(line)) == sorted(json.loads(line))
    metrics = spark.createDataFrame([(10, 5, 0.5, 0, 0, 3, 0)], "fetched long, errors long, error_rate double, cli_errors long, pipeline_errors long, robots_blocks long, missing_run_ids long")
    got = canary.report(canary.alerts(metrics), "now", spark.createDataFrame([("n", "rss:x", "s")], "name string, source_id string, seed string"), spark.createDataFrame([("sync", "r", 0)], "name string, run_id string, returncode int"), True, "r").first()
    out = json.loads(got.value)
    assert got.exit_code == 2 and out["alerts"] == {"critical": ["error rate"], "warning": ["robots blocks"]} and out["metrics"]["blocked_by_robots_count"] == 3 and out["rollback_check"] == {"checked": True, "target_run_id": "r", "ok": True}
