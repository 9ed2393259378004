import json

import pytest
from tests.test_documents import RSS
from tests.test_messages import changed

from newsloom import cli
from newsloom.session import run_dir
from newsloom.sources import topics

CRAWL = ["crawl", "--documents", "d", "--output", "o"]


@pytest.mark.parametrize("flag", ["--per-feed-limit", "--total-limit", "--days"])
@pytest.mark.parametrize("value", ["0", "-1", "x"])
def test_limits_must_be_positive(flag, value):
    with pytest.raises(SystemExit):
        cli.parser().parse_args([*CRAWL, flag, value])


def test_modes(monkeypatch):
    assert cli.parser().parse_args(CRAWL).mode == "realtime"
    monkeypatch.setenv("CRAWLER_MODE", "backfill")
    args = cli.parser().parse_args([*CRAWL, "--days", "7"])
    assert (args.mode, args.days, args.per_feed_limit, args.name) == ("backfill", 7, None, "crawl")
    with pytest.raises(SystemExit):
        cli.parser().parse_args([*CRAWL, "--mode", "live"])


def test_commands_read_each_others_folders(spark, tmp_path, monkeypatch):
    """crawl, process, store and alert, with nothing between them."""
    folder = run_dir(spark, "cli")
    monkeypatch.setattr(cli.jobs, "shared_dir", lambda _: folder)
    (tmp_path / "feeds.json").write_text(json.dumps({"feeds": [{"name": "A", "url": "u"}]}))
    (tmp_path / "docs").mkdir()
    doc = {"feed_name": "A", "status": 200, "body": RSS, "fetched_at": "2024-03-23T12:00:00Z"}
    (tmp_path / "docs" / "0.json").write_text(json.dumps(doc) + "\n")
    path = {n: str(tmp_path / n) for n in ("feeds.json", "docs", "raw_news", "processed_news", "alt", "bad", "outbox", "report", "store")}

    def run(*args):
        cli.run(spark, cli.parser().parse_args([*args]))

    def urls(name):
        return sorted(json.loads(r["value"])["url"] for r in topics.file_batch(spark, path[name]).collect())

    crawl = ["crawl", "--mode", "backfill", "--feeds", path["feeds.json"], "--documents", path["docs"],
             "--output", path["raw_news"], "--per-feed-limit", "2", "--report", path["report"]]
    run(*crawl)
    assert urls("raw_news") == ["https://a/1", "https://a/2"]
    assert [(r["feed_ord"], r["published"]) for r in spark.read.json(path["report"]).collect()] == [(0, 2)]
    sent = topics.file_batch(spark, path["raw_news"])
    assert set(json.loads(sent.first()["value"])) == set(changed()) | {"matched_feed_name"}

    run("process", "--input", path["raw_news"], "--output", path["processed_news"], "--quarantine", path["bad"])
    run("alt-process", "--input", path["raw_news"], "--output", path["alt"])
    assert urls("processed_news") == urls("alt") == ["https://a/1", "https://a/2"]

    store = ["store", "--input", path["processed_news"], "--warehouse", path["store"], "--namespace", "cli_news"]
    run(*store)
    run("alert", "--input", path["processed_news"], "--output", path["outbox"], "--all")
    assert spark.table("cli_news.processed_news").count() == 2
    assert spark.read.parquet(path["outbox"]).count() == 2

    # A second crawl sends the same entries behind the first; the processor drops them, the store has nothing new.
    run(*crawl)
    assert len(urls("raw_news")) == 4
    run("process", "--input", path["raw_news"], "--output", path["processed_news"], "--quarantine", path["bad"])
    run(*store)
    assert urls("processed_news") == ["https://a/1", "https://a/2"] and spark.table("cli_news.processed_news").count() == 2


def test_seen_urls_outlive_a_query(spark, tmp_path, monkeypatch):
    folder = run_dir(spark, "cli-seen")
    monkeypatch.setattr(cli.jobs, "shared_dir", lambda _: folder)
    (tmp_path / "feeds.json").write_text(json.dumps({"feeds": [{"name": "A", "url": "u"}]}))
    (tmp_path / "docs").mkdir()
    doc = {"feed_name": "A", "status": 200, "body": RSS, "fetched_at": "2024-03-23T12:00:00Z"}
    (tmp_path / "docs" / "0.json").write_text(json.dumps(doc) + "\n")
    for name, sent in (("first", True), ("second", False)):
        out = tmp_path / name
        cli.run(spark, cli.parser().parse_args(
            ["crawl", "--feeds", str(tmp_path / "feeds.json"), "--documents", str(tmp_path / "docs"), "--output", str(out),
             "--seen", str(tmp_path / "seen"), "--name", name, "--startup-ts", "0"]))
        assert bool(topics.file_batch(spark, str(out)).count()) == sent


def test_start_time_is_kept(spark, tmp_path):
    run = cli.jobs.Run("c", str(tmp_path))
    assert [cli.jobs.startup_time(spark, run, given) for given in (5, 9, None)] == [5, 5, 5]
    assert cli.jobs.startup_time(spark, cli.jobs.Run("d", str(tmp_path))) > 1_700_000_000


def test_settings_of_the_store_and_the_alerts():
    args = cli.parser().parse_args(["store", "--input", "i", "--warehouse", "w", "--catalog", "c", "--catalog-uri", "http://c", "--endpoint", "http://s"])
    assert (args.catalog_uri, args.endpoint, args.flush_messages) == ("http://c", "http://s", 100)
    args = cli.parser().parse_args(["alert", "--input", "i", "--output", "o", "--starting", "earliest", "--pace", "1.5"])
    assert (args.starting, args.pace) == ("earliest", 1.5)
