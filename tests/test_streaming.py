import datetime
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tests.plain import ttl_kept, window_kept
from tests.test_documents import RSS
from tests.test_messages import changed

from newsloom.plans import queries
from newsloom.schemas import FEEDS
from newsloom.session import run_dir
from newsloom.sources import documents, messages, tables, topics
from newsloom.streaming import jobs, metrics, state


def put(folder, name, values, start=0, topic="raw_news"):
    """One file of envelope rows, as a topic would deliver them."""
    folder.mkdir(exist_ok=True, parents=True)
    lines = [json.dumps({"topic": topic, "partition": 0, "offset": start + i, "key": None,
                         "value": v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)}, ensure_ascii=False)
             for i, v in enumerate(values)]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n", encoding="utf-8")


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def keyed_stream(spark, folder):
    rows = spark.readStream.schema("key string, seconds long, pos long").json(str(folder))
    return rows


def keep(rows, name, folder):
    run(jobs.Run(name, str(folder)).start(rows.writeStream.format("json").option("path", f"{folder}/out")))


def stored(spark, folder, schema):
    return spark.read.schema(schema).json(f"{folder}/out")


def write_rows(folder, name, rows):
    folder.mkdir(exist_ok=True, parents=True)
    text = "\n".join(json.dumps({"key": k, "seconds": s, "pos": p}) for k, s, p in rows)
    (folder / f"{name}.json").write_text(text + "\n")


def test_window_drops_the_oldest_accepted(spark, tmp_path):
    """h1 h2 h3 h4 h1 with room for three: the last h1 is new again, also over a restart."""
    src, out = tmp_path / "src", tmp_path / "run"
    keys = ["h1", "h2", "h3", "h1", "h4", "h1"]
    for i, part in enumerate((keys[:4], keys[4:])):
        write_rows(src, str(i), [(k, 0, 10 * i + j) for j, k in enumerate(part)])
        rows = state.window_stream(keyed_stream(spark, src), "key", size=3)
        keep(rows, "window", out)
    got = stored(spark, out, "key string, pos long").orderBy("pos").collect()
    assert [r["key"] for r in got] == ["h1", "h2", "h3", "h4", "h1"]


def test_window_against_plain_model(spark, tmp_path):
    rng = random.Random(5)
    keys = [f"k{rng.randrange(12)}" for _ in range(150)]
    src = tmp_path / "src"
    for i in range(3):
        write_rows(src, str(i), [(k, 0, p) for p, k in enumerate(keys)][50 * i:50 * i + 50])
        keep(state.window_stream(keyed_stream(spark, src), "key", size=6, flag="again"), "window", tmp_path / "run")
    got = {r["pos"]: r["again"] for r in stored(spark, tmp_path / "run", "pos long, again boolean").collect()}
    kept = set(window_kept(keys, 6))
    assert got == {p: p not in kept for p in range(150)}


def test_buckets_must_divide_the_window(spark, tmp_path):
    write_rows(tmp_path / "src", "0", [("a", 0, 0)])
    with pytest.raises(ValueError):
        state.window_stream(keyed_stream(spark, tmp_path / "src"), "key", size=10, buckets=3)


def test_seen_urls_seed_the_window(spark, tmp_path):
    write_rows(tmp_path / "src", "0", [("a", 0, 0), ("b", 0, 1), ("c", 0, 2)])
    seen = spark.createDataFrame([("a", 1), ("c", 2), ("z", 0)], "url_hash string, seq long")
    rows = state.window_stream(keyed_stream(spark, tmp_path / "src"), "key", size=2, seen=seen)
    keep(rows, "seeded", tmp_path / "run")
    assert [r["key"] for r in stored(spark, tmp_path / "run", "key string").collect()] == ["b"]


def test_ttl_against_plain_model_over_restarts(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice("aaab"), 60 * i + rng.randrange(50), i) for i in range(90)]
    for i in range(3):
        write_rows(tmp_path / "src", str(i), rng.sample(rows[30 * i:30 * i + 30], 30))
        keep(state.ttl_stream(keyed_stream(spark, tmp_path / "src"), "key", "seconds"), "ttl", tmp_path / "run")
    want = set()
    for key in "ab":
        own = [(s, p) for k, s, p in rows if k == key]
        want |= {own[i][1] for i in ttl_kept([s for s, _ in own], 600)}
    assert {r["pos"] for r in stored(spark, tmp_path / "run", "pos long").collect()} == want


def live(spark, run, variable, name):
    """Rows a query's last checkpoint holds of one state variable."""
    rows = spark.read.format("statestore").option("path", f"{run}/checkpoints/{name}").option("stateVarName", variable).load()
    return rows.filter("value is not null").collect()


def test_ttl_state_expires_by_event_time(spark, tmp_path):
    """Keys that come once each: the state keeps those of the last window only, and a replay gives the same rows."""
    rng = random.Random(3)
    rows = [(f"k{i // 2 if i % 5 else i % 7}", 20 * i + rng.randrange(15), i) for i in range(1200)]
    want = set()
    for key in {k for k, _, _ in rows}:
        own = sorted((s, p) for k, s, p in rows if k == key)
        want |= {own[i][1] for i in ttl_kept([s for s, _ in own], 600)}
    for name in ("first", "replay"):
        folder = tmp_path / name
        for i in range(4):
            write_rows(folder / "src", str(i), rng.sample(rows[300 * i:300 * i + 300], 300))
            keep(state.ttl_stream(keyed_stream(spark, folder / "src"), "key", "seconds", ttl=600, lateness=30), "ttl", folder)
        got = [r["pos"] for r in stored(spark, folder, "pos long").collect()]
        assert len(got) == len(set(got)) and set(got) == want
        held = live(spark, folder, "anchor", "ttl")
        assert 7 <= len(held) < 60 < len({k for k, _, _ in rows})


def test_windows_by_column_and_their_state(spark, tmp_path):
    """A window for each value of a column; the checkpoint tells what they hold, which seeds the next query."""
    rng = random.Random(8)
    rows = [(f"k{rng.randrange(25)}", rng.randrange(3), p) for p in range(240)]
    for i in range(4):
        write_rows(tmp_path / "src", str(i), rng.sample(rows[60 * i:60 * i + 60], 60))
        keep(state.window_stream(keyed_stream(spark, tmp_path / "src"), "key", size=5, buckets="seconds"), "window", tmp_path / "run")
    got = sorted(r["pos"] for r in stored(spark, tmp_path / "run", "pos long").collect())
    want, last = [], []
    for source in range(3):
        own = [(k, p) for k, s, p in rows if s == source]
        kept = window_kept([k for k, _ in own], 5)
        want += [own[i][1] for i in kept]
        last += [own[i][0] for i in kept][-5:]
    assert got == sorted(want)
    held = state.held_hashes(spark, f"{tmp_path}/run/checkpoints/window")
    assert sorted(r.url_hash for r in held.collect()) == sorted(last)
    write_rows(tmp_path / "more", "0", [(k, 0, i) for i, k in enumerate(sorted(set(last)) + ["new"])])
    keep(state.window_stream(keyed_stream(spark, tmp_path / "more"), "key", size=50, seen=held), "seeded", tmp_path / "seeded")
    assert [r["key"] for r in stored(spark, tmp_path / "seeded", "key string").collect()] == ["new"]


def test_two_jobs_and_a_fresh_start_share_a_topic(spark, tmp_path):
    """Both processors publish to one topic, one of them a second time from nothing: no message replaces another."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "0", [changed(title=f"t{i}", url=f"https://x/{i}", timestamp=1000 + i) for i in range(6)])
    stream = topics.file_stream(spark, str(raw))
    first, again, alt = (jobs.Run(n, str(tmp_path / f)) for n, f in (("process", "runs"), ("process", "fresh"), ("alt", "runs")))
    run(jobs.start_processor(stream, out, first))
    run(jobs.start_alt_processor(stream, out, alt))
    assert topics.file_batch(spark, out).count() == 12
    run(jobs.start_processor(stream, out, again))
    put(raw, "1", [changed(title="later", url="https://x/later", timestamp=5000)], start=100)
    for job, start in ((first, jobs.start_processor), (alt, jobs.start_alt_processor)):
        run(start(stream, out, job))
    sent = topics.file_batch(spark, out).collect()
    assert len(sent) == 20 == len({(r.partition, r.offset) for r in sent})
    by_partition = {}
    for r in sent:
        by_partition.setdefault(r.partition >> topics.TASK_BITS, set()).add(json.loads(r["value"])["title"])
    assert sorted(map(len, by_partition.values())) == [6, 7, 7]


def test_built_in_relatives(spark, tmp_path):
    write_rows(tmp_path / "src", "0", [("a", 0, 0), ("a", 1, 1), ("b", 2, 2)])
    rows = keyed_stream(spark, tmp_path / "src")
    keep(state.first_stream(rows, "key"), "first", tmp_path / "first")
    timed = rows.withColumn("at", F.timestamp_seconds("seconds"))
    keep(state.ttl_stream_built_in(timed, "key", "at").drop("at"), "ttl", tmp_path / "ttl")
    for folder in ("first", "ttl"):
        assert sorted(r["key"] for r in stored(spark, tmp_path / folder, "key string").collect()) == ["a", "b"]


def test_processor_quarantine_store_and_alerts(spark, tmp_path):
    """raw_news to processed_news to table and outbox, in two runs each."""
    raw, done, bad = tmp_path / "raw", tmp_path / "done", tmp_path / "bad"
    values = [
        changed(title="AI chip", url="https://a/1", published_ts=1711230000),
        changed(title="AI chip", url="HTTPS://A/1 "), changed(title="AI chip, updated", url="https://a/1"),
        changed(url=None), "{broken", changed(title="quiet", url="https://a/2", should_alert=False)]
    run_of = {n: jobs.Run(n, str(tmp_path / "runs")) for n in ("process", "bad", "store", "alert")}
    for i, part in enumerate((values, [changed(title="AI chip", url="https://a/1"), changed(title="new", url="https://a/3")])):
        put(raw, str(i), part, start=100 * i)
        stream = topics.file_stream(spark, str(raw))
        run(jobs.start_processor(stream, str(done), run_of["process"], buckets=2, now=F.timestamp_seconds(F.lit(1711240000))))
        run(jobs.start_quarantine(stream, str(bad), run_of["bad"]))
    sent = [json.loads(r["value"]) for r in topics.file_batch(spark, str(done)).collect()]
    assert {(m["title"], m["category"]) for m in sent} == {
        ("AI chip", "Công nghệ"), ("AI chip, updated", "Công nghệ"), ("quiet", "Tin tức"), ("new", "Tin tức")}
    first = next(m for m in sent if m["title"] == "AI chip")
    assert (first["published_at"], first["_published_at_source"], first["ingested_at"]) == (
        "2024-03-23T21:40:00Z", "rss", "2024-03-24T00:26:40Z")
    assert first["raw_payload"]["published_ts"] == 1711230000 and first["keywords"] == ["ai", "chip"]
    assert {r["reason"] for r in spark.read.parquet(str(bad)).collect()} == {"missing_url", "bad_json"}

    processed = tmp_path / "processed"
    put(processed, "0", sent, topic="processed_news")
    config = tables.TableConfig(run_dir(spark, "warehouse"), namespace="stream_test")
    name = tables.create_table(spark, config)
    for fresh in ("store", "store again"):
        # A second query without the first one's progress reads everything again and adds nothing.
        run(jobs.start_store(topics.file_stream(spark, str(processed)), name, jobs.Run(fresh, str(tmp_path / "runs"))))
        assert spark.table(name).count() == len(sent)
    alerts = jobs.scoped(run_of["alert"], "realtime")
    run(jobs.start_alerts(topics.file_stream(spark, str(processed)), str(tmp_path / "outbox"), alerts))
    texts = [r["message"] for r in spark.read.parquet(str(tmp_path / "outbox")).collect()]
    assert len(texts) == 3 and not any("quiet" in t for t in texts)


def test_alternative_processor(spark, tmp_path):
    raw = tmp_path / "raw"
    values = [changed(timestamp=1000, title=" government "), changed(timestamp=1500), changed(timestamp=1601),
              changed(title="", url="https://x"), changed(url=""), changed(timestamp=None, url="https://no-time"),
              changed(timestamp="soon", url="https://no-time")]
    put(raw, "0", values)
    run(jobs.start_alt_processor(topics.file_stream(spark, str(raw)), str(tmp_path / "out"), jobs.Run("alt", str(tmp_path))))
    got = [json.loads(r["value"]) for r in topics.file_batch(spark, str(tmp_path / "out")).collect()]
    assert sorted((m["timestamp"], m["title"], m["category"], m["summary"]) for m in got if m["url"] != "https://no-time") == [
        (1000, " government ", "Chính trị", "C"), (1601, " T ", "Tin tức", "C")]
    # Messages without a time count from their envelope's.
    assert [m["title"] for m in got if m["url"] == "https://no-time"] == [" T "]
    assert set(got[0]) == {"id", "title", "summary", "url", "keywords", "category", "source", "timestamp", "processed_at"}
    # Rows without a flag are always sent.
    put(tmp_path / "alt", "0", got, topic="processed_news")
    rows = messages.processed_news(topics.file_batch(spark, str(tmp_path / "alt")))
    assert [r["should_alert"] for r in rows.collect()] == [None, None, None]


def test_crawler_counts_and_restart(spark, tmp_path):
    """Every url is looked at once: the second crawl of the same feed is all repeats."""
    landing = tmp_path / "landing"
    landing.mkdir()
    registry = spark.createDataFrame([(0, "A", "u", True, "", ["ai"], [])], FEEDS)
    listener = metrics.MetricsListener()
    spark.streams.addListener(listener)
    start = int(datetime.datetime(2024, 3, 23, 10, tzinfo=datetime.timezone.utc).timestamp())
    try:
        for i in range(2):
            doc = {"feed_name": "A", "status": 200, "body": RSS.replace("2024-03-23T10", "2024-03-23T09"),
                   "fetched_at": f"2024-03-23T12:0{i}:00Z"}
            (landing / f"{i}.json").write_text(json.dumps(doc) + "\n")
            docs = documents.read_documents(spark, str(landing), stream=True)
            run(jobs.start_crawler(docs, registry, str(tmp_path / "raw"), jobs.Run("crawl", str(tmp_path)), start))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    sent = [json.loads(r["value"]) for r in topics.file_batch(spark, str(tmp_path / "raw")).collect()]
    assert [(m["url"], m["should_alert"], m["matched_keywords"]) for m in sent] == [("https://a/1", True, ["ai"])]
    counts = {}
    for _, batch, name, value in listener.rows:
        counts.setdefault(batch, {})[name] = value
    full = [c for _, c in sorted(counts.items()) if c.get("total")]
    assert [(c["published"], c["skip_old"], c["skip_no_ts"], c["skip_dedup"]) for c in full] == [(1, 1, 1, 0), (0, 0, 0, 3)]
    n = listener.write(spark, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).count() == n > 0 and listener.rows == []


def test_first_position_over_files_and_restarts(spark, tmp_path):
    """Of one micro-batch the smallest position counts; a key stays known, also over a restart."""
    src, out = tmp_path / "src", tmp_path / "run"
    rnd = random.Random(4)
    first = [(f"k{rnd.randrange(300)}", 0, p) for p in rnd.sample(range(1000), 1000)]
    for i in range(4):
        write_rows(src, f"a{i}", first[i::4])
    keep(state.first_position_stream(keyed_stream(spark, src), "key"), "first", out)
    write_rows(src, "b", [(k, 0, 1000 + p) for k, _, p in first] + [("new", 0, 5000), ("new", 0, 4000)])
    keep(state.first_position_stream(keyed_stream(spark, src), "key"), "first", out)
    want = {"new": 4000}
    for k, _, p in first:
        want[k] = min(p, want.get(k, p))
    got = [(r.key, r.pos) for r in stored(spark, out, "key string, pos long").collect()]
    assert sorted(got) == sorted(want.items())


def test_registered_streams_forget_no_hash(spark, monkeypatch):
    """A window far below the number of articles, in place of one far above, changes no row."""
    short = lambda rows, key, size, buckets: window(rows, key, size=buckets, buckets=buckets)
    window = state.window_stream
    monkeypatch.setattr(state, "window_stream", short)
    monkeypatch.setattr(jobs, "window_stream", short)
    sf = "/root/testdata/sf0.01"
    for stream, batch in (("stream_window", "dedup_first"), ("stream_processor", "process_messages")):
        got, want = (queries.REGISTRY[n](spark, sf).select("doc_id", "raw_hash").collect() for n in (stream, batch))
        assert sorted(got) == sorted(want) and len(got) < 1000


def test_jobs_write_their_counters(spark, tmp_path):
    """One folder of metrics for the processor, the alternative job and the store, written when a query ends."""
    raw, out, bad = tmp_path / "raw", str(tmp_path / "processed_news"), str(tmp_path / "bad")
    put(raw, "0", [changed(url="https://x/1"), changed(url="https://x/1"), "{broken", changed(url=None), changed(url="https://x/2", timestamp=5000)])
    stream, folder = topics.file_stream(spark, str(raw)), str(tmp_path / "runs")
    run(jobs.start_processor(stream, out, jobs.Run("process", folder), quarantine=bad))
    run(jobs.start_alt_processor(stream, str(tmp_path / "alt"), jobs.Run("alt", folder), quarantine=bad))
    name = tables.create_table(spark, tables.TableConfig(run_dir(spark, "warehouse"), namespace="counted"))
    run(jobs.start_store(topics.file_stream(spark, out), name, jobs.Run("store", folder)))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    sums = {(r.query, r.name): r.n for r in spark.read.schema(metrics.METRICS).json(f"{folder}/metrics").groupBy("query", "name").agg(F.sum("value").alias("n")).collect()}
    assert sums == {("process", "process_read.total"): 5, ("process", "process_read.errors"): 2, ("process", "process_unique.total"): 4,
                    ("process", "process_unique.errors"): 2, ("alt", "alt_read.total"): 5, ("alt", "alt_read.errors"): 2,
                    ("alt", "alt_unique.total"): 4, ("alt", "alt_unique.errors"): 2, ("store", "store_read.total"): 2}
    assert sorted(r.reason for r in jobs.read_quarantine(spark, bad).collect()) == ["bad_json", "bad_json", "missing_url", "process_error"]


def test_a_batch_that_was_not_noted_is_not_stored_twice(spark, tmp_path, monkeypatch):
    """The store ends between append and note; the query goes on, and another one reads everything again."""
    done = tmp_path / "processed_news"
    put(done, "0", [{"article_id": f"a{i}"} for i in range(8)], topic="processed_news")
    name = tables.create_table(spark, tables.TableConfig(run_dir(spark, "warehouse"), namespace="noted"))
    job, ledger = jobs.Run("store", str(tmp_path / "runs")), str(tmp_path / "ledger")
    start = lambda r: jobs.start_store(topics.file_stream(spark, str(done)), name, r, ledger=ledger)
    whole, kept = tables.append_batch, []

    def cut(rows, table, *rest):
        tables.append_new(rows, table)
        raise RuntimeError("ended before the note")

    monkeypatch.setattr(jobs, "append_batch", cut)
    with pytest.raises(Exception, match="ended before the note"):
        start(job).awaitTermination()
    monkeypatch.setattr(jobs, "append_batch", lambda *a: kept.append(whole(*a)))
    run(start(job))
    put(done, "1", [{"article_id": f"b{i}"} for i in range(3)], start=100, topic="processed_news")
    run(start(job))
    run(start(jobs.Run("again", str(tmp_path / "runs"))))
    assert kept[:2] == [0, 3] and sum(kept) == 3
    assert spark.table(name).count() == 11
    assert {r.rows for r in tables.read_ledger(spark, ledger).filter("query like 'store%'").collect()} == {0, 3}


@pytest.mark.parametrize("kind", ["first", "ttl"])
def test_keys_share_a_group_state(spark, tmp_path, monkeypatch, kind):
    """However many keys a stream has, they make at most ``GROUPS`` calls a micro-batch; each key, null included, is judged alone."""
    monkeypatch.setattr(state, "GROUPS", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(4)
        rows = [(rng.choice([None, "", *(f"k{i}" for i in range(60))]), 20 * i + rng.randrange(15), i) for i in range(300)]
        for i in range(3):
            write_rows(tmp_path / "src", str(i), rng.sample(rows[100 * i:100 * i + 100], 100))
            stream = keyed_stream(spark, tmp_path / "src")
            keep(state.first_position_stream(stream, "key") if kind == "first" else state.ttl_stream(stream, "key", "seconds"), kind, tmp_path / "run")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = set()
    for key in {k for k, _, _ in rows}:
        own = [(s, p) for k, s, p in rows if k == key]
        want |= {own[0][1]} if kind == "first" else {own[i][1] for i in ttl_kept([s for s, _ in own], 600)}
    assert sorted(r["pos"] for r in stored(spark, tmp_path / "run", "pos long").collect()) == sorted(want)
    held = spark.read.format("statestore").option("path", f"{tmp_path}/run/checkpoints/{kind}")
    held = held.option("stateVarName", "seen" if kind == "first" else "anchors").load().collect()
    assert len(held) == len({k for k, _, _ in rows}) and len({r["key"] for r in held}) <= 4


@pytest.mark.parametrize(("every", "kind"), [(7, "string"), (1000, "long")])
def test_expiring_keys_share_a_group_state(spark, tmp_path, monkeypatch, every, kind):
    """Keys whose state expires make at most ``GROUPS`` calls a micro-batch and have as many timers; each key, null included, is judged alone.

    What the groups hold fills several pages, and ended keys have left them.
    """
    monkeypatch.setattr(state, "GROUPS", 3)
    monkeypatch.setattr(state, "PAGE_KEYS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(every))
    try:
        rng = random.Random(6)
        names = [f"k{j}" if kind == "string" else j for j in range(100)]
        rows = [(rng.choice([None, "" if kind == "string" else -1, *names[i // 8:i // 8 + 40]]), 20 * i + rng.randrange(15), i) for i in range(480)]
        for i in range(3):
            write_rows(tmp_path / "src", str(i), rng.sample(rows[160 * i:160 * i + 160], 160))
            stream = spark.readStream.schema(f"key {kind}, seconds long, pos long").json(str(tmp_path / "src"))
            keep(state.ttl_stream(stream, "key", "seconds", ttl=600, lateness=30), "ttl", tmp_path / "run")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, last = set(), {}
    for key in {k for k, _, _ in rows}:
        own = [(s, p) for k, s, p in rows if k == key]
        kept = [own[i] for i in ttl_kept([s for s, _ in own], 600)]
        want |= {p for _, p in kept}
        last["" if key is None else f"={key}"] = kept[-1][0]
    got = stored(spark, tmp_path / "run", f"key {kind}, seconds long, pos long").collect()
    assert sorted(r["pos"] for r in got) == sorted(want) and {tuple(r) for r in got} <= set(rows)
    groups = live(spark, tmp_path / "run", "anchor", "ttl")
    assert 0 < len(groups) <= 3
    pages = spark.read.format("statestore").option("path", f"{tmp_path}/run/checkpoints/ttl").option("stateVarName", "pages").load().collect()
    held = {k: a for r in pages for k, a in zip(r["user_map_value"]["keys"], r["user_map_value"]["anchors"])}
    assert sum(r["value"]["keys"] for r in groups) == len(held) == sum(len(r["user_map_value"]["keys"]) for r in pages)
    assert len(pages) > 3 and held == {k: last[k] for k in held}
    watermark, slack = max(s for _, s, _ in rows) - 30, 630 // 8
    assert {k for k, s in last.items() if s + 601 > watermark} <= set(held)
    assert all(s + 601 + slack > watermark for s in held.values()) and len(held) < len(last)


class HeldState:
    """The state of one group in memory, and its timers."""

    def __init__(self):
        self.timers, self.value, self.map = set(), None, {}
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def getValue(self, key):
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        self.map.pop(key, None)


class Watermark:
    def __init__(self, seconds):
        self.ms = 1000 * seconds

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_pages_of_expiring_state_grow_and_shrink(monkeypatch):
    """Bursts of keys and quiet times: pages hold the keys still open and no others, a batch touches pages of its keys only, and nothing stays at the end."""
    monkeypatch.setattr(state, "PAGE_KEYS", 4)
    held, rng = HeldState(), random.Random(2)
    processor = state.TtlProcessor("seconds", "pos", 100, 10)
    processor.init(held)
    anchors, most, least = {}, 0, 99
    for step in range(300):
        low = 20 * step
        burst = 60 if step % 60 < 20 else 1
        rows = sorted((f"k{rng.randrange(3 * burst)}", low + rng.randrange(20), 100 * step + i) for i in range(burst))
        if step % 60 > 45:
            rows = []
        frame = pd.DataFrame(rows, columns=["state_key", "seconds", "pos"])
        got = [p for f in processor.handleInputRows((0,), iter([frame.iloc[::2], frame.iloc[1::2]]), None) for p in f["pos"]]
        want = []
        for key, second, pos in rows:
            if key not in anchors or second > anchors[key] + 100:
                anchors[key] = second
                want.append(pos)
        assert sorted(got) == sorted(want)
        watermark = Watermark(low + 20)
        for due in sorted(t for t in held.timers if t <= watermark.ms):
            assert not list(processor.handleExpiredTimer((0,), watermark, Watermark(due // 1000)))
            held.timers.remove(due)
        pages = {p: dict(zip(*v)) for (p,), v in held.map.items()}
        left = {k: a for page in pages.values() for k, a in page.items()}
        assert left == {k: anchors[k] for k in left} and all(pages.values())
        assert {k for k, a in anchors.items() if a + 100 >= low + 20} <= set(left)
        if held.value is None:
            assert not left and not held.timers
            continue
        assert len(held.timers) == 1 and min(held.timers) > watermark.ms
        due, keys, number = held.value
        assert keys == len(left) and max(pages) < number and min(left.values()) >= due and due + 111 > low + 20
        most, least = max(most, number), min(least, number)
    assert most >= 16 and least == 1 and held.value is None and not held.map
