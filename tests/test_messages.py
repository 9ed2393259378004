import json

from pyspark.sql import functions as F

from newsloom.functions import variant as V
from newsloom.schemas import ENVELOPE
from newsloom.sources import messages as M

GOOD = {"id": "1", "title": " T ", "content": " C ", "url": " https://a/1 ", "source": "S", "timestamp": 100,
        "published_ts": 50, "should_alert": True, "matched_keywords": ["x"]}


def envelope(spark, values, topic="raw_news"):
    rows = [(topic, 0, i, None, None, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def changed(**fields):
    return {k: v for k, v in (GOOD | fields).items() if v is not ...}


def test_reasons(spark):
    cases = [
        (GOOD, None), ("{not json", "bad_json"), ("[1]", "not_an_object"), ("5", "not_an_object"),
        ('  {"url": "u"}', None), (changed(url=...), "missing_url"), (changed(url=None), "missing_url"),
        (changed(url=""), "missing_url"), (changed(url=0), "missing_url"), (changed(url=[]), "missing_url"),
        (changed(url="  "), None), (changed(url=7), "process_error"), (changed(title=None), "process_error"),
        (changed(title=3), "process_error"), (changed(title=...), None), (changed(content=None), "process_error"),
        (changed(content=...), None), (changed(content=..., summary=None), "process_error"),
        (changed(content="", summary=5), None), (changed(published_ts="abc"), None),
        (changed(published_ts=[1]), "process_error"), (changed(published_ts=None, timestamp={"a": 1}), "process_error"),
        (changed(timestamp=[1]), None),
    ]
    parsed = M.parse_raw_news(envelope(spark, [c for c, _ in cases]))
    got = {r["offset"]: r["reason"] for r in parsed.select("offset", "reason").collect()}
    assert [got[i] for i in range(len(cases))] == [e for _, e in cases]
    assert M.quarantine(parsed).count() == sum(e is not None for _, e in cases)


def test_article_fields(spark):
    cases = [
        (GOOD, ("https://a/1", "T", "C", "S", "S", 50.0, "rss", True, ["x"])),
        (changed(content=..., summary=" sum "), ("https://a/1", "T", "sum", "S", "S", 50.0, "rss", True, ["x"])),
        (changed(content="", summary="sum"), ("https://a/1", "T", "", "S", "S", 50.0, "rss", True, ["x"])),
        (changed(published_ts=None), ("https://a/1", "T", "C", "S", "S", 100.0, "ingestion_fallback", True, ["x"])),
        (changed(published_ts="abc"), ("https://a/1", "T", "C", "S", "S", None, "rss", True, ["x"])),
        (changed(published_ts=" 1e2 "), ("https://a/1", "T", "C", "S", "S", 100.0, "rss", True, ["x"])),
        (changed(published_ts=True), ("https://a/1", "T", "C", "S", "S", 1.0, "rss", True, ["x"])),
        (changed(matched_feed_name="", should_alert="false"), ("https://a/1", "T", "C", "S", "", 50.0, "rss", True, ["x"])),
        (changed(source=..., should_alert=0, matched_keywords=None),
         ("https://a/1", "T", "C", "", "", 50.0, "rss", False, [])),
    ]
    rows = M.articles(M.parse_raw_news(envelope(spark, [c for c, _ in cases])))
    got = [tuple(r)[:9] for r in sorted(rows.drop("raw_payload").collect(), key=lambda r: r["pos"])]
    assert got == [e for _, e in cases]


def test_truthiness_lists_and_json(rows_of):
    values = [None, False, True, 0, 0.0, 1, "", "false", [], [0], [1.0, 2.5, 0.0], 1.0, 2.50, {}, {"b": 1, "a": [None, "é"]}, " ", "two words",
              [1, None, True, "x"]]
    m = F.try_parse_json("s")
    v = V.field(m, "v")
    data = [(json.dumps({"v": x}, ensure_ascii=False),) for x in values] + [("{}",)]
    got = rows_of(data, "s string", V.truthy(v), V.text_list(v), V.json_text(v))
    assert [r[0] for r in got] == [bool(x) for x in values] + [False]

    def listed(x):
        if x is None or (isinstance(x, str) and not x.strip()):
            return []
        if isinstance(x, list):
            return [str(i) for i in x if i is not None]
        compact = {"separators": (",", ":"), "sort_keys": True, "ensure_ascii": False}
        return [json.dumps(x, **compact) if isinstance(x, dict) else str(x)]

    assert [r[1] for r, x in zip(got, values)] == [listed(x) for x in values]
    assert [json.loads(r[2]) for r in got] == values + [{}]
    assert got[14][2] == '{"a":[null,"é"],"b":1}'


def test_json_text_keeps_payload_an_object(spark):
    rows = spark.createDataFrame([("k", '{"b":1,"a":"é"}', None)], "article_id string, raw_payload string, x string")
    value = M.to_messages(rows, "article_id", ("raw_payload",)).first()
    assert value["key"] == "k"
    assert json.loads(value["value"]) == {"article_id": "k", "raw_payload": {"a": "é", "b": 1}, "x": None}


def test_absent_flag_stays_absent(spark):
    values = [{"title": "a", "should_alert": 0}, {"title": "b"}, {"title": "c", "should_alert": "no"}]
    rows = M.processed_news(envelope(spark, values))
    assert [r["should_alert"] for r in rows.orderBy("kafka_offset").collect()] == [False, None, True]
