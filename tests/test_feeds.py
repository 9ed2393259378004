import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions.alerts import feed_alert
from newsloom.functions.rules import match_text
from newsloom.operators import joins
from newsloom.operators.alerts import tag_articles
from newsloom.sources import feeds

REGISTRY = {"feeds": [
    {"name": " A ", "url": "https://a/rss", "include_keywords": ["AI", "blockchain"], "exclude_keywords": ["Sponsored"]},
    {"name": "B", "url": "https://b/rss", "enabled": False},
    {"name": "C", "url": "https://c/rss", "category_hint": "x"},
]}


def written(tmp_path, content, name="feeds.json"):
    path = tmp_path / name
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return str(path)


def test_load(spark, tmp_path):
    rows = feeds.load_feeds(spark, written(tmp_path, REGISTRY)).orderBy("feed_ord").collect()
    assert [(r["feed_ord"], r["name"], r["include_keywords"], r["exclude_keywords"], r["category_hint"]) for r in rows] == [
        (0, "A", ["ai", "blockchain"], ["sponsored"], ""), (2, "C", [], [], "x")]


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    path = written(tmp_path, "feeds:\n  - name: Đ\n    url: u\n    include_keywords: [X]\n", "feeds.yaml")
    assert feeds.load_feeds(spark, path).first()["include_keywords"] == ["x"]
    with pytest.raises(ValueError):
        feeds.load_feeds(spark, written(tmp_path, "feeds: [", "bad.yaml"))


@pytest.mark.parametrize("content", [
    {}, {"feeds": {}}, [], {"feeds": ["x"]}, {"feeds": [{"url": "u"}]}, {"feeds": [{"name": "n", "url": " "}]},
    {"feeds": [{"name": "n", "url": "u"}, {"name": "n", "url": "v"}]}])
def test_bad_registries(spark, tmp_path, content):
    with pytest.raises(ValueError):
        feeds.load_feeds(spark, written(tmp_path, content))


def test_missing_and_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        feeds.load_feeds(spark, str(tmp_path / "none.json"))
    assert feeds.load_feeds(spark, written(tmp_path, {"feeds": []})).count() == 0


ALERTS = [
    ("any", "", [], [], (True, [])),
    ("AI news", "", ["ai", "gold"], [], (True, ["ai"])),
    ("nothing", "", ["gold"], [], (False, [])),
    ("Gold ad", "", ["gold"], ["ad"], (False, [])),
    ("free", "ad", [], ["ad"], (False, [])),
    ("t", "GOLD and oil", ["oil", "gold"], ["zzz"], (True, ["oil", "gold"])),
]


def test_alert_rule(rows_of):
    alert = feed_alert(match_text(F.col("t"), F.col("c")), F.col("inc"), F.col("exc"))
    got = rows_of([a[:4] for a in ALERTS], "t string, c string, inc array<string>, exc array<string>", alert)
    assert [tuple(r[0]) for r in got] == [a[4] for a in ALERTS]


@pytest.mark.parametrize("limit", [100, 0])
def test_tagging_keeps_every_row(spark, tmp_path, monkeypatch, limit):
    """The same rows come out of the broadcast and of the salted join."""
    monkeypatch.setattr(joins.join_small, "__defaults__", ("inner", "pos", limit))
    registry = feeds.load_feeds(spark, written(tmp_path, REGISTRY))
    data = [(i, "A" if i % 3 else "unknown", "AI" if i % 2 else "x", "", i) for i in range(60)]
    rows = spark.createDataFrame(data, "id int, source string, title string, content string, pos long")
    got = {r["id"]: (r["should_alert"], r["matched_keywords"]) for r in tag_articles(rows, registry).collect()}
    assert got == {i: (True, ["ai"]) if i % 3 and i % 2 else (False, []) for i in range(60)}
