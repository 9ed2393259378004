import json

import pytest
from tests.test_messages import envelope

from newsloom.operators import storage
from newsloom.schemas import STORAGE_ROW, columns
from newsloom.session import run_dir
from newsloom.sources import tables, topics

PAYLOAD = {
    "article_id": "k-17", "source": "Harbour Post", "matched_feed_name": "harbour", "title": " Ferry runs again ",
    "summary": "The pier is mended.", "url": "https://harbour.test/ferry", "keywords": ["pier", None, 5],
    "published_at": "2021-05-02T06:30:00Z", "ingested_at": "2021-05-02T06:45:10Z", "category": "Du lich",
    "raw_hash": "0f1e2d", "is_duplicate": False, "should_alert": "false", "matched_keywords": "ferry",
    "_published_at_source": "rss", "raw_payload": {"id": "h-9", "lines": [1, 2]},
}


def test_flatten(spark):
    values = [PAYLOAD, {"title": None, "keywords": " ", "raw_payload": None}, "[1]", "nonsense"]
    rows = storage.storage_rows(envelope(spark, values, "processed_news"))
    assert rows.columns == columns(STORAGE_ROW)
    assert [f.dataType.simpleString() for f in rows.schema] == [c.split()[1] for c in STORAGE_ROW.split(", ")]
    full, empty = rows.orderBy("kafka_offset").collect()
    assert (full["title"], full["keywords"], full["matched_keywords"]) == ("Ferry runs again", ["pier", "5"], ["ferry"])
    assert (full["is_duplicate"], full["should_alert"], full["published_at_source"]) == (False, True, "rss")
    assert json.loads(full["raw_payload_json"]) == PAYLOAD["raw_payload"]
    assert (full["source_topic"], full["kafka_partition"], full["kafka_offset"]) == ("processed_news", 0, 0)
    assert (empty["title"], empty["url"], empty["keywords"], empty["raw_payload_json"]) == ("", "", [], "null")


def test_config():
    config = tables.TableConfig("s3://harbour-store/tables/", catalog="lake", table_format="iceberg",
                                rest_uri="http://catalog:8181", endpoint="http://store:9000")
    assert config.name == "lake.news.processed_news"
    assert config.location == "s3://harbour-store/tables/news/processed_news"
    conf = config.catalog_conf()
    assert conf["spark.sql.catalog.lake.type"] == "rest"
    assert conf["spark.sql.catalog.lake.uri"] == "http://catalog:8181"
    assert conf["spark.sql.catalog.lake.s3.endpoint"] == "http://store:9000"
    assert tables.TableConfig("w").catalog_conf() == {} and tables.TableConfig("w").name == "news.processed_news"


def test_append_is_idempotent(spark):
    config = tables.TableConfig(run_dir(spark, "warehouse"), namespace="append_test")
    name = tables.create_table(spark, config)
    assert tables.create_table(spark, config) == name
    rows = storage.storage_rows(envelope(spark, [dict(PAYLOAD, article_id=str(i)) for i in range(8)], "processed_news"))
    assert tables.append_new(rows.filter("kafka_offset < 5"), name) == 5
    assert tables.append_new(rows.filter("kafka_offset < 5"), name) == 0
    assert tables.append_new(rows, name) == 3
    assert tables.append_new(rows.filter("kafka_offset > 100"), name) == 0
    table = tables.scan(spark, name)
    assert table.count() == 8 and table.columns == columns(STORAGE_ROW)
    assert [r["kafka_offset"] for r in storage.latest_rows(table, 3).collect()] == [7, 6, 5]
    assert "append_test" in [r[0] for r in tables.schemas(spark).collect()]
    assert [r["tableName"] for r in tables.tables(spark, "append_test").collect()] == ["processed_news"]
    files = spark.read.format("binaryFile").load(config.location).select("path").collect()
    assert files and all("zstd" in r["path"] for r in files)


def test_scan_prunes_and_pushes(spark):
    config = tables.TableConfig(run_dir(spark, "warehouse"), namespace="prune_test")
    name = tables.create_table(spark, config)
    plan = spark.sql(f"SELECT title FROM {name} WHERE source = 'x'")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<source:string,title:string>" in plan and "EqualTo(source,x)" in plan


def test_peek(spark):
    assert [r["offset"] for r in topics.peek(envelope(spark, [{}] * 9), 3).collect()] == [0, 1, 2]


def test_kafka_options():
    with pytest.raises(ValueError):
        topics._kafka_options("b:9092", "raw_news", "newest")
    assert topics._kafka_options("b:9092", "raw_news", "latest")["startingOffsets"] == "latest"
