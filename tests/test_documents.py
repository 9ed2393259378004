import datetime

import pytest

from newsloom.plans import jobs
from newsloom.schemas import FEED_DOCUMENTS, FEEDS
from newsloom.sources import documents as D

AT = datetime.datetime(2024, 3, 23, 12, 0, tzinfo=datetime.timezone.utc)

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>feed</title>
<item><title>  AI &amp; more </title><link> https://a/1 </link><description><![CDATA[<b>Giá</b> vàng]]></description>
  <pubDate>Sat, 23 Mar 2024 17:00:00 +0700</pubDate></item>
<item><title>no link</title><link></link></item>
<item><title>guid</title><guid>https://a/2</guid><content:encoded>body</content:encoded><dc:date>2024-03-23T10:00:00Z</dc:date></item>
<item><title>guid only id</title><guid isPermaLink="false">urn:2</guid></item>
<item><title>bad date</title><link>https://a/3</link><pubDate>soon</pubDate></item>
</channel></rss>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>feed</title>
<entry><title type="html">first</title><link rel="self" href="https://c/self"/><link rel="alternate" href="https://c/1"/>
  <summary>sum</summary><updated>2024-03-23T10:00:00Z</updated></entry>
<entry><title>second</title><link href="https://c/2"/><content type="html">text</content>
  <published>2024-03-22T10:00:00+07:00</published><updated>2024-03-23T10:00:00Z</updated></entry></feed>"""

RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><channel><title>t</title></channel>
<item><title>old style</title><link>https://r/1</link><description>d</description></item></rdf:RDF>"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([
        ("A", 200, RSS, AT), ("C", 200, ATOM, AT), ("R", 200, RDF, AT), ("A", 200, RSS[:-30], AT), ("A", 404, RSS, AT),
        ("A", 200, None, AT), ("A", 200, "", AT), ("off", 200, RSS, AT)], FEED_DOCUMENTS)


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([
        (0, "A", "u", True, "", ["ai"], []), (1, "R", "u", True, "", [], []), (2, "C", "u", True, "", [], ["text"])], FEEDS)


def test_entries(docs):
    rows = D.entries(D.parse_documents(D.fetched(docs).filter("feed_name <> 'off'"))).collect()
    got = {r["url"]: (r["feed_name"], r["entry_pos"], r["title"], r["content"], r["published_ts"]) for r in rows}
    assert len(rows) == len(got) == 6
    assert got == {
        "https://a/1": ("A", 0, "AI & more", "<b>Giá</b> vàng", 1711188000),
        "https://a/2": ("A", 2, "guid", "body", 1711188000),
        "https://a/3": ("A", 4, "bad date", "", None),
        "https://c/1": ("C", 0, "first", "sum", 1711188000),
        "https://c/2": ("C", 1, "second", "text", 1711076400),
        "https://r/1": ("R", 0, "old style", "d", None),
    }


def test_broken_documents_are_set_apart(docs):
    broken = D.broken_documents(D.parse_documents(D.fetched(docs)))
    assert [r["body"] for r in broken.collect()] == [RSS[:-30], ""]


def test_crawl_and_backfill(docs, registry):
    rows = {r["url"]: r for r in D.crawl(docs, registry).collect()}
    assert {u: (r["should_alert"], r["matched_keywords"]) for u, r in rows.items()} == {
        "https://a/1": (True, ["ai"]), "https://a/2": (False, []), "https://a/3": (False, []),
        "https://r/1": (True, []), "https://c/1": (True, []), "https://c/2": (False, [])}
    assert all(r["timestamp"] == int(AT.timestamp()) and r["source"] == r["matched_feed_name"] for r in rows.values())
    picked = jobs.backfill(docs, registry, per_feed_limit=1, total_limit=2, now=int(AT.timestamp()))
    assert sorted(r["url"] for r in picked.collect()) == ["https://a/1", "https://r/1"]
    report = jobs.backfill_report(docs, registry, per_feed_limit=1, now=int(AT.timestamp()))
    assert {r["feed_ord"]: (r["published"], r["skip_per_feed_limit"]) for r in report.collect()} == {
        0: (1, 2), 1: (1, 0), 2: (1, 1)}


def test_files_named_by_feed(spark, tmp_path):
    folder = tmp_path / "A - B"
    folder.mkdir()
    (folder / "1.xml").write_text(RSS, encoding="utf-8")
    rows = D.entries(D.parse_documents(D.read_document_files(spark, str(tmp_path)))).collect()
    assert {r["feed_name"] for r in rows} == {"A - B"} and len(rows) == 3
