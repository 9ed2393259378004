from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.operators.alerts import alert_outbox
from newsloom.streaming import jobs

SCHEMA = ("article_id string, title string, summary string, content string, url string, source string, "
          "category string, keywords array<string>, should_alert boolean")


def messages(spark, rows, **options):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], SCHEMA)
    return {int(r["article_id"]): r["message"] for r in alert_outbox(df, **options).collect()}


def test_whole_message(spark):
    row = ("Pier & ferry <i>late</i> \"p\" 'q' ", "Bến phà sửa xong.", "", "https://harbour.test/news?id=4&lang=vi",
           "VNExpress - Kinh doanh", "Công nghệ", ["pier", "r&d", "slow boat", "d", "e", "f"], True)
    assert messages(spark, [row])[0] == "\n".join([
        "💼 <b>Pier &amp; ferry &lt;i&gt;late&lt;/i&gt; &quot;p&quot; &#x27;q&#x27;</b>", "📂 <i>Công nghệ</i>", "",
        "Bến phà sửa xong.", "", "🏷 #pier #r&d #slow_boat #d #e", "",
        '🔗 <a href="https://harbour.test/news?id=4&amp;lang=vi">Read more</a>'])


def test_left_out_lines(spark):
    row = ("Phà đêm", None, "Chạy đến nửa đêm", "", "VNExpress", "", [], None)
    assert messages(spark, [row])[0] == "📰 <b>Phà đêm</b>\n📌 <i>VNExpress</i>\n\nChạy đến nửa đêm"
    bare = (None, "", "unused", "", "", "", None, None)
    assert messages(spark, [bare])[0] == "📡 <b>No title</b>"


def test_preview_text(spark):
    tags = '<p class="x"><br/></p>Bến  phà　số ba&nbsp;mở'
    rows = [("t", s, "", "", "s", "", [], True) for s in (
        tags, "x" * 300, "x" * 301, "&amp;lt;b&amp;gt; &lt;i&gt;kept&lt;/i&gt; &eacute;")]
    got = messages(spark, rows)
    assert got[0].endswith("\n\nBến phà số ba mở")
    assert got[1].endswith("\n" + "x" * 300) and got[2].endswith("\n" + "x" * 297 + "…")
    # Decoded once, tags removed after decoding, the rest escaped again.
    assert got[3].endswith("\n\n&lt;b&gt; kept é".replace("&lt;", "&amp;lt;").replace("&gt;", "&amp;gt;"))


def test_alert_filter(spark):
    rows = [("t", "s", "", "", "s", "", [], flag) for flag in (True, False, None)]
    assert set(messages(spark, rows)) == {0, 2}
    assert set(messages(spark, rows, only_matched=False)) == {0, 1, 2}


def test_escape_and_unescape(rows_of):
    import html
    texts = ["a & b < c > \"d\" 'e'", "&amp;&copy;&#233;&#xE9;&notit;&unknown;", "plain"]
    got = rows_of([(t,) for t in texts], "s string", H.escape(F.col("s")), H.unescape(F.col("s")))
    assert got == [(html.escape(t), html.unescape(t)) for t in texts]


def test_names_and_pace():
    assert jobs.query_name("alerts", "realtime") == "alerts-realtime"
    assert jobs.query_name("alerts", "other") == "alerts-realtime"
    assert jobs.query_name("alerts-backfill", "backfill") == "alerts-backfill"
    assert jobs.query_name("alerts", "backfill", scoped=False) == "alerts"
    assert jobs.alert_pace() == ("60 seconds", 54)
    assert (jobs.starting_offsets("realtime"), jobs.starting_offsets("backfill")) == ("latest", "earliest")
    assert jobs.writer_interval() == "60 seconds"
