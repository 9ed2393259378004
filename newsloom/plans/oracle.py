"""SQL checks for the registered queries, over the same tables.

They are written from the rules of the operators, not from their code: joins,
window functions and recursion take the place of arrays, partial aggregates and
batch functions.
"""

from __future__ import annotations

from newsloom.functions import alerts as A
from newsloom.functions import rules as R
from newsloom.functions import times as M
from newsloom.plans import fixture as X
from newsloom.plans import queries as Q

SQL: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# White space of the trimming rule: U+0009-000D, U+001C-0020, U+0085 and the Unicode separators.
SPACE_CHARS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(e: str) -> str:
    return f"trim({e}, {lit(SPACE_CHARS)})"


def values(rules: R.RuleSet) -> str:
    return ", ".join(f"({c}, {lit(cat)}, {k}, {lit(kw)})" for c, cat, k, kw in rules.rows())


def iso(seconds: str) -> str:
    return f"strftime(make_timestamp(CAST(floor({seconds}) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


# Derived streams ----------------------------------------------------------------------------

TITLE = "split_part(text, chr(10), 1)"
NEWS = f"""
news AS (
  SELECT doc_id, source, {TITLE} AS title, text AS content,
         'https://' || source || '.example.com/' || substr(sha256({TITLE}), 1, 12) AS url,
         {X.START} + (doc_id * 37) % {X.SPREAD} AS ts,
         CASE WHEN doc_id % 7 <> 0 THEN {X.START} + (doc_id * 37) % {X.SPREAD} - (doc_id % 5) * 86400 END AS published_ts,
         doc_id % 4 AS part, doc_id // 4 AS off
  FROM documents)"""

KEYED = f"""
keyed AS (
  SELECT *, {strip('title')} AS ttl, {strip('content')} AS body,
         sha256(lower({strip('url')}) || '|' || lower({strip('title')})) AS raw_hash,
         sha256(lower({strip('url')})) AS url_hash,
         lower(title || ' ' || content) AS t, lower({strip('title')} || ' ' || {strip('content')}) AS tt
  FROM news)"""

FIRSTS = """
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_hash ORDER BY part, off) AS rn FROM keyed) WHERE rn = 1)"""


def hits(name: str, base: str, rules: R.RuleSet, text: str) -> str:
    """(doc_id, k, keyword, category): every keyword once, at its first place in the rules."""
    return f"""
{name}_rules(cat_ord, category, kw_ord, keyword) AS (VALUES {values(rules)}),
{name} AS (
  SELECT b.doc_id, min(r.kw_ord) AS k, r.keyword, arg_min(r.category, r.kw_ord) AS category
  FROM {base} b JOIN {name}_rules r ON contains(b.{text}, r.keyword) GROUP BY b.doc_id, r.keyword)"""


def labels(name: str, limit: int = 8) -> str:
    """(doc_id, category, keywords) of a hits table, first match wins."""
    return f"""
{name}_labels AS (
  SELECT doc_id, arg_min(category, k) AS category,
         string_agg(keyword, '|' ORDER BY k) FILTER (rn <= {limit}) AS keywords
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS rn FROM {name}) GROUP BY doc_id)"""


def scored(name: str, limit: int = 8) -> str:
    """(doc_id, category, score, rank) and labels of a scored rule set."""
    return f"""
{name}_scores AS (
  SELECT doc_id, category, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cat_ord) AS rank
  FROM (SELECT h.doc_id, r.category, r.cat_ord, count(DISTINCT r.keyword) AS score
        FROM {name} h JOIN {name}_rules r ON r.keyword = h.keyword GROUP BY ALL))"""


def regex_escape(mark: str) -> str:
    return mark.replace(".", "\\.").replace("?", "\\?").replace("!", "\\!").replace("\n", "\\n")


def last_index(head: str, mark: str) -> str:
    """0-based place of the last mark, -1 for none."""
    pattern = lit("(?s)^(.*)" + regex_escape(mark))
    return f"CASE WHEN contains({head}, {lit(mark)}) THEN length(regexp_extract({head}, {pattern}, 1)) ELSE -1 END"


def summary(title: str, body: str) -> str:
    n = 300
    head = f"left({body}, {n})"
    cases = " ".join(
        f"WHEN {last_index(head, m)} > {n // 2} THEN {strip(f'left({head}, {last_index(head, m)} + {len(m)})')} || '…'"
        for m in (". ", "。", "! ", "? ", "\n"))
    return (f"CASE WHEN {body} = '' THEN {title} WHEN length({body}) <= {n} THEN {body} {cases} "
            f"ELSE {strip(head)} || '…' END")


def short_summary(title: str, body: str) -> str:
    n = 200
    head = f"left({body}, {n})"
    last = "greatest(" + ", ".join(f"({last_index(head, m)})" for m in (". ", "。", "! ")) + ")"
    return (f"CASE WHEN {body} = '' THEN {strip(title)} WHEN length({body}) <= {n} THEN {body} "
            f"WHEN {last} > {n // 2} THEN {strip(f'left({head}, {last} + 1)')} ELSE {strip(head)} || '…' END")


FEEDS = """
registry AS (
  SELECT DISTINCT source AS name, CAST(substr(source, 4) AS INT) AS feed_ord,
         'https://' || source || '.example.com/rss' AS url FROM documents),
feed_words(kind, word_ord, modulus, remainder, word) AS (VALUES
  ('include', 1, 4, 1, 'the '), ('include', 2, 4, 1, 'ation'), ('include', 1, 4, 2, 'ung'), ('include', 2, 4, 2, 'sch'),
  ('include', 1, 4, 3, 'ai'), ('include', 2, 4, 3, 'oil'), ('include', 3, 4, 3, 'ción'), ('exclude', 1, 5, 0, 'license')),
feed_rules AS (
  SELECT r.name, r.feed_ord, r.url, w.kind, w.word_ord, w.word
  FROM registry r LEFT JOIN feed_words w ON r.feed_ord % w.modulus = w.remainder WHERE r.feed_ord <> 19)"""


def tagged(base: str, text: str, name: str = "tagged", key: str = "doc_id") -> str:
    return f"""
{name} AS (
  SELECT b.{key},
         count(f.name) > 0 AND count(*) FILTER (f.kind = 'exclude' AND contains(b.{text}, f.word)) = 0
           AND (count(*) FILTER (f.kind = 'include') = 0
                OR count(*) FILTER (f.kind = 'include' AND contains(b.{text}, f.word)) > 0) AS should_alert,
         CASE WHEN count(*) FILTER (f.kind = 'exclude' AND contains(b.{text}, f.word)) > 0 THEN '' ELSE
           coalesce(string_agg(f.word, '|' ORDER BY f.word_ord)
                    FILTER (f.kind = 'include' AND contains(b.{text}, f.word)), '') END AS matched_keywords
  FROM {base} b LEFT JOIN feed_rules f ON f.name = b.source GROUP BY b.{key})"""


SEEN = f"""
seen AS (SELECT DISTINCT url_hash FROM keyed WHERE doc_id IN (SELECT doc_id FROM labels))"""

WITH_NEWS = f"WITH {NEWS}, {KEYED}"


def add(name: str, sql: str) -> None:
    SQL[name] = sql


# Articles -----------------------------------------------------------------------------------

FIRST_HITS = hits("h", "keyed", R.FIRST_MATCH_RULES, "t") + "," + labels("h")
FIRST_TRIMMED = hits("h", "firsts", R.FIRST_MATCH_RULES, "tt") + "," + labels("h")

PROCESSED = f"""
processed AS (
  SELECT f.doc_id, f.part, f.off, left(f.url_hash, 32) AS article_id, f.source, f.source AS matched_feed_name, f.ttl AS title,
         {summary('f.ttl', 'f.body')} AS summary, {strip('f.url')} AS url, coalesce(l.keywords, '') AS keywords,
         {iso('coalesce(f.published_ts, f.ts)')} AS published_at,
         CASE WHEN f.published_ts IS NULL THEN 'ingestion_fallback' ELSE 'rss' END AS _published_at_source,
         {iso(str(X.NOW))} AS ingested_at, coalesce(l.category, {lit(R.DEFAULT_CATEGORY)}) AS category,
         f.raw_hash, FALSE AS is_duplicate, FALSE AS should_alert
  FROM firsts f LEFT JOIN h_labels l USING (doc_id))"""

WITH_PROCESSED = f"{WITH_NEWS}, {FIRSTS}, {FIRST_TRIMMED}, {PROCESSED}"

add("process_articles", f"{WITH_PROCESSED} SELECT * EXCLUDE (part, off) FROM processed")
add("classify_first_match", f"""{WITH_NEWS}, {FIRST_HITS}
SELECT n.doc_id, coalesce(l.category, {lit(R.DEFAULT_CATEGORY)}) AS category FROM news n LEFT JOIN h_labels l USING (doc_id)""")
add("extract_keywords", f"""{WITH_NEWS}, {FIRST_HITS}
SELECT n.doc_id, coalesce(l.keywords, '') AS keywords FROM news n LEFT JOIN h_labels l USING (doc_id)""")

SPREAD = R.RuleSet.from_text(X.SPREAD_RULES)
add("classify_rules_table", f"""{WITH_NEWS}, {hits('h', 'keyed', SPREAD, 't')}, {labels('h')}
SELECT n.doc_id, coalesce(l.category, {lit(R.DEFAULT_CATEGORY)}) AS category, coalesce(l.keywords, '') AS keywords
FROM news n LEFT JOIN h_labels l USING (doc_id)""")

add("classify_rules_joined", SQL["classify_rules_table"])

SCORED_HITS = f"{hits('s', 'keyed', R.SCORED_RULES, 't')}, {labels('s')}, {scored('s')}"
add("classify_by_score", f"""{WITH_NEWS}, {SCORED_HITS}
SELECT n.doc_id, coalesce(b.category, {lit(R.DEFAULT_CATEGORY)}) AS category, coalesce(l.keywords, '') AS keywords
FROM news n LEFT JOIN s_labels l USING (doc_id) LEFT JOIN (SELECT * FROM s_scores WHERE rank = 1) b USING (doc_id)""")
add("category_scores", f"{WITH_NEWS}, {SCORED_HITS} SELECT doc_id, category, score, rank FROM s_scores")
add("category_counts", f"{WITH_PROCESSED} SELECT source, category, count(*) AS articles FROM processed GROUP BY ALL")
add("summaries", f"{WITH_NEWS} SELECT doc_id, {summary('ttl', 'body')} AS summary FROM keyed")
add("short_summaries", f"{WITH_NEWS} SELECT doc_id, {short_summary('title', 'body')} AS summary FROM keyed")
add("article_ids", f"{WITH_NEWS} SELECT doc_id, left(url_hash, 32) AS article_id, raw_hash, url_hash FROM keyed")

SPACES = "[" + SPACE_CHARS + "]+"
add("canonical_texts", f"""
WITH padded AS (SELECT conv_id, turn, {lit(" ")} || chr(31) || ' ' || chr(10) || text || chr(9) || ' ' || chr(133) AS p
                FROM conversations)
SELECT conv_id, turn, lower({strip('p')}) AS canonical, {strip(f"regexp_replace(p, {lit(SPACES)}, ' ', 'g')")} AS collapsed
FROM padded""")
add("published_times", f"""{WITH_NEWS}, timed AS (SELECT *, coalesce(published_ts, ts) AS s FROM news)
SELECT doc_id, {iso('s')} AS published_at,
       CASE WHEN published_ts IS NULL THEN 'ingestion_fallback' ELSE 'rss' END AS time_source,
       {iso('s - 0.5')} AS half_second_earlier,
       CASE WHEN -s * 37 < {M.FIRST_SECOND} THEN 'now' ELSE {iso('-s * 37')} END AS long_ago
FROM timed""")
add("feed_dates", """
SELECT event_id, CAST(CASE event_id % 8
    WHEN 7 THEN NULL WHEN 6 THEN epoch(date_trunc('day', ts))
    ELSE floor(epoch(ts)) + CASE event_id % 8 WHEN 1 THEN -7 * 3600 WHEN 2 THEN 5 * 3600 WHEN 3 THEN 7 * 3600
                                              WHEN 5 THEN 12600 ELSE 0 END END AS BIGINT) AS epoch
FROM events""")

# Duplicates ---------------------------------------------------------------------------------

add("dedup_first", f"{WITH_NEWS}, {FIRSTS} SELECT doc_id, raw_hash FROM firsts")
add("dedup_flags", f"""{WITH_NEWS}
SELECT doc_id, row_number() OVER (PARTITION BY raw_hash ORDER BY part, off) > 1 AS is_duplicate FROM keyed""")


def ttl(source: str, key: str, seconds: str, ttl_seconds: int) -> str:
    """(key, seconds) accepted by a fixed-anchor window: start at the first, jump to the next one out of reach."""
    return f"""
accepted AS (
  SELECT {key}, min({seconds}) AS s FROM {source} GROUP BY {key}
  UNION ALL
  SELECT * FROM (SELECT a.{key}, (SELECT min(e.{seconds}) FROM {source} e
                                  WHERE e.{key} = a.{key} AND e.{seconds} > a.s + {ttl_seconds}) AS s FROM accepted a)
  WHERE s IS NOT NULL)"""


EVENT_SECONDS = "ev AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events)"
add("dedup_ttl", f"""WITH RECURSIVE {EVENT_SECONDS}, {ttl('ev', 'user_id', 'seconds', 6 * 3600)}
SELECT min(event_id) AS event_id, user_id, seconds FROM ev JOIN accepted a USING (user_id)
WHERE seconds = a.s GROUP BY user_id, seconds""")
add("dedup_ttl_flags", f"""WITH RECURSIVE {EVENT_SECONDS}, {ttl('ev', 'event_type', 'seconds', 600)}
SELECT event_id, NOT (a.s IS NOT NULL AND
       row_number() OVER (PARTITION BY ev.event_type, ev.seconds ORDER BY event_id) = 1) AS is_duplicate
FROM ev LEFT JOIN accepted a ON a.event_type = ev.event_type AND a.s = ev.seconds""")
add("seen_anti_join", f"""{WITH_NEWS}, {SEEN}
SELECT url_hash, arg_min(doc_id, part * 100000000000 + off) AS doc_id FROM keyed
WHERE url_hash NOT IN (SELECT url_hash FROM seen) GROUP BY url_hash""")
add("seen_size", f"{WITH_NEWS}, {SEEN} SELECT count(*) AS urls FROM seen")
add("latest_urls", f"""{WITH_NEWS}
SELECT url_hash FROM (SELECT url_hash, min(part * 100000000000 + off) AS seq FROM keyed GROUP BY url_hash)
ORDER BY seq DESC, url_hash LIMIT 50""")

# Feeds and crawling -------------------------------------------------------------------------

add("enabled_feeds", f"""WITH {FEEDS}
SELECT feed_ord, name, url, coalesce(string_agg(word, '|' ORDER BY word_ord) FILTER (kind = 'include'), '') AS include_keywords,
       coalesce(string_agg(word, '|' ORDER BY word_ord) FILTER (kind = 'exclude'), '') AS exclude_keywords
FROM feed_rules GROUP BY feed_ord, name, url""")
add("feed_alerts", f"{WITH_NEWS}, {FEEDS}, {tagged('keyed', 't')} SELECT * FROM tagged")
add("alert_counts", f"""{WITH_NEWS}, {FEEDS}, {tagged('keyed', 't')}
SELECT source, count(*) AS articles, count(*) FILTER (should_alert) AS alerts FROM tagged JOIN news USING (doc_id) GROUP BY source""")

OUTCOMES = f"""
labelled AS (
  SELECT doc_id, CASE WHEN url_hash IN (SELECT url_hash FROM seen)
                        OR row_number() OVER (PARTITION BY url_hash ORDER BY part, off) > 1 THEN 'skip_dedup'
                      WHEN published_ts IS NULL THEN 'skip_no_ts' WHEN published_ts < {X.STARTUP} THEN 'skip_old'
                      ELSE 'published' END AS outcome
  FROM keyed)"""
add("realtime_outcomes", f"{WITH_NEWS}, {SEEN}, {OUTCOMES} SELECT * FROM labelled")
add("realtime_counters", f"""{WITH_NEWS}, {SEEN}, {OUTCOMES}
SELECT count(*) FILTER (outcome = 'published') AS published, count(*) FILTER (outcome = 'skip_old') AS skip_old,
       count(*) FILTER (outcome = 'skip_no_ts') AS skip_no_ts, count(*) FILTER (outcome = 'skip_dedup') AS skip_dedup
FROM labelled""")


def backfill(per_feed: int | None, total: int | None, days: int | None) -> str:
    """Every row with its place in the run: eligible, rank in its feed, rank in all."""
    fresh = "TRUE" if days is None else f"(published_ts IS NULL OR published_ts >= {X.NOW - days * 86400})"
    in_feed = "TRUE" if per_feed is None else f"feed_rank <= {per_feed}"
    in_all = "TRUE" if total is None else f"total_rank <= {total}"
    return f"""
ordered AS (SELECT doc_id, CAST(substr(source, 4) AS INT) AS feed_ord, title, {fresh} AS fresh FROM news),
ranked AS (SELECT *, row_number() OVER (PARTITION BY feed_ord, fresh ORDER BY doc_id) AS feed_rank FROM ordered),
wanted AS (SELECT *, fresh AND {in_feed} AS wanted FROM ranked),
placed AS (SELECT *, sum(CASE WHEN wanted THEN 1 ELSE 0 END) OVER (ORDER BY feed_ord, doc_id) AS total_rank FROM wanted),
run AS (SELECT *, wanted AND {in_all} AS published FROM placed)"""


def counters(total: int | None) -> str:
    """Counters of the rows before the first wanted row that is not published."""
    return f"""
stops AS (SELECT min(feed_ord * 1000000000000 + doc_id) AS stop FROM run WHERE wanted AND NOT published),
counted AS (
  SELECT feed_ord, count(*) FILTER (before AND published) AS published, count(*) FILTER (before AND NOT fresh) AS skip_old,
         count(*) FILTER (before AND fresh AND NOT wanted) AS skip_per_feed_limit
  FROM (SELECT *, stop IS NULL OR feed_ord * 1000000000000 + doc_id < stop AS before FROM run, stops)
  WHERE stop IS NULL OR feed_ord <= stop // 1000000000000 GROUP BY feed_ord)"""


add("backfill_rows", f"""{WITH_NEWS}, {backfill(Q.PER_FEED, Q.TOTAL, Q.DAYS)}
SELECT feed_ord, doc_id, title FROM run WHERE published""")
add("backfill_by_days", f"{WITH_NEWS}, {backfill(None, None, Q.DAYS)} SELECT feed_ord, doc_id FROM run WHERE published")
add("backfill_per_feed", f"{WITH_NEWS}, {backfill(Q.PER_FEED, None, None)} SELECT feed_ord, doc_id FROM run WHERE published")
add("backfill_total", f"{WITH_NEWS}, {backfill(None, Q.TOTAL, None)} SELECT feed_ord, doc_id FROM run WHERE published")
add("backfill_counters", f"{WITH_NEWS}, {backfill(Q.PER_FEED, Q.TOTAL, Q.DAYS)}, {counters(Q.TOTAL)} SELECT * FROM counted")
add("backfill_totals", f"""{WITH_NEWS}, {backfill(Q.PER_FEED, None, Q.DAYS)}, {counters(None)}
SELECT * FROM counted UNION ALL
SELECT NULL, CAST(sum(published) AS BIGINT), CAST(sum(skip_old) AS BIGINT), CAST(sum(skip_per_feed_limit) AS BIGINT) FROM counted""")

LINES = f"""
doc_lines AS (
  SELECT n.*, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) - 1 AS i
  FROM news n),
items AS (
  SELECT doc_id, CAST(i AS INTEGER) AS entry_pos, url || '/' || i AS url, {strip('line')} AS title, {strip('line')} AS content,
         CASE WHEN i % 2 = 0 THEN ts + i * 3600 END AS published_ts, source, ts
  FROM doc_lines)"""
ATOM = f"""
atoms AS (
  SELECT doc_id, CAST(0 AS INTEGER) AS entry_pos, url, {strip('title')} AS title, {strip('content')} AS content, ts - 7 * 3600 AS published_ts,
         source, ts FROM news)"""
add("rss_entries", f"{WITH_NEWS}, {LINES} SELECT doc_id, entry_pos, url, title, content, published_ts FROM items")
add("atom_entries", f"{WITH_NEWS}, {ATOM} SELECT doc_id, entry_pos, url, title, content, published_ts FROM atoms")
add("broken_documents", "SELECT page_id, url AS feed_name, CAST(length(html) AS INTEGER) AS chars FROM pages")
add("crawl", f"""{WITH_NEWS}, {FEEDS}, {LINES}, {ATOM},
entries AS (SELECT *, row_number() OVER () AS entry, lower(title || ' ' || content) AS t
            FROM (SELECT * FROM items UNION ALL SELECT * FROM atoms)),
{tagged('entries', 't', key='entry')}
SELECT left(sha256(concat_ws('|', e.source, e.url, e.title, e.published_ts)), 32) AS id, e.title, e.url, e.source,
       e.ts AS timestamp, e.published_ts, g.should_alert, g.matched_keywords, r.feed_ord, e.entry_pos
FROM entries e JOIN tagged g USING (entry) JOIN (SELECT DISTINCT name, feed_ord FROM feed_rules) r ON r.name = e.source""")

# Messages, storage, alerts ------------------------------------------------------------------

K = f"doc_id % {X.FAULTS}"
REASONS = f"""
reasons AS (
  SELECT doc_id, CASE {K} WHEN 1 THEN 'bad_json' WHEN 2 THEN 'not_an_object'
    WHEN 3 THEN 'missing_url' WHEN 4 THEN 'missing_url' WHEN 5 THEN 'missing_url' WHEN 16 THEN 'missing_url'
    WHEN 7 THEN 'process_error' WHEN 8 THEN 'process_error' WHEN 11 THEN 'process_error'
    WHEN 12 THEN 'process_error' WHEN 15 THEN 'process_error' END AS reason FROM documents)"""
add("quarantine", f"WITH {REASONS} SELECT * FROM reasons WHERE reason IS NOT NULL")

GOOD = f"""
good AS (
  SELECT doc_id, part, off, CASE WHEN {K} = 6 THEN '' ELSE url END AS url, {strip('title')} AS title,
         {strip('content')} AS content, source, CASE WHEN {K} = 14 THEN source ELSE 'feed ' || source END AS matched_feed_name,
         CASE WHEN {K} = 10 THEN ts + 0.75 WHEN published_ts IS NULL THEN ts ELSE published_ts END::DOUBLE AS seconds,
         CASE WHEN {K} = 10 OR published_ts IS NULL THEN 'ingestion_fallback' ELSE 'rss' END AS time_source,
         CASE WHEN {K} = 13 THEN TRUE WHEN {K} = 17 THEN FALSE ELSE doc_id % 3 = 0 END AS should_alert,
         CASE WHEN doc_id % 2 = 0 THEN 'the |' || source ELSE '' END AS matched_keywords
  FROM news JOIN reasons USING (doc_id) WHERE reason IS NULL)"""
GOOD_KEYED = f"""
good_keyed AS (
  SELECT *, sha256(lower(url) || '|' || lower(title)) AS raw_hash, lower(title || ' ' || content) AS tt,
         row_number() OVER (PARTITION BY lower(url), lower(title) ORDER BY part, off) AS rn FROM good)"""
WITH_GOOD = f"{WITH_NEWS}, {REASONS}, {GOOD}"
add("parsed_messages", f"{WITH_GOOD} SELECT * EXCLUDE (part, off) FROM good")
PROCESS_MESSAGES = f"""{WITH_GOOD}, {GOOD_KEYED}, good_firsts AS (SELECT * FROM good_keyed WHERE rn = 1),
{hits('h', 'good_firsts', R.FIRST_MATCH_RULES, 'tt')}, {labels('h')}
SELECT doc_id, left(sha256(lower(url)), 32) AS article_id, raw_hash, title, {summary('title', 'content')} AS summary,
       coalesce(l.category, {lit(R.DEFAULT_CATEGORY)}) AS category, coalesce(l.keywords, '') AS keywords,
       {iso('seconds')} AS published_at, should_alert
FROM good_firsts LEFT JOIN h_labels l USING (doc_id)"""
add("process_messages", PROCESS_MESSAGES)
add("stream_processor", PROCESS_MESSAGES)
add("processor_counters", f"""{WITH_GOOD}, {GOOD_KEYED}
SELECT (SELECT count(*) FROM news) AS total, count(*) FILTER (rn = 1) AS published,
       count(*) FILTER (rn > 1) AS dropped_duplicates,
       (SELECT count(*) FROM reasons WHERE reason IS NOT NULL) AS errors
FROM good_keyed""")
add("topic_peek", f"""{WITH_NEWS}
SELECT CAST(part AS INT) AS partition, off AS offset, CAST(doc_id AS VARCHAR) AS key FROM news ORDER BY off, part LIMIT 25""")

ALT = f"""
cells AS (SELECT * FROM keyed WHERE url <> '' AND title <> ''),
{ttl('cells', 'url_hash', 'ts', 600)},
alt AS (
  SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.url_hash, c.ts ORDER BY part, off) AS rn
                 FROM cells c JOIN accepted a ON a.url_hash = c.url_hash AND a.s = c.ts) WHERE rn = 1)"""
WITH_ALT = f"WITH RECURSIVE {NEWS}, {KEYED}, {ALT}"
add("alt_process_articles", f"""{WITH_ALT}, {hits('s', 'alt', R.SCORED_RULES, 't')}, {labels('s')}, {scored('s')}
SELECT CAST(a.doc_id AS VARCHAR) AS id, title, {short_summary('title', 'body')} AS summary, url,
       coalesce(l.keywords, '') AS keywords, coalesce(b.category, {lit(R.DEFAULT_CATEGORY)}) AS category, source,
       ts AS timestamp, CAST({X.NOW} AS BIGINT) AS processed_at
FROM alt a LEFT JOIN s_labels l ON l.doc_id = a.doc_id LEFT JOIN (SELECT * FROM s_scores WHERE rank = 1) b ON b.doc_id = a.doc_id""")
add("alt_counters", f"""{WITH_ALT}
SELECT (SELECT count(*) FROM alt) AS processed, (SELECT count(*) FROM cells) - (SELECT count(*) FROM alt) AS duplicates,
       (SELECT count(*) FROM news) - (SELECT count(*) FROM cells) AS filtered""")

# Messages: times as text are read, lists as a time and missing times fall back to the envelope's.
ALT_MESSAGES = f"""
alt_reasons AS (SELECT doc_id FROM documents WHERE {K} NOT IN (1, 2, 3, 4, 7, 8, 12, 15, 16)),
sent AS (
  SELECT doc_id, part, off, source, title, CASE WHEN {K} = 9 THEN '' ELSE content END AS content,
         CASE {K} WHEN 5 THEN '' WHEN 6 THEN '   ' ELSE url END AS url, ts,
         CASE WHEN {K} = 11 THEN CAST({X.NOW} AS BIGINT) ELSE ts END AS shown
  FROM news JOIN alt_reasons USING (doc_id)),
cells AS (SELECT *, sha256(lower({strip('url')})) AS url_hash, {strip('content')} AS body,
                 lower(title || ' ' || content) AS t FROM sent WHERE url <> '' AND title <> ''),
{ttl('cells', 'url_hash', 'ts', 600)},
alt AS (
  SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.url_hash, c.ts ORDER BY part, off) AS rn
                 FROM cells c JOIN accepted a ON a.url_hash = c.url_hash AND a.s = c.ts) WHERE rn = 1)"""
WITH_ALT_MESSAGES = f"WITH RECURSIVE {NEWS}, {ALT_MESSAGES}"
add("alt_process_messages", f"""{WITH_ALT_MESSAGES}, {hits('s', 'alt', R.SCORED_RULES, 't')}, {labels('s')}, {scored('s')}
SELECT CAST(a.doc_id AS VARCHAR) AS id, title, {short_summary('title', 'body')} AS summary, url,
       coalesce(l.keywords, '') AS keywords, coalesce(b.category, {lit(R.DEFAULT_CATEGORY)}) AS category, source,
       shown AS timestamp, CAST({X.NOW} AS BIGINT) AS processed_at
FROM alt a LEFT JOIN s_labels l ON l.doc_id = a.doc_id LEFT JOIN (SELECT * FROM s_scores WHERE rank = 1) b ON b.doc_id = a.doc_id""")
add("alt_message_counters", f"""{WITH_ALT_MESSAGES}
SELECT (SELECT count(*) FROM alt) AS processed, (SELECT count(*) FROM cells) - (SELECT count(*) FROM alt) AS duplicates,
       (SELECT count(*) FROM sent) - (SELECT count(*) FROM cells) AS filtered""")

ENTRIES = f"""
entries AS (
  SELECT e.*, r.feed_ord FROM (SELECT * FROM items UNION ALL SELECT * FROM atoms) e
  JOIN (SELECT DISTINCT name, feed_ord FROM feed_rules) r ON r.name = e.source)"""
add("crawl_outcomes", f"""{WITH_NEWS}, {FEEDS}, {LINES}, {ATOM}, {ENTRIES},
placed AS (SELECT *, row_number() OVER (PARTITION BY lower({strip('url')}) ORDER BY ts, entry_pos) > 1 AS again FROM entries)
SELECT feed_ord, url, published_ts, CASE WHEN again THEN 'skip_dedup' WHEN published_ts IS NULL THEN 'skip_no_ts'
         WHEN published_ts < {X.STARTUP} THEN 'skip_old' ELSE 'published' END AS outcome, count(*) AS rows
FROM placed GROUP BY ALL""")
add("backfill_documents", f"""{WITH_NEWS}, {FEEDS}, {LINES}, {ATOM}, {ENTRIES},
counted AS (SELECT feed_ord, count(*) FILTER (published_ts IS NULL OR published_ts >= {X.NOW - Q.DAYS * 86400}) AS fresh,
                   count(*) AS n FROM entries GROUP BY feed_ord)
SELECT feed_ord, least(fresh, {3 * Q.PER_FEED}) AS published, n - fresh AS skip_old,
       fresh - least(fresh, {3 * Q.PER_FEED}) AS skip_per_feed_limit, least(fresh, {3 * Q.PER_FEED}) AS rows FROM counted""")

add("storage_rows", f"""{WITH_PROCESSED}
SELECT article_id, p.source, matched_feed_name, p.title, summary, p.url, published_at, ingested_at, category, p.raw_hash,
       is_duplicate, should_alert, _published_at_source AS published_at_source, 'processed_news' AS source_topic,
       p.part AS kafka_partition, p.off AS kafka_offset, keywords, '' AS matched_keywords, f.content AS payload_content
FROM processed p JOIN firsts f USING (doc_id)""")
LATEST = f"""{WITH_PROCESSED}
SELECT article_id, source, title, published_at, should_alert, off AS kafka_offset
FROM processed ORDER BY off DESC, part DESC LIMIT 10"""
add("latest_rows", LATEST)
add("stored_latest", LATEST)


def escape(e: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        e = f"replace({e}, {lit(char)}, {lit(entity)})"
    return e


def unescape(e: str) -> str:
    """Only the references that occur in the tables."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", "\xa0"),
                         ("&lt;", "<"), ("&gt;", ">")):
        e = f"replace({e}, {lit(entity)}, {lit(char)})"
    # A text cut short may end the last one without its semicolon.
    return f"regexp_replace({e}, '&amp;?', '&', 'g')"


def preview(e: str) -> str:
    tags_gone = f"regexp_replace({unescape(e)}, '<[^>]+>', ' ', 'g')"
    return strip(f"regexp_replace({tags_gone}, {lit(SPACES)}, ' ', 'g')")


def message(title: str, summary_text: str, url: str, source: str, category: str, tags: str) -> str:
    p = f"({preview(summary_text)})"
    short = f"CASE WHEN length({p}) > 300 THEN left({p}, 297) || '…' ELSE {p} END"
    icons = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in A.SOURCE_ICONS.items())
    return f"""concat_ws(chr(10),
      CASE {source} {icons} ELSE {lit(A.DEFAULT_ICON)} END || ' <b>' || {escape(strip(title))} || '</b>',
      CASE WHEN {category} <> '' THEN '📂 <i>' || {escape(category)} || '</i>'
           WHEN {source} <> '' THEN '📌 <i>' || {escape(source)} || '</i>' END,
      CASE WHEN {p} <> '' THEN chr(10) || {escape(f'({short})')} END,
      CASE WHEN {tags} <> '' THEN chr(10) || '🏷 ' || {tags} END,
      CASE WHEN {url} <> '' THEN chr(10) || '🔗 <a href="' || {escape(url)} || '">Read more</a>' END)"""


TAGS = """(SELECT string_agg('#' || replace(w, ' ', '_'), ' ' ORDER BY i)
  FROM (SELECT unnest(string_split(keywords, '|')) AS w, generate_subscripts(string_split(keywords, '|'), 1) AS i) WHERE i <= 5)"""
add("alert_outbox", f"""{WITH_PROCESSED}, {FEEDS}, {tagged('firsts', 't')},
sent AS (SELECT p.*, CASE WHEN keywords = '' THEN '' ELSE {TAGS} END AS tags
         FROM processed p JOIN tagged g USING (doc_id) WHERE g.should_alert)
SELECT article_id, {message('title', 'summary', 'url', 'source', 'category', 'tags')} AS message FROM sent""")

add("raw_alert_messages", f"""{WITH_NEWS},
sent AS (
  SELECT part AS kafka_partition, off AS kafka_offset, source,
         CASE {K} WHEN 7 THEN '' WHEN 15 THEN '15' ELSE title END AS title,
         CASE {K} WHEN 8 THEN '' ELSE content END AS body,
         CASE WHEN {K} IN (3, 4, 5) THEN '' WHEN {K} = 6 THEN '   ' WHEN {K} = 12 THEN '5' WHEN {K} = 16 THEN '0' ELSE url END AS url
  FROM news WHERE {K} NOT IN (1, 2) AND ({K} = 13 OR ({K} <> 17 AND doc_id % 3 = 0)))
SELECT kafka_partition, kafka_offset, {message('title', 'body', 'url', 'source', "''", "''")} AS message FROM sent""")

add("page_preview", f"SELECT page_id, {preview('html')} AS preview FROM pages")
add("escaped_pages", f"SELECT page_id, {escape('html')} AS escaped FROM pages")
add("hashtag_lines", f"""
WITH words AS (SELECT conv_id, turn, unnest(string_split(text, '. ')) AS w,
                      generate_subscripts(string_split(text, '. '), 1) AS i FROM conversations),
tags AS (SELECT conv_id, turn, string_agg('#' || replace(w, ' ', '_'), ' ' ORDER BY i) AS tags
         FROM words WHERE i <= 5 GROUP BY conv_id, turn)
SELECT conv_id, turn, tags, CASE role WHEN 'user' THEN {lit(A.SOURCE_ICONS['VNExpress'])} ELSE {lit(A.DEFAULT_ICON)} END AS icon
FROM tags JOIN conversations USING (conv_id, turn)""")
add("json_fields", """
WITH rows AS (SELECT event_id, event_id % 6 AS n, CAST(json_extract(props, '$.k') AS VARCHAR) AS kv FROM events)
SELECT event_id,
       CASE n WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'false' WHEN 4 THEN '[]' ELSE 'none' END AS a,
       n IN (0, 3) AS a_true,
       CASE n WHEN 0 THEN '' WHEN 1 THEN '[null,1,"é",2]' WHEN 2 THEN ' ' WHEN 3 THEN 'two words' WHEN 4 THEN 'True'
              ELSE 'none' END AS b,
       CASE n WHEN 1 THEN '1|é|2.0' WHEN 3 THEN 'two words' WHEN 4 THEN 'True' ELSE '' END AS b_list,
       kv AS k,
       '{' || CASE n WHEN 0 THEN '"a":"x","b":null,' WHEN 1 THEN '"a":"","b":[null,1,"é",2],' WHEN 2 THEN '"a":0,"b":" ",'
              WHEN 3 THEN '"a":"false","b":"two words",' WHEN 4 THEN '"a":[],"b":true,' ELSE '' END || '"k":' || kv || '}' AS json
FROM rows""")

# Streams give what their batch forms give ---------------------------------------------------

add("stream_first", f"{WITH_NEWS} SELECT DISTINCT raw_hash FROM keyed")
add("stream_window", SQL["dedup_first"])
EVICTS = f"""WITH RECURSIVE {NEWS}, {KEYED},
ordered AS (SELECT doc_id, source, raw_hash, row_number() OVER (PARTITION BY source ORDER BY part, off) AS i, count(*) OVER (PARTITION BY source) AS n FROM keyed),
walk AS (
  SELECT DISTINCT source, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS held, CAST(NULL AS BIGINT) AS doc_id, '' AS raw_hash, FALSE AS fresh, FALSE AS last
  FROM keyed
  UNION ALL
  SELECT o.source, o.i, CASE WHEN list_contains(w.held, o.raw_hash) THEN w.held
                   ELSE list_slice(list_append(w.held, o.raw_hash), greatest(1, len(w.held) + 2 - 100), len(w.held) + 1) END,
         o.doc_id, o.raw_hash, NOT list_contains(w.held, o.raw_hash), o.i = o.n
  FROM walk w JOIN ordered o ON o.source = w.source AND o.i = w.i + 1)"""
add("stream_window_evicts", f"{EVICTS} SELECT doc_id, source, raw_hash FROM walk WHERE fresh")
add("stream_window_state", f"""{EVICTS}
SELECT url_hash, count(*) AS windows FROM (SELECT unnest(held) AS url_hash FROM walk WHERE last) GROUP BY url_hash""")
add("stream_alt", SQL["alt_process_messages"])
add("stream_ttl", SQL["dedup_ttl"])
add("stream_ttl_expiring", SQL["dedup_ttl"])
# The offsets of a partition are all in one of two batches, or in both halves of a third one.
add("stored_ledger", f"""{WITH_PROCESSED}, half AS (SELECT quantile_disc(off, 0.5) AS h FROM firsts)
SELECT 'processed_news' AS source_topic, CAST(part AS BIGINT) AS kafka_partition, CAST(max(off) AS BIGINT) AS high,
       count(DISTINCT off <= h) + 1 AS batches, count(*) AS rows, count(DISTINCT off) AS offsets
FROM firsts, half GROUP BY part""")
add("stored_catalog", f"""{WITH_PROCESSED}
SELECT category, count(*) AS articles, (SELECT count(*) FROM processed) AS appended, CAST(1 AS BIGINT) AS listed FROM processed GROUP BY category""")
add("stored_seen", SQL["latest_urls"])
add("stream_exits", f"""{WITH_GOOD}, {GOOD_KEYED}
SELECT doc_id, reason FROM reasons WHERE reason IS NOT NULL UNION ALL SELECT doc_id, NULL FROM good_keyed WHERE rn = 1""")
add("stream_alt_exits", f"""{WITH_ALT_MESSAGES}
SELECT doc_id, CASE {K} WHEN 1 THEN 'bad_json' WHEN 2 THEN 'not_an_object' ELSE 'process_error' END AS reason
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM alt_reasons)
UNION ALL SELECT doc_id, NULL FROM alt""")
add("stream_counters", SQL["processor_counters"])

add("classify_replaced", f"""{WITH_PROCESSED}
SELECT p.doc_id, CASE WHEN length(p.title) * 20 > length(f.body) THEN 'brief' WHEN contains(p.title, ',') THEN 'listing' ELSE 'report' END AS category, p.keywords
FROM processed p JOIN firsts f USING (doc_id)""")
add("fetched_documents", f"""{WITH_NEWS}, {ATOM}
SELECT doc_id, entry_pos, url FROM atoms WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0""")
add("storage_objects", f"""{WITH_NEWS}
SELECT 'raw_news' AS source_topic, CAST(part AS BIGINT) AS kafka_partition, off AS kafka_offset,
       CASE {K} WHEN 7 THEN '' WHEN 15 THEN '15' ELSE {strip('title')} END AS title,
       CASE WHEN {K} IN (3, 4, 5, 6) THEN '' WHEN {K} = 12 THEN '5' WHEN {K} = 16 THEN '0' ELSE {strip('url')} END AS url,
       {K} = 13 OR ({K} <> 17 AND doc_id % 3 = 0) AS should_alert,
       CASE WHEN doc_id % 2 = 0 THEN 'the |' || source ELSE '' END AS matched_keywords
FROM news WHERE {K} NOT IN (1, 2)""")
