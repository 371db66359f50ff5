"""SQL that checks the registered queries, for DuckDB over the driver's tables.

The SQL states the expected result from the tables themselves. It does not follow the engine's
way: where the engine builds a feed or a page and parses it again, the SQL starts from the lines.
"""

from __future__ import annotations

from chroniq.plans import driver_tables as D
from chroniq.plans.catalog import LANG, MIRROR, PAGE, SECOND, TERMS

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


def _decode(x: str) -> str:
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


SPEECHES = f"speeches AS ({D.SPEECHES_SQL})"
GAPS = f"""{SPEECHES}, gaps AS (
  SELECT * REPLACE ({D.GAP_SQL} AS full_text) FROM speeches LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) ON doc_id = ord)"""
FOREIGN = r"length(regexp_replace(full_text, '[\x20-\x7E]', '', 'g'))"
FRACTION = f"CASE WHEN length(full_text) > 0 THEN {FOREIGN}::DOUBLE / length(full_text) ELSE 0.0 END"
MISSING = "(full_text IS NULL OR full_text = '')"
UTC_DAY = "(DATE '1970-01-01' + (date // 86400)::INT)"


def _trend(bucket: str, pattern: str) -> str:
    counts = ", ".join(
        f"coalesce(sum(len(regexp_extract_all(full_text, '{p}'))), 0)::BIGINT AS {label}" for label, p in TERMS.items()
    )
    return f"""WITH {SPEECHES},
months AS (SELECT strftime({UTC_DAY}, '{pattern}') AS {bucket}, {counts} FROM speeches WHERE lang = '{LANG}' GROUP BY 1)
SELECT * FROM months WHERE {bucket} < (SELECT max({bucket}) FROM months) ORDER BY {bucket}"""


def _columnar() -> str:
    arrays = ", ".join(f"'{c}': list({c} ORDER BY місяць)" for c in ["місяць", *TERMS])
    return f"""WITH report AS ({_trend("місяць", "%y-%m")}) SELECT to_json({{{arrays}}})::VARCHAR AS value FROM report"""


WORDS = rf"""{SPEECHES}, found AS (
  SELECT ord, regexp_extract_all(lower(full_text), '[\p{{L}}\p{{N}}_]{{5,}}') AS ws FROM speeches WHERE lang = '{LANG}'),
tokens AS (SELECT ord, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM found)"""

# One row per line of a document, with the parts of the item it stands for.
LINES = f"""raw AS (
  SELECT doc_id, source, lang AS doc_lang, {D.DATE_SQL} AS base, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, source, doc_lang, base, 'feed-' || doc_id AS lang, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM raw),
items AS (
  SELECT *, {D.ITEM_DATE_SQL} AS date,
    CASE WHEN {D.NO_LINK_SQL} THEN '' ELSE 'https://{D.SITE}/doc/' || doc_id || '/' || i END AS link,
    {D.NO_DATE_SQL} AS no_date, {D.NO_LINK_SQL} AS no_link
  FROM lines)"""

ARTICLE = f"""CASE WHEN {D.NO_ARTICLE_SQL} THEN NULL
  ELSE {_collapse("line || 'inner ' || chr(10) || ' tail'")} END"""

# What becomes of every feed, and the items that are read from feeds and listings.
FEEDS = f"""{LINES},
verdicts AS (
  SELECT doc_id, source, doc_lang, lang, base,
    CASE source WHEN 'src0' THEN 'rss_fetch_failed_500' WHEN 'src1' THEN 'rss_parse_error' WHEN 'src2' THEN 'rss_no_channel'
      WHEN 'src3' THEN 'rss_no_items' WHEN 'src4' THEN 'rss_bad_first_date'
      ELSE CASE WHEN no_date THEN 'rss_bad_first_date' END END AS error_context,
    CASE WHEN no_date OR source IN ('src1', 'src2', 'src3', 'src4') THEN NULL ELSE date END AS latest
  FROM items WHERE i = 0),
listed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY i) - 1 AS idx
  FROM (SELECT *, i // {D.ITEMS_PER_PAGE} + 1 AS page FROM items WHERE NOT (source = 'src1' AND doc_lang = 'de'))
  WHERE NOT no_date AND NOT no_link),
list_pages AS (SELECT DISTINCT doc_id, lang, source, i // {D.ITEMS_PER_PAGE} + 1 AS page FROM lines),
list_ends AS (
  SELECT doc_id, lang, page, CASE WHEN source = 'src3' AND page = 2 THEN 503 ELSE 200 END AS status FROM list_pages p
  WHERE (source = 'src3' AND page = 2)
    OR NOT EXISTS (SELECT 1 FROM listed l WHERE l.doc_id = p.doc_id AND l.page = p.page)),
stops AS (SELECT doc_id, lang, min(page) AS stop_page, arg_min(status, page) AS status FROM list_ends GROUP BY ALL),
reading AS (
  SELECT doc_id, v.source, lang, 0 AS page, i AS idx, i, date, link, line FROM items JOIN verdicts v USING (doc_id, lang)
  WHERE error_context IS NULL AND NOT no_date AND NOT no_link
  UNION ALL
  SELECT l.doc_id, l.source, l.lang, l.page, l.idx, l.i, l.date, l.link, l.line
  FROM listed l JOIN verdicts v USING (doc_id) LEFT JOIN stops s USING (doc_id)
  WHERE error_context IS NOT NULL AND (stop_page IS NULL OR l.page < stop_page)),
marks AS (SELECT doc_id, {D.MARK_SQL} AS high_water FROM raw WHERE source <> 'src7'),
halts AS (
  SELECT doc_id, min((page, idx)) AS halt FROM reading JOIN marks USING (doc_id) WHERE date <= high_water GROUP BY 1)"""


def _ingest(force: bool = False) -> str:
    fresh = (
        "fresh AS (SELECT r.*, FALSE AS halted FROM reading r)"
        if force
        else """fresh AS (
  SELECT r.*, halt IS NOT NULL AS halted FROM reading r JOIN marks USING (doc_id) LEFT JOIN halts USING (doc_id)
  WHERE halt IS NULL OR (r.page, r.idx) < halt)"""
    )
    return f"""{FEEDS}, {fresh},
joined AS (
  SELECT *, {ARTICLE} AS article, {D.NOT_CRAWLED_SQL} AS not_crawled FROM fresh),
barren AS (
  SELECT doc_id, min(page) AS barren_page FROM (
    SELECT doc_id, page FROM joined WHERE page > 0 GROUP BY ALL
    HAVING count(*) FILTER (article IS NOT NULL AND NOT not_crawled) = 0) GROUP BY 1),
reached AS (
  SELECT * FROM joined LEFT JOIN barren USING (doc_id) WHERE barren_page IS NULL OR page <= barren_page),
new_rows AS (
  SELECT lang, page, idx, date, link, {_collapse("line")} AS topic, article AS full_text
  FROM reached WHERE article IS NOT NULL AND NOT not_crawled),
latest AS (
  SELECT doc_id, source, lang, latest FROM verdicts WHERE error_context IS NULL
  UNION ALL
  SELECT doc_id, source, lang, arg_min(date, idx) FROM reading WHERE page = 1 GROUP BY ALL),
unmarked AS (SELECT DISTINCT doc_id FROM reading WHERE source = 'src7' AND NOT {force}),
processed AS (SELECT * FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM unmarked))"""


POLLS = """polls AS (
  SELECT event_id, event_type AS lang, -event_id AS pos, floor(epoch(ts))::BIGINT + floor(value)::BIGINT * 60 AS date FROM events),
marks AS (SELECT lang, ((min(date) + max(date)) // 2)::BIGINT AS high_water FROM polls GROUP BY 1),
stops AS (SELECT lang, min(pos) AS stop FROM polls JOIN marks USING (lang) WHERE date <= high_water GROUP BY 1),
fresh AS (SELECT p.* FROM polls p JOIN marks USING (lang) LEFT JOIN stops USING (lang) WHERE stop IS NULL OR pos < stop),
latest AS (SELECT lang, arg_min(date, pos) AS latest FROM polls GROUP BY 1)"""

REPAIRED = f"""repaired AS (
  SELECT ord, lang, {MISSING} AS was_missing,
    CASE WHEN {MISSING} AND lang NOT IN ('de', 'es') THEN {_collapse("text || 'inner ' || chr(10) || ' tail'")} ELSE full_text END AS full_text
  FROM (SELECT s.*, d.text FROM gaps s JOIN documents d ON d.doc_id = s.ord))"""


def _markup_free(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '(?s)<!--.*?-->', '', 'g'), '<[/!]?[a-zA-Z][^>]*>?', '', 'g')"


TWICE = f"""{SPEECHES}, twice AS (
  SELECT * FROM speeches UNION ALL SELECT * REPLACE (ord + {SECOND} AS ord) FROM speeches WHERE lang = '{LANG}')"""


def _written_marks(latest: str) -> str:
    return f"""WITH {_ingest()}, held AS (
  SELECT lang, min(date) AS oldest FROM reached WHERE article IS NULL OR not_crawled GROUP BY 1)
SELECT 'feed-' || m.doc_id AS lang, coalesce({latest}, high_water) AS high_water
FROM marks m LEFT JOIN processed p USING (doc_id) LEFT JOIN held h ON h.lang = p.lang"""


ORACLES: dict[str, str] = {
    "corpus_scan": f"WITH {SPEECHES} SELECT * FROM speeches",
    "language_filter": f"WITH {SPEECHES} SELECT ord, date, lang, topic FROM speeches WHERE lang = 'fr'",
    "missing_text": f"WITH {GAPS} SELECT ord, link FROM gaps WHERE {MISSING}",
    "missing_counts": f"""WITH {GAPS}
SELECT count(*) FILTER ({MISSING}) AS missing, count(*) FILTER (NOT {MISSING}) AS present FROM gaps""",
    "deny_list": f"""WITH {SPEECHES} SELECT ord, link, lang FROM speeches
WHERE ord NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "export_text": f"""WITH {SPEECHES} SELECT ord, 'date: ' || strftime({UTC_DAY}, '%Y-%m-%d') || chr(10) || 'topic: ' || topic
  || chr(10) || 'text: ' || coalesce(full_text, '') || chr(10) AS value FROM speeches WHERE lang = '{LANG}'""",
    "jsonl_round_trip": f"WITH {SPEECHES} SELECT date, link, topic, full_text, lang FROM speeches",
    "term_trend": _trend("month", "%y-%m"),
    "term_trend_full_years": _trend("month", "%Y-%m"),
    "trend_columnar": _columnar(),
    "top_words": f"WITH {WORDS} SELECT word, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, word LIMIT 20",
    "top_words_first_seen": f"""WITH {WORDS} SELECT word, n FROM (
  SELECT word, count(*) AS n, min((ord, pos)) AS seen FROM tokens GROUP BY 1) ORDER BY n DESC, seen LIMIT 20""",
    "invalid_percentage": f"WITH {SPEECHES} SELECT ord, {FRACTION} * 100 AS invalid_percentage FROM speeches",
    "max_invalid_pct": f"""WITH {SPEECHES} SELECT round(max({FRACTION} * 100), 2) AS max_invalid_pct
FROM speeches WHERE lang = '{LANG}'""",
    "looks_english": f"WITH {SPEECHES} SELECT ord, lang FROM speeches WHERE {FRACTION} < 0.035",
    "valid_totals": f"""WITH {SPEECHES} SELECT count(*) FILTER ({FRACTION} < 0.035) AS valid_count,
  count(*) FILTER ({FRACTION} >= 0.035) AS filtered_count FROM speeches""",
    "rows_per_language": "SELECT lang, count(*) AS n FROM documents GROUP BY 1",
    "dedup_first": f"""WITH {SPEECHES} SELECT ord, date, lang, link FROM speeches
QUALIFY row_number() OVER (PARTITION BY date, lang ORDER BY ord) = 1""",
    "duplicate_dates": f"WITH {SPEECHES} SELECT date, count(*) AS n FROM speeches GROUP BY 1 HAVING count(*) > 1",
    "duplicate_members": f"""WITH {SPEECHES} SELECT ord, date, lang FROM speeches
QUALIFY count(*) OVER (PARTITION BY date) > 1""",
    "repair_text": f"WITH {GAPS}, {REPAIRED} SELECT ord, full_text, was_missing FROM repaired",
    "repair_counts": f"""WITH {GAPS}, {REPAIRED} SELECT count(*) FILTER (was_missing) AS missing,
  count(*) FILTER (was_missing AND NOT {MISSING}) AS fixed, count(*) FILTER ({MISSING}) AS remaining FROM repaired""",
    "patch_text": f"""WITH {SPEECHES} SELECT ord, CASE WHEN item_id IS NOT NULL THEN b.text ELSE full_text END AS full_text
FROM speeches LEFT JOIN benchmark b ON item_id = ord""",
    "append_union": f"""WITH {SPEECHES} SELECT ord, date, lang FROM speeches
UNION ALL SELECT -ord - 1, date, lang FROM speeches WHERE lang = 'en'""",
    "append_counts": f"""WITH {SPEECHES} SELECT count(*) AS old_rows, count(*) + count(*) FILTER (lang = '{LANG}') AS new_rows
FROM speeches""",
    "blocked_pages": """SELECT page_id, contains(substr(html, 1, 500), 'Access Denied')
  OR contains(html, 'sec-if-cpt-container') AS blocked FROM pages""",
    "crawl_scan": "SELECT url, 200 AS status, 0::BIGINT AS seen, length(html) AS html_chars FROM pages",
    "article_text": f"""SELECT page_id,
  {_collapse(_decode(_markup_free(r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")))} AS article_text FROM pages""",
    # The pages have one style and one script element, whose text counts and holds the fixed string `</p>`.
    "page_text": f"""SELECT page_id, {_collapse(
        "replace(" + _decode(_markup_free("replace(html, 't=\"</p>\"', 't=\"@PARA@\"')")) + ", '@PARA@', '</p>')"
    )} AS page_text FROM pages""",
    "nested_article_text": f"""WITH {LINES} SELECT 'https://{D.SITE}/doc/' || doc_id || '/' || i AS url, seen,
  CASE WHEN {D.NO_ARTICLE_SQL} THEN NULL WHEN seen = 0 THEN 'oldinner tail'
    ELSE {ARTICLE} END AS article_text
FROM lines, (VALUES (0::BIGINT), (1::BIGINT)) v(seen) WHERE NOT ({D.NOT_CRAWLED_SQL}) AND (seen = 1 OR {D.CRAWLED_TWICE_SQL})""",
    "soup_article_text": f"""WITH {LINES} SELECT 'https://{D.SITE}/soup/' || doc_id || '/' || i AS url,
  {_collapse("line || CASE i % 3 WHEN 0 THEN ' inner' WHEN 1 THEN ' two' ELSE ' © 2020 ¬it; &a</div>b' END")} AS article_text FROM lines""",
    "newest_articles": f"""WITH {LINES} SELECT link AS url, {ARTICLE} AS article_text FROM items
WHERE link <> '' AND NOT ({D.NOT_CRAWLED_SQL})""",
    "listing_links": rf"""WITH found AS (
  SELECT page_id, url, regexp_extract_all(html, '<a href="[^"]*">.*?</a>') AS tags FROM pages),
one AS (SELECT page_id, url, unnest(tags) AS tag, unnest(range(len(tags))) AS idx FROM found)
SELECT page_id, idx, regexp_extract(url, '^(https?://[^/?#]*)', 1) || {_decode("regexp_extract(tag, 'href=\"([^\"]*)\"', 1)")} AS link,
  {_collapse(_decode(_markup_free("tag")))} AS title FROM one""",
    "page_param": f"""WITH cut AS (SELECT page_id, regexp_extract(url, '^([^#]*)', 1) AS head, regexp_extract(url, '(#.*)$', 1) AS tail FROM pages)
SELECT page_id, CASE WHEN regexp_matches(head, '[?&]page=') THEN regexp_replace(head, '([?&])page=[^&]*', '\\1page={PAGE}')
  WHEN contains(head, '?') THEN head || '&page={PAGE}' ELSE head || '?page={PAGE}' END || tail AS url FROM cut""",
    "normalize_link": r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/?#]*example\.org(/|$|\?|#)')
  THEN regexp_replace(url, '^https?://[^/?#]*', 'https://mirror.example.net') ELSE url END AS link FROM pages""",
    "listing_url": f"SELECT page_id, CASE WHEN url LIKE '%.html' THEN '{MIRROR}' ELSE url END AS url FROM pages",
    "element_audit": f"""WITH {LINES} SELECT lang, (i // {D.ITEMS_PER_PAGE} + 1)::INT AS page,
  CASE WHEN bool_and(source = 'src1' AND doc_lang = 'de') THEN 'no_topics_found'
    WHEN bool_or(no_link) THEN 'element_count_mismatch' ELSE 'elements_found' END AS verdict FROM items GROUP BY ALL""",
    "epoch_buckets": f"""WITH {SPEECHES} SELECT ord, strftime({UTC_DAY}, '%y-%m') AS month, strftime({UTC_DAY}, '%Y-%m-%d') AS day
FROM speeches""",
    "parse_dates_rfc": f"WITH {LINES} SELECT doc_id, i, date FROM items",
    "parse_dates_listing": f"WITH {LINES} SELECT doc_id, i, date FROM items",
    "parse_dates_iso": "SELECT event_id, floor(epoch(ts))::BIGINT AS date FROM events",
    "whitespace": f"""WITH padded AS (
  SELECT doc_id, chr(160) || ' ' || chr(10) || replace(text, ',', chr(9) || chr(8195)) || ' ' || chr(133) AS x FROM documents)
SELECT doc_id, {_collapse("x")} AS collapsed, {_strip("x")} AS stripped FROM padded""",
    "words_per_document": rf"""WITH {SPEECHES}, found AS (
  SELECT ord, regexp_extract_all(lower(full_text), '[\p{{L}}\p{{N}}_]{{5,}}') AS ws FROM speeches)
SELECT ord, len(ws) AS n_words, ws[1] AS first_word FROM found""",
    "source_registry": f"""SELECT 'feed-' || doc_id AS lang, CASE WHEN source = 'src0' THEN 500 ELSE 200 END AS status,
  CASE WHEN source = 'src6' THEN 'https://{D.SITE}/list/' || doc_id || '?all=1'
    ELSE 'https://{D.SITE}/rss/' || doc_id || '.rss' END AS feed_url,
  'https://{D.SITE}/list/' || doc_id || CASE WHEN source = 'src6' THEN '?all=1' ELSE '' END AS listing_url
FROM documents""",
    "feed_status": f"WITH {FEEDS} SELECT lang, latest, error_context FROM verdicts",
    "rss_items": f"""WITH {FEEDS} SELECT lang, i AS pos, date, link, {_strip("line")} AS topic FROM items
JOIN verdicts v USING (doc_id, lang) WHERE error_context IS NULL AND NOT no_date AND NOT no_link""",
    "rss_first_children": f"""WITH {LINES} SELECT lang, i AS pos, base - i * 3600 AS date, 'https://{D.SITE}/doc/' || doc_id || '/' || i AS link,
  CASE WHEN doc_id % 5 = 4 THEN '' ELSE {_strip("line")} END AS topic FROM lines WHERE doc_id % 5 <> 2""",
    "rss_odd_status": f"""WITH {LINES} SELECT lang, CASE WHEN doc_id % 5 <> 2 THEN base END AS latest,
  CASE WHEN doc_id % 5 = 2 THEN 'rss_parse_error' END AS error_context FROM lines WHERE i = 0""",
    "listing_items": f"""WITH {FEEDS} SELECT lang, page::INT AS page, idx::INT AS idx, date, link, {_collapse("line")} AS topic
FROM listed""",
    "page_stops": f"WITH {FEEDS} SELECT lang, stop_page::INT AS stop_page FROM stops",
    "feed_fallback": f"""WITH {FEEDS} SELECT p.lang, p.page::INT AS page FROM list_pages p JOIN verdicts v USING (doc_id)
WHERE error_context IS NOT NULL""",
    "newer_than_mark": f"""WITH {POLLS} SELECT event_id, lang, date FROM polls JOIN marks USING (lang)
WHERE date > high_water""",
    "newer_forced": f"WITH {POLLS} SELECT event_id, lang, date FROM polls",
    "take_while_newer": f"WITH {POLLS} SELECT event_id, lang, date FROM fresh",
    "take_while_newer_per_feed": f"""WITH {LINES},
marks AS (SELECT doc_id, {D.MARK_SQL} AS high_water FROM raw WHERE source <> 'src7'),
stops AS (SELECT doc_id, min(i) AS stop FROM items JOIN marks USING (doc_id) WHERE date <= high_water GROUP BY 1)
SELECT lang, i AS pos, date FROM items JOIN marks USING (doc_id) LEFT JOIN stops USING (doc_id) WHERE stop IS NULL OR i < stop""",
    "latest_mark": f"WITH {POLLS} SELECT lang, latest FROM latest",
    "commit_state": f"WITH {POLLS} SELECT lang, latest FROM latest WHERE (SELECT count(*) FROM fresh) > 0",
    "article_join": f"""WITH {LINES} SELECT lang, i AS pos, link, {ARTICLE} AS article_text FROM items
WHERE link <> '' AND NOT ({D.NOT_CRAWLED_SQL}) AND NOT ({D.NO_ARTICLE_SQL})""",
    "ingest_new_rows": f"""WITH {_ingest()} SELECT lang, page::INT AS page, idx::INT AS idx, date, link, topic, full_text
FROM new_rows""",
    "ingest_marks": f"WITH {_ingest()} SELECT lang, latest FROM processed WHERE (SELECT count(*) FROM new_rows) > 0",
    "ingest_rejects": f"""WITH {_ingest()}
SELECT lang, link AS url, CASE WHEN not_crawled THEN 'page_not_crawled' ELSE 'no_article_content' END AS error_context
FROM reached WHERE article IS NULL OR not_crawled
UNION ALL
SELECT lang, NULL, error_context FROM verdicts WHERE regexp_matches(error_context, '^rss_(fetch_failed_.*|parse_error|no_channel)$')
UNION ALL
SELECT s.lang, 'https://{D.SITE}/list/' || s.doc_id || '?page=' || stop_page,
  CASE WHEN status <> 200 THEN 'html_listing_fetch_failed_' || status ELSE 'html_listing_no_items' END
FROM stops s JOIN verdicts v USING (doc_id)
WHERE v.error_context IS NOT NULL AND (status <> 200 OR stop_page = 1)
  AND s.doc_id NOT IN (SELECT doc_id FROM halts) AND s.doc_id NOT IN (SELECT doc_id FROM barren)
  AND s.doc_id NOT IN (SELECT doc_id FROM unmarked)""",
    "ingest_failures": f"""WITH {_ingest()}
SELECT lang, CASE WHEN doc_id IN (SELECT doc_id FROM unmarked) THEN 'no_saved_mark' ELSE 'no_usable_source' END AS error_context
FROM verdicts WHERE doc_id NOT IN (SELECT doc_id FROM processed)""",
    "backfill": f"WITH {_ingest(force=True)} SELECT lang, page::INT AS page, idx::INT AS idx, link FROM new_rows",
    "stream_dedup": f"WITH {SPEECHES} SELECT DISTINCT date, lang FROM speeches",
    "append_published": f"WITH {TWICE} SELECT * FROM twice",
    "append_report": f"""WITH {TWICE} SELECT (SELECT count(*) FROM speeches) AS old_rows, count(*) AS new_rows FROM twice""",
    "deny_published": f"""WITH {TWICE} SELECT ord, link, CASE WHEN item_id IS NOT NULL THEN b.text ELSE full_text END AS full_text
FROM twice LEFT JOIN benchmark b ON item_id = ord % {SECOND}
WHERE ord % {SECOND} NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "published_language": f"WITH {TWICE} SELECT * FROM twice WHERE lang = 'fr'",
    "cleanup_published": f"""WITH {TWICE} SELECT * FROM twice
QUALIFY row_number() OVER (PARTITION BY date, lang ORDER BY ord) = 1""",
    "repair_published": f"WITH {GAPS}, {REPAIRED} SELECT ord, full_text FROM repaired",
    "jsonl_with_language": f"WITH {SPEECHES} SELECT date, link, topic, full_text, 'de' AS lang FROM speeches WHERE lang = 'fr'",
    "csv_round_trip": _trend("month", "%y-%m"),
    "url_list": f"WITH {GAPS} SELECT link FROM gaps WHERE {MISSING}",
    "ingest_published": f"WITH {_ingest()} SELECT date, link, topic, full_text, lang FROM new_rows",
    "marks_written": _written_marks("p.latest"),
    "ingest_marks_strict": _written_marks("CASE WHEN p.latest IS NOT NULL THEN least(p.latest, coalesce(oldest - 1, p.latest)) END"),
}
ORACLES["patch_published"] = ORACLES["patch_text"]
ORACLES["usable_articles"] = ORACLES["newest_articles"]
ORACLES["rss_items_of_files"] = ORACLES["rss_items"]
