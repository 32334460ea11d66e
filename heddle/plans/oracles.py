"""SQL for DuckDB that says the same as the queries of the core."""

from __future__ import annotations

from heddle.functions.text import BOILERPLATE
from heddle.plans import readers

WS = r"[\s\p{Z}]+"
NORM_TITLE = rf"trim(regexp_replace(regexp_replace(strip_accents(lower(title)), '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g'), '{WS}', ' ', 'g'))"
LAST_NAME = rf"lower(list_extract(string_split(trim(regexp_replace(split_part(coalesce(authors, ''), ',', 1), '{WS}', ' ', 'g')), ' '), -1))"
HASH = f"substr(sha256({NORM_TITLE} || '|' || {LAST_NAME}), 1, 16)"
SCORING = "lower(coalesce(nullif(source_name, ''), nullif(source, ''), '') || ' ' || coalesce(nullif(title, ''), '') || ' ' || coalesce(nullif(content, ''), nullif(abstract, ''), ''))"
SLIM = "i.id, i.url, i.title, i.source, i.published_date"

SCORES = f"""
x AS (SELECT id, {SCORING} AS t FROM items),
s AS (SELECT x.id AS item_id, k.subtopic, k.topic, k.ordinal,
        CASE WHEN coalesce(len(k.keywords), 0) = 0 THEN 0.0
             ELSE least(len(list_filter(k.keywords, lambda w: contains(x.t, lower(w))))::DOUBLE / len(k.keywords) * coalesce(k.weight, 1.0), 1.0) END AS score
      FROM x CROSS JOIN taxonomy k)"""

LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, subtopic ORDER BY classified_at DESC NULLS LAST, id DESC) AS r FROM classifications) WHERE r = 1)"
VERDICTS = f"""{LATEST},
tp AS (SELECT item_id, subtopic, list_sort(list(DISTINCT topic_key)) AS topics FROM item_topics GROUP BY item_id, subtopic),
v AS (SELECT l.*, coalesce(tp.topics, []) AS topics FROM latest l LEFT JOIN tp USING (item_id, subtopic))"""

CONNECTIONS = f"""
n AS (SELECT id AS item_id, {SCORING} || ' ' || lower(coalesce(authors, '')) AS t FROM items),
conn AS (SELECT item_id,
   CASE WHEN contains(t, 'edward lumnisige') THEN 'author' WHEN contains(t, 'fatima gralmelleri') THEN 'author' WHEN contains(t, 'sarbomeni council') THEN 'organization'
        WHEN regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_])wto([^\\p{{L}}\\p{{N}}_]|$)') THEN 'organization' WHEN contains(t, 'lantern review') THEN 'publication' END AS connection_type,
   CASE WHEN contains(t, 'edward lumnisige') THEN 'Edward Lumnisige' WHEN contains(t, 'fatima gralmelleri') THEN 'Fatima Gralmelleri' WHEN contains(t, 'sarbomeni council') THEN 'Sarbomeni Council'
        WHEN regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_])wto([^\\p{{L}}\\p{{N}}_]|$)') THEN 'Wto' WHEN contains(t, 'lantern review') THEN 'Lantern Review' END AS connection_name
   FROM n)"""
DESCRIBE = "CASE connection_name WHEN 'Sarbomeni Council' THEN 'a council' WHEN 'Wto' THEN 'a body' WHEN 'Lantern Review' THEN 'a review' ELSE 'an author' END"

FEED_WHERE = """EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = i.id AND c.relevant AND c.subtopic IN ('built_world', 'power_systems', 'fair_rules') AND c.confidence IN ('high', 'medium'))
  AND EXISTS (SELECT 1 FROM item_topics t WHERE t.item_id = i.id AND t.subtopic IN ('built_world', 'power_systems', 'fair_rules') AND t.topic_key IN ('homes_supply', 'wires_and_storage', 'pay_and_prices', 'general_fair_rules'))
  AND i.published_date BETWEEN DATE '2025-01-01' AND DATE '2026-12-31'"""

LATE = "TIMESTAMPTZ '2025-09-01 00:00:00+00'"
NOW = "TIMESTAMPTZ '2026-03-01 00:00:00+00'"
FIRST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY crawled_at, id) AS r FROM items WHERE {0}) WHERE r = 1"


TOPIC_WEEKS = """SELECT t.topic_key, t.item_id, i.*, published_date + ((7 - dayofweek(published_date)) % 7)::INT AS week_ending FROM (SELECT DISTINCT item_id, topic_key FROM item_topics) t JOIN items i ON i.id = t.item_id WHERE published_date IS NOT NULL"""
SET_HASH = "substr(sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id)), 1, 16)"


def _queue(days: int) -> str:
    return f"""SELECT i.id, coalesce(i.published_date, (i.crawled_at AT TIME ZONE 'UTC')::DATE) AS day FROM items i
 WHERE coalesce(i.published_date, (i.crawled_at AT TIME ZONE 'UTC')::DATE) BETWEEN DATE '2026-03-01' - {days} AND DATE '2026-03-02'
   AND NOT EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = i.id)"""


#: date and time columns: both sides give them as text, so that engines' types for them don't matter
TIMES = {
    **{q: ["published_date"] for q in ("feed_items", "feed_any_topic", "feed_min_confidence", "feed_topic_uncorrelated", "feed_connected_only", "rss_items", "registry_items")},
    **{q: ["day"] for q in ("unclassified_queue", "unclassified_topn", "rss_dates", "flexible_dates", "future_dates")},
    "last_boundary": ["last_at"], "item_upsert": ["published_date", "crawled_at"], "store_upsert": ["published_date", "crawled_at"], "classification_upsert": ["classified_at"], "weekly_snapshots": ["week_ending"], "topic_week_prompts": ["week_ending"], "topic_summary_upsert": ["week_ending", "created_at"], "source_crawls": ["last_crawled_at"], "listing_items": ["first_day"],
}


def oracle_sql() -> dict[str, str]:
    out = _sql()
    out["store_upsert"] = out["item_upsert"]  # the store changes nothing in the result
    for name, columns in TIMES.items():
        text = ", ".join(f"strftime({c if c not in ('crawled_at', 'classified_at', 'created_at', 'last_crawled_at') else c + " AT TIME ZONE 'UTC'"}, '{'%Y-%m-%d %H:%M:%S' if c.endswith('at') else '%Y-%m-%d'}') AS {c}" for c in columns)
        out[name] = f"SELECT * REPLACE ({text}) FROM ({out[name]})"
    return out | readers.SQL


def _sql() -> dict[str, str]:
    return {
        "feed_items": f"SELECT {SLIM} FROM items i WHERE {FEED_WHERE} ORDER BY published_date DESC NULLS FIRST, id DESC",
        "feed_any_topic": f"SELECT {SLIM} FROM items i WHERE EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = i.id AND c.relevant AND c.subtopic = 'health_security')",
        "feed_min_confidence": f"SELECT {SLIM} FROM items i WHERE EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = i.id AND c.relevant AND c.subtopic IN ('machine_conduct', 'fair_rules') AND c.confidence = 'high')",
        "feed_topic_uncorrelated": f"""SELECT {SLIM} FROM items i WHERE EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = i.id AND c.relevant AND c.subtopic IN ('health_security', 'fair_rules'))
  AND EXISTS (SELECT 1 FROM item_topics t WHERE t.item_id = i.id AND t.subtopic IN ('health_security', 'fair_rules') AND t.topic_key IN ('early_years', 'courts_and_claims'))""",
        "feed_connected_only": f"WITH {CONNECTIONS} SELECT {SLIM} FROM items i JOIN conn ON conn.item_id = i.id WHERE connection_name IS NOT NULL AND published_date >= DATE '2025-03-01'",
        "feed_nested": f"""WITH {VERDICTS}, {CONNECTIONS},
 g AS (SELECT item_id, string_agg(subtopic || ':' || relevant::VARCHAR || ':' || coalesce(confidence, '') || ':' || array_to_string(topics, '+'), ';' ORDER BY subtopic) AS verdicts FROM v GROUP BY item_id)
 SELECT i.id, coalesce(i.abstract, '') AS abstract, coalesce(g.verdicts, '') AS verdicts, coalesce(conn.connection_name, '') AS connection_name
 FROM items i LEFT JOIN g ON g.item_id = i.id LEFT JOIN conn ON conn.item_id = i.id WHERE {FEED_WHERE}""",
        "unclassified_queue": _queue(365),
        "unclassified_topn": _queue(730) + " ORDER BY day DESC, id LIMIT 50",
        "content_hash": f"SELECT id, CASE WHEN length(title) > 0 THEN {HASH} END AS content_hash FROM items",
        "dedup_best_wins": f"""WITH h AS (SELECT *, CASE WHEN length(title) > 0 THEN {HASH} END AS hash FROM items)
 SELECT id, hash AS content_hash FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY length(coalesce(abstract, '')) DESC, crawled_at, id) AS r FROM h) WHERE r = 1 OR hash IS NULL""",
        "dedup_best_per_source": f"""WITH h AS (SELECT *, {HASH} AS hash FROM items WHERE length(title) > 0)
 SELECT source, hash AS content_hash, id FROM (SELECT *, row_number() OVER (PARTITION BY source, hash ORDER BY length(coalesce(abstract, '')) DESC, crawled_at, id) AS r FROM h) WHERE r = 1""",
        "dedup_first_wins": f"SELECT id, url FROM ({FIRST.format('true')})",
        "known_url_antijoin": f"""SELECT id, url FROM items i WHERE crawled_at >= {NOW} - INTERVAL 60 DAY AND NOT EXISTS (SELECT 1 FROM items k
 WHERE k.url = i.url AND k.crawled_at < {NOW} - INTERVAL 60 DAY AND k.crawled_at >= {NOW} - INTERVAL 460 DAY)""",
        "item_batches": "SELECT id, source, ((row_number() OVER (PARTITION BY source ORDER BY id) - 1) // 5)::BIGINT AS batch FROM items",
        "keyword_scores": f"WITH {SCORES} SELECT item_id, subtopic, topic, round(score, 6) AS score FROM s WHERE score > 0",
        "subtopic_scores": f"WITH {SCORES} SELECT item_id, subtopic, round(max(score), 6) AS score FROM s GROUP BY item_id, subtopic",
        "keyword_candidates": f"WITH {SCORES} SELECT item_id, subtopic, string_agg(topic, ',' ORDER BY score DESC, ordinal, topic) AS topics FROM s WHERE score >= 0.1 GROUP BY item_id, subtopic",
        "prefilter_split": f"WITH {SCORES} SELECT item_id AS id, max(score) >= 0.02 AS passes FROM s GROUP BY item_id",
        "network_match": f"WITH {CONNECTIONS} SELECT item_id, connection_type, connection_name, {DESCRIBE} AS connection_description FROM conn WHERE connection_name IS NOT NULL",
        "audit_keyword_hits": f"WITH {SCORES.split('s AS')[0].rstrip().rstrip(',')} SELECT x.id AS item_id, k.subtopic, k.topic FROM x CROSS JOIN taxonomy k WHERE len(list_filter(k.keywords[1:8], lambda w: contains(x.t, lower(w)))) > 0",
        "autotag": f"""WITH {VERDICTS}, tag AS (SELECT v.*, CASE WHEN source = 'docket_notes' AND subtopic = 'built_world' THEN 'general_built_world' WHEN source = 'merge_window' AND subtopic = 'machine_conduct' THEN 'general_machine_conduct'
   WHEN source = 'tidewater_policy' AND subtopic = 'fair_rules' THEN 'general_fair_rules' END AS tag FROM v LEFT JOIN items i ON i.id = v.item_id)
 SELECT item_id, subtopic, array_to_string(CASE WHEN tag IS NOT NULL AND relevant AND len(list_filter(topics, lambda t: NOT starts_with(t, 'general'))) = 0 AND NOT list_contains(topics, tag) THEN list_append(topics, tag) ELSE topics END, ',') AS topics FROM tag""",
        "relevance_counts": f"WITH {LATEST} SELECT subtopic, count(*) FILTER (coalesce(relevant, false)) AS n_relevant, count(*) AS n_verdicts FROM latest GROUP BY subtopic",
        "populated_topics": f"WITH {VERDICTS} SELECT DISTINCT subtopic, unnest(topics) AS topic FROM v WHERE relevant",
        "filter_relevant": f"WITH {LATEST} SELECT item_id, confidence FROM latest WHERE relevant AND subtopic = 'fair_rules'",
        "item_types": """SELECT CASE WHEN source_type IN ('working_paper', 'nber', 'academic_journal', 'preprint') THEN 'research paper' WHEN source_type IN ('blog', 'substack', 'newsletter') THEN 'blog post' ELSE 'article' END AS item_type, count(*) AS n
 FROM items i LEFT JOIN sources s ON s.key = i.source GROUP BY 1""",
        "topic_key_norm": "SELECT topic, translate(lower(name), ' -', '__') AS topic_key FROM taxonomy",
        "strip_html": rf"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\s\p{{Z}}\x{{0085}}\x{{000B}}\x{{001C}}-\x{{001F}}]+', ' ', 'g')) AS text FROM documents",
        "url_hosts": "SELECT nullif(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '') AS host, count(*) AS n FROM items GROUP BY 1",
        "rss_dates": "SELECT id, (crawled_at AT TIME ZONE 'UTC')::DATE AS day FROM items",
        "flexible_dates": "SELECT id, CASE WHEN id % 5 < 4 THEN published_date END AS day FROM items",
        "last_boundary": "SELECT id, CASE WHEN hour(crawled_at AT TIME ZONE 'UTC') >= 8 THEN date_trunc('day', crawled_at AT TIME ZONE 'UTC') + INTERVAL 8 HOUR ELSE date_trunc('day', crawled_at AT TIME ZONE 'UTC') - INTERVAL 16 HOUR END AS last_at FROM items",
        "future_dates": "SELECT id, CASE WHEN published_date::TIMESTAMP <= (crawled_at AT TIME ZONE 'UTC') + INTERVAL 7 DAY THEN published_date END AS day FROM items",
        "storage_rows": """SELECT id, coalesce(abstract, '') AS abstract, coalesce(authors, '') AS authors, coalesce(source_id, '') AS source_id, coalesce(source_name, '') AS source_name,
 coalesce(json_array_length(raw_metadata, '$.images'), 0)::INT AS n_images, json_extract(raw_metadata, '$.keyword_scores') IS NOT NULL AS has_scores FROM items""",
        "needs_abstract": "SELECT id, length(trim(coalesce(abstract, ''))) < 50 AS needs, length(coalesce(content, '')) < 500 AS thin FROM items",
        "summary_candidates": "SELECT id FROM items WHERE length(trim(coalesce(abstract, ''))) < 50 AND length(content) > 0 AND api_refused_at IS NULL",
        "refused_candidates": "SELECT id, api_refusal_type FROM items WHERE api_refused_at IS NOT NULL AND length(content) > 0",
        "item_upsert": f"""WITH o AS ({FIRST.format(f'crawled_at < {NOW}')}), n AS ({FIRST.format(f'crawled_at >= {NOW}')})
 SELECT coalesce(n.url, o.url) AS url, coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN o.title ELSE n.title END AS title, CASE WHEN n.id IS NULL THEN o.abstract ELSE n.abstract END AS abstract,
   coalesce(n.published_date, o.published_date) AS published_date, coalesce(n.crawled_at, o.crawled_at) AS crawled_at,
   CASE WHEN n.id IS NULL THEN o.raw_metadata WHEN o.id IS NULL THEN n.raw_metadata WHEN n.raw_metadata IS NULL OR n.raw_metadata IN ('', '{{}}', '[]') THEN o.raw_metadata ELSE n.raw_metadata END AS raw_metadata
 FROM o FULL JOIN n ON o.url = n.url""",
        "classification_upsert": f"WITH {LATEST} SELECT item_id, subtopic, relevant, confidence, classified_at FROM latest",
        "topics_replace": f"""WITH touched AS (SELECT DISTINCT item_id, subtopic FROM classifications WHERE classified_at >= {LATE}), {SCORES.lstrip()}
 SELECT DISTINCT item_id, subtopic, topic_key FROM item_topics t WHERE NOT EXISTS (SELECT 1 FROM touched u WHERE u.item_id = t.item_id AND u.subtopic = t.subtopic)
 UNION ALL SELECT DISTINCT s.item_id, s.subtopic, s.topic FROM s JOIN touched USING (item_id, subtopic) WHERE s.score >= 0.2""",
        "connection_replace": f"""WITH {CONNECTIONS}, f AS (SELECT item_id, connection_name, {DESCRIBE} AS connection_description FROM conn WHERE connection_name IS NOT NULL)
 SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = f.item_id AND classified_at >= {LATE})
  OR EXISTS (SELECT 1 FROM classifications c WHERE c.item_id = f.item_id AND relevant)""",
        "source_upsert": "SELECT key, CASE WHEN id % 2 = 0 THEN upper(name) ELSE name END AS name, url, is_enabled, crawl_status FROM sources",
        "cascade_topics": "SELECT DISTINCT id, item_id FROM item_topics t WHERE EXISTS (SELECT 1 FROM items i WHERE i.id = t.item_id AND published_date >= DATE '2025-06-01')",
        "item_set_hash": "SELECT subtopic, substr(sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id)), 1, 16) AS item_hash, count(*) AS n_items FROM (SELECT DISTINCT subtopic, item_id FROM classifications WHERE relevant) GROUP BY subtopic",
        "summary_cache_status": """WITH t AS (SELECT DISTINCT item_id, subtopic, topic_key FROM item_topics),
 e AS (SELECT DISTINCT item_id, subtopic FROM classifications WHERE classified_at < TIMESTAMPTZ '2025-12-01 00:00:00+00'),
 a AS (SELECT topic_key, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS h, count(*) AS n_items FROM t GROUP BY 1), b AS (SELECT topic_key, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS h FROM t JOIN e USING (item_id, subtopic) GROUP BY 1)
 SELECT a.topic_key, CASE WHEN b.h IS NULL THEN 'miss' WHEN a.h = b.h THEN 'hit' ELSE 'stale' END AS status, a.n_items FROM a LEFT JOIN b USING (topic_key)""",
        "topic_prompts": """WITH t AS (SELECT DISTINCT item_id, topic_key FROM item_topics)
 SELECT topic_key, substr(sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id)), 1, 16) AS item_hash, count(*) AS n_items,
  sum(length(coalesce(title, 'Untitled')) + length(coalesce(nullif(source_name, ''), source, '')) + least(length(coalesce(abstract, '')), 300) + 7)::BIGINT + count(*) - 1 AS n_chars
 FROM t JOIN items i ON i.id = t.item_id GROUP BY topic_key""",
        "topic_week_prompts": f"""SELECT topic_key, week_ending, {SET_HASH} AS item_hash, count(*) AS n_items,
  sum(length(coalesce(title, 'Untitled')) + length(coalesce(nullif(source_name, ''), source, '')) + least(length(coalesce(abstract, '')), 300) + 7 + 3 + length('https://reader.example/digests/daily#item-' || item_id))::BIGINT + count(*) - 1 AS n_chars
 FROM ({TOPIC_WEEKS}) GROUP BY topic_key, week_ending""",
        "topic_summary_upsert": f"""WITH n AS (SELECT topic_key, week_ending, {SET_HASH} AS item_hash, count(*) AS n FROM ({TOPIC_WEEKS}) GROUP BY ALL),
 o AS (SELECT topic_key, week_ending, {SET_HASH} AS item_hash FROM ({TOPIC_WEEKS}) WHERE crawled_at < TIMESTAMPTZ '2025-06-01 00:00:00+00' GROUP BY ALL)
 SELECT 7::BIGINT AS feed_id, topic_key, week_ending, topic_key || ': ' || n AS summary, n.item_hash, CASE WHEN n.item_hash = o.item_hash THEN TIMESTAMPTZ '2025-06-01 00:00:00+00' ELSE TIMESTAMPTZ '2026-03-01 00:00:00+00' END AS created_at FROM n LEFT JOIN o USING (topic_key, week_ending)""",
        "source_crawls": """WITH c AS (SELECT source, max(crawled_at) AS seen, bool_or(api_refused_at IS NOT NULL) AS bad FROM items GROUP BY source, (crawled_at AT TIME ZONE 'UTC')::DATE),
 k AS (SELECT source, max(seen) FILTER (NOT bad) AS ok, arg_max(bad, seen) AS bad, max(seen) AS last FROM c GROUP BY source), r AS (SELECT c.source, count(*) FILTER (c.bad AND (ok IS NULL OR seen > ok)) AS n FROM c JOIN k USING (source) GROUP BY c.source)
 SELECT key, CASE WHEN k.source IS NULL THEN crawl_status WHEN bad THEN 'error' ELSE 'ok' END AS crawl_status, CASE WHEN k.source IS NULL THEN crawl_error WHEN bad THEN 'refused' END AS crawl_error,
  (CASE WHEN k.source IS NULL THEN consecutive_failures ELSE n + CASE WHEN ok IS NULL THEN coalesce(consecutive_failures, 0) ELSE 0 END END)::BIGINT AS consecutive_failures, coalesce(last, last_crawled_at) AS last_crawled_at
 FROM sources s LEFT JOIN k ON k.source = s.key LEFT JOIN r ON r.source = s.key""",
        "weekly_snapshots": """SELECT source, published_date + ((7 - dayofweek(published_date)) % 7)::INT AS week_ending, string_agg(id::VARCHAR, ',' ORDER BY id) AS item_ids, count(*) AS n_items
 FROM items WHERE published_date IS NOT NULL GROUP BY 1, 2""",
        "source_failures": """WITH o AS (SELECT user_id, max(struct_pack(ts := ts, event_id := event_id)) FILTER (event_type <> 'error') AS last_ok FROM events GROUP BY user_id)
 SELECT e.user_id AS source, count(*) FILTER (event_type = 'error' AND (last_ok IS NULL OR struct_pack(ts := ts, event_id := event_id) > last_ok)) AS consecutive_failures FROM events e JOIN o USING (user_id) GROUP BY 1""",
        "crawl_counters": "SELECT user_id, CASE WHEN event_type = 'error' THEN 'error' WHEN (props->>'$.k')::INT % 10 = 0 THEN 'empty' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1, 2",
        "usage_rollup": "SELECT event_type AS service, count(*) AS n_calls, sum((props->>'$.k')::BIGINT)::BIGINT AS tokens, round(sum(value), 2) AS cost FROM events GROUP BY 1",
        "source_validation": """WITH s AS (SELECT row_number() OVER (ORDER BY id) - 1 AS position, CASE WHEN id % 7 = 0 THEN 'quiet_grid' ELSE key END AS key, CASE WHEN id % 5 <> 0 THEN name END AS name, source_type,
   CASE WHEN id % 3 = 0 THEN crawler_type || 's' ELSE crawler_type END AS crawler_type FROM sources)
 SELECT position, key, 'name is missing' AS problem FROM s WHERE trim(coalesce(name, '')) = '' UNION ALL
 SELECT position, key, 'unknown crawler_type ' || crawler_type FROM s WHERE crawler_type NOT IN ('nber', 'rss', 'crossref', 'openalex', 'arxiv_atom', 'html_scraper', 'osf_preprint') UNION ALL
 SELECT position, key, 'key stands at ' || first::VARCHAR FROM (SELECT *, min(position) OVER (PARTITION BY key) AS first FROM s) WHERE first < position""",
        "enabled_sources": "SELECT key, name, crawler_type FROM sources WHERE is_enabled AND list_contains(subtopics, 'fair_rules')",
        "failing_sources": "SELECT key, consecutive_failures::BIGINT AS consecutive_failures FROM sources WHERE is_enabled AND consecutive_failures >= 3",
        "sources_by_crawler": "SELECT crawler_type, count(*) AS n_sources, sum(coalesce(n, 0))::BIGINT AS n_items FROM sources s LEFT JOIN (SELECT source, count(*) AS n FROM items GROUP BY 1) p ON p.source = s.key GROUP BY 1",
        "rss_items": rf"""SELECT source, (crawled_at AT TIME ZONE 'UTC')::DATE AS published_date, count(*) AS n, sum(length(coalesce(trim(regexp_replace(regexp_replace(abstract, '<[^>]+>', ' ', 'g'), '[\s\p{{Z}}]+', ' ', 'g')), '')))::BIGINT AS n_chars
 FROM items WHERE length(title) > 0 AND length(url) > 0 AND (crawled_at AT TIME ZONE 'UTC')::DATE >= DATE '2025-02-01' GROUP BY 1, 2""",
        "registry_items": rf"""SELECT '10.1000/' || id AS source_id, 'https://doi.org/10.1000/' || id AS url, trim(regexp_replace(title, '{WS}', ' ', 'g')) AS title, 'Ann ' || source AS authors,
 CASE WHEN published_date IS NULL OR published_date > DATE '2026-03-08' THEN DATE '2026-03-01' ELSE published_date END AS published_date FROM items WHERE length(title) > 0""",
        "extractive_abstract": rf"""WITH p AS (SELECT id, trim(regexp_replace(content, '{WS}', ' ', 'g')) AS whole, trim(regexp_replace(regexp_replace(content, '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g')) AS plain FROM items),
 k AS (SELECT id, whole, list_filter(list_transform(string_split(regexp_replace(plain, '([.!?])\s+([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) BETWEEN 30 AND 200 AND NOT regexp_matches(x, '{BOILERPLATE}')) AS kept FROM p),
 c AS (SELECT id, whole, list_transform(kept, lambda x: CASE WHEN regexp_matches(x, '[.!?]$') THEN x ELSE regexp_replace(x, '[,;:]+$', '') || '.' END) AS closed FROM k),
 b AS (SELECT id, whole, list_transform(closed, lambda x: CASE WHEN length(x) > 95 THEN regexp_replace(regexp_replace(substr(x, 1, 90), ' [^ ]*$', ''), '[.,;:]+$', '') || '...' ELSE x END) AS bullets FROM c)
 SELECT id, CASE WHEN length(whole) >= 100 AND len(bullets) >= 2 THEN array_to_string(list_transform(bullets[1:3], lambda x: '- ' || x), chr(10)) END AS bullets FROM b""",
        "category_audit": f"""WITH RECURSIVE {VERDICTS}, {SCORES.split('s AS')[0].strip().rstrip(',')},
 filled AS (SELECT DISTINCT subtopic, unnest(list_filter(topics, lambda t: starts_with(t, 'general'))) AS topic FROM v WHERE relevant),
 h AS (SELECT x.id AS item_id, k.subtopic, k.topic, k.ordinal FROM x CROSS JOIN taxonomy k WHERE len(list_filter(k.keywords[1:8], lambda w: contains(x.t, lower(w)))) > 0
  AND NOT EXISTS (SELECT 1 FROM filled f WHERE f.subtopic = k.subtopic AND f.topic = k.topic) AND EXISTS (SELECT 1 FROM v WHERE v.item_id = x.id AND v.subtopic = k.subtopic AND NOT coalesce(v.relevant, false))),
 first AS (SELECT *, row_number() OVER (PARTITION BY subtopic ORDER BY item_id, ordinal) AS n FROM (SELECT *, row_number() OVER (PARTITION BY subtopic, topic ORDER BY item_id) AS r FROM h) WHERE r <= (SELECT count(*) FROM taxonomy)),
 walk AS (SELECT DISTINCT subtopic, 0::BIGINT AS n, []::VARCHAR[] AS taken, NULL::BIGINT AS item_id, NULL::VARCHAR AS topic, NULL::BIGINT AS last FROM first
  UNION ALL SELECT w.subtopic, f.n, CASE WHEN list_contains(taken, f.topic) OR last IS NOT DISTINCT FROM f.item_id THEN taken ELSE list_append(taken, f.topic) END,
   CASE WHEN list_contains(taken, f.topic) OR last IS NOT DISTINCT FROM f.item_id THEN NULL ELSE f.item_id END, CASE WHEN list_contains(taken, f.topic) OR last IS NOT DISTINCT FROM f.item_id THEN NULL ELSE f.topic END,
   CASE WHEN list_contains(taken, f.topic) OR last IS NOT DISTINCT FROM f.item_id THEN last ELSE f.item_id END FROM walk w JOIN first f ON f.subtopic = w.subtopic AND f.n = w.n + 1)
 SELECT item_id, subtopic, topic FROM walk WHERE item_id IS NOT NULL""",
        "enriched_items": """SELECT id, coalesce(length(coalesce(content, '')) < 500 AND length(d.t) > CASE WHEN length(coalesce(content, '')) = 0 THEN length(coalesce(abstract, '')) ELSE length(content) END, false) AS enriched,
 length(CASE WHEN coalesce(length(coalesce(content, '')) < 500 AND length(d.t) > CASE WHEN length(coalesce(content, '')) = 0 THEN length(coalesce(abstract, '')) ELSE length(content) END, false) THEN d.t ELSE content END)::BIGINT AS n_chars
 FROM items i LEFT JOIN (SELECT j.url, arg_max(text, length(text)) AS t FROM documents JOIN items j ON j.id = doc_id WHERE text IS NOT NULL GROUP BY j.url) d ON d.url = i.url""",
        "listing_items": "SELECT source, count(*) AS n, min(published_date) AS first_day FROM items WHERE length(title) > 0 AND published_date >= DATE '2025-02-01' GROUP BY source",
        "stream_first_seen": "SELECT DISTINCT user_id::VARCHAR || '/' || event_type AS key, 1::BIGINT AS n FROM events",
        "stream_failures": """WITH o AS (SELECT user_id, max(struct_pack(ts := ts, event_id := event_id)) FILTER (event_type <> 'error') AS last_ok FROM events GROUP BY user_id)
 SELECT e.user_id AS source, count(*) FILTER (event_type = 'error' AND (last_ok IS NULL OR struct_pack(ts := ts, event_id := event_id) > last_ok)) AS consecutive_failures FROM events e JOIN o USING (user_id) GROUP BY 1""",
    }
