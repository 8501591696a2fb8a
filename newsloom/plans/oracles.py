"""ANSI SQL twins of the queries, for a second engine over the same tables.

They rebuild each result from the tables by other means than the operators: set-based SQL for joins and grouping,
recursive SQL for components, and for text and dates the expected value from its parts.
"""

from __future__ import annotations

from newsloom.functions.dates import CALENDAR, NEPALI_MONTHS
from newsloom.functions.text import WEEKDAYS
from newsloom.plans.adapters import DATE_FROM, LONG_WORD, PER_ARTICLE, REFERENCE_YEAR

STAR = f"""
ea AS (SELECT DISTINCT l_orderkey AS event_key, l_suppkey AS actor_key FROM lineitem),
es AS (SELECT DISTINCT l_orderkey AS event_key, l_partkey AS source_key FROM lineitem),
src AS (SELECT p_partkey AS source_key, p_name AS title, 'part/' || p_partkey AS url,
               min(CAST(l_shipdate AS DATE)) AS published_date
        FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2, 3),
j AS (SELECT s_suppkey AS actor_key, s_name AS actor_label, o_orderkey AS event_key, o_orderpriority AS event_label,
             o_orderstatus AS event_details, src.source_key, title AS source_title, url AS source_url,
             CAST(published_date AS VARCHAR) AS published_date
      FROM src JOIN es ON src.source_key = es.source_key JOIN orders ON o_orderkey = es.event_key
      JOIN ea ON ea.event_key = o_orderkey JOIN supplier ON s_suppkey = ea.actor_key
      WHERE published_date >= DATE '{DATE_FROM}')"""

NODES = """
SELECT DISTINCT 'actor_' || actor_key AS node_id, 'actor' AS role, actor_label AS label,
       CAST(NULL AS VARCHAR) AS details, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS published_date FROM j
UNION ALL SELECT DISTINCT 'event_' || event_key, 'event', event_label, event_details, NULL, NULL FROM j
UNION ALL SELECT DISTINCT 'source_' || source_key, 'source', source_title, NULL, source_url, published_date FROM j"""

EDGES = """
SELECT DISTINCT 'actor_' || actor_key AS src, 'event_' || event_key AS dst FROM j
UNION ALL SELECT DISTINCT 'event_' || event_key, 'source_' || source_key FROM j"""

ENT = f"""
ent AS (SELECT event_id, event_id // {PER_ARTICLE} AS article_pos,
    CAST(row_number() OVER (PARTITION BY event_id // {PER_ARTICLE} ORDER BY event_id) - 1 AS INTEGER) AS entity_pos,
    'http://example.com/a/' || ((event_id // {PER_ARTICLE}) % 701) AS article_url,
    'Article ' || (event_id // {PER_ARTICLE}) AS title,
    strftime(min(ts) OVER (PARTITION BY event_id // {PER_ARTICLE}), '%Y-%m-%d (%A)') AS published_date,
    event_type AS event,
    list_concat(['user_' || user_id], CASE WHEN event_id % 3 = 0 THEN ['u' || user_id] ELSE [] END,
                CASE WHEN event_id % 5 = 0 THEN ['user_' || user_id] ELSE [] END,
                CASE WHEN event_id % 10 = 0 THEN [''] ELSE [] END) AS actors,
    CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS event_date,
    strftime(ts, '%H:%M') AS event_time, 'loc_' || (user_id % 7) AS location, props AS details
  FROM events),
dated AS (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY article_pos, entity_pos) AS n
          FROM ent WHERE event_date IS NOT NULL AND event_date <> '')"""

ALIASES = """
users AS (SELECT DISTINCT user_id AS i FROM events),
al AS (SELECT 'actor' AS kind, 'user_' || i AS canonical, 'user_' || i AS variant, i AS rank FROM users
       UNION ALL SELECT 'actor', 'user_' || i, 'u' || i, i FROM users
       UNION ALL SELECT 'actor', 'user_' || (i + 1), 'u' || i, i + 1 FROM users WHERE i % 10 = 0
       UNION ALL SELECT DISTINCT 'location', 'place_' || (i % 7), 'loc_' || (i % 7), i % 7 FROM users WHERE i % 7 <> 3),
fm AS (SELECT kind, variant, arg_min(canonical, rank) AS canonical FROM al GROUP BY 1, 2),
names AS (SELECT article_pos, entity_pos, i, actors[i] AS name FROM (SELECT *, unnest(range(1, len(actors) + 1)) AS i FROM ent)),
canon AS (SELECT e.article_pos, e.entity_pos, string_agg(coalesce(f.canonical, n.name), '|' ORDER BY n.i) AS actors,
                 any_value(coalesce(l.canonical, e.location)) AS location
          FROM ent e JOIN names n USING (article_pos, entity_pos)
          LEFT JOIN fm f ON f.kind = 'actor' AND f.variant = n.name
          LEFT JOIN fm l ON l.kind = 'location' AND l.variant = e.location GROUP BY 1, 2)"""

MERGED = f"""{ENT},
mem AS (SELECT *, CAST(event_time[1:2] AS BIGINT) AS merged_id FROM dated),
mev AS (SELECT event_date, merged_id, arg_min(event, n) AS event, arg_min(details, n) AS details FROM mem GROUP BY 1, 2),
mact AS (SELECT event_date, merged_id, actor, min((n, i)) AS p
         FROM (SELECT event_date, merged_id, n, unnest(actors) AS actor, unnest(range(1, len(actors) + 1)) AS i FROM mem)
         GROUP BY 1, 2, 3),
msrc AS (SELECT event_date, merged_id, title, article_url, published_date, min(n) AS source_pos FROM mem
         GROUP BY 1, 2, 3, 4, 5),
sdim AS (SELECT article_url AS url, arg_min(title, (event_date, merged_id, source_pos)) AS title,
                arg_min(split_part(published_date, ' ', 1), (event_date, merged_id, source_pos)) AS published_date
         FROM msrc GROUP BY 1)"""


def _key(*columns: str) -> str:
    return "md5(" + " || chr(1) || ".join(f"'=' || {c}" for c in columns) + ")"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _calendar() -> str:
    starts = CALENDAR.month_starts()
    rows = ", ".join(
        f"({CALENDAR.first_year + i // 12}, {i % 12 + 1}, DATE '{first}', {(following - first).days})"
        for i, (first, following) in enumerate(zip(starts, starts[1:]))
    )
    return f"cal(cy, cm, first, days) AS (VALUES {rows})"


BS = f"""{_calendar()},
bs AS (SELECT event_id, 2078 + event_id % 7 AS y, 1 + event_id % 12 AS m, 1 + event_id % 33 AS d,
              ({_list(NEPALI_MONTHS)})[event_id % 24 + 1] AS month,
              ({_list(WEEKDAYS)})[event_id % 7 + 1] AS weekday, ({_list(WEEKDAYS.values())})[event_id % 7 + 1] AS day_en
       FROM events),
bsd AS (SELECT bs.*, translate(CAST(y AS VARCHAR), '0123456789', '०१२३४५६७८९') AS yd,
               translate(CAST(d AS VARCHAR), '0123456789', '०१२३४५६७८९') AS dd,
               CASE WHEN d <= c.days THEN c.first + CAST(d - 1 AS INTEGER) END AS greg,
               CASE WHEN d <= r.days THEN r.first + CAST(d - 1 AS INTEGER) END AS greg_ref
        FROM bs LEFT JOIN cal c ON c.cy = y AND c.cm = m JOIN cal r ON r.cy = {REFERENCE_YEAR} AND r.cm = m)"""

_PARAGRAPHS = """array_to_string(list_transform(string_split({region}, '<p>')[2:],
    lambda p: array_to_string(list_transform(string_split_regex(split_part(regexp_replace(p, '{cut}.*', '', 's'), '</p>', 1), '<[^>]*>'),
         lambda t: trim(t, chr(32) || chr(10) || chr(9) || chr(13) || chr(160))), '')), chr(10))"""


def _decode(text: str) -> str:
    return f"replace(replace({text}, '&quot;', '\"'), '&amp;', '&')"


_CLEAN = "regexp_replace(regexp_replace(html, '(?s)<script>.*?</script>', ''), '(?s)<!--.*?-->', '')"
_TITLE = _decode(
    "array_to_string(list_transform(string_split_regex(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>'), lambda t: trim(t, chr(32) || chr(10))), '')"
)
_CONTENT = _decode(_PARAGRAPHS.format(region="regexp_extract(html, '(?s)<article>(.*?)</article>', 1)", cut="</article>"))
_ALL_PARAGRAPHS = _decode(_PARAGRAPHS.format(region=_CLEAN, cut="</article>"))

RESPONSES = """
one AS (SELECT event_id, event_type, event_id % 11 AS k,
    concat_ws(';', event_type, 'user_' || user_id || '|u' || user_id, strftime(ts, '%Y-%m-%d'), 'loc_' || (user_id % 7),
              'd' || event_id, '', 'false') AS e,
    '{"event":"' || event_type || '","actors":["user_' || user_id || '",["u' || user_id || '",7],9],"event_date":"'
      || strftime(ts, '%Y-%m-%d') || '","event_time":null,"location":"loc_' || (user_id % 7) || '","details":"d'
      || event_id || '"}' AS good FROM events)"""

# Shingles, exact Jaccard of all pairs that share one, components.
SIMILAR = """
words AS (SELECT lang, doc_id + 1 AS n, list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '') AS w FROM documents),
grams AS (SELECT lang, n, CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM words),
dig AS (SELECT lang, n, g, md5(array_to_string(list_sort(g), chr(1))) AS digest FROM grams WHERE len(g) > 0),
sets AS (SELECT lang, digest, min(n) AS node, any_value(g) AS g FROM dig GROUP BY 1, 2),
tok AS (SELECT lang, node, len(g) AS n, unnest(g) AS t FROM sets),
edge AS (SELECT p.lang, p.node AS x, q.node AS y FROM tok p JOIN tok q ON p.lang = q.lang AND p.t = q.t AND p.node < q.node
  GROUP BY 1, 2, 3 HAVING count(*) >= 0.5 * (any_value(p.n) + any_value(q.n) - count(*))),
reach AS (SELECT lang, node, node AS root FROM sets
          UNION SELECT r.lang, CASE WHEN e.x = r.node THEN e.y ELSE e.x END, r.root
          FROM reach r JOIN edge e ON e.lang = r.lang AND (e.x = r.node OR e.y = r.node)),
comp AS (SELECT lang, node, min(root) AS component FROM reach GROUP BY 1, 2),
groups AS (SELECT d.lang AS event_date, d.n, component FROM dig d JOIN sets s USING (lang, digest)
           JOIN comp c ON c.lang = d.lang AND c.node = s.node
           UNION ALL SELECT lang, n, n FROM grams WHERE len(g) = 0)"""

LOG = "SELECT event_id, 'id-' || event_id AS id, 'Article ' || event_type AS title, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp FROM events"

ONCE = f"SELECT id, title, timestamp FROM ({LOG})"

_COUNTS = """
SELECT role AS what, count(*) AS n FROM nodes GROUP BY 1 UNION ALL SELECT 'nodes', count(*) FROM nodes
UNION ALL SELECT 'edges', count(*) FROM edges"""

NARRATIVE_COUNTS = f"""WITH {MERGED},
links AS (SELECT s.event_date, s.merged_id, s.article_url FROM msrc s JOIN sdim d ON d.url = s.article_url
          WHERE d.published_date >= '2024-01-10'),
al2 AS (SELECT DISTINCT event_date, merged_id, actor FROM mact WHERE (event_date, merged_id) IN (SELECT (event_date, merged_id) FROM links)),
nodes AS (SELECT DISTINCT 'actor' AS role, actor AS k FROM al2
          UNION ALL SELECT DISTINCT 'event', event_date || '/' || merged_id FROM links
          UNION ALL SELECT DISTINCT 'source', article_url FROM links),
edges AS (SELECT DISTINCT event_date || '/' || merged_id AS s, actor AS d FROM al2
          UNION ALL SELECT DISTINCT event_date || '/' || merged_id, article_url FROM links)
{_COUNTS}"""

ORACLES = {
    "star_join": f"WITH {STAR} SELECT * FROM j",
    "graph_role_counts": f"WITH {STAR} SELECT role, count(*) AS n FROM ({NODES}) GROUP BY 1",
    "graph_nodes": f"WITH {STAR} {NODES}",
    "graph_edges": f"WITH {STAR} {EDGES}",
    "graph_pruned_nodes": f"WITH {STAR} {NODES}",
    "graph_pruned": f"WITH {STAR} {EDGES}",
    "graph_counts": f"WITH {STAR}, nodes AS ({NODES}), edges AS ({EDGES}) {_COUNTS}",
    "actors_dim": f"""WITH {MERGED}, {ALIASES} SELECT {_key('label')} AS actor_key, label FROM (
        SELECT canonical AS label FROM al WHERE kind = 'actor' UNION SELECT actor FROM mact)""",
    "actors_new": f"""WITH {MERGED}, {ALIASES} SELECT DISTINCT actor AS label FROM mact
        WHERE NOT EXISTS (SELECT 1 FROM al WHERE kind = 'actor' AND canonical = actor)""",
    "aliases_dim": f"""WITH {ENT}, {ALIASES} SELECT {_key('canonical')} AS actor_key, variant AS alias FROM al
        WHERE kind = 'actor' AND variant <> canonical""",
    "sources_dim": f"WITH {MERGED} SELECT {_key('url')} AS source_key, title, url, published_date FROM sdim",
    "events_dim": f"WITH {MERGED} SELECT {_key('event_date', 'merged_id')} AS event_key, event_date, event AS label, details FROM mev",
    "event_actor_links": f"WITH {MERGED} SELECT {_key('event_date', 'merged_id')} AS event_key, {_key('actor')} AS actor_key FROM mact",
    "event_source_links": f"WITH {MERGED} SELECT {_key('event_date', 'merged_id')} AS event_key, {_key('article_url')} AS source_key FROM msrc",
    "narrative_graph": NARRATIVE_COUNTS,
    "sink_star": NARRATIVE_COUNTS,
    "dense_ids": "SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer",
    "table_previews": f"""WITH {STAR} SELECT 'actors' AS table_name, least(3, count(*)) AS n FROM supplier
        UNION ALL SELECT 'sources', least(3, count(*)) FROM src UNION ALL SELECT 'events', least(3, count(*)) FROM orders
        UNION ALL SELECT 'event_actors', least(3, count(*)) FROM ea UNION ALL SELECT 'event_sources', least(3, count(*)) FROM es""",
    "entities_unnest": f"""WITH {ENT} SELECT article_pos, article_url, title, published_date, entity_pos, event,
        array_to_string(actors, '|') AS actors, event_date, event_time, location, details FROM dated""",
    "unique_actors": f"WITH {ENT} SELECT DISTINCT value FROM (SELECT unnest(actors) AS value FROM ent) WHERE value <> '' ORDER BY 1",
    "unique_locations": f"WITH {ENT} SELECT DISTINCT location AS value FROM ent",
    "unique_event_labels": "SELECT DISTINCT event_type AS value FROM events",
    "canonical_names": f"WITH {ENT}, {ALIASES} SELECT * FROM canon",
    "canonical_nested": f"WITH {ENT}, {ALIASES} SELECT * FROM canon",
    "canonical_locations": f"""WITH {ENT} SELECT article_pos, entity_pos, array_to_string(actors, '|') AS actors,
        CASE WHEN location = 'loc_3' THEN location ELSE replace(location, 'loc_', 'place_') END AS location FROM ent""",
    "canonical_actors": f"""WITH {ENT}, {ALIASES} SELECT name AS value, coalesce(canonical, name) AS canonical, count(*) AS uses
        FROM names LEFT JOIN fm ON kind = 'actor' AND variant = name GROUP BY 1, 2""",
    "per_date_ids": f"WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, article_pos, entity_pos FROM dated",
    "events_by_date": f"""WITH {ENT} SELECT event_date, (n - 1) // 100 AS chunk, count(*) AS n,
        string_agg(n || ':' || event || ':' || article_url, '|' ORDER BY n) AS events FROM dated GROUP BY event_date, (n - 1) // 100""",
    "events_sorted": f"WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event, event_time FROM dated ORDER BY event_date, n",
    "narrow_events": f"""WITH {ENT}, {ALIASES} SELECT d.event_date, d.event, d.details, c.actors, c.location, d.article_url, d.title,
        d.published_date FROM dated d JOIN canon c USING (article_pos, entity_pos)""",
    "merge_input": f"""WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event, details,
        array_to_string(actors, '|') AS actors FROM dated""",
    "merged_sources": f"WITH {MERGED} SELECT * FROM msrc",
    "merged_nested": f"""WITH {MERGED},
        na AS (SELECT event_date, merged_id, (r - 1) // 20 AS chunk, string_agg(actor, '|' ORDER BY r) AS actors FROM (
            SELECT *, row_number() OVER (PARTITION BY event_date, merged_id ORDER BY p) AS r FROM mact) GROUP BY 1, 2, 3),
        ns AS (SELECT event_date, merged_id, (r - 1) // 20 AS chunk,
                      string_agg(title || '~' || article_url || '~' || published_date, '|' ORDER BY r) AS sources FROM (
            SELECT *, row_number() OVER (PARTITION BY event_date, merged_id ORDER BY source_pos) AS r FROM msrc) GROUP BY 1, 2, 3)
        SELECT event_date, merged_id, coalesce(na.chunk, ns.chunk, 0) AS chunk, event, details, coalesce(actors, '') AS actors,
               coalesce(sources, '') AS sources
        FROM mev JOIN (na FULL JOIN ns USING (event_date, merged_id, chunk)) USING (event_date, merged_id)""",
    "dates_gregorian": """SELECT o_orderkey, CASE o_orderkey % 7
            WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-d-%-m-%Y')
            WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
            WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 5 THEN strftime(o_orderdate, '%-d %B %Y')
            ELSE '31/02/' || strftime(o_orderdate, '%Y') END AS line,
        CASE WHEN o_orderkey % 7 < 6 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date,
        CASE WHEN o_orderkey % 7 < 6 THEN strftime(o_orderdate, '%Y-%m-%d (%A)') ELSE '' END AS label FROM orders""",
    "dates_bs": f"""WITH {BS} SELECT event_id, CASE WHEN greg IS NOT NULL THEN y END AS bs_year,
        CASE WHEN greg IS NOT NULL THEN m END AS bs_month, CASE WHEN greg IS NOT NULL THEN d END AS bs_day,
        CAST(greg AS VARCHAR) AS greg, strftime(greg, '%A') AS day_name, CAST(greg AS VARCHAR) AS date,
        coalesce(strftime(greg, '%Y-%m-%d (%A)'), '') AS label FROM bsd""",
    "digits_and_months": f"""WITH {BS} SELECT event_id, y || ' ' || month || ' ' || d || ' गते '
        || lpad(CAST(event_id % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS line, m AS month FROM bsd""",
    "text_dates": f"""WITH {BS}, t AS (SELECT *, strftime(greg, '%Y-%m-%d (%A)') AS full_label,
            strftime(greg_ref, '%Y-%m-%d (%A)') AS ref_label FROM bsd)
        SELECT event_id, CASE event_id % 4
            WHEN 0 THEN CASE WHEN greg IS NOT NULL THEN day_en || ' ' || full_label || ' भयो।'
                ELSE day_en || ' ' || yd || ' ' || coalesce(ref_label, month || ' ' || dd) || ' lastे भयो।' END
            WHEN 1 THEN 'last ' || day_en || ', ' || coalesce(ref_label, month || ' ' || d) || ' मा।'
            WHEN 2 THEN 'मिति: ' || coalesce(ref_label, dd || ' ' || month) || ', ' || day_en
            ELSE day_en || ' lastेको कुरा, ' || month || ' महिना।' END AS sentence FROM t""",
    "text_words": f"""WITH {BS}, t AS (SELECT event_id, CASE event_id % 4
            WHEN 0 THEN day_en || ' ' || yd || ' ' || month || ' ' || dd || ' गते भयो।'
            WHEN 1 THEN 'गत ' || day_en || ', ' || month || ' ' || d || ' मा।'
            WHEN 2 THEN 'मिति: ' || dd || ' ' || month || ', ' || day_en
            ELSE day_en || ' गतेको कुरा, ' || month || ' महिना।' END AS weekdays FROM bsd)
        SELECT event_id, weekdays, replace(weekdays, 'गत', 'last') AS time_words, replace(weekdays, 'गत ', 'last ') AS whole_words FROM t""",
    "page_titles": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_by_classes": f"""SELECT page_id, {_TITLE} AS title,
        '२०८१ असार ' || translate(CAST(page_id % 31 + 1 AS VARCHAR), '0123456789', '०१२३४५६७८९') || ' गते & ०९:३०' AS published_raw,
        {_CONTENT} AS content FROM (SELECT page_id, {_CLEAN} AS html FROM pages)""",
    "page_content": f"SELECT page_id, {_CONTENT} AS content, '' AS published_raw FROM pages",
    "page_paragraphs_fallback": f"SELECT page_id, {_ALL_PARAGRAPHS} AS content FROM pages",
    "page_attach": "SELECT url, page_id AS pos, CASE WHEN page_id % 10 = 0 THEN '' ELSE html END AS html FROM pages",
    "page_articles": f"""SELECT page_id AS pos, url, CASE WHEN page_id % 10 = 0 THEN '' ELSE {_TITLE} END AS title,
        '' AS published_date, CASE WHEN page_id % 10 = 0 THEN '' ELSE {_CONTENT} END AS content FROM pages""",
    "parse_responses": f"""WITH {RESPONSES} SELECT event_id, CASE WHEN k IN (0, 1, 2, 4) THEN '' WHEN k IN (3, 6) THEN e
            WHEN k = 5 THEN event_type || ';soon;actors|details|location;true' ELSE e || '#' || e END AS entities,
        CASE k WHEN 0 THEN 'The model found nothing.' WHEN 1 THEN '[' || good END AS raw_response, k > 1 AS parse_ok FROM one""",
    "conforming_events": f"""WITH {RESPONSES} SELECT event_type AS event, CAST(sum(CASE WHEN k IN (3, 6) THEN 1 ELSE 2 END) AS BIGINT) AS n,
            true AS good FROM one WHERE k IN (3, 6, 7, 8, 9, 10) GROUP BY 1
        UNION ALL SELECT event_type, count(*), false FROM one WHERE k = 5 GROUP BY 1""",
    "parse_dictionary": """SELECT 'actor' AS kind, s_name AS canonical, unnest([s_name, 'S' || s_suppkey]) AS variant,
        s_suppkey * 4294967296 AS rank FROM supplier WHERE s_suppkey % 9 > 1""",
    "dictionary_fallback": """SELECT 'actor' AS kind, 'S' || s_suppkey AS variant,
            CASE WHEN s_suppkey % 9 > 1 THEN s_name ELSE 'old ' || s_name END AS canonical FROM supplier
        UNION ALL SELECT 'actor', s_name, s_name FROM supplier WHERE s_suppkey % 9 > 1""",
    "prompts_extraction": """SELECT doc_id AS pos, 'Find events.' || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN
        'On 2024-05-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' at 9:3' || (doc_id % 10) || ' ' || text ELSE text END AS prompt
        FROM documents""",
    "prompts_merge": f"""WITH {ENT},
        alike AS (SELECT *, min(n) OVER (PARTITION BY event_date, event, details) AS unit, count(*) OVER (PARTITION BY event_date) AS whole FROM dated),
        placed AS (SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY unit, n) - 1 AS place,
                          count(*) OVER (PARTITION BY event_date, unit) AS size FROM alike),
        started AS (SELECT *, min(place) OVER (PARTITION BY event_date, unit) AS start FROM placed)
        SELECT event_date, CASE WHEN whole <= 50 THEN 0 WHEN size <= 25 THEN 2 * (start // 25)
              ELSE 2 * (start // 25) + 1 + 2 * ((place - start) // 50) END AS chunk, 'Merge events.' || chr(10) || chr(10) || '{{"Events":['
        || string_agg('{{"id":"' || n || '","event":"' || event || '","details":"' || replace(details, '"', '\\"') || '","actors":["'
        || array_to_string(actors, '","') || '"]}}', ',' ORDER BY n) || ']}}' AS prompt FROM started GROUP BY 1, 2""",
    "prompts_aliases": f"""WITH {ENT}, v AS (SELECT DISTINCT value FROM (SELECT unnest(actors) AS value FROM ent) WHERE value <> ''),
        r AS (SELECT value, row_number() OVER (ORDER BY replace(value, '_', ' '), value) AS n, count(*) OVER () AS whole FROM v)
        SELECT CASE WHEN whole <= 40 THEN 0 ELSE 2 * ((n - 1) // 20) END AS chunk,
            'Unify names.' || chr(10) || string_agg(value, chr(10) ORDER BY value) AS prompt FROM r GROUP BY 1""",
    "infer_stage": """SELECT event_id, 'p' || event_id AS prompt,
        CASE WHEN contains('p' || event_id, '66') THEN NULL ELSE '[p' || event_id || ']' END AS response,
        CASE WHEN contains('p' || event_id, '66') THEN 'RuntimeError: prompt refused' END AS error FROM events""",
    "merge_responses": f"""WITH {ENT}, p AS (SELECT event_date, (n - 1) // 2 AS pair, string_agg(n, '|' ORDER BY n) AS members FROM dated
            WHERE event_date <> '2024-01-05' GROUP BY 1, 2)
        SELECT event_date, row_number() OVER (PARTITION BY event_date ORDER BY pair) AS merged_id, 'pair' AS event, members FROM p
        UNION ALL SELECT event_date, 0, 'no', '' FROM dated WHERE event_date = '2024-01-05' GROUP BY event_date, (n - 1) // 50""",
    "similar_documents": f"WITH RECURSIVE {SIMILAR} SELECT event_date, n, component FROM groups",
    "merge_events": f"""WITH RECURSIVE {SIMILAR} SELECT event_date, component AS merged_id, '' AS event,
            (SELECT md5(text) FROM documents h WHERE h.doc_id + 1 = component) AS details, count(*) AS members, count(DISTINCT source) AS actors
        FROM groups JOIN documents d ON d.doc_id + 1 = n GROUP BY 1, 2""",
    "components": """WITH RECURSIVE e AS (
            SELECT CAST(c_nationkey AS BIGINT) * 1000000000 + c_custkey AS x, CAST(c_nationkey AS BIGINT) * 1000000000 + c_custkey // 2 AS y
            FROM customer WHERE c_custkey <> c_custkey // 2),
        pairs AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
        reach AS (SELECT x AS node, x AS root FROM pairs UNION SELECT p.y, r.root FROM reach r JOIN pairs p ON p.x = r.node)
        SELECT node, min(root) AS component FROM reach GROUP BY 1""",
    "resolve_aliases": r"""WITH used AS (SELECT CASE p_partkey % 8
            WHEN 0 THEN left(p_name, p_partkey % 5) || substr(p_name, p_partkey % 5 + 2)
            WHEN 1 THEN left(p_name, p_partkey % 5 + 1) || substr(p_name, p_partkey % 5 + 1)
            WHEN 2 THEN left(p_name, p_partkey % 5) || 'q' || substr(p_name, p_partkey % 5 + 2)
            WHEN 3 THEN upper(p_name) ELSE p_name END AS name FROM part),
        counted AS (SELECT name, count(*) AS uses FROM used WHERE name <> '' GROUP BY 1),
        normal AS (SELECT name, uses, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS f FROM counted),
        forms AS (SELECT f, sum(uses) AS w, arg_min(name, (-uses, name)) AS best FROM normal WHERE f <> '' GROUP BY 1),
        keys AS (SELECT f, f AS k FROM forms UNION SELECT f, left(f, i - 1) || substr(f, i + 1) FROM (
            SELECT f, unnest(range(1, length(f) + 1)) AS i FROM forms WHERE length(regexp_replace(f, '[^a-z]', '', 'g')) >= 5) WHERE NOT regexp_matches(f[i], '\d')),
        e AS (SELECT DISTINCT p.f AS x, q.f AS y FROM keys p JOIN keys q USING (k) WHERE p.f <> q.f),
        clear AS (SELECT a.f, b.f AS h, b.w, b.best FROM e JOIN forms a ON a.f = e.x JOIN forms b ON b.f = e.y WHERE b.w >= 2 * a.w),
        moved AS (SELECT f, arg_min(best, (-w, h)) AS other FROM clear WHERE h NOT IN (SELECT f FROM clear) GROUP BY 1)
        SELECT 'actor' AS kind, coalesce(other, best, name) AS canonical, name AS variant, CAST(0 AS BIGINT) AS rank, uses
        FROM normal LEFT JOIN forms USING (f) LEFT JOIN moved USING (f)""",
    "extract_baseline": rf"""WITH art AS (SELECT doc_id AS pos, CASE WHEN doc_id % 2 = 0 THEN
            'On 2024-05-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' at 9:3' || (doc_id % 10) || ' ' || text ELSE text END AS content FROM documents),
        pieces AS (SELECT pos, string_split_regex(content, '[।.!?\n]+') AS p FROM art),
        sent AS (SELECT pos, i - 1 AS no, regexp_replace(p[i], '^\s+|\s+$', '', 'g') AS s
                 FROM (SELECT pos, p, unnest(range(1, len(p) + 1)) AS i FROM pieces)),
        toks AS (SELECT pos, no, s, list_filter(list_transform(string_split_regex(s, '\s+'),
                   lambda w: regexp_replace(w, '^[^\p{{L}}\p{{M}}\p{{N}}]+|[^\p{{L}}\p{{M}}\p{{N}}]+$', '', 'g')), lambda w: w <> '') AS w FROM sent WHERE s <> ''),
        runs AS (SELECT pos, no, i AS spot, unnest(CASE WHEN i < len(w) THEN [w[i], w[i] || ' ' || w[i + 1]] ELSE [w[i]] END) AS variant
                 FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM toks)),
        bw AS (SELECT list_filter(list_transform(string_split_regex(text, '\s+'),
                   lambda w: regexp_replace(w, '^[^\p{{L}}\p{{M}}\p{{N}}]+|[^\p{{L}}\p{{M}}\p{{N}}]+$', '', 'g')), lambda w: w <> '') AS w FROM benchmark),
        dict AS (SELECT DISTINCT CASE WHEN length(x) % 2 = 0 THEN 'actor' ELSE 'location' END AS kind, lower(v) AS canonical, v AS variant FROM (
            SELECT w[i] AS x, unnest(CASE WHEN i < len(w) THEN [w[i], w[i] || ' ' || w[i + 1]] ELSE [w[i]] END) AS v
            FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM bw)) WHERE length(x) >= {LONG_WORD}),
        hit AS (SELECT pos, no, kind, canonical, min(spot) AS spot FROM runs JOIN dict USING (variant) GROUP BY 1, 2, 3, 4),
        agg AS (SELECT pos, no, string_agg(canonical, '|' ORDER BY spot, canonical) FILTER (WHERE kind = 'actor') AS actors,
                       coalesce(string_agg(canonical, '|' ORDER BY spot, canonical) FILTER (WHERE kind = 'location'), '') AS location
                FROM hit GROUP BY 1, 2 HAVING count(*) FILTER (WHERE kind = 'actor') > 0)
        SELECT pos AS article_pos, 'doc/' || pos AS article_url, 'Document ' || pos AS title, '2024-06-01 (Saturday)' AS published_date,
            CAST(no AS INTEGER) AS entity_pos, md5(s) AS event, actors,
            CASE WHEN no = 0 AND pos % 2 = 0 THEN '2024-05-' || lpad(CAST(pos % 28 + 1 AS VARCHAR), 2, '0') ELSE '2024-06-01' END AS event_date,
            CASE WHEN no = 0 AND pos % 2 = 0 THEN '9:3' || (pos % 10) END AS event_time, location, md5(s) AS details
        FROM agg JOIN toks USING (pos, no)""",
    "sink_dated_events": f"WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event, array_to_string(actors, '|') AS actors FROM dated",
    "sink_progress": f"""WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event,
        CASE WHEN event_date < '2024-01-11' THEN 'first' ELSE 'second' END AS run FROM dated""",
    "sink_aliases": f"WITH {ENT}, {ALIASES} SELECT kind, canonical, rank, variant FROM al",
    "sink_articles": """SELECT 'doc/' || doc_id AS url, 'Document ' || doc_id AS title, '2024-06-01 (Saturday)' AS published_date,
        CASE WHEN doc_id % 2 = 0 THEN 'On 2024-05-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' at 9:3' || (doc_id % 10) || ' ' || text
        ELSE text END AS content FROM documents""",
    "sink_grouped_events": f"""WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event, article_url,
        array_to_string(actors, '|') AS actors FROM dated""",
    "date_keyed_file": f"""WITH {ENT} SELECT event_date, CAST(n AS VARCHAR) AS id, event, article_url,
        array_to_string(actors, '|') AS actors FROM dated""",
    "sink_merged_events": f"""WITH {MERGED} SELECT event_date, merged_id, event, details, title, article_url, published_date
        FROM mev JOIN msrc USING (event_date, merged_id)""",
    "sink_graph_xml": f"""WITH {STAR}, nodes AS ({NODES}), edges AS ({EDGES})
        SELECT 'node' AS what, node_id AS a, label AS b, concat_ws('|', '0=' || role, '1=' || details, '2=' || url, '3=' || published_date) AS c FROM nodes
        UNION ALL SELECT 'edge', src, dst, '' FROM edges""",
    "stream_ingest": f"{ONCE} UNION ALL {ONCE} WHERE event_id % 4 = 0",
    "stream_once_per_id": ONCE,
    "stream_append_once": ONCE,
}
