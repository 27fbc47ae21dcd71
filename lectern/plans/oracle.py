"""SQL of the queries in ``catalog.py`` for a second engine, written apart from their DataFrame form.

That engine's patterns have no look-ahead, and their word boundary is ASCII. ``found`` rewrites both:
``A(?!B)`` holds if A is found and what follows its last match has no B.
"""

from __future__ import annotations

import re

from ..functions import patterns as P


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _boundary(pattern: str) -> str:
    if pattern.isascii():
        return pattern
    edge = r"(^|[^\p{L}\p{N}_])"
    pattern = re.sub(r"^\\b", lambda m: edge, pattern)
    return re.sub(r"\\b$", lambda m: edge.replace("^|", "$|"), pattern)


def _edges(pattern: str) -> str:
    """Every word boundary as one between letters of any script."""
    parts = re.split(r"(\\b)", pattern)
    edge = {True: r"(?:^|[^\p{L}\p{N}_])", False: r"(?:$|[^\p{L}\p{N}_])"}
    return "".join(edge[k + 1 < len(parts) and parts[k + 1][:1] not in ("", "|", ")")] if p == r"\b" else p for k, p in enumerate(parts))


def found(column: str, patterns: list[str]) -> str:
    """A condition that is never null: one of the patterns is found."""
    plain, ahead = [], []
    for p in patterns:
        (ahead if "(?!" in p else plain).append(p)
    terms = [f"regexp_matches(coalesce({column}, ''), {_quoted('(?i)' + '|'.join(_boundary(p) for p in plain))})"]
    for p in ahead:
        first, rest = p.split("(?!", 1)
        rest = rest.removesuffix(")")
        if not rest.startswith(".*"):
            terms.append(f"regexp_matches(coalesce({column}, ''), {_quoted('(?i)' + first)})")
            continue
        only = re.sub(r"\((?!\?)", "(?:", first)
        tail = f"regexp_extract(coalesce({column}, ''), {_quoted('(?is)^.*' + only + '(.*)$')}, 1)"
        terms.append(f"(regexp_matches(coalesce({column}, ''), {_quoted('(?i)' + only)}) AND NOT regexp_matches({tail}, {_quoted('(?is)' + rest)}))")
    return "(" + " OR ".join(terms) + ")"


def any_word(column: str, *lists: list[str]) -> str:
    """Words between boundaries; those outside ASCII have their own edges."""
    names = [w for one in lists for w in one]
    ascii_words = "(?i)\\b(" + "|".join(w for w in names if w.isascii()) + ")\\b"
    terms = [f"regexp_matches(coalesce({column}, ''), {_quoted(ascii_words)})"]
    if others := [w for w in names if not w.isascii()]:
        terms.append(f"regexp_matches(coalesce({column}, ''), {_quoted('(?i)(^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])(' + '|'.join(others) + ')($|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])')})")
    return "(" + " OR ".join(terms) + ")"


LONG = "(duration_seconds >= 900 OR duration_seconds IS NULL OR duration_seconds = 0)"
KEEP = f"({LONG} AND coalesce(title, '') <> '' AND NOT {found('title', P.REJECT)})"
TIER = f"CASE WHEN {found('title', P.TIER_9)} THEN 9 WHEN {found('title', P.TIER_8)} THEN 8 WHEN {found('title', P.TIER_7)} THEN 7 ELSE 5 END"
URL = "'https://videos.example/watch?v=' || video_id"
ORDER = "md5(cast(id AS varchar) || ':42'), id"

ENTRIES = """
entries AS (
  SELECT arrival, fetched_at, line ->> '$.id' AS id, line ->> '$.title' AS title, try_cast(line ->> '$.duration' AS double) AS duration,
         line ->> '$.channel_id' AS channel_id, line ->> '$.url' AS url
  FROM (SELECT * FROM raw_entries WHERE line IS NOT NULL AND trim(line) <> '' AND json_valid(line)) r
  WHERE json_type(line) = 'OBJECT' AND (line ->> '$.id' IS NOT NULL OR line ->> '$.url' IS NOT NULL)),
valid AS (
  SELECT * FROM (SELECT *, CASE WHEN length(id) = 11 THEN id ELSE split_part(url, '=', -1) END AS video_id FROM entries) e WHERE length(video_id) = 11)"""

RESPONSES = """
readable AS (SELECT * FROM license_responses WHERE body IS NOT NULL AND json_valid(body) AND json_type(body, '$.items') = 'ARRAY'),
items AS (
  SELECT request_id, item ->> '$.id' AS video_id, coalesce(item ->> '$.status.license', 'unknown') AS licence
  FROM (SELECT request_id, unnest(from_json(json_extract(body, '$.items'), '["json"]')) AS item FROM readable) i
  WHERE item ->> '$.id' IS NOT NULL),
scanned AS (
  SELECT a.request_id, a.video_id, coalesce(min(i.licence), 'unavailable') AS licence
  FROM (SELECT DISTINCT request_id, unnest(requested_ids) AS video_id FROM readable) a
  LEFT JOIN items i ON i.request_id = a.request_id AND i.video_id = a.video_id
  WHERE a.video_id IS NOT NULL GROUP BY 1, 2)"""

FREE = found("description", P.FREE_LICENCE)
SAYS = "coalesce(contains(lower(youtube_license), 'creative'), false)"


def _admitted(long_enough: str, reject: list[list[str]], priority: str, mark: str, duration: str = "coalesce(duration, 0.0)", title: str = "coalesce(title, '')", more: str = "") -> str:
    refused = f"AND NOT {any_word('title', *reject)}" if reject else ""
    return f"""WITH {ENTRIES},
      kept AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY arrival) AS rn FROM valid WHERE {long_enough} {refused})
      SELECT video_id, arrival, {title} AS title, {duration} AS duration, {priority} AS priority, '{mark}:' || video_id AS origin{more} FROM kept WHERE rn = 1"""


def _boosted(high: int, low: int, *boost: list[str]) -> str:
    return f"CASE WHEN {any_word('title', *boost)} THEN {high} ELSE {low} END"


_KNOWN = "(duration >= 900 OR duration IS NULL OR duration = 0)"
_NULL = "(duration >= 900 OR duration IS NULL)"
_RANGE = "(duration > 120 AND duration < 36000)"
#: Words between boundaries of the profiles, written out for each as the source tables have them.
_BASE = [*P.SHORT_REJECT, "gta v"]
_BOOST_CHANNEL = [*P.BOOST, "лекция", "курс", "Vorlesung", "cours", "lezione", "wykład", "강의", "講義", "课程"]
_BOOST_10M = [*P.BOOST, "coursera", "edx", "advanced", "graduate", "undergraduate", "лекция", "курс", "университет", "Vorlesung", "cours magistral", "lezione", "wykład", "강의", "講義", "课程"]
_REJECT_10M = [*P.SHORT_REJECT, "let's play", "get ready with me", "scene", "challenge video", "best of", "gta"]


def _share(column: str, where: str = "true", expression: str | None = None) -> str:
    e = expression or column
    return f"""SELECT {e} AS {column}, count(*) AS n,
      round(cast(count(*) AS double) * 100.0 / cast(sum(count(*)) OVER () AS double), 4) AS percent FROM videos WHERE {where} GROUP BY {e}"""


EXPORTED = """coalesce(url, '') AS url, coalesce(cast(trunc(duration_seconds) AS bigint), 0) AS duration_seconds, coalesce(nullif(priority, 0), 5) AS priority,
      coalesce(nullif(university, ''), nullif(course, ''), '') AS source,"""


def _category() -> str:
    cases = lambda k, column: "".join(f" WHEN regexp_matches(coalesce({column}, ''), {_quoted('(?i)' + _edges(c[k]))}) THEN '{c[0]}'" for c in P.CATEGORIES if c[k])
    return f"""SELECT id, coalesce(CASE {cases(1, 'university')} END, CASE {cases(2, 'title')} END, CASE WHEN priority >= 8 THEN 'university_lecture'
      WHEN NOT (coalesce(university, '') = '' AND coalesce(title, '') = '' AND priority IS NULL) THEN 'unknown' END) AS category FROM videos"""


ORACLE: dict[str, str] = {
    "scan_project": "SELECT id, video_id, title, university, duration_seconds FROM videos WHERE status = 'completed'",
    "schema_evolve": "SELECT id, video_id, lang, cast(NULL AS varchar) AS region_code, cast(NULL AS bigint) AS view_count FROM videos",
    "url_build": f"SELECT id, {URL} AS watch_url FROM videos",
    "truncate_text": """SELECT id, substring(university, 1, 30) AS name_30, substring(title, 1, 60) AS title_60, substring(title, 1, 200) AS title_200,
      substring(transcript, 1, 500) AS text_500, substring(error, 1, 500) AS error_500, md5(substring(description, 1, 5000)) AS description_5000 FROM videos""",
    "title_clean": r"""SELECT id, CASE WHEN length(h) < 10 THEN substring(title, 1, 60) ELSE h END AS short_title
      FROM (SELECT id, title, substring(trim(regexp_replace(title, '[|\-–—:]+.*$', ''), ' '), 1, 60) AS h FROM videos) v""",
    "url_label": """SELECT id, split_part(url, '/', -1) AS tail, split_part(url || '/videos', '/', -2) AS parent, split_part(replace(url || '/videos', '/videos', ''), '/', -1) AS channel,
      substring(split_part(url, 'v=', -1), 1, 20) AS label, CASE WHEN url IS NOT NULL THEN substring('PL' || md5(video_id), 1, 20) END AS playlist FROM videos""",
    "speed_ratio": "SELECT id, round(CASE WHEN processing_time_seconds > 0 THEN duration_seconds / processing_time_seconds ELSE 0.0 END, 4) AS speed FROM videos",
    "segments_join": r"""SELECT id, len(string_split(transcript, chr(10))) AS n_segments, md5(trim(replace(transcript, chr(10), ' '), ' ')) AS text_md5
      FROM videos WHERE transcript IS NOT NULL""",
    "outcome_classify": """SELECT id, CASE WHEN error = 'download_failed' THEN 'download_failed'
        WHEN duration_seconds < 5 THEN 'too_short_' || cast(cast(floor(duration_seconds) AS int) AS varchar) || 's'
        WHEN length(trim(transcript, ' ')) > 0 THEN 'completed' ELSE 'empty_transcript' END AS outcome
      FROM videos WHERE status IN ('completed', 'error')""",
    "priority_tier": f"SELECT id, {TIER} AS tier FROM videos",
    "content_category": _category(),
    "license_classify": f"""SELECT id, CASE WHEN {SAYS} OR {FREE} THEN 'green' END AS risk,
        CASE WHEN {SAYS} THEN 'creativeCommon' WHEN {FREE} THEN 'cc_in_description' ELSE coalesce(nullif(youtube_license, ''), 'youtube') END AS note FROM videos""",
    "quality_filter": f"SELECT id, video_id FROM videos WHERE {KEEP}",
    "text_segments": """SELECT id, cast(k - 1 AS int) AS position, length(s[k]) AS n_chars FROM (
        SELECT id, string_split(transcript, chr(10)) AS s, unnest(range(1, len(string_split(transcript, chr(10))) + 1)) AS k
        FROM videos WHERE transcript IS NOT NULL) v""",
    "duration_floor": f"SELECT id, duration_seconds FROM videos WHERE {LONG}",
    "duration_strict": "SELECT id, duration_seconds FROM videos WHERE duration_seconds > 900",
    "duration_range": "SELECT id, duration_seconds FROM videos WHERE duration_seconds > 120 AND duration_seconds < 36000",
    "status_filter": "SELECT id, status FROM videos WHERE status IN ('pending', 'processing')",
    "needs_license": "SELECT id, video_id FROM videos WHERE youtube_license IS NULL OR youtube_license = ''",
    "needs_description": f"""SELECT id, status FROM videos WHERE description IS NULL OR description = ''
      ORDER BY CASE WHEN status = 'completed' THEN 0 ELSE 1 END, {ORDER} LIMIT 100""",
    "known_channels": """SELECT DISTINCT source FROM (SELECT coalesce(nullif(university, ''), url) AS source FROM videos) v WHERE source ILIKE 'http%' OR source ILIKE '@%'""",
    "green_sources": """SELECT DISTINCT university FROM videos WHERE license_risk = 'green' AND university <> ''
      AND university NOT ILIKE '%crawl%' AND university NOT ILIKE '%search%' ORDER BY university LIMIT 500""",
    "id_validate": f"WITH {ENTRIES} SELECT arrival, video_id FROM valid",
    "related_pairs": """SELECT DISTINCT from_channel AS source, to_channel AS target FROM channel_discoveries
      WHERE from_channel IS NOT NULL AND to_channel IS NOT NULL AND from_channel <> to_channel""",
    "ndjson_parse": f"WITH {ENTRIES} SELECT arrival, id, title, duration FROM entries",
    "entries_explode": f"WITH {RESPONSES} SELECT request_id, video_id, licence FROM items",
    "license_scan": f"WITH {RESPONSES} SELECT request_id, video_id, licence FROM scanned",
    "watch_links": r"SELECT DISTINCT arrival, unnest(regexp_extract_all(line, 'watch\?v=([A-Za-z0-9_-]{11})', 1)) AS link FROM raw_entries",
    "playlist_extract": r"""WITH p AS (SELECT id, substring(md5(video_id), 1, 8) AS mark FROM videos), d AS (
        SELECT id, CASE WHEN id % 3 = 0 THEN 'see https://videos.example/playlist?list=PL' || mark || ' and watch?v=x&list=PL_' || cast(id % 5 AS varchar) || '-a' WHEN id % 3 = 2 THEN 'no links, list=UUabc' END AS text,
               CASE WHEN id % 4 = 0 THEN 'PL' || mark WHEN id % 4 = 1 THEN 'UU' || mark END AS own FROM p)
      SELECT id, unnest(regexp_extract_all(text, 'list=(PL[A-Za-z0-9_-]+)', 1)) AS link FROM d UNION SELECT id, own FROM d WHERE own LIKE 'PL%'""",
    "playlist_videos": f"""WITH {ENTRIES}, o AS (SELECT 'UU' || substring(c.channel_id, 3) AS playlist_id, video_id, min(arrival) AS arrival
        FROM channels c JOIN valid v ON v.channel_id = c.channel_id WHERE v.channel_id LIKE 'UC%' GROUP BY 1, 2)
      SELECT playlist_id, video_id, arrival FROM (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY arrival) AS rn FROM o) p WHERE rn <= 500""",
    "admit_related": _admitted(_KNOWN, [_BASE, ["let's play"]], _boosted(8, 5, _BOOST_CHANNEL), "related", duration="duration"),
    "admit_channel": _admitted(_NULL, [_BASE, ["let.s play"]], _boosted(8, 5, _BOOST_CHANNEL), "channel"),
    "admit_cc": _admitted(_KNOWN, [_BASE, ["let.s play"], P.RELIGIOUS], _boosted(9, 7, P.BOOST), "cc"),
    "admit_safe": _admitted(_KNOWN, [_BASE, ["let.s play"], P.RELIGIOUS, P.CONSPIRACY], _boosted(8, 5, _BOOST_CHANNEL, ["coursera", "edx"]), "safe",
        more=", CASE WHEN channel_id IS NULL THEN 'yellow' ELSE 'green' END AS license_risk"),
    "admit_boot10m": _admitted(_KNOWN, [_REJECT_10M], _boosted(8, 5, _BOOST_10M), "boot10m", duration="duration"),
    "admit_boot1m": _admitted(_RANGE, [], "5", "boot1m"),
    "admit_aggressive": _admitted(_RANGE, [], "5", "aggressive"),
    "admit_mega": f"""WITH {ENTRIES}, kept AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY arrival) AS rn FROM valid WHERE duration >= 900)
      SELECT video_id, arrival, substring(coalesce(title, ''), 1, 500) AS title, duration, CASE WHEN channel_id IS NULL THEN 7 ELSE 8 END AS priority,
             'mega:' || video_id AS origin, CASE WHEN channel_id IS NULL THEN 'search' ELSE 'channel' END AS course FROM kept WHERE rn = 1""",
    "legacy_import": f"""WITH {ENTRIES}, r AS (
        SELECT video_id, arrival, substring(coalesce(title, 'Unknown'), 1, 200) AS title, CASE WHEN duration IS NULL OR duration = 0 THEN 900.0 ELSE duration END AS duration,
               row_number() OVER (PARTITION BY video_id ORDER BY arrival) AS rn
        FROM valid WHERE NOT coalesce(duration <> 0 AND duration < 120, false))
      SELECT video_id, arrival, title, duration, CASE WHEN duration > 3600 THEN 3 WHEN duration > 1800 THEN 4 ELSE 5 END AS priority FROM r WHERE rn = 1""",
    "insert_new": f"""WITH {ENTRIES}, r AS (
        SELECT video_id, arrival, title, duration, row_number() OVER (PARTITION BY video_id ORDER BY arrival) AS rn
        FROM valid v WHERE NOT EXISTS (SELECT 1 FROM videos q WHERE q.video_id = v.video_id AND q.status = 'completed'))
      SELECT video_id, arrival, title, duration FROM r WHERE rn = 1""",
    "edges_insert": """SELECT from_channel, to_channel, min(id) AS id FROM channel_discoveries d
      WHERE from_channel IS NOT NULL AND to_channel IS NOT NULL AND NOT coalesce(discovered_at < TIMESTAMP '2026-01-05 01:00:00', false)
        AND NOT EXISTS (SELECT 1 FROM channel_discoveries e WHERE e.from_channel = d.from_channel AND e.to_channel = d.to_channel AND e.discovered_at < TIMESTAMP '2026-01-05 01:00:00')
      GROUP BY 1, 2""",
    "channel_extract": f"""WITH {ENTRIES} SELECT DISTINCT channel_id FROM entries e WHERE channel_id LIKE 'UC%'
      AND NOT EXISTS (SELECT 1 FROM channels c WHERE c.channel_id = e.channel_id AND c.status = 'crawled')""",
    "channel_verdict": f"""WITH {ENTRIES}, g AS (SELECT * FROM valid WHERE channel_id IS NOT NULL), f AS (
        SELECT channel_id, avg(CASE WHEN {any_word('title', _BOOST_CHANNEL)} THEN 1.0 ELSE 0.0 END) AS teaching, avg(CASE WHEN duration >= 900 THEN 1.0 ELSE 0.0 END) AS long
        FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY arrival) AS rn FROM g) e WHERE rn <= 50 GROUP BY 1),
      n AS (SELECT channel_id, count(*) AS n_videos FROM g GROUP BY 1),
      a AS (SELECT video_id, channel_id, row_number() OVER (PARTITION BY video_id ORDER BY arrival) AS rn FROM g WHERE {_NULL} AND NOT {any_word('title', _BASE, ["let.s play"])}),
      i AS (SELECT channel_id, count(*) AS n_inserted FROM a WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM videos q WHERE q.video_id = a.video_id AND q.status = 'completed') GROUP BY 1),
      w AS (SELECT c.channel_id, NOT {any_word('c.channel_name', P.REJECT_CHANNEL)} AND (f.teaching IS NULL OR f.teaching >= 0.2 OR f.long >= 0.3) AS worth,
                   coalesce(n.n_videos, 0) AS n_videos, coalesce(i.n_inserted, 0) AS n_inserted
            FROM channels c LEFT JOIN f ON f.channel_id = c.channel_id LEFT JOIN n ON n.channel_id = c.channel_id LEFT JOIN i ON i.channel_id = c.channel_id)
      SELECT channel_id, CASE WHEN worth THEN 'crawled' ELSE 'rejected' END AS status, n_videos, CASE WHEN worth THEN n_inserted END AS n_inserted FROM w""",
    "claim_batch": f"""WITH c AS (SELECT * FROM videos WHERE status = 'pending' AND {LONG}), b AS (
        SELECT id, 0 AS k, row_number() OVER (ORDER BY {ORDER}) AS rn, 6 AS q FROM c WHERE license_risk = 'green'
        UNION ALL SELECT id, 1, row_number() OVER (ORDER BY {ORDER}), 3 FROM c WHERE license_risk <> 'red' AND priority >= 8 AND duration_seconds < 3600
        UNION ALL SELECT id, 2, row_number() OVER (ORDER BY {ORDER}), 1 FROM c WHERE license_risk <> 'red' AND priority >= 8 AND duration_seconds >= 3600
        UNION ALL SELECT id, 3, row_number() OVER (ORDER BY {ORDER}), 3 FROM c WHERE license_risk <> 'red' AND priority < 8 AND duration_seconds < 3600
        UNION ALL SELECT id, 4, row_number() OVER (ORDER BY {ORDER}), 1 FROM c WHERE license_risk <> 'red' AND priority < 8 AND duration_seconds >= 3600)
      SELECT id, CASE min(k) WHEN 0 THEN 'green' WHEN 1 THEN 'first_short' WHEN 2 THEN 'first_long' WHEN 3 THEN 'other_short' ELSE 'other_long' END AS bucket
      FROM b WHERE rn <= q GROUP BY id""",
    "claim_fallback": f"""SELECT id, 'any' AS bucket FROM videos WHERE status = 'pending' AND {LONG} AND license_risk IS NULL ORDER BY {ORDER} LIMIT 15""",
    "finish_rows": r"""WITH q AS (
        SELECT *, CASE WHEN id % 5 = 0 THEN 'download_failed' WHEN id % 5 = 1 THEN 'ERROR: ' || repeat(video_id, 60) END AS failure,
               (CASE WHEN id % 7 = 0 THEN 2.5 ELSE coalesce(duration_seconds, 600.0) END) * 1.2 AS own, cast(id % 11 AS double) AS secs,
               CASE WHEN id % 3 = 0 THEN '' ELSE 'text of ' || video_id END AS said FROM videos WHERE status = 'processing'),
      e AS (SELECT *, substring(CASE WHEN failure IS NOT NULL THEN failure WHEN own < 5 THEN 'too_short_' || cast(cast(floor(own) AS int) AS varchar) || 's' WHEN said = '' THEN 'empty_transcript' END, 1, 500) AS wrong FROM q)
      SELECT id, CASE WHEN wrong IS NULL THEN 'completed' ELSE 'error' END AS status, coalesce(wrong, error) AS error, CASE WHEN wrong IS NULL THEN said ELSE transcript END AS text,
             round(CASE WHEN wrong IS NULL THEN own ELSE duration_seconds END, 3) AS duration_seconds, CASE WHEN wrong IS NULL THEN secs ELSE processing_time_seconds END AS processing_time_seconds,
             round(CASE WHEN wrong IS NULL THEN CASE WHEN secs > 0 THEN own / secs ELSE 0.0 END ELSE speed_ratio END, 3) AS speed_ratio,
             CASE WHEN wrong IS NULL THEN TIMESTAMP '2026-02-01 00:00:00' ELSE completed_at END AS completed_at FROM e""",
    "describe_rows": f"""WITH {RESPONSES}, last AS (SELECT video_id, arg_max(licence, request_id) AS licence FROM scanned GROUP BY 1),
      f AS (SELECT video_id, licence, licence <> 'unavailable' AS ok, ascii(video_id) % 4 = 0 AS worded FROM last),
      r AS (SELECT v.id, CASE WHEN f.ok THEN CASE WHEN f.worded THEN 'Notes. Licensed under a creative commons licence.' ELSE substring(repeat(f.video_id, 600), 1, 5000) END
                   WHEN coalesce(v.description, '') = '' THEN '[unavailable]' ELSE v.description END AS d,
              CASE WHEN NOT f.ok THEN v.youtube_license WHEN contains(lower(f.licence), 'creative') THEN 'creativeCommon' WHEN f.worded THEN 'cc_in_description' ELSE coalesce(nullif(f.licence, ''), 'youtube') END AS youtube_license,
              CASE WHEN f.ok AND (f.worded OR contains(lower(f.licence), 'creative')) THEN 'green' ELSE v.license_risk END AS license_risk
            FROM videos v JOIN f ON f.video_id = v.video_id)
      SELECT id, length(d) AS n_chars, md5(d) AS description_md5, youtube_license, license_risk FROM r""",
    "stale_reset": """SELECT id, CASE WHEN status = 'processing' AND processing_started_at < TIMESTAMP '2026-01-06 11:30:00' THEN 'pending' ELSE status END AS status FROM videos""",
    "retro_clean": f"SELECT id, CASE WHEN {KEEP} THEN 'pending' ELSE 'rejected' END AS status, CASE WHEN {KEEP} THEN {TIER} ELSE 0 END AS priority FROM videos WHERE status = 'pending'",
    "retro_clean_stats": f"""SELECT count(*) FILTER (WHERE NOT k) AS rejected, count(*) FILTER (WHERE k AND t > priority) AS upgraded, count(*) FILTER (WHERE k AND t < priority) AS downgraded
      FROM (SELECT priority, {KEEP} AS k, {TIER} AS t FROM videos WHERE status = 'pending') v""",
    "license_merge": f"""WITH {RESPONSES}, last AS (SELECT video_id, arg_max(licence, request_id) AS licence FROM scanned GROUP BY 1)
      SELECT v.id, v.video_id, coalesce(l.licence, v.youtube_license) AS youtube_license,
             CASE WHEN l.licence = 'creativeCommon' AND v.license_risk <> 'green' THEN 'green' ELSE v.license_risk END AS license_risk
      FROM videos v LEFT JOIN last l ON l.video_id = v.video_id""",
    "license_batches": """SELECT cast((rn - 1) // 50 AS bigint) AS shard, count(*) AS n, min(id) AS first_id, max(id) AS last_id
      FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM videos WHERE youtube_license IS NULL OR youtube_license = '') v GROUP BY 1""",
    "seed_sample": f"""WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY id) AS rn FROM videos) v WHERE rn = 1)
      SELECT * FROM (SELECT id, video_id, status FROM o WHERE status = 'completed' AND duration_seconds > 1800 ORDER BY {ORDER} LIMIT 50) a
      UNION ALL SELECT * FROM (SELECT id, video_id, status FROM o WHERE status = 'pending' AND priority >= 8 ORDER BY {ORDER} LIMIT 50) b""",
    "cc_seeds": f"""SELECT id, status FROM videos WHERE license_risk = 'green' AND status IN ('completed', 'pending')
      ORDER BY CASE WHEN status = 'completed' THEN 0 ELSE 1 END, {ORDER} LIMIT 100""",
    "seed_titles": """SELECT c.channel_id, c.channel_name FROM channels c
      WHERE c.channel_id IN (SELECT to_channel FROM channel_discoveries WHERE to_channel IS NOT NULL)""",
    "topn_per_group": """SELECT university, id, duration_seconds FROM (
        SELECT university, id, duration_seconds, row_number() OVER (PARTITION BY university ORDER BY duration_seconds DESC, id) AS rn
        FROM videos WHERE university IS NOT NULL AND duration_seconds IS NOT NULL) v WHERE rn <= 3""",
    "query_gen": """SELECT replace(f.form, '{}', s.subject_code) || ' in ' || l.english_name AS question
      FROM subjects s, (VALUES ('full course {}'), ('{} lecture'), ('{} seminar for beginners')) f(form), languages l""",
    "query_shuffle": """WITH q AS (SELECT replace(f.form, '{}', s.subject_code) || ' in ' || l.english_name AS question
        FROM subjects s, (VALUES ('full course {}'), ('{} lecture'), ('{} seminar for beginners')) f(form), languages l)
      SELECT question, place FROM (SELECT question, row_number() OVER (ORDER BY md5(question || ':42'), question) AS place FROM q) r WHERE place <= 30""",
    "frontier_unexplored": """SELECT channel_id, status FROM channels c
      WHERE NOT EXISTS (SELECT 1 FROM channel_discoveries d WHERE d.from_channel = c.channel_id)""",
    "snowball_round": """WITH c AS (SELECT channel_id FROM channels WHERE status = 'crawled') SELECT DISTINCT to_channel AS node FROM channel_discoveries d
      WHERE to_channel IS NOT NULL AND from_channel <> to_channel AND from_channel IN (SELECT * FROM c) AND to_channel NOT IN (SELECT * FROM c)""",
    "snowball_reach": """WITH RECURSIVE e AS (SELECT DISTINCT from_channel AS s, to_channel AS t FROM channel_discoveries WHERE from_channel IS NOT NULL AND to_channel IS NOT NULL AND from_channel <> to_channel),
      -- a shortest path visits no node twice, so there is none longer than the number of nodes
      size AS (SELECT count(*) AS n FROM (SELECT s FROM e UNION SELECT t FROM e) x),
      r(node, depth) USING KEY (node) AS (SELECT DISTINCT channel_id, 0 FROM channels WHERE source = 'search'
        UNION SELECT e.t, min(r.depth + 1) FROM r JOIN e ON e.s = r.node LEFT JOIN recurring.r AS k ON k.node = e.t WHERE k.node IS NULL GROUP BY e.t)
      SELECT node, depth FROM r""",
    "queue_counts": """SELECT count(*) AS n_rows, count(*) FILTER (WHERE status = 'pending') AS n_pending,
      count(*) FILTER (WHERE license_risk = 'green') AS n_green, count(DISTINCT video_id) AS n_videos FROM videos""",
    "dist_status": _share("status"),
    "dist_priority": _share("priority", "status = 'pending'"),
    "dist_category": _share("content_category", expression="nullif(content_category, '')"),
    "dist_license_risk": """SELECT license_risk, count(*) AS n, round(cast(count(*) AS double) * 100.0 / cast(sum(count(*)) OVER () AS double), 4) AS percent,
      CASE license_risk WHEN 'green' THEN 'free' WHEN 'yellow' THEN 'standard' WHEN 'orange' THEN 'unclear' WHEN 'red' THEN 'refused' ELSE 'unknown' END AS label
      FROM videos GROUP BY license_risk""",
    "green_by_license": "SELECT youtube_license, count(*) AS n FROM videos WHERE license_risk = 'green' GROUP BY 1 ORDER BY n DESC, youtube_license NULLS FIRST LIMIT 20",
    "cc_channels": """SELECT university, count(*) AS n, cast(sum(CASE WHEN youtube_license = 'creativeCommon' THEN 1 ELSE 0 END) AS bigint) AS n_free FROM videos
      WHERE youtube_license IN ('creativeCommon', 'youtube') AND university <> '' AND university NOT ILIKE '%crawl%' AND university NOT ILIKE '%search%'
      GROUP BY 1 HAVING count(*) >= 5 AND cast(sum(CASE WHEN youtube_license = 'creativeCommon' THEN 1 ELSE 0 END) AS double) / count(*) > 0.2
      ORDER BY n_free DESC, university LIMIT 100""",
    "monitor_stats": """SELECT n_done, round(s / 3600, 3) AS hours, mean_speed, n_chars, cast(n_chars // 4 AS bigint) AS tokens_by_chars, round(s / 3600 * 12000, 1) AS tokens_by_hours,
        elapsed_seconds, round(n_done * 3600.0::double / greatest(elapsed_seconds, 1), 4) AS done_per_hour, round(n_done * 100.0::double / greatest(n, 1), 4) AS percent_done
      FROM (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'completed') AS n_done, coalesce(sum(duration_seconds) FILTER (WHERE status = 'completed'), 0.0) AS s,
              round(coalesce(avg(speed_ratio) FILTER (WHERE speed_ratio > 0), 0.0), 4) AS mean_speed, cast(coalesce(sum(length(transcript)), 0) AS bigint) AS n_chars,
              cast(floor(epoch(max(completed_at) - min(processing_started_at))) AS bigint) AS elapsed_seconds FROM videos) v""",
    "recent_speed": """SELECT round(avg(speed_ratio), 4) AS recent_speed
      FROM (SELECT speed_ratio FROM videos WHERE status = 'completed' AND speed_ratio > 0 ORDER BY completed_at DESC NULLS LAST, id DESC LIMIT 20) v""",
    "progress_milestone": """SELECT n, round(h, 3) AS hours, round(h / 10000, 6) AS percent,
        CASE WHEN h >= 1000000 THEN '1M' WHEN h >= 500000 THEN '500K' WHEN h >= 100000 THEN '100K' ELSE 'start' END AS milestone, n_rows >= 10000000 AS stop
      FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE status = 'pending') AS n, coalesce(sum(duration_seconds) FILTER (WHERE status = 'pending'), 0.0) / 3600 AS h FROM videos) v""",
    "worker_running": """SELECT event_id, user_id, seen, round(running_total, 2) AS running_total, round(round(running_total, 2) / seen, 6) AS running_mean FROM (
        SELECT event_id, user_id, count(*) OVER w AS seen, sum(value) OVER w AS running_total FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) e WHERE seen <= 3 OR seen % 5 = 0""",
    "source_rollup": """SELECT license_risk, status, cast(grouping_id(license_risk, status) AS int) AS level, count(*) AS n, round(sum(duration_seconds), 1) AS seconds
      FROM videos GROUP BY ROLLUP (license_risk, status)""",
    "licensing_targets": """SELECT university, count(*) AS n, CASE WHEN count(*) > 100 THEN 'high' ELSE 'middle' END AS band FROM videos
      WHERE university IS NOT NULL AND university <> '' GROUP BY 1 HAVING count(*) > 20 ORDER BY n DESC, university LIMIT 50""",
    "export_transcripts": f"""SELECT id, coalesce(video_id, '') AS video_id, coalesce(title, '') AS title, transcript AS text, {EXPORTED}
      round(coalesce(speed_ratio, 0.0), 1) AS speed_ratio, coalesce(content_category, '') AS content_category, coalesce(license_risk, '') AS license_risk
      FROM videos WHERE status = 'completed' AND transcript IS NOT NULL""",
    "export_shards": """SELECT cast((rn - 1) // 500 AS bigint) AS shard, count(*) AS n, cast(sum(id) AS bigint) AS id_sum FROM (
        SELECT id, row_number() OVER (ORDER BY priority DESC NULLS LAST, completed_at ASC NULLS FIRST, id) AS rn
        FROM videos WHERE status = 'completed' AND transcript IS NOT NULL) v GROUP BY 1""",
    "export_queue": f"""SELECT id, coalesce(video_id, '') AS video_id, coalesce(title, '') AS title, {EXPORTED} coalesce(status, '') AS status,
      coalesce(nullif(content_category, ''), 'unknown') AS content_category, coalesce(nullif(license_risk, ''), 'yellow') AS license_risk FROM videos""",
    "export_card_stats": """SELECT n, n_chars, cast(n_chars // 4 AS bigint) AS n_tokens, cast(floor(s / 3600) AS bigint) AS hours,
      CASE WHEN n < 1000 THEN 'n<1K' WHEN n < 10000 THEN '1K<n<10K' WHEN n < 100000 THEN '10K<n<100K' WHEN n < 1000000 THEN '100K<n<1M' ELSE 'n>1M' END AS size_bucket
      FROM (SELECT count(*) AS n, cast(coalesce(sum(length(transcript)), 0) AS bigint) AS n_chars, coalesce(sum(duration_seconds), 0.0) AS s
            FROM videos WHERE status = 'completed' AND transcript IS NOT NULL) v""",
    "late_counts": """SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n_events, round(sum(value), 2) AS value_sum FROM events GROUP BY 1, 2""",
}

ORACLE["claim_rows"] = f"""WITH taken AS ({ORACLE['claim_batch']}) SELECT id, video_id, title, 'processing' AS status, TIMESTAMP '2026-02-01 00:00:00' AS processing_started_at
  FROM videos WHERE id IN (SELECT id FROM taken)"""
