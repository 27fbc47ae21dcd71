"""SQL of those queries that a second engine can state: exact likeness by shingles, classes and groups of
copies, and the multiplicities of texts. The others rest on tokenizers or fitted models."""

from __future__ import annotations

# White space as Python's split has it, and words as runs of letters and digits.
_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_RUN = r"[\p{L}\p{N}]+"


def _shingles(least: int) -> str:
    """Tables ``v`` (video_id, its words ``w``, its text ``t``) and ``s`` (video_id, distinct shingles ``g``) of the
    videos whose transcript has ``least`` words."""
    return f"""
      v AS (SELECT video_id, min(coalesce(title, '') || chr(10) || transcript) AS t FROM videos
            WHERE video_id IS NOT NULL AND len(list_filter(regexp_split_to_array(transcript, '{_SPACE}'), lambda x: x <> '')) >= {least} GROUP BY 1),
      w AS (SELECT video_id, t, regexp_extract_all(lower(t), '{_RUN}') AS w FROM v),
      s AS (SELECT video_id, t, w, list_distinct([w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3] || ' ' || w[k + 4] FOR k IN range(1, len(w) - 3)]) AS g FROM w)"""


_PAIRS = """
      f AS (SELECT video_id, len(g) AS n, unnest(g) AS x FROM s),
      p AS (SELECT a.video_id AS va, b.video_id AS vb, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
            FROM f a JOIN f b ON a.x = b.x AND a.video_id < b.video_id AND least(a.n, b.n) >= 0.6 * greatest(a.n, b.n) GROUP BY 1, 2),
      l AS (SELECT va, vb FROM p WHERE shared >= 0.6 * (na + nb - shared))"""

ORACLE = {
    # no class of exact copies in the test tables is as large as that from which p1_found shortens its pairs
    "p1_found": f"WITH {_shingles(50)}, {_PAIRS} SELECT va AS video_id_a, vb AS video_id_b FROM l",
    "p1_groups": f"""WITH RECURSIVE {_shingles(1)}, {_PAIRS},
      k AS (SELECT video_id, CASE WHEN len(g) > 0 THEN list_sort(g) WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
                ELSE [trim(regexp_replace(t, '{_SPACE}', ' ', 'g'))] END AS k FROM s),
      c AS (SELECT video_id, min(video_id) OVER (PARTITION BY k) AS class_id FROM k),
      m AS (SELECT DISTINCT a.class_id AS x, b.class_id AS y FROM (SELECT va, vb FROM l UNION SELECT vb, va FROM l) q
            JOIN c a ON a.video_id = q.va JOIN c b ON b.video_id = q.vb WHERE a.class_id <> b.class_id),
      r AS (SELECT class_id AS x, class_id AS y FROM c UNION SELECT r.x, m.y FROM r JOIN m ON m.x = r.y)
      SELECT c.video_id, c.class_id, coalesce(d.n, 0) AS n_links, g.group_id FROM c
      JOIN (SELECT x, min(y) AS group_id FROM r GROUP BY 1) g ON g.x = c.class_id
      LEFT JOIN (SELECT x, count(*) AS n FROM m GROUP BY 1) d ON d.x = c.class_id""",
    "p3_multiplicities": """
      WITH one AS (SELECT video_id, university, lang, license_risk, min(md5(transcript)) AS h FROM videos GROUP BY ALL)
      SELECT university, lang, license_risk, count(*) AS n_videos, count(DISTINCT h) AS n_texts FROM one GROUP BY ALL""",
}
