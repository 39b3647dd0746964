"""SQL that gives the rows of some registered queries."""

from __future__ import annotations

from ordstrata.llm.mixing import FILLERS

# The checksum works on bits: the byte goes in at the first of its eight steps.
MANIFEST_SQL = r"""
WITH RECURSIVE bits AS (SELECT doc_id, flatten(list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
    lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS b
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
sums AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295) AS crc FROM bits),
said AS (SELECT documents.*, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS found
  FROM documents LEFT JOIN sums USING (doc_id)),
parts AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') ||
    coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS own,
    coalesce(strlen(found::VARCHAR) || ':' || found, '-') AS met,
    coalesce(strlen(text) || ':' || text, '-') AS z FROM said),
hashed AS (SELECT doc_id, tree, sha256(a || own || z) AS leaf, sha256(a || met || z) AS given FROM parts),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)
    - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
built AS (SELECT tree, 0 AS level, pos, leaf AS h, n FROM leaves UNION ALL
  SELECT tree, level + 1, pos // 2, string_agg(h, '' ORDER BY pos).sha256(), any_value((n + 1) // 2)
  FROM built WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS MATERIALIZED (SELECT tree, level, h, row_number() OVER (ORDER BY tree) - 1 AS pos,
    count(*) OVER () AS n FROM built WHERE n = 1),
above AS (SELECT 0 AS level, pos, h, n FROM subroots UNION ALL
  SELECT level + 1, pos // 2, string_agg(h, '' ORDER BY pos).sha256(), any_value((n + 1) // 2)
  FROM above WHERE n > 1 GROUP BY level, pos // 2),
nodes AS MATERIALIZED (SELECT tree, level, pos, h, n FROM built WHERE n > 1 UNION ALL
  SELECT '', level, pos, h, n FROM above),
climb AS (SELECT doc_id, l.tree AS home, leaf, given AS folded, '' AS proof,
    CASE WHEN l.n = 1 THEN '' ELSE l.tree END AS tree, 0 AS level,
    CASE WHEN l.n = 1 THEN r.pos ELSE l.pos END AS pos, CASE WHEN l.n = 1 THEN r.n ELSE l.n END AS n
  FROM leaves l JOIN subroots r ON r.tree = l.tree
  UNION ALL
  SELECT doc_id, home, leaf,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || folded ELSE folded || coalesce(s.h, '') END),
    proof || coalesce(s.h, ''),
    CASE WHEN c.n <= 2 AND c.tree <> '' THEN '' ELSE c.tree END,
    CASE WHEN c.n <= 2 AND c.tree <> '' THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n <= 2 AND c.tree <> '' THEN r.pos ELSE c.pos // 2 END,
    CASE WHEN c.n <= 2 AND c.tree <> '' THEN r.n ELSE (c.n + 1) // 2 END
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
  JOIN subroots r ON r.tree = c.home WHERE c.n > 1)
SELECT doc_id, leaf, r.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = root AS verified
FROM climb JOIN subroots r ON r.tree = home, (SELECT h AS root FROM above WHERE n = 1)
WHERE climb.tree = '' AND climb.n = 1"""

# Water-filling by sorted sources, prefix sums in the seeded order, and the fillers one by one. A
# document is in one source, so the cheapest flow is what the source holds, once and then again.
def _mix_sql(fillers: int) -> str:
    steps, picked = [], []
    for k in range(1, fillers + 1):
        most = "gap" if k < fillers else "2 * gap - 1"
        others = "".join(f" AND rid NOT IN (SELECT rid FROM pick{j})" for j in range(1, k))
        steps.append(
            f"pick{k} AS MATERIALIZED (SELECT DISTINCT ON (g) g, rid, gap - size AS gap"
            f" FROM placed JOIN gap{k - 1} USING (g) WHERE size BETWEEN 1 AND {most} AND NOT below{others}"
            f" ORDER BY g, abs(gap - size), size, key),\n"
            f"gap{k} AS MATERIALIZED (SELECT g, gap FROM pick{k} UNION ALL"
            f" SELECT g, gap FROM gap{k - 1} WHERE g NOT IN (SELECT g FROM pick{k})),\n"
        )
        picked.append(f"SELECT rid FROM pick{k}")
    return rf"""
WITH sized AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '-') AS g, source IS NULL AS none, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
keyed AS MATERIALIZED (SELECT doc_id, g, size, row_number() OVER () AS rid,
    substr(md5('mix:' || coalesce(doc_id::VARCHAR, '-') || ':' || size), 1, 15) AS key FROM sized),
groups AS (SELECT g, CAST(sum(size) AS BIGINT) AS total,
    [3, 1, 2][((row_number() OVER (ORDER BY none, source) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY g, none, source),
filled AS (SELECT *, CAST(sum(total) OVER () AS BIGINT) AS t, CAST(sum(w) OVER () AS BIGINT) AS all_w,
    CAST(sum(total) OVER p AS BIGINT) - total AS s_before, CAST(sum(w) OVER p AS BIGINT) - w AS w_before
  FROM groups WINDOW p AS (ORDER BY total * (6 // w), g ROWS UNBOUNDED PRECEDING)),
stopped AS (SELECT *, (3 * t - 4 * s_before) * w > 4 * total * (all_w - w_before) AS stop FROM filled),
rest AS (SELECT coalesce(CAST(sum(total) FILTER (stop) AS BIGINT), 0) AS s,
    coalesce(CAST(sum(w) FILTER (stop) AS BIGINT), 0) AS sw FROM stopped),
aims AS (SELECT g, total, CASE WHEN stop THEN 2 * total ELSE w * (3 * t - 4 * s) END AS above,
    CASE WHEN stop THEN 1 ELSE 2 * (all_w - sw) END AS below FROM stopped, rest),
goals AS MATERIALIZED (SELECT g, total, CAST(above AS DOUBLE) / CAST(below AS DOUBLE) AS target,
    CASE WHEN total > 0 THEN least(above // below, 2 * total) // total ELSE 0 END AS whole,
    CASE WHEN total > 0 THEN least(above // below, 2 * total) % total ELSE 0 END AS part FROM aims),
placed AS MATERIALIZED (SELECT keyed.*, total, target, whole, part,
    part > 0 AND sum(size) OVER (PARTITION BY g ORDER BY key, rid) <= part AS below
  FROM keyed JOIN goals USING (g)),
gap0 AS MATERIALIZED (SELECT g, CAST(any_value(part) - coalesce(sum(size) FILTER (below), 0) AS BIGINT) AS gap
  FROM placed GROUP BY g),
{"".join(steps)}picked AS ({" UNION ALL ".join(picked)})
SELECT doc_id, size, total AS source_size, target,
  CAST(size * (whole + CASE WHEN below OR rid IN (FROM picked) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed"""


MIX_SQL = _mix_sql(FILLERS)


# A phrase's count is at least that of any longer one, so 100 f(longer) >= 100 a means equal counts.
COLLOCATIONS_SQL = r"""
WITH pieces AS (SELECT row_number() OVER () AS piece, * FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
said AS MATERIALIZED (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(
    range(1, len(w) - k + 2), lambda i: {'k': k, 'p': array_to_string(w[i:i + k - 1], ' ')})))) AS g FROM said),
counts AS MATERIALIZED (SELECT lang, g.k AS k, g.p AS phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM said GROUP BY lang),
found AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND a >= 100),
kept AS (SELECT * FROM found c WHERE NOT EXISTS (SELECT 1 FROM found m WHERE m.lang = c.lang AND m.a = c.a
    AND m.k > c.k AND contains(' ' || m.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS i FROM kept),
scored AS (SELECT c.lang, c.phrase, c.a, c.i, x.a AS l, y.a AS r, n,
    (1000 * c.a::HUGEINT * n::HUGEINT // (x.a::HUGEINT * y.a::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.i], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:c.k], ' ')),
least_cut AS (SELECT DISTINCT ON (lang, phrase) * FROM scored ORDER BY lang, phrase, score, i),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least_cut)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""
