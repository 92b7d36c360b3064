"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_COMPONENTS = """
walk(node, reach) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT w.node, l.b FROM walk w JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l(a, b) ON l.a = w.reach
),
comp AS (SELECT node, min(reach) AS component_id FROM walk GROUP BY node)
"""

OP1 = rf"""
WITH RECURSIVE toks AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: list_aggregate(w[i:i+2], 'string_agg', ' '))
                               WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s
    FROM toks)
),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b WHERE 100 * c >= 85 * (sa.n + sb.n - c)),
nodes AS (SELECT doc_id AS node FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c ON c.node = d.doc_id LEFT JOIN size s USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE vecs AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vecs x JOIN vecs y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_COMPONENTS},
n AS (SELECT v, count(*) AS n FROM (SELECT a AS v FROM links UNION ALL SELECT b FROM links) GROUP BY v)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.node = e.vec_id LEFT JOIN n ON n.v = e.vec_id
"""

OP8 = """
WITH l AS (
  SELECT doc_id, i - 1 AS pos, ls[i] AS x, ls[i + 1] AS y, ls[i + 2] AS z, len(ls) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), unnest(range(1, len(ls) + 1)) u(i)
),
w AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS turn FROM l WHERE pos + 2 < n
),
gone AS (SELECT DISTINCT doc_id, pos + j AS pos FROM w, unnest([0, 1, 2]) v(j) WHERE turn > 1),
per AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
    coalesce(string_agg(l.x, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, md5(coalesce(kept, '')) AS kept_md5
FROM documents d LEFT JOIN per USING (doc_id)
"""

# Trust and distrust as sums over the walks from the seeds: each walk carries its seed's mass times the shares and the damping.
def _url_sql() -> str:
    from coursematch.llm.linkgraph import DAMPING, LINK, ROUNDS
    from coursematch.llm.queries import URL_RULES

    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    link = LINK.replace("'", "''")
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES {rules}),
split AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages)
),
judged AS (
  SELECT s.page_id, s.host, s.path, s.html, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM (SELECT *, row_number() OVER () AS i FROM split) s
  LEFT JOIN rules ON (s.host = rh OR ends_with(s.host, '.' || rh)) AND starts_with(s.path, rp)
  GROUP BY s.i, s.page_id, s.host, s.path, s.html
),
hosts AS (SELECT host, avg((rv IS NOT DISTINCT FROM 'allow')::INT) AS allow, avg((rv IS NOT DISTINCT FROM 'block')::INT) AS block FROM judged WHERE host <> '' GROUP BY host),
links AS (
  SELECT src, dst, count(*) AS n FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst FROM judged)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
),
edges AS (
  SELECT 't' AS kind, src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS share FROM links
  UNION ALL SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links
),
walks(kind, host, mass, step) AS (
  SELECT 't', host, allow::DOUBLE, 0 FROM hosts WHERE allow > 0 UNION ALL SELECT 'd', host, block::DOUBLE, 0 FROM hosts WHERE block > 0
  UNION ALL
  SELECT w.kind, e.b, w.mass * e.share * {DAMPING}, w.step + 1 FROM walks w JOIN edges e ON e.kind = w.kind AND e.a = w.host WHERE w.step < {ROUNDS}
),
ranks AS (SELECT host, round(sum(CASE kind WHEN 't' THEN mass ELSE 0 END), 6) AS trust, round(sum(CASE kind WHEN 'd' THEN mass ELSE 0 END), 6) AS distrust FROM walks GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(rv, CASE WHEN distrust >= 0.5 AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN ranks r ON r.host = j.host
"""


OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
  FROM documents
),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM lists GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, unnest([1, 2, 3, 4, 5]) u(k))),
freq AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(ws[1:c], ' ') AS lp, array_to_string(ws[c + 1:], ' ') AS rp
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM freq WHERE k > 1)
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, l.f AS l, r.f AS r, n, (1000 * a * n) // (l.f * r.f) AS score
  FROM cuts JOIN freq l ON l.lang = cuts.lang AND l.phrase = lp JOIN freq r ON r.lang = cuts.lang AND r.phrase = rp JOIN total ON total.lang = cuts.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_phrases AS (
  SELECT lang, f, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, f, ws, k, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, f, k, string_split(phrase, ' ') AS ws, unnest(range(2, k)) AS m FROM freq WHERE k > 2))
),
absorbed AS (SELECT DISTINCT c.lang, c.phrase FROM freq c JOIN inner_phrases p ON p.lang = c.lang AND p.phrase = c.phrase WHERE 100 * p.f >= 100 * c.f),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN absorbed USING (lang, phrase)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

ORACLE = {"op1_minhash": OP1, "op3_hyperplane": OP3, "op8_line_windows": OP8, "op11_link_graph": _url_sql(), "op12_collocations": OP12}
