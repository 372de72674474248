"""SQL for the queries of operators whose results it can state: all pairs, all shingles, plain digests."""

from __future__ import annotations

#: Components of links (a, b), both ways, over all nodes (id): the smallest id that links reach.
REACH = "reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY 1)"

OP2 = f"""WITH RECURSIVE sound AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) > 0 AND list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and') AND list_aggregate(list_transform(embedding, lambda x: x <> 0), 'bool_or')),
 links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95), nodes AS (SELECT vec_id AS id FROM embeddings), {REACH}
 SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept FROM embeddings v JOIN component c ON c.id = v.vec_id"""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
OP3 = f"""WITH RECURSIVE words AS (SELECT doc_id, {WORDS} AS w FROM documents),
 sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END AS s FROM words),
 shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
 shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2),
 links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * c >= 90 * (n - c)), nodes AS (SELECT doc_id AS id FROM documents), {REACH}
 SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN component ON id = doc_id"""

#: A turn is ``### role: text</turn>`` and a line end, with a backslash before each control character in role and text.
OP4 = r"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
 sums AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
 CAST(sum(14 + length(role) + length(role) - length(translate(role, '\#<:', '')) + length(text) + length(text) - length(translate(text, '\#<', ''))) AS BIGINT) AS formatted_chars FROM rows GROUP BY 1)
 SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM sums"""

OP6 = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages), f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM p)
 SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f"""

#: All phrases of 1 to 4 words with their counts, cuts by joins, and phrases inside longer ones.
OP11 = r"""WITH pieces AS (SELECT coalesce(CAST(lang AS VARCHAR), 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 split AS MATERIALIZED (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
 words AS (SELECT lang, piece, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w FROM split),
 ahead AS MATERIALIZED (SELECT lang, w, lead(w, 1) OVER (PARTITION BY piece ORDER BY i) AS w2, lead(w, 2) OVER (PARTITION BY piece ORDER BY i) AS w3, lead(w, 3) OVER (PARTITION BY piece ORDER BY i) AS w4 FROM words),
 grams AS (SELECT lang, 1 AS k, w AS phrase FROM ahead UNION ALL SELECT lang, 2, w || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM ahead WHERE w3 IS NOT NULL UNION ALL SELECT lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM ahead WHERE w4 IS NOT NULL),
 f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30), total AS (SELECT lang, count(*) AS n FROM ahead GROUP BY 1),
 candidates AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2),
 cuts AS (SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score FROM candidates c, range(1, 4) t(cut), f l, f r
  WHERE cut < c.k AND l.lang = c.lang AND r.lang = c.lang AND l.k = cut AND r.k = c.k - cut AND l.phrase = array_to_string(c.w[1:cut], ' ') AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
 best AS (SELECT lang, phrase, any_value(a) AS a, arg_min(l, struct_pack(s := score, c := cut)) AS l, arg_min(r, struct_pack(s := score, c := cut)) AS r, min(score) AS score FROM cuts GROUP BY 1, 2),
 longer AS (SELECT lang, part, max(a) AS a FROM (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS part FROM candidates, range(2, 4) t(m) WHERE m < k) GROUP BY 1, 2),
 kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.part = b.phrase WHERE g.a IS NULL OR CAST(100 AS HUGEINT) * g.a < CAST(80 AS HUGEINT) * b.a)
 SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang) QUALIFY rank <= 2000"""


def _op12(k: int = 16, rounds: int = 3, width: int = 64) -> str:
    """Lloyd's rounds as one CTE each: all distances, the nearest, floored means."""
    nearest = "SELECT vec_id, min(struct_pack(d := d, c := c)) AS best FROM (SELECT v.vec_id, m.c, list_sum(list_transform(range(1, {w}), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i]))) AS d FROM v, m{r} m) GROUP BY vec_id"
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = {width} AND list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and'))",
        f"m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < {k})",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED ({nearest.format(w=width + 1, r=r)})")
        if r < rounds:
            means = f"SELECT c, list(CASE WHEN s % n < 0 THEN (s - s % n - n) // n ELSE (s - s % n) // n END ORDER BY i) AS x FROM (SELECT best.c AS c, i, sum(v.x[i]) AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id), range(1, {width + 1}) t(i) GROUP BY 1, 2) GROUP BY c"
            parts.append(f"m{r + 1} AS MATERIALIZED (SELECT m{r}.c, coalesce(u.x, m{r}.x) AS x FROM m{r} LEFT JOIN ({means}) u USING (c))")
    return f"""WITH {', '.join(parts)} SELECT vec_id, CAST(best.c AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(m{rounds}.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN m{rounds} ON m{rounds}.c = best.c"""


OP12 = _op12()
