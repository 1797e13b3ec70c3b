"""Independent SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op3_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, hot.top IS NOT NULL AND hot.top <> k.doc_id AS gone FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ORACLE["op8_url_filters"] = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
r(verdict, domain, prefix) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                      ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (SELECT page_id, domain || prefix AS rule, verdict,
             row_number() OVER (PARTITION BY page_id ORDER BY length(domain || prefix) DESC) AS n
      FROM h JOIN r ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix))
SELECT h.page_id, host, path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(host, '(^|\.)(adult-x|spam-farm|cheap-pills|ads-track|casino-win|free-bets)\.')
                                  OR regexp_matches(host, '(^|\.)(adult-x|spam-farm|cheap-pills|ads-track|casino-win|free-bets)$')
                                  OR (host <> '' AND md5(host || path)[1:1] = '0')
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN f ON f.page_id = h.page_id AND f.n = 1
"""

ORACLE["op2_decontaminate"] = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(len(w), 5) AS width,
             unnest([array_to_string(w[k : k + least(len(w), 5) - 1], ' ') FOR k IN range(1, len(w) - least(len(w), 5) + 2)]) AS shingle
      FROM i WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
v AS (SELECT DISTINCT width FROM s),
t AS (SELECT DISTINCT doc_id, width,
             unnest([array_to_string(w[k : k + width - 1], ' ') FOR k IN range(1, len(w) - width + 2)]) AS shingle
      FROM d, v WHERE len(w) >= width)
SELECT doc_id, item_id, count(*) / max(n_shingles) AS containment, max(n_shingles) AS n_shingles
FROM t JOIN s USING (width, shingle) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) / max(n_shingles) >= 0.8
"""

ORACLE["op9_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS win,
             unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM
        (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g JOIN
            (SELECT doc_id, win FROM g GROUP BY doc_id, win HAVING count(*) > 1) USING (doc_id, win)) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, len(string_split(t, chr(10))) AS n_lines,
             len(list_filter(w, lambda x: ends_with(x, '!'))) AS n_loud
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
            OR 100 * n_loud > 30 * n_words OR (n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)) AS kept
FROM b
"""


def _lloyd(k: int = 40, dims: int = 64, rounds: int = 5) -> str:
    """Whole vectors and centroids as one row per component; a round is two CTEs."""
    nearest = """
a{r} AS MATERIALIZED (SELECT row_id, min(distance) AS distance, arg_min(c, (distance, c)) AS c FROM
    (SELECT row_id, c, sum((v.x - m.x) * (v.x - m.x)) AS distance FROM v JOIN c{r} m USING (i) GROUP BY row_id, c) GROUP BY row_id)"""
    means = """
c{n} AS MATERIALIZED (SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM c{r} m LEFT JOIN
    (SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM a{r} JOIN v USING (row_id) GROUP BY c, i) s
    ON s.c = m.c AND s.i = m.i)"""
    steps = [
        f"""e AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        """
v AS MATERIALIZED (SELECT row_id, generate_subscripts(embedding, 1) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM e)""",
        f"""
t AS MATERIALIZED (SELECT row_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM e WHERE vec_id IS NOT NULL
    QUALIFY c < {k})""",
        """
c0 AS MATERIALIZED (SELECT c, i, x FROM t JOIN v USING (row_id))""",
    ]
    for r in range(rounds):
        steps += [nearest.format(r=r), means.format(r=r, n=r + 1)]
    steps.append(nearest.format(r=rounds))
    steps.append(f"""
h AS (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)""")
    return f"""
WITH {','.join(steps)}
SELECT vec_id, c::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN e USING (row_id) JOIN h USING (c)
"""


ORACLE["op12_centroids"] = _lloyd()

ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s,
                  regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || s[1:8])::UBIGINT AS h1, ('0x' || s[9:16])::UBIGINT AS h2,
             ('0x' || s[17:24])::UBIGINT AS h3, ('0x' || s[25:32])::UBIGINT AS h4 FROM d),
b AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM h),
p AS (SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:], '') AS suffix,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM b)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
