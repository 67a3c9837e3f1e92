"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import shard_tree

_OP6 = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT row_number() OVER () AS r, * FROM words),
wins AS (
  SELECT r, i, w[i:i+4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM lines)),
dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM wins) WHERE c > 1),
cover AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM dup, (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
         (n_lines
          - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))
         )::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM lines LEFT JOIN cover USING (r)),
b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
         (base_failed::INT + (word_chars < 2 * n_words OR word_chars > 10 * n_words)::INT
          + (100 * n_symbols > 10 * n_words)::INT + (100 * n_dup_lines > 30 * n_lines)::INT)::BIGINT AS n_rules_failed
  FROM m),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum((n_rules_failed > 0)::INT)::DOUBLE AS f FROM b
  WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT count(*) AS h, sum(n) AS n, sum(f) AS f, sum(f * f / n) AS rr FROM hosts),
prior AS (
  SELECT f / n AS p, (f / n) * (1 - f / n) AS noise,
         greatest(rr / n - (f / n) * (f / n), 0) - (f / n) * (1 - f / n) * h / n AS spread FROM sums),
strength AS (
  SELECT p, CASE WHEN spread > 0 THEN least(greatest(noise / spread - 1, 2), 1e6) ELSE 1e6 END AS s FROM prior),
rates AS (SELECT source, (f + p * s) / (n + s) AS host_rate FROM hosts, strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_rules_failed,
       (NOT base_failed AND coalesce(host_rate, 0) <= 0.5) AS kept
FROM b LEFT JOIN rates USING (source)
"""


def _uniform(name: str) -> str:
    return f"(('0x' || substr(md5(k || '/{name}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"


def _descend(node: shard_tree.Node) -> str:
    if not node.children:
        return str(node.shard)
    if len(node.children) == 1:
        return _descend(node.children[0])
    draws = [f"-ln({_uniform(c.name)}) / {c.weight}" for c in node.children]
    least = f"least({', '.join(draws)})"
    arms = " ".join(f"WHEN {d} = {least} THEN {_descend(c)}" for d, c in zip(draws, node.children))
    return f"(CASE {arms} END)"


_OP7 = f"""
WITH bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
base AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents),
rows AS (
  SELECT doc_id, k, (octet_length(encode(t)) + 1)::BIGINT AS size,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(t))),
             lambda i: ('0x' || substr(hex(encode(t)), 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM base, bits),
placed AS (
  SELECT doc_id, size, text_crc32, {_descend(shard_tree.tree(2, 2, 2))} AS shard,
         {_descend(shard_tree.grown(shard_tree.tree(2, 2, 2)))} AS grown_shard,
         {_uniform('slot')} AS o
  FROM rows)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY o, doc_id, size, text_crc32) - 1)::BIGINT AS slot,
       grown_shard::INT AS grown_shard
FROM placed
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP11 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS MATERIALIZED (
  SELECT r, i, l[i] AS line,
         translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT r, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
many AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n
  FROM lines WHERE k NOT IN (SELECT k FROM many) GROUP BY r)
SELECT doc_id, len(l)::BIGINT AS n_lines, (len(l) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _round(n: int) -> str:
    """Assignment number ``n`` and the centroids that follow from it."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT r, b.c, b.d FROM (
    SELECT r, min({{'d': list_sum(list_transform(list_zip(kept.v, c{n}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                    'c': c}}) AS b
    FROM kept, c{n} GROUP BY r)),
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.v, c{n}.v) AS v FROM c{n} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS n
      FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM kept JOIN a{n} USING (r)) GROUP BY c, i)
    GROUP BY c) AS m USING (c))"""


_OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT 16)),
{",".join(_round(n) for n in range(4))},
sums AS (SELECT c, sum(d) AS s FROM a3 GROUP BY c)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance, s::BIGINT AS cluster_inertia,
       (SELECT sum(s) FROM sums)::BIGINT AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM kept JOIN a3 USING (r) JOIN sums USING (c) JOIN c3 USING (c)
"""

_OP13 = f"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
runs AS (
  SELECT r, k, w, count(*) AS n FROM (
    SELECT r, k, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{_UPPER}', '{_LOWER}') AS w
    FROM (SELECT row_number() OVER () AS r, coalesce(doc_id::VARCHAR, '') AS k, text FROM documents))
  WHERE length(w) >= 6 GROUP BY r, k, w),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(k || ':' || w))),
             lambda i: ('0x' || substr(hex(encode(k || ':' || w)), 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, bits),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (
  SELECT word, n, i, left(word, i) || chr(1) || substr(word, i + 2) AS replaced, left(word, i) || substr(word, i + 2) AS less
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS longer, c.n AS longer_n, w.word, w.n FROM cuts c JOIN words w ON c.less = w.word),
near AS (
  SELECT a.word, b.word AS v, b.n FROM cuts a JOIN cuts b USING (replaced) WHERE a.word <> b.word
  UNION ALL SELECT longer, word, n FROM shorter
  UNION ALL SELECT word, longer, longer_n FROM shorter),
best AS (
  SELECT word, count(*) AS n_near, min({{'m': -n, 'v': v}}) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * n THEN b.v END AS form,
         CASE WHEN -b.m >= 5 * n THEN -b.m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS step FROM words
  UNION ALL
  SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) USING (word)
"""

SQL: dict[str, str] = {
    "op6_host_rules": _OP6,
    "op7_shard_tree": _OP7,
    "op11_line_index": _OP11,
    "op12_vp_clusters": _OP12,
    "op13_kd_words": _OP13,
}
