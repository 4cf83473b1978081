"""DuckDB SQL of the operators that SQL expresses."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM d),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(list_slice(ws, p, p + 19), ' ') ORDER BY doc_id, p) AS rn FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM ranked WHERE rn > 1),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT word.doc_id, string_agg(w, ' ' ORDER BY word.i) AS t FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM d),
again AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, list_slice(ws, p, p + 2)) AS n FROM win),
covered AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS i FROM again WHERE n > 1) GROUP BY 1),
text_lines AS (SELECT DISTINCT source, text, list_filter(list_transform(string_split(text, chr(10)),
    lambda x: trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')),
    lambda x: x <> '') AS ls FROM d),
hosts AS (SELECT source, count(*) AS docs FROM text_lines GROUP BY 1),
seen AS (SELECT source, line, count(*) AS n FROM (SELECT source, unnest(list_distinct(ls)) AS line FROM text_lines) GROUP BY 1, 2),
frequent AS (SELECT seen.source, line FROM seen JOIN hosts ON seen.source IS NOT DISTINCT FROM hosts.source WHERE n > 10 AND n > 0.005 * docs),
removed AS (SELECT t.source, t.text, sum(len(string_split(t.line, ' '))) AS n FROM (SELECT source, text, unnest(ls) AS line FROM text_lines) t
    JOIN frequent f ON t.source IS NOT DISTINCT FROM f.source AND t.line = f.line GROUP BY 1, 2),
base AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
       - len(list_distinct(list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN removed ON removed.source IS NOT DISTINCT FROM d.source AND removed.text = d.text)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_removed_words * 2 <= n_words AS kept FROM base
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (SELECT k, p, md5(array_slice(b, p, p + 399)) AS h FROM (SELECT k, b, unnest(range(1, octet_length(b) - 398)) AS p FROM d)),
again AS (SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
edge AS (SELECT k, p, CASE WHEN p <= lag(p) OVER (PARTITION BY k ORDER BY p) + 400 THEN 0 ELSE 1 END AS new FROM again),
run AS (SELECT k, min(p) AS lo, max(p) + 399 AS hi FROM (SELECT k, p, sum(new) OVER (PARTITION BY k ORDER BY p) AS g FROM edge) GROUP BY k, g),
gap AS (SELECT k, coalesce(lag(hi) OVER (PARTITION BY k ORDER BY lo), 0) + 1 AS a, lo - 1 AS z FROM run
        UNION ALL SELECT d.k, coalesce(r.hi, 0) + 1, octet_length(b) FROM d LEFT JOIN (SELECT k, max(hi) AS hi FROM run GROUP BY k) r ON r.k = d.k),
kept AS (SELECT gap.k, string_agg(hex(array_slice(b, a, z)), '' ORDER BY a) AS x FROM gap JOIN d ON d.k = gap.k WHERE a <= z GROUP BY gap.k),
lost AS (SELECT k, sum(hi - lo + 1) AS n, count(*) AS spans FROM run GROUP BY k)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(x, ''))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.k = d.k LEFT JOIN lost ON lost.k = d.k
"""

DECONTAMINATION = r"""
WITH words AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, * EXCLUDE text FROM documents),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM words),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
term AS (SELECT DISTINCT item, size, md5(array_to_string(list_slice(ws, p, p + size - 1), ' ')) AS h
         FROM (SELECT item, ws, least(len(ws), 13) AS size, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS p FROM b WHERE len(ws) > 0)),
win AS (SELECT k, p, size, md5(array_to_string(list_slice(ws, p, p + size - 1), ' ')) AS h
        FROM (SELECT k, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT size FROM term))),
hit AS (SELECT k, p, win.size, item FROM win JOIN term ON term.h = win.h AND term.size = win.size),
covered AS (SELECT k, count(DISTINCT i) AS n FROM (SELECT k, unnest(range(p, p + size)) AS i FROM hit) GROUP BY k),
found AS (SELECT k, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit WHERE item IS NOT NULL GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(found.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered ON covered.k = d.k LEFT JOIN found ON found.k = d.k
"""


def _centroids() -> str:
    """Three rounds with 16 centroids over ``floor(64 * x)``."""
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = f"""SELECT i, vec_id, v, cluster, distance FROM (SELECT v.i, v.vec_id, v.v, c.c AS cluster, {distance} AS distance,
        row_number() OVER (PARTITION BY v.i ORDER BY {distance}, c.c) AS k FROM kept v CROSS JOIN %s c) WHERE k = 1"""
    steps = [r"""kept AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             "c0 AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept) WHERE c < 16)"]
    for r in range(3):
        steps += [f"a{r} AS MATERIALIZED ({near % f'c{r}'})",
                  f"m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY p) AS v FROM (SELECT cluster, p, sum(x) AS s, count(*) AS n "
                  f"FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS p FROM a{r}) GROUP BY 1, 2) GROUP BY 1)",
                  f"c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.c)"]
    return "WITH " + ",\n".join([*steps, f"a3 AS MATERIALIZED ({near % 'c3'})"]) + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256 FROM a3 JOIN c3 ON c3.c = cluster
"""


CENTROIDS = _centroids()


def _climb(name: str, levels: int) -> list[str]:
    """The levels of the trees in ``name``\0 (tree, pos, n, digest), and the walk of ``name``\0_walk (key, tree, pos, n, proof, folded) up to their tops."""
    steps = []
    side = "coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN {}), '')"
    for k in range(levels):
        steps += [f"{name}{k}_sides AS (SELECT tree, pos, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, {side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {name}{k})",
                  f"{name}{k + 1}_walk AS (SELECT key, w.tree, w.pos // 8 AS pos, (n + 7) // 8 AS n, proof || l || r AS proof, "
                  f"CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded FROM {name}{k}_walk w JOIN {name}{k}_sides s ON s.tree = w.tree AND s.pos = w.pos)",
                  f"{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest "
                  f"FROM {name}{k} GROUP BY tree, pos // 8, n)"]
    return steps


def _merkle(levels: int = 8, high: int = 4) -> str:
    """Trees of up to 8 ** ``levels`` documents a language, 8 ** ``high`` languages."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    leaf = lambda text: "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR _ IN range(8)]), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))))")
    steps = [f"""docs AS MATERIALIZED (SELECT row_number() OVER () AS key, doc_id, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} END AS forged,
        dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, lang FROM documents)""",
             "low0_docs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM docs)",
             "low0 AS (SELECT tree, pos, n, leaf AS digest FROM low0_docs)",
             "low0_walk AS (SELECT key, tree, pos, n, '' AS proof, coalesce(forged, leaf) AS folded FROM low0_docs)", *_climb("low", levels),
             f"high0 AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, digest FROM low{levels})",
             f"high0_walk AS (SELECT key, 0 AS tree, w.tree AS pos, (SELECT count(*) FROM low{levels}) AS n, proof, folded FROM low{levels}_walk w)", *_climb("high", high)]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM docs d JOIN low{levels} s ON s.tree = d.tree JOIN high{high}_walk w ON w.key = d.key CROSS JOIN high{high} r
"""


MERKLE = _merkle()
