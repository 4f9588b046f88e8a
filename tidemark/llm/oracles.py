"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.licenses import TEMPLATES, THRESHOLD, template_bigrams
from tidemark.llm.rules import RULES, STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _quality_rules() -> str:
    bounds = [f"{name} >= {low}" for name, low, _ in RULES if low is not None] + [f"{name} <= {high}" for name, _, high in RULES if high is not None]
    stop = ", ".join(map(_quote, STOP_WORDS))
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w WHERE len(ws) >= 3),
named AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM windows),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM named) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls FROM w),
m AS (
  SELECT w.doc_id, len(ws) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks,
    len([x for x in ws if lower(x) IN ({stop})]) AS n_stop_words,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    len([x for x in ls if regexp_matches(rtrim(x), '(\\.\\.\\.|…)$')]) AS n_ellipsis_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_marks / n_words ELSE 0 END AS marks_per_word,
    CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN n_ellipsis_lines / n_lines ELSE 0 END AS ellipsis_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(bounds)} AS kept
FROM r"""


def _licenses() -> str:
    rows = []
    for name, pairs in template_bigrams(TEMPLATES):
        rows.append(f"({_quote(name)}, [{', '.join(map(_quote, pairs))}])")
    t = THRESHOLD
    return f"""
WITH templates(name, pairs) AS (VALUES {", ".join(rows)}),
n AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS t FROM documents),
parts AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS p FROM n
  UNION ALL
  SELECT doc_id, p FROM (
    SELECT doc_id, unnest(regexp_split_to_array(t, '\\n *\\n[ \\n]*')) AS p FROM n WHERE regexp_matches(t, '\\n *\\n')
  ) WHERE contains(rtrim(p), chr(10))),
words AS (SELECT doc_id, row_number() OVER () AS part, regexp_extract_all(p, '[^ \\n]+') AS ws FROM parts),
mine AS (
  SELECT doc_id, part, list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) AS ps
  FROM words WHERE len(ws) > 1),
scored AS (
  SELECT doc_id, part, name, len(list_intersect(ps, pairs)) * CAST(2.0 AS DOUBLE) / (len(ps) + len(pairs)) AS dice
  FROM mine JOIN templates ON len(pairs) * {t} <= {2 - t} * len(ps) AND len(ps) * {t} <= {2 - t} * len(pairs)),
best AS (
  SELECT doc_id, part, max(dice) AS dice, max_by(name, (dice, name)) AS name FROM scored GROUP BY doc_id, part HAVING max(dice) >= {t})
SELECT doc_id, b.name AS license, b.dice AS dice, coalesce(b.n, 0) AS n_passages
FROM documents LEFT JOIN (
  SELECT doc_id, max(dice) AS dice, max_by(name, (dice, name)) AS name, count(*) AS n FROM best GROUP BY doc_id) b USING (doc_id)"""


_LINES = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS no
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT doc_id, k, line AS a, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c FROM full_lines WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth FROM windows WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM ranked WHERE nth > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.k IS NULL) AS text,
    count(f.k) AS n_lines, count(g.k) AS n_removed
  FROM l LEFT JOIN full_lines f USING (doc_id, no) LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.k = f.k
  GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM kept"""

_PASSAGES = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
origin AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS o FROM windows),
starts AS (SELECT doc_id, i FROM origin WHERE o < doc_id),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(50)) AS i FROM starts),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) FILTER (WHERE g.i IS NULL) AS text, count(g.i) AS n_removed
  FROM places p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0 AND len([e for e in embedding if e <> 0]) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN links ON links.a = vec_id"""


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """Each round a pair of tables: who is nearest to what, and the centroids after it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, x, best.c AS cluster, best.d AS distance FROM (
    SELECT vec_id, x, min({{'d': d, 'c': c}}) AS best FROM (
      SELECT v.vec_id, v.x, cluster AS c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.x, c{i}.x)])::BIGINT AS d
      FROM v, c{i}) GROUP BY vec_id, x))""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x FROM (
      SELECT cluster, p, sum(e) AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, unnest(range(64)) AS p FROM a{i}) GROUP BY cluster, p)
    GROUP BY cluster) m USING (cluster))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, [CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT) for e in embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len([e for e in embedding if e IS NULL OR NOT isfinite(e)]) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY mark) - 1 AS INTEGER) AS cluster, x FROM (
    SELECT sha256('2:' || vec_id) AS mark, x FROM v ORDER BY mark LIMIT {k})),{",".join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


# The CRC-32 of a text, a byte at a time, from the table its polynomial gives.
_SPELLING = r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) for n in range(256)] AS crc),
runs AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT doc_id, run, n, [4294967295] || flatten([CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END
    for c in string_split(doc_id || ':' || run, '')]) AS bytes FROM runs),
marked AS (
  SELECT run, n, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM coded, tab),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM marked),
v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT word, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cut c JOIN v ON v.word = c.rest
  UNION SELECT v.word, c.word FROM cut c JOIN v ON v.word = c.rest),
best AS (
  SELECT near.word, count(*) AS n_near, min({'less': -o.n, 'word': near.other}) AS b FROM near JOIN v o ON o.word = near.other GROUP BY near.word),
judged AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * v.n THEN b.word END AS form, CASE WHEN -b.less >= 5 * v.n THEN -b.less END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
walk(word, root, steps) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT walk.word, j.form, steps + 1 FROM walk JOIN judged j ON j.word = walk.root WHERE j.form IS NOT NULL),
roots AS (SELECT word, max_by(root, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)"""


ORACLES = {
    "op1_embedding_near_dedup": _VECTORS,
    "op2_substring_dedup": _PASSAGES,
    "op4_quality_rules": _quality_rules(),
    "op8_license_scan": _licenses(),
    "op9_line_dedup": _LINES,
    "op11_centroid_clustering": _clusters(),
    "op13_spelling_variants": _SPELLING,
}
