"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import license, recompress, suffix


def _license() -> str:
    phrases = " UNION ALL ".join(f"SELECT '{p}' AS phrase, '{label}' AS label" for p, label in license.PHRASES.items())
    notices = " UNION ALL ".join(f"SELECT '{n}' AS notice, '{label}' AS label" for n, label in license.NOTICES.items())
    num, den = license.NEED
    return f"""
WITH phrases AS (SELECT phrase, label, string_split(phrase, ' ') AS p FROM ({phrases})),
notices AS (SELECT label, list_distinct(string_split(notice, ' ')) AS t FROM ({notices})),
norm AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{license.UPPER}', '{license.LOWER}'), '{license.BETWEEN}', ' ', 'g'), ' ') AS s FROM documents),
words AS (SELECT doc_id, CASE WHEN s = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(s, ' ') END AS w FROM norm),
places AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i FROM words, phrases WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' ')) WHERE w[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list_sort(list_distinct(list(label))) AS base_labels FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, list_distinct(w[i + 1:i + {license.BLOCK}]) AS b FROM (SELECT doc_id, w, unnest(range(0, len(w), {license.STEP})) AS i FROM words)),
found AS (SELECT doc_id, label, len(list_intersect(b, t)) / len(t) AS containment FROM blocks, notices WHERE {den} * len(list_intersect(b, t)) >= {num} * len(t)),
own AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(containment) AS most FROM found GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(base_labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ','), '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(most, 0.0) END AS DOUBLE) AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)"""


#: Smallest node that links reach, by rounds that pass it on; ``links`` has both directions, ``nodes`` every node.
REACHED = """walk AS (SELECT id, id AS root FROM nodes UNION SELECT links.b AS id, walk.root FROM walk JOIN links ON links.a = walk.id WHERE walk.root < links.b),
least AS (SELECT id, min(root) AS component_id FROM walk GROUP BY id)"""


def _jaccard() -> str:
    """Shingles as lists of words; two documents meet by every shingle that both have."""
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{license.UPPER}', '{license.LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS o FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id <> y.doc_id AND x.n * 4 >= y.n * 3 AND y.n * 4 >= x.n * 3 GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * o >= 75 * (na + nb - o)),
nodes AS (SELECT doc_id AS id FROM documents),
{REACHED}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least ON id = doc_id"""


def _near_vectors() -> str:
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
usable AS MATERIALIZED (SELECT * FROM v WHERE x IS NOT NULL AND label IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM usable p JOIN usable q ON p.label = q.label AND len(p.x) = len(q.x) AND p.vec_id <> q.vec_id
  WHERE list_inner_product(p.x, q.x) / sqrt(list_inner_product(p.x, p.x)) / sqrt(list_inner_product(q.x, q.x)) >= 0.98),
nodes AS (SELECT vec_id AS id FROM v),
{REACHED}
SELECT v.vec_id, CAST((SELECT count(*) FROM links WHERE a = v.vec_id) AS BIGINT) AS n_links, component_id, component_id = v.vec_id AS kept FROM v JOIN least ON id = v.vec_id"""


def _repeats() -> str:
    """Every string of 100 bytes, in hexadecimal, with the place where it starts first; ranges are merged as islands."""
    n = suffix.LENGTH
    return f"""
WITH t AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS MATERIALIZED (SELECT doc_id, i, hash(substr(h, 2 * i + 1, {2 * n})) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {n - 1})) AS i FROM t WHERE length(h) >= {2 * n})),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM strings) WHERE r > 1),
heads AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {n} OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL THEN 1 ELSE 0 END AS head FROM gone),
islands AS (SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM heads),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {n} AS b FROM islands GROUP BY doc_id, island),
ends AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before, max(b) OVER (PARTITION BY doc_id) AS last FROM spans),
kept AS (SELECT t.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * any_value(last) + 1) AS h, sum(b - a) AS removed, count(*) AS spans FROM ends JOIN t USING (doc_id) GROUP BY t.doc_id)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""


def _fill_in_middle() -> str:
    number = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
seeds AS (SELECT *, {number(0)} % (n + 1) AS x, {number(1)} % (n + 1) AS y,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {number(2)} % 100 >= 90 THEN 'plain' WHEN {number(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
cuts AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b FROM seeds),
parts AS (SELECT *, '<P>' || substr(text, 1, a) AS p, '<S>' || substr(text, b + 1) AS s, '<M>' || substr(text, a + 1, b - a) AS m FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts"""


def _repeated_windows() -> str:
    """Every window of words as one string, with the place where it starts first; ranges are merged as islands."""
    n = recompress.WINDOW
    return f"""
WITH t AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (SELECT doc_id, i, hash(array_to_string(w[i + 1:i + {n}], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(0, len(w) - {n - 1})) AS i FROM t WHERE len(w) >= {n})),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
heads AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {n} OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL THEN 1 ELSE 0 END AS head FROM gone),
islands AS (SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM heads),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {n} AS b FROM islands GROUP BY doc_id, island),
ends AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before, max(b) OVER (PARTITION BY doc_id) AS last FROM spans),
kept AS (SELECT t.doc_id, list_concat(flatten(list(w[before + 1:a] ORDER BY a)), any_value(w)[any_value(last) + 1:]) AS w, sum(b - a) AS removed, count(*) AS spans FROM ends JOIN t USING (doc_id) GROUP BY t.doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(array_to_string(coalesce(kept.w, t.w), ' ')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op6_jaccard_join": _jaccard(), "op8_suffix_dedup": _repeats(), "op9_embedding_near_dedup": _near_vectors(), "op10_license_scan": _license(), "op12_recompression_dedup": _repeated_windows(), "op13_fill_in_middle": _fill_in_middle()}
