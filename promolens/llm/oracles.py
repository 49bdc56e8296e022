"""DuckDB SQL of the corpus queries that SQL can state.

Plain restatements of the contracts: windows and shingles are spelled out as
strings, similar pairs come from shared shingles or from all pairs, and
components from the closure of the links.
"""

from __future__ import annotations

_REACH = """
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
component AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a)"""


def repeated_windows(size: int = 35) -> str:
    return f"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
spot AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM split WHERE len(ws) >= {size}),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS seq FROM spot),
again AS (SELECT doc_id, i FROM win WHERE seq IN (SELECT seq FROM win GROUP BY seq HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + {size})) AS p FROM again) GROUP BY doc_id),
word AS (
  SELECT s.doc_id, unnest(s.ws) AS w, unnest(range(1, len(s.ws) + 1)) AS p FROM split s
),
kept AS (
  SELECT word.doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word LEFT JOIN gone USING (doc_id) WHERE ps IS NULL OR NOT list_contains(ps, p) GROUP BY word.doc_id
)
SELECT s.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words, CAST(len(s.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)"""


def jaccard_classes(size: int, num: int, den: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {size - 2}))) AS i FROM split WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingle x JOIN shingle y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE {den} * shared >= {num} * (na.n + nb.n - shared)
),{_REACH}
SELECT s.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id
FROM split s LEFT JOIN n USING (doc_id) LEFT JOIN component c ON c.a = s.doc_id"""


def near_vectors(least: float) -> str:
    return f"""
WITH RECURSIVE unit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= {least}
),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),{_REACH}
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, coalesce(c.root, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN component c ON c.a = e.vec_id"""


# CRC-32 of a list of bytes, a table step a byte
_CRC = """
bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), list_transform(range(8), lambda j: CAST(0 AS BIGINT))),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
)"""


def _crc(octets: str) -> str:
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
            "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)")


def _octets(text: str) -> str:
    """UTF-8 bytes of a text below code point 2048."""
    return (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] "
            "ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END))")


def merkle_proofs() -> str:
    def field(v: str) -> str:
        return f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || {v}, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""
{name} AS (
  SELECT g, 0 AS lv, i, h, n FROM {leaves}
  UNION ALL
  SELECT g, lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM {name} WHERE n > 1 GROUP BY g, lv, i // 2
)"""

    def way(name: str, leaves: str) -> str:
        return f"""
  SELECT l.g, l.i, list(CASE WHEN s.h IS NULL THEN 'N' WHEN s.i > c.i THEN 'R' || s.h ELSE 'L' || s.h END ORDER BY c.lv)
    FILTER (WHERE c.n > 1) AS steps
  FROM {leaves} l JOIN {name} c ON c.g = l.g AND c.i = l.i >> c.lv LEFT JOIN {name} s ON s.g = c.g AND s.lv = c.lv AND s.i = xor(c.i, 1)
  GROUP BY l.g, l.i"""

    return f"""
WITH RECURSIVE{_CRC},
digest AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS g, {leaf('n_chars')} AS leaf,
    CASE WHEN {_crc(_octets('CAST(doc_id AS VARCHAR)'))} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS raised
  FROM documents, bits
),
low AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM digest
),{tree('node', 'low')},
sub AS (SELECT g AS of_g, '+' AS g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),{tree('top', 'sub')},
below AS ({way('node', 'low')}
), above AS ({way('top', 'sub')}
),
whole AS (
  SELECT low.doc_id, leaf, raised, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
    list_concat(coalesce(below.steps, []), coalesce(above.steps, [])) AS steps
  FROM low JOIN below USING (g, i) JOIN sub ON sub.of_g = low.g JOIN above ON above.i = sub.i
),
folded AS (
  SELECT *, list_reduce(list_prepend(coalesce(raised, leaf), steps), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
  FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM folded"""


def spelling_variants() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE{_CRC},
run AS (
  SELECT doc_id, w, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[a-z\u00C0-\u00FF]+')) AS w FROM documents) GROUP BY doc_id, w
),
summed AS (SELECT w, k, {_crc(_octets("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w"))} AS h FROM run, bits WHERE length(w) >= 7),
word AS (
  SELECT w, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS w, k FROM summed)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(k) >= 2
),
spot AS (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word),
gap AS (SELECT w, n, i, w[1:i - 1] || '*' || w[i + 1:] AS held, w[1:i - 1] || w[i + 1:] AS cut FROM spot),
near AS (
  SELECT x.w AS a, y.w AS b, y.n AS m FROM gap x JOIN gap y ON x.held = y.held AND x.i = y.i AND x.w <> y.w
  UNION SELECT g.w, v.w, v.n FROM gap g JOIN word v ON v.w = g.cut
  UNION SELECT v.w, g.w, g.n FROM gap g JOIN word v ON v.w = g.cut
),
best AS (SELECT a, count(*) AS n_near, max(m) AS m FROM near GROUP BY a),
form AS (
  SELECT best.a, min(near.b) AS form, any_value(near.m) AS m FROM best JOIN near ON near.a = best.a AND near.m = best.m JOIN word ON word.w = best.a
  WHERE best.m >= 10 * word.n GROUP BY best.a
),
path AS (
  SELECT a AS w, form AS root FROM form
  UNION SELECT path.w, form.form FROM path JOIN form ON form.a = path.root
),
ends AS (SELECT w, root FROM path WHERE root NOT IN (SELECT a FROM form))
SELECT word.w AS word, form.form, coalesce(ends.root, word.w) AS root, word.n, CAST(coalesce(best.n_near, 0) AS BIGINT) AS n_near, form.m AS form_n
FROM word LEFT JOIN best ON best.a = word.w LEFT JOIN form ON form.a = word.w LEFT JOIN ends ON ends.w = word.w"""


ORACLES = {
    "op3_pq_near_duplicates": near_vectors(0.93),
    "op6_repeated_windows": repeated_windows(35),
    "op10_jaccard_join": jaccard_classes(4, 85, 100),
    "op11_merkle_manifest": merkle_proofs(),
    "op12_spelling_variants": spelling_variants(),
}
