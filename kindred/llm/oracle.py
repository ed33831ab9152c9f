"""The same results in plain SQL over the same tables, where SQL can express them."""

from __future__ import annotations

from kindred.llm import jaccard, lloyd, rules, substring, topk, trie, urls

UPPER, LOWER = urls.UPPER, urls.LOWER
WORD = r"[^\x20\x09-\x0D]+"

_WORDS = f"SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents"

OP2 = f"""
WITH docs AS ({_WORDS}),
starts AS (
  SELECT row_id, i, md5(array_to_string(w[i : i + {substring.WINDOW - 1}], ' ')) AS h
  FROM (SELECT row_id, w, unnest(range(1, len(w) - {substring.WINDOW - 2})) AS i FROM docs)),
again AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT row_id, unnest(range(i, i + {substring.WINDOW})) AS p
  FROM starts WHERE h IN (SELECT h FROM again)),
words AS (SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (
  SELECT row_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (row_id, p) GROUP BY row_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)"""

_PHRASES = " OR ".join(f"contains(low, '{p}')" for p in rules.PHRASES)
_CLOSING = rules.CLOSING.replace("'", "''")


def _marks(column: str, kind: str) -> str:
    return f"len(regexp_replace({column}, '[^{kind}]', '', 'g'))"


OP6 = f"""
WITH docs AS ({_WORDS}),
cut AS (SELECT row_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
lines AS (
  SELECT row_id, line, len(regexp_extract_all(line, '{WORD}')) AS n, regexp_extract_all(line, '{WORD}')[-1] AS last,
         translate(line, '{UPPER}', '{LOWER}') AS low,
         row_number() OVER (PARTITION BY row_id, line ORDER BY pos) > 1 AS again
  FROM cut),
judged AS (
  SELECT row_id, n, again AND n > 0 AS dup,
         n > 0 AND (again OR 2 * {_marks("line", "#*$%&|<>")} > n
           OR (2 * {_marks("line", "!")} > n AND {_marks("line", "A-Z")} > {_marks("line", "a-z")})
           OR ({_marks("line", "|")} >= 2 AND 4 * {_marks("line", "|")} >= n)
           OR (n >= 3 AND NOT contains('{_CLOSING}', last[-1]))
           OR (n <= 30 AND ({_PHRASES}))) AS fails
  FROM lines),
per_doc AS (
  SELECT row_id, count(*) FILTER (dup) AS n_dup_lines, coalesce(sum(n) FILTER (fails), 0)::BIGINT AS n_lost FROM judged GROUP BY row_id),
grams AS (
  SELECT row_id, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
twice AS (SELECT row_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
again AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, unnest(range(i, i + 5)) AS p FROM grams JOIN twice USING (row_id, g)) GROUP BY row_id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         {_marks("text", "#*$%&|<>")}::BIGINT AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lost
  FROM docs JOIN per_doc USING (row_id) LEFT JOIN again USING (row_id)),
failed AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND 100 * n_lost <= {rules.MAX_LOST} * n_words AS kept FROM failed"""

OP7 = f"""
WITH valid AS (
  SELECT vec_id, row_number() OVER () AS row_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row_id, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM valid q JOIN valid c ON q.row_id <> c.row_id
  WHERE q.vec_id % {topk.EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {topk.K}"""

OP4 = f"""
WITH RECURSIVE docs AS ({_WORDS}),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + {jaccard.WORDS - 1}], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard.WORDS - 2}, least(len(w), 1) + 1))) AS i FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE k >= {jaccard.THRESHOLD}::DOUBLE * (p.n + q.n - k) - 1e-9),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS doc_id, min(b) AS least FROM reached GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS class_id, coalesce(n_links, 0) AS n_links
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (doc_id) LEFT JOIN counts USING (doc_id)"""


def _lloyd_sql() -> str:
    """Every round scans all entries; parts and entries are rows."""
    steps = [
        f"""
WITH kept AS (
  SELECT row_number() OVER () AS row_id, vec_id, label, list_transform(embedding, lambda x: floor({lloyd.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT row_id, part, v[part * len(v) // {lloyd.PARTS} + 1 : (part + 1) * len(v) // {lloyd.PARTS}] AS x FROM kept, range({lloyd.PARTS}) t(part)),
first AS (SELECT row_id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept QUALIFY entry < {lloyd.ENTRIES}),
book0 AS (SELECT part, entry, x AS c FROM cut JOIN first USING (row_id))"""
    ]
    for n in range(lloyd.ROUNDS + 1):
        steps.append(f"""
near{n} AS (
  SELECT row_id, part, min((list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, entry)) AS best
  FROM cut JOIN book{n} USING (part) GROUP BY ALL)""")
        if n < lloyd.ROUNDS:
            steps.append(f"""
flat{n} AS (
  SELECT part, best[2] AS entry, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM cut JOIN near{n} USING (row_id, part)),
mean{n} AS (SELECT part, entry, i, sum(x) AS s, count(*) AS n FROM flat{n} GROUP BY ALL),
moved{n} AS (
  SELECT part, entry, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END::BIGINT ORDER BY i) AS c
  FROM mean{n} GROUP BY ALL),
book{n + 1} AS (SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN moved{n} m USING (part, entry))""")
    steps.append(f"""
found AS (
  SELECT row_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM near{lloyd.ROUNDS} GROUP BY row_id),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{lloyd.ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN found USING (row_id), book""")
    return ",".join(steps)


# CRC-32 of a decimal, a bit at a time.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda acc, x: xor(xor(acc, x) >> 1, (xor(acc, x) & 1) * 3988292384)))"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % {trie.EVERY} AS base, {_CRC} % {trie.HEADS} AS h FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT convs.c, 0 AS own, p, role, text FROM convs JOIN turns ON turns.c = base AND p <= h
  UNION ALL SELECT c, 1, p, role, text FROM convs JOIN turns USING (c) WHERE p > h),
seqs AS (
  SELECT c, coalesce(s, []) AS s FROM convs
  LEFT JOIN (SELECT c, list({{'role': role, 'text': text}} ORDER BY own, p) AS s FROM rebuilt GROUP BY c) USING (c)),
prefixes AS (SELECT c, d, s[1:d] AS k, s FROM seqs, unnest(range(len(s) + 1)) t(d)),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(len(any_value(k)[d].text), 0) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, k),
children AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (SELECT saved, n_children IS NULL AS leaf, unnest(range(d + 1)) AS top, k FROM nodes LEFT JOIN children USING (d, k)),
subtrees AS (
  SELECT top AS d, k[1:top] AS k, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees USING (d, k) LEFT JOIN children USING (d, k) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]"""

ORACLE = {
    "op2_substring_dedup": OP2,
    "op3_url_filters": urls.oracle(),
    "op4_jaccard_join": OP4,
    "op6_quality_rules": OP6,
    "op7_topk_search": OP7,
    "op12_vector_codes": _lloyd_sql(),
    "op13_prefix_trie": OP13,
}
