"""SQL texts that return the same rows as the queries of this subpackage, where SQL can express them."""

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# Keys of runs of 2**k lines, from those of their halves; documents have fewer than 2**LEVELS lines.
LEVELS = 14
OP6_RUNS = """
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM {docs} WHERE text IS NOT NULL
), l0 AS (SELECT doc_id, pos, line AS key, length(line) AS chars, 1 AS len FROM lines)
"""


def line_levels(docs: str, least_chars: int = 30) -> str:
    """SQL for the lines that repeat: a table ``gone(doc_id, pos)`` after the WITH."""
    parts = [OP6_RUNS.format(docs=docs).strip()]
    for k in range(LEVELS):
        size = 1 << k
        parts.append(
            f"f{k} AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS copy, count(*) OVER (PARTITION BY key) AS n FROM l{k}),"
            f" l{k + 1} AS (SELECT a.doc_id, a.pos, md5(a.key || chr(10) || b.key) AS key, a.chars + b.chars AS chars, {2 * size} AS len"
            f" FROM f{k} a JOIN f{k} b ON a.doc_id = b.doc_id AND b.pos = a.pos + {size} WHERE a.n > 1 AND b.n > 1)"
        )
    spans = " UNION ALL ".join(f"SELECT doc_id, pos, len FROM f{k} WHERE copy > 1 AND chars >= {least_chars}" for k in range(LEVELS))
    parts.append(f"gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + len)) AS pos FROM ({spans}))")
    return ", ".join(parts)


OP6 = (
    line_levels("documents")
    + """
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n, 0) AS INTEGER) AS n_removed,
       sha256(CASE WHEN k.n IS NULL THEN d.text ELSE coalesce(k.kept, '') END) AS kept_sha256
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(g.pos) AS n, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id HAVING count(g.pos) > 0
) k ON d.doc_id = k.doc_id
"""
)



def near_copies(docs: str, words: int) -> str:
    """SQL for the similarity components: tables ``n(doc_id, n)`` and ``comp(doc_id, component_id)`` after the WITH."""
    joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {docs}
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: {joined}) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM {docs} UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
"""


OP8 = (
    near_copies("documents", 2)
    + """
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
)



def repeated_words(docs: str) -> str:
    """SQL for the words that earlier documents have in a window of 50: tables ``w(doc_id, w)`` and ``cut(doc_id, i)``."""
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)
), later AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY key) AS first FROM windows) WHERE first < doc_id
), cut AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later)
"""


OP9 = (
    repeated_words("documents")
    + """, kept AS (
  SELECT u.doc_id, count(c.i) AS n_removed, string_agg(u.word, ' ' ORDER BY u.i) FILTER (WHERE c.i IS NULL) AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) u
  LEFT JOIN cut c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
)

# CRC-32 of a decimal number: a byte is mixed in, then eight steps of one bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

OP11 = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS own, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos > c.h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, md5(role) || md5(text) AS turn, length(text) AS chars FROM r
), paths AS MATERIALIZED (
  SELECT conv_id, depth, chars, md5(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), linked AS (
  SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS MATERIALIZED (
  SELECT depth, key, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM linked GROUP BY depth, key
), children AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
described AS (SELECT a.*, coalesce(b.n, 0) AS n_children FROM nodes a LEFT JOIN children b USING (depth, key)),
below AS (
  SELECT p.depth, p.key, sum(x.own) AS saved, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM described x JOIN paths p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY 1, 2
)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM described a JOIN below b USING (depth, key) LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.key = a.parent
"""

# A control string, or an escaped one, gets one more tilde.
_ESCAPED = "regexp_replace({}, '([\\[<])(~*)(/?(?:INST|SYS|ROLE)\\]|:\\]|/?s>)', '\\1~\\2\\3', 'g')"

OP13 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), s AS (
  SELECT *, length({_ESCAPED.format("text")}) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 13
    ELSE 17 + length({_ESCAPED.format("role")}) END AS shown
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

ORACLES: dict[str, str] = {"op3_exact_top_k": OP3, "op6_line_dedup": OP6, "op8_near_dedup": OP8, "op9_substring_dedup": OP9, "op11_prefix_trie": OP11, "op13_chat_format": OP13}
