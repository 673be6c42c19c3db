"""SQL with the same results, for the operators that SQL can express."""

from __future__ import annotations

from spendfall.llm.license_scan import COPYRIGHT_LINE, EQUIVALENT, KNOWN, MARKS

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS a
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.a, c.a), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_HOST = "translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)"
_RULE = """CASE
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
END"""

OP4 = f"""
WITH RECURSIVE edges AS (
  SELECT url AS u, 'https://' || regexp_replace({_HOST}, '^(www|m)\\.', '') || regexp_replace({_PATH}, '(\\.html|/)$', '')
    || CASE WHEN q = '' THEN '' ELSE '?' || q END AS v
  FROM (
    SELECT url, {_REST} AS rest,
      array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)=')), '&') AS q
    FROM (SELECT DISTINCT url FROM pages WHERE strpos(url, '://') > 0)
  )
  UNION
  SELECT url, regexp_extract(html, '(?is)<link\\b[^>]*\\brel=["'']?canonical\\b[^>]*\\bhref=["'']?([^"''\\s>]+)', 1) FROM pages WHERE strpos(html, 'canonical') > 0 AND url IS NOT NULL
),
both_ways AS (SELECT u, v FROM edges WHERE u <> v AND strpos(v, '://') > 0 UNION SELECT v, u FROM edges WHERE u <> v AND strpos(v, '://') > 0),
reached AS (
  SELECT u AS a, v AS b FROM both_ways
  UNION
  SELECT r.a, e.v FROM reached r JOIN both_ways e ON r.b = e.u
),
ruled AS (
  SELECT url, host, path, {_RULE} AS rule
  FROM (SELECT url, {_HOST} AS host, {_PATH} AS path FROM (SELECT url, {_REST} AS rest FROM (SELECT url FROM pages UNION SELECT u FROM both_ways)))
),
aliases AS (
  SELECT r.a AS url, bool_or(coalesce(x.rule IN ('org/', 'com/fr/'), false)) AS allowed,
    bool_or(coalesce(x.rule IN ('example.org/es/', 'example.org/en/1', 'com/de/'), false)) AS blocked
  FROM reached r JOIN ruled x ON x.url = r.b GROUP BY r.a
)
SELECT p.page_id, coalesce(r.host, '') AS host, coalesce(r.path, '') AS path, r.rule,
  CASE WHEN r.rule IN ('org/', 'com/fr/') THEN 'allow' WHEN r.rule IS NOT NULL THEN 'block'
       WHEN a.blocked AND NOT a.allowed THEN 'block' ELSE 'allow' END AS verdict
FROM pages p LEFT JOIN ruled r ON r.url = p.url LEFT JOIN aliases a ON a.url = p.url
"""

_CONTROL = r"(\\[)(\\\\*(?:INST\\]|/INST\\]|ROLE\\]|TEXT\\]|/TEXT\\]))|(<)(\\\\*(?:s>|/s>|<SYS>>|</SYS>>))".replace("\\\\", "\\")
_ESCAPED = f"regexp_replace(text, '{_CONTROL}', '\\1\\3\\\\\\2\\4', 'g')"

OP5 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED}) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 19 + length(role) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    form = f"regexp_replace(lower({text}), {_quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    for pattern, to in EQUIVALENT:
        form = f"regexp_replace({form}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return f"trim(regexp_replace({form}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in KNOWN.items() for text in texts)

OP3 = f"""
WITH known AS (
  SELECT sha256({_canonical("known")}) AS digest, min(license) AS license FROM (VALUES {_KNOWN}) AS t(license, known) GROUP BY 1
),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
),
by_line AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS found
  FROM (SELECT DISTINCT l.doc_id, k.license FROM lines l JOIN known k ON sha256({_canonical("l.line")}) = k.digest WHERE regexp_matches(lower(l.line), '{MARKS}'))
  GROUP BY doc_id
),
whole AS (SELECT doc_id, CASE WHEN {_canonical("text")} <> '' THEN sha256({_canonical("text")}) END AS text_digest FROM documents)
SELECT w.doc_id, w.text_digest, k.license, coalesce(b.found, '') AS line_licenses
FROM whole w LEFT JOIN known k ON k.digest = w.text_digest LEFT JOIN by_line b ON b.doc_id = w.doc_id
"""

OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS u, q.vec_id AS v FROM v p JOIN v q ON p.label = q.label AND len(p.a) = len(q.a) AND p.vec_id <> q.vec_id
  WHERE list_dot_product(p.a, q.a) / (sqrt(list_dot_product(p.a, p.a)) * sqrt(list_dot_product(q.a, q.a))) >= 0.93
),
reached AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
lows AS (SELECT u, min(v) AS low FROM reached GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id, e.vec_id <= coalesce(l.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN lows l ON l.u = e.vec_id LEFT JOIN counts c ON c.u = e.vec_id
"""


def _crc32(number: str) -> str:
    """The unsigned CRC-32 of a number's decimal digits, bit by bit."""
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = "list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda a, b: {byte}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END" for x in fields) + ")"


OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_crc32("doc_id")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
  FROM leaves
),
nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS digest, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n
),
subroots AS (SELECT tree, level AS height, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, tree AS idx, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, idx // 3, n
),
every AS (SELECT tree, level, idx, digest FROM nodes WHERE n > 1 UNION ALL SELECT -1, level, idx, digest FROM upper WHERE n > 1),
levels AS (
  SELECT p.tree, p.idx, g.l AS step, p.tree AS at, g.l AS level, p.idx // CAST(pow(3, g.l) AS BIGINT) AS place
  FROM placed p JOIN subroots s ON s.tree = p.tree, range(0, 40) g(l) WHERE g.l < s.height
  UNION ALL
  SELECT p.tree, p.idx, s.height + g.l, -1, g.l, p.tree // CAST(pow(3, g.l) AS BIGINT)
  FROM placed p JOIN subroots s ON s.tree = p.tree, range(0, 40) g(l) WHERE g.l < (SELECT max(level) FROM upper)
),
steps AS (
  SELECT l.tree, l.idx, l.step, coalesce(string_agg(e.digest, '' ORDER BY e.idx) FILTER (e.idx < l.place), '') AS before,
    coalesce(string_agg(e.digest, '' ORDER BY e.idx) FILTER (e.idx > l.place), '') AS after
  FROM levels l JOIN every e ON e.tree = l.at AND e.level = l.level AND e.idx // 3 = l.place // 3
  GROUP BY l.tree, l.idx, l.step
),
folded AS (
  SELECT tree, idx, 0 AS step, other AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(s.before || f.digest || s.after) FROM folded f JOIN steps s ON s.tree = f.tree AND s.idx = f.idx AND s.step = f.step
),
ends AS (SELECT tree, idx, arg_max(digest, step) AS digest FROM folded GROUP BY tree, idx),
proofs AS (SELECT tree, idx, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY tree, idx)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, e.digest AS folded_root, e.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN ends e ON e.tree = p.tree AND e.idx = p.idx LEFT JOIN proofs q ON q.tree = p.tree AND q.idx = p.idx,
  (SELECT digest FROM upper WHERE n = 1) r
"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(turn ORDER BY pos) AS turns, {_crc32("conv_id")} % 6 AS h FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(CASE WHEN b.turns IS NULL THEN [] ELSE b.turns[1:o.h] END, o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
),
prefixes AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends FROM rebuilt, range(0, 1000000) g(d) WHERE d <= len(turns)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM prefixes GROUP BY depth, prefix
),
named AS (
  SELECT n.*, p.conv_id AS parent, CASE WHEN n.depth > 0 THEN (n.n - 1) * length(n.prefix[n.depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
),
kids AS (SELECT depth - 1 AS depth, parent AS conv_id, count(*) AS k FROM named WHERE parent IS NOT NULL GROUP BY ALL),
counted AS (SELECT n.*, coalesce(k.k, 0) AS k FROM named n LEFT JOIN kids k ON k.depth = n.depth AND k.conv_id = n.conv_id),
sums AS (
  SELECT a.depth, a.conv_id, sum(CASE WHEN b.k = 0 THEN 1 ELSE 0 END) AS leaves, sum(b.saved) AS saved
  FROM counted a JOIN counted b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY a.depth, a.conv_id
)
SELECT c.conv_id, c.depth, c.parent AS parent_conv_id, c.n AS n_convs, c.k AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(c.ids) AS ends_sha256
FROM counted c JOIN sums s ON s.depth = c.depth AND s.conv_id = c.conv_id
"""

ORACLE = {
    "op2_exact_topk": OP2,
    "op3_license_scan": OP3,
    "op4_url_filter": OP4,
    "op5_chat_format": OP5,
    "op11_near_embeddings": OP11,
    "op12_merkle_manifest": OP12,
    "op13_prefix_trie": OP13,
}
