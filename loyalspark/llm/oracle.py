"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def words_of(text: str) -> str:
    return _WORDS.format(_LOWER.format(f"coalesce({text}, '')"))


OP1 = f"""
WITH u AS (
  SELECT page_id,
         {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, rule, rh, rp) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), fits AS (
  SELECT DISTINCT host, path, rule, verdict FROM u JOIN rules
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
), best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM fits GROUP BY ALL
)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path
"""

OP5 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

OP8 = f"""
WITH item AS (
  SELECT item_id, {words_of('text')} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win),
doc AS (SELECT doc_id, {words_of('text')} AS w FROM documents),
dwin AS (
  SELECT doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc JOIN sizes ON len(w) >= size)
), occ AS (SELECT doc_id, k, win.size AS size, item_id FROM dwin JOIN win ON dwin.win = win.win AND dwin.size = win.size),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN its ON doc.doc_id = its.doc_id
"""

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP9 = f"""
WITH d AS (
  SELECT source, lang, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) AS copy
  FROM documents
), n AS (
  SELECT source, lang,
         len(regexp_extract_all(text, '[0-9]|[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS words,
         len(regexp_extract_all(text, '{_WORD}|[\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]')) AS pieces
  FROM d WHERE copy = 1
)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs, CAST(sum(words) AS BIGINT) AS tokens FROM n GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-1', count(*), CAST(sum(pieces) AS BIGINT) FROM n GROUP BY source, lang
"""


def crc32(number: str) -> str:
    """Unsigned CRC-32 of a number written in decimal, bit by bit."""
    text = f"CAST({number} AS VARCHAR)"
    bits = f"[(ascii(substr({text}, CAST(k // 8 + 1 AS INTEGER), 1)) >> CAST(k % 8 AS INTEGER)) & 1 for k in range(8 * length({text}))]"
    step = "xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda crc, bit: {step}), 4294967295)"


def _field(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN '-' ELSE CAST(strlen(CAST({col} AS VARCHAR)) AS VARCHAR) || ':' || CAST({col} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, grp: str, nodes: str, levels: int) -> str:
    """CTEs of a 16-ary tree over ``nodes`` (grp, r, d), one per level. Each
    node is one of a run; ``{name}_top`` has the last node of each group."""
    out = [f"{name}_n0 AS (SELECT *, count(*) OVER (PARTITION BY {grp}) AS n FROM {nodes})"]
    for k in range(levels):
        out.append(f"{name}_r{k} AS (SELECT {grp}, r // 16 AS r, list(d ORDER BY r) AS run FROM {name}_n{k} WHERE n > 1 GROUP BY {grp}, r // 16)")
        out.append(f"{name}_n{k + 1} AS (SELECT {grp}, r, sha256(array_to_string(run, '')) AS d, count(*) OVER (PARTITION BY {grp}) AS n FROM {name}_r{k})")
    tops = " UNION ALL ".join(f"SELECT {grp}, d FROM {name}_n{k} WHERE n = 1" for k in range(levels + 1))
    return ",\n".join([*out, f"{name}_top AS ({tops})"])


def _climb(name: str, grp: str, start: str, levels: int) -> str:
    """CTEs that carry (proof, folded) of every row of ``start`` up the tree."""
    out, last = [], start
    for k in range(levels):
        at = f"CAST((s.r // {16 ** k}) % 16 AS INTEGER)"
        out.append(f"""{name}_c{k} AS (
  SELECT s.* REPLACE (
    CASE WHEN run IS NULL THEN proof ELSE proof || array_to_string(run[1 : {at}], '') || array_to_string(run[{at} + 2 :], '') END AS proof,
    CASE WHEN run IS NULL THEN folded
         ELSE sha256(array_to_string(run[1 : {at}], '') || folded || array_to_string(run[{at} + 2 :], '')) END AS folded)
  FROM {last} s LEFT JOIN {name}_r{k} t ON s.{grp} IS NOT DISTINCT FROM t.{grp} AND s.r // {16 ** (k + 1)} = t.r)""")
        last = f"{name}_c{k}"
    return ",\n".join([*out, f"{name}_end AS (SELECT * FROM {last})"])


# Trees of up to 16 ** 6 documents a source and 16 ** 3 sources.
OP12 = f"""
WITH leaf AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32('doc_id')} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS shown
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, leaf AS d FROM leaf
), {_tree('doc', 'source', 'placed', 6)},
sources AS (SELECT source, 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, d FROM doc_top),
{_tree('src', 'one', 'sources', 3)},
start AS (SELECT doc_id, source, leaf, r, '' AS proof, shown AS folded FROM placed),
{_climb('doc', 'source', 'start', 6)},
up AS (
  SELECT e.doc_id, e.leaf, s.d AS subroot, s.one, s.r, e.proof, e.folded
  FROM doc_end e JOIN sources s ON e.source IS NOT DISTINCT FROM s.source
), {_climb('src', 'one', 'up', 3)}
SELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.d AS verified
FROM src_end CROSS JOIN src_top t
"""

# Turns of one number stand by digest, as the operator has them. A prefix is
# the list of its turns' digests.
OP11 = f"""
WITH turns AS (
  SELECT conv_id, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, turn,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id AS c, list({{'t': t, 'w': w}} ORDER BY turn NULLS FIRST, t) AS own, {crc32('conv_id')} % 4 AS h FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.own[1 : CAST(a.h AS INTEGER)], []), a.own[CAST(a.h AS INTEGER) + 1 :]) AS s
  FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 20
), prefixes AS (
  SELECT c, len(s) = d AS last, d, array_to_string(list_transform(s[1 : d], lambda x: x.t), '') AS p,
         array_to_string(list_transform(s[1 : d - 1], lambda x: x.t), '') AS q, CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w
  FROM (SELECT c, s, CAST(unnest(range(0, len(s) + 1)) AS INTEGER) AS d FROM rebuilt)
), nodes AS (
  SELECT d, p, any_value(q) AS q, any_value(w) AS w, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p
), children AS (SELECT d - 1 AS d, q AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (d, p)),
below AS (
  SELECT u.d, u.p, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, CAST(sum((n.n_convs - 1) * n.w) AS BIGINT) AS saved_tokens
  FROM full_nodes n JOIN prefixes m ON m.c = n.conv_id AND m.d <= n.d JOIN nodes u ON u.d = m.d AND u.p = m.p GROUP BY u.d, u.p
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.q AND n.d > 0
"""

# All pairs. Equal to the operator as long as its index looks at every list,
# up to some ten thousand vectors.
OP13 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS k FROM embeddings
), good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.k AS a, b.k AS b FROM good a JOIN good b ON len(a.e) = len(b.e) AND a.k <> b.k WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(vec_id) AS c FROM reach JOIN v ON v.k = b GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(coalesce(c, vec_id), vec_id) AS component_id,
       least(coalesce(c, vec_id), vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM v LEFT JOIN n ON n.a = k LEFT JOIN least ON least.a = k
"""

SQL = {"op1_url_filters": OP1, "op5_exact_dedup": OP5, "op8_decontamination": OP8, "op9_token_counts": OP9,
       "op11_conversation_trie": OP11, "op12_merkle_manifest": OP12,
       "op13_embedding_near_dedup": OP13}
