"""DuckDB SQL for the rows of the registered queries, where SQL can state them."""

from __future__ import annotations

from stratus.llm.quality_rules import MAX_HOST_RATE, PLAIN_PRIOR, PRIOR_BOUNDS
from stratus.llm.queries import URL_RULES
from stratus.llm.url_filters import TRACKING

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE = r"'[\x20\x09-\x0D]+'"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {SPACE}), lambda w: w <> '')"


def _rule(host: str, path: str) -> str:
    """The longest rule that fits, or null."""
    tests = []
    for rule in sorted(URL_RULES, key=len, reverse=True):
        name, _, prefix = rule.partition("/")
        tests.append(
            f"WHEN ({host} = '{name}' OR ends_with({host}, '.{name}')) AND starts_with({path}, '/{prefix}') THEN '{rule}'"
        )
    return f"CASE {' '.join(tests)} END"


_KIND = f"CASE {{}} {' '.join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())} END"
_HOST = LOWERED.format("regexp_extract(CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END, '^[^/?#]*')")
_REST = "substr(CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END, length(host) + 1)"

OP1 = f"""
WITH RECURSIVE urls AS (SELECT DISTINCT url AS u FROM pages WHERE url IS NOT NULL),
split AS (SELECT u, {_HOST} AS host FROM urls),
parts AS (
  SELECT u, host, regexp_extract({_REST}, '^[^?#]*') AS path,
    array_to_string(list_filter(string_split(regexp_extract({_REST}, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}')), '&') AS query
  FROM split
),
addresses AS (
  SELECT u, host, path, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS address
  FROM parts
),
rules AS (SELECT u, address, {_rule('host', 'path')} AS rule FROM addresses WHERE host <> ''),
shared AS (
  SELECT address, bool_or({_KIND.format('rule')} = 'allow') AS allowed, bool_or({_KIND.format('rule')} = 'block') AS blocked
  FROM rules GROUP BY address
)
SELECT p.page_id, coalesce(a.host, '') AS host, coalesce(a.path, '') AS path, r.rule,
  CASE WHEN r.rule IS NOT NULL THEN {_KIND.format('r.rule')} WHEN s.allowed THEN 'allow' WHEN s.blocked THEN 'block'
    ELSE 'allow' END AS verdict
FROM pages p LEFT JOIN addresses a ON p.url = a.u LEFT JOIN rules r ON p.url = r.u
  LEFT JOIN shared s ON r.address = s.address
"""

OP2 = f"""
WITH split AS (SELECT doc_id, source, coalesce(text, '') AS body, {WORDS} AS ws, row_number() OVER () AS row FROM documents),
windows AS (
  SELECT row, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM split, unnest(range(1, greatest(len(ws) - 1, 1))) AS t(i)
),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, a, b, c) > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, range(3) AS t(k) GROUP BY row),
counted AS (
  SELECT doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.row = c.row
),
rules AS (
  SELECT doc_id, source, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counted
),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed))::DOUBLE AS f FROM rules WHERE source IS NOT NULL GROUP BY 1
),
totals AS (
  SELECT count(*)::DOUBLE AS k, sum(n) AS n, sum(f) AS f, sum(floor(1e6 * f * (f / n))) AS ff, sum(n * n) AS nn FROM hosts
),
spread AS (
  SELECT *, f / n AS mean,
    ((ff / 1e6 - f * (f / n)) / ((f / n) * (1 - f / n)) - (k - 1)) / (n - nn / n - (k - 1)) AS rho FROM totals
),
prior AS (
  SELECT mean, CASE WHEN k < 2 OR f = 0 OR f = n OR n <= k THEN {PLAIN_PRIOR}
    WHEN rho <= 0 THEN {PRIOR_BOUNDS[1]} ELSE least(greatest(1 / rho - 1, {PRIOR_BOUNDS[0]}), {PRIOR_BOUNDS[1]}) END AS weight
  FROM spread
),
verdicts AS (SELECT source, (f + weight * mean) / (n + weight) <= {MAX_HOST_RATE} AS host_kept FROM hosts, prior)
SELECT r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words::BIGINT AS n_repeat_words, r.base_failed,
  NOT r.base_failed AND coalesce(v.host_kept, true) AS kept
FROM rules r LEFT JOIN verdicts v ON r.source = v.source
"""

OP3 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_transform({WORDS}, lambda w: {LOWERED.format('w')}) AS ws FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS s
  FROM split
),
tokens AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS t FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b
    ON a.t = b.t AND a.doc_id < b.doc_id AND 85 * a.n <= 100 * b.n AND 85 * b.n <= 100 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, len(s.s) AS n_shingles, r.least AS component_id
FROM sets s JOIN (SELECT x, min(y) AS least FROM reached GROUP BY x) r ON s.doc_id = r.x
"""

OP6 = f"""
WITH split AS (SELECT doc_id, {WORDS} AS ws, row_number() OVER () AS row FROM documents),
windows AS (
  SELECT row, i, array_to_string(ws[i:i + 34], ' ') AS w FROM split, unnest(range(1, greatest(len(ws) - 33, 1))) AS t(i)
),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
words AS (SELECT row, i, ws[i] AS w FROM split, unnest(range(1, len(ws) + 1)) AS t(i)),
covered AS (SELECT DISTINCT row, i + k AS i FROM twice, range(35) AS t(k)),
kept AS (
  SELECT w.row, string_agg(w.w, ' ' ORDER BY w.i) AS text, count(*) AS n
  FROM words w ANTI JOIN covered c ON w.row = c.row AND w.i = c.i GROUP BY w.row
)
SELECT s.doc_id, len(s.ws) AS n_words, len(s.ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.row = k.row
"""

_TOKENS = {"words-1": r"[^\x20\x09-\x0D]+", "kinds-1": r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]+"}
OP8 = " UNION ALL ".join(
    f"""
SELECT source, lang, '{version}' AS tokenizer, count(*) AS n_docs,
  sum(len(regexp_extract_all(translate(coalesce(text, ''), '#*$%&|<>', ''), '{pattern}')))::BIGINT AS n_tokens
FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
GROUP BY source, lang
"""
    for version, pattern in _TOKENS.items()
)

OP10 = f"""
WITH n AS (SELECT doc_id, {LOWERED.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

OP12 = """
WITH keyed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
drawn AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || k[1:8])::BIGINT AS h1, ('0x' || k[9:16])::BIGINT AS h2,
    ('0x' || k[17:24])::BIGINT AS h3, ('0x' || k[25:32])::BIGINT AS h4
  FROM keyed
),
cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
parts AS (SELECT *, left(t, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

#: Every pair of one label is compared: short, for the small tables it is run on.
OP11 = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
),
fit AS (
  SELECT row, vec_id, label, v, sqrt(list_inner_product(v, v)) AS size FROM given
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.row AS x, b.row AS y FROM fit a JOIN fit b ON a.label = b.label AND len(a.v) = len(b.v) AND a.row <> b.row
  WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.98
),
reached AS (SELECT row AS x, row AS y FROM given UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least AS (SELECT r.x, min(g.vec_id) AS component_id FROM reached r JOIN given g ON r.y = g.row GROUP BY r.x)
SELECT g.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, c.component_id, g.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM given g JOIN least c ON g.row = c.x LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) l ON g.row = l.x
"""

STATEMENTS = {
    "op1_url_filters": OP1,
    "op2_quality_rules": OP2,
    "op3_ngram_join": OP3,
    "op6_substring_dedup": OP6,
    "op8_token_counts": OP8,
    "op10_exact_dedup": OP10,
    "op11_embedding_pivots": OP11,
    "op12_fill_middle": OP12,
}
