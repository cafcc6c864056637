"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from . import lm_scoring, quality_rules

_SPACE = r"\x20\x09-\x0D"
_LETTERS = ("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'")


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{_SPACE}]+'), lambda x: x <> '')"


def _quality() -> str:
    odd = quality_rules.ODD.replace(r"\s", _SPACE).replace("'", "''")
    stub = quality_rules.STUB.replace(r"[^\s\p{P}]", rf"[^{_SPACE}\p{{P}}]").replace(r"\s", f"[{_SPACE}]")
    phrases, common = (r"(?i)\b(?:" + "|".join(p) + r")\b" for p in (quality_rules.PHRASES, quality_rules.COMMON_PHRASES))
    separators = r"^(?:[|>»›•·/–—-]|::|>>|\|\|)$"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_words('t')} AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w) x),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM g) x WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) x GROUP BY r),
l AS (SELECT r, unnest(lines) AS x FROM w),
judged AS (SELECT r, x, length(x) - length(regexp_replace(x, '{odd}', '', 'g')) > {quality_rules.MAX_ODD}::DOUBLE * length(x)
    OR regexp_matches(x, '{stub}')
    OR (length(x) <= {quality_rules.BOILER_CHARS} AND (regexp_matches(x, '{phrases}')
        OR 2 * length(regexp_replace(x, '{common}', '', 'g')) <= length(x)))
    OR (s >= {quality_rules.MIN_SEPARATORS} AND s * {quality_rules.SEPARATOR_SHARE} >= n) AS bad
  FROM (SELECT r, x, len(ws) AS n, len(list_filter(ws, lambda y: regexp_matches(y, '{separators}'))) AS s
        FROM (SELECT r, x, {_words('x')} AS ws FROM l) a) b),
lost AS (SELECT r, count(*) AS n_lines, count(DISTINCT x) AS kinds, sum(length(x)) AS chars,
    sum(CASE WHEN bad THEN 0 ELSE length(x) END) AS stay FROM judged GROUP BY r),
f AS (SELECT doc_id, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
    length(t) - length(regexp_replace(t, '{quality_rules.SYMBOLS}', '', 'g')) AS n_symbols,
    coalesce(q.n_lines - kinds, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(stay, 0) AS stay, coalesce(chars, 0) AS chars
  FROM w LEFT JOIN covered USING (r) LEFT JOIN lost q USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
  n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words)
    AND stay >= {1 - quality_rules.MAX_LOST} * chars AS kept
FROM f"""


def _lm() -> str:
    own = "PARTITION BY doc_id, text, "
    return f"""
WITH d AS (SELECT doc_id, text, count(*) AS copies FROM documents GROUP BY doc_id, text),
w AS (SELECT doc_id, text, copies, {_words(f"translate(coalesce(text, ''), {_LETTERS[0]}, {_LETTERS[1]})")} AS w FROM d),
n AS (SELECT sum(copies * len(w)) AS tokens, sum(CASE WHEN len(w) > 0 THEN copies END) AS texts FROM w),
t AS (SELECT doc_id, text, copies, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
p AS (SELECT *, CASE WHEN i = 1 THEN '<s> ' ELSE lag(x) OVER o END AS v,
    CASE WHEN i = 2 THEN '<s> ' ELSE lag(x, 2) OVER o END AS u FROM t WINDOW o AS (PARTITION BY doc_id, text ORDER BY i)),
c AS (SELECT *, sum(copies) OVER (PARTITION BY x) - count(*) OVER ({own} x) AS c1,
    sum(copies) OVER (PARTITION BY v, x) - count(*) OVER ({own} v, x) AS c2,
    sum(copies) OVER (PARTITION BY u, v, x) - count(*) OVER ({own} u, v, x) AS c3 FROM p),
b AS (SELECT *, lag(c1) OVER o AS before1, lag(c2) OVER o AS before2 FROM c WINDOW o AS (PARTITION BY doc_id, text ORDER BY i)),
s AS (SELECT doc_id, text, sum(CASE WHEN c2 > 0 THEN 0 ELSE 1 END) AS n_backoff,
    sum(CASE WHEN i > 1 AND c3 > 0 THEN log10(c3::DOUBLE / before2::DOUBLE)
             WHEN c2 > 0 THEN log10(c2::DOUBLE / (CASE WHEN i = 1 THEN texts - 1 ELSE before1 END)::DOUBLE) + least(i - 1, 1) * log10({lm_scoring.BACKOFF}::DOUBLE)
             ELSE log10(greatest(c1, 1)::DOUBLE / tokens::DOUBLE) + least(i, 2) * log10({lm_scoring.BACKOFF}::DOUBLE) END) AS log_score
  FROM b, n GROUP BY doc_id, text)
SELECT w.doc_id, len(w.w) AS n_tokens, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff, round(log_score, 6) AS log_score,
  round(log_score / len(w.w), 6) AS mean_log_score, copies
FROM w LEFT JOIN s ON w.doc_id IS NOT DISTINCT FROM s.doc_id AND w.text IS NOT DISTINCT FROM s.text"""


def _audit() -> str:
    fail = {"A": "n_words < 200", "B": "100 * n_distinct < 50 * n_words", "C": "100 * capitals > 2 * points", "D": "symbol", "E": "copy"}
    letters = ", ".join(f"('{f}')" for f in fail)
    judged = ", ".join(f"{c} AS {f}" for f, c in fail.items())
    bits = " || ".join(f"CASE WHEN {f} THEN '{f}' ELSE '' END" for f in fail)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, part, t, {_words('t')} AS w FROM d),
m AS (SELECT r, doc_id, part, len(w) AS n_words, len(list_distinct(w)) AS n_distinct, length(t) AS points,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals, regexp_matches(t, '[#$%&*|]') AS symbol,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy FROM w),
j AS (SELECT r, doc_id, part, {judged} FROM m),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, {bits} AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM j LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails),
x(f) AS (VALUES {letters}),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f)
    AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (SELECT filter_order, step, filter_order[step] AS f, left(filter_order, step - 1) AS before FROM o, (SELECT unnest(range(1, 6)) AS step) y),
g AS (SELECT part, filter_order, step, f, n, good, toxic, fails, fails <> '' AND regexp_matches(fails, '[' || f || ']') AS own,
    before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS gone FROM c, s),
h AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM g GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM h"""


def _merkle() -> str:
    """Levels by recursion, each node with the siblings before and after it; then each leaf's way up."""
    fields = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"
                         for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    leaf = lambda text: f"sha256({fields.replace('{text}', text)})"
    # CRC-32 of the digits, bit by bit
    bit = "list_reduce([{0}, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), "
           f"lambda a, x: {bit.format('xor(a, x)')}), 4294967295)")

    def tree(name: str, leaves: str) -> str:
        """{name}: (tree, level, pos, n, hash) of every node; {name}_run: also the siblings before and after it."""
        return f"""
{name} AS (SELECT tree, 0 AS level, pos, n, hash FROM {leaves}
  UNION ALL SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 16, n),
{name}_run AS (SELECT tree, level, pos, hash,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, level, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} WHERE n > 1),
{name}_top AS (SELECT tree, hash FROM {name} WHERE n = 1)"""

    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN {leaf(f"translate(text, {_LETTERS[0]}, {_LETTERS[1]})")} ELSE {leaf('text')} END AS altered FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, leaf AS hash FROM d),
{tree('t', 'p')},
q AS (SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, hash FROM t_top),
{tree('u', 'q')},
up AS (SELECT p.r, x.level, x.before, x.after FROM p JOIN t_run x ON x.tree = p.tree AND x.pos = p.pos // CAST(power(16, x.level) AS BIGINT)
  UNION ALL SELECT p.r, 1000 + y.level, y.before, y.after FROM p JOIN q ON q.source = p.tree
  JOIN u_run y ON y.pos = q.pos // CAST(power(16, y.level) AS BIGINT)),
step AS (SELECT r, before, after, row_number() OVER (PARTITION BY r ORDER BY level) AS i FROM up),
proof AS (SELECT r, string_agg(before || after, '' ORDER BY i) AS siblings FROM step GROUP BY r),
folded AS (SELECT r, 0::BIGINT AS i, altered AS hash FROM d
  UNION ALL SELECT f.r, s.i, sha256(s.before || f.hash || s.after) FROM folded f JOIN step s ON s.r = f.r AND s.i = f.i + 1),
result AS (SELECT r, arg_max(hash, i) AS folded_root FROM folded GROUP BY r)
SELECT p.doc_id, p.leaf, t_top.hash AS subroot, u_top.hash AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
  folded_root = u_top.hash AS verified
FROM p JOIN t_top ON t_top.tree = p.tree JOIN result USING (r) LEFT JOIN proof USING (r), u_top"""


ORACLES = {"op11_filter_audit": _audit(), "op13_merkle_manifest": _merkle(), "op7_lm_scoring": _lm(), "op8_quality_rules": _quality()}
