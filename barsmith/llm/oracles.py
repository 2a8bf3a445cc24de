"""Plain SQL giving the rows of the training-data queries."""

from __future__ import annotations

import re

from .centroids import CENTROIDS, COMPONENTS, ROUNDS, SCALE, SEED
from .decontaminate import MASKS, MISSES, SPAN, WINDOW, short_masks
from .quality_rules import STOP_WORDS
from .url_filters import PATTERNS, SITE_RULES
from .variants import LETTERS, OCCURRENCES, SPOILED, TIMES


def quality_rules(table: str = "documents") -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {table}),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
dup AS (
  SELECT doc_id, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(gap, 8)))::BIGINT AS n FROM dup GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    length(t) - length(replace(t, '!!', '!')) AS bangs,
    len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS stops,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS same
  FROM (SELECT *, list_filter(string_split(t, chr(10)),
                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d)
  LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, greatest(n_words, 1)::DOUBLE AS n,
    n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2 FROM m),
f AS (
  SELECT *, list_filter([
    CASE WHEN f1 THEN 'word_count' END, CASE WHEN f2 THEN 'repeated_windows' END,
    CASE WHEN word_chars / n < 2 OR word_chars / n > 12 THEN 'mean_word_length' END,
    CASE WHEN n_symbols / n > 0.1 THEN 'symbols' END, CASE WHEN bangs / n > 0.1 THEN 'shouting' END,
    CASE WHEN stops / n < 0.02 THEN 'stop_words' END, CASE WHEN same / n > 0.25 THEN 'repeated_words' END,
    CASE WHEN n_dup_lines / greatest(n_lines, 1)::DOUBLE > 0.5 THEN 'repeated_lines' END],
    lambda x: x IS NOT NULL) AS fails FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  len(fails) = 0 AS kept, array_to_string(fails, ',') AS failed_rules FROM f
"""


def spaced_seeds(docs: str = "documents", items: str = "benchmark") -> str:
    """Seeds as lists of tokens; every hit is aligned and counted as in ``decontaminate``."""
    lengths: dict[tuple[int, ...], list[int]] = {m: [] for m in MASKS}
    for n in range(1, WINDOW):
        for m in short_masks(n):
            lengths.setdefault(m, []).append(n)
    masks = ", ".join(f"({k}, {list(m)}, {n}::INT[])" for k, (m, n) in enumerate(lengths.items()))
    tokens = r"regexp_extract_all(lower(coalesce(text, '')), '[^ \t-\r!-/:-@\[-`{-~]+')"
    return f"""
WITH d AS (SELECT doc_id, {tokens} AS w FROM {docs}),
b AS (SELECT DISTINCT item_id, {tokens} AS w FROM {items}),
m AS (
  SELECT * FROM (VALUES {masks}) AS t(k, o, lengths)
  WHERE k < {len(MASKS)} OR EXISTS (SELECT 1 FROM b WHERE list_contains(lengths, len(w)))),
bs AS (
  SELECT item_id, k, p, list_transform(o, lambda x: w[p + x + 1]) AS seed FROM (
    SELECT *, unnest(range(0, len(w) - o[len(o)])) AS p FROM b, m
    WHERE (k < {len(MASKS)} AND len(w) >= {SPAN}) OR list_contains(lengths, len(w)))),
ds AS (
  SELECT doc_id, k, q, list_transform(o, lambda x: w[q + x + 1]) AS seed FROM (
    SELECT *, unnest(range(0, len(w) - o[len(o)])) AS q FROM d, m WHERE len(w) > o[len(o)])),
hits AS (
  SELECT doc_id, item_id, q, p, d.w AS doc, b.w AS item, least({WINDOW}, len(b.w)) AS width
  FROM (SELECT doc_id, item_id, q, p FROM ds JOIN bs USING (k, seed)) JOIN d USING (doc_id) JOIN b USING (item_id)),
same AS (
  SELECT *, list_transform(range(greatest(0, p - width + 1), least(len(item), p + width)), lambda x:
    CASE WHEN q - p + x >= 0 AND doc[q - p + x + 1] = item[x + 1] THEN 1 ELSE 0 END) AS eq FROM hits),
best AS (
  SELECT doc_id, item_id, q, width, list_max(list_transform(range(0, len(eq) - width + 1),
    lambda s: list_sum(eq[s + 1:s + width]))) AS n FROM same)
SELECT doc_id, item_id, count(*) AS n_hits, CAST(max(n) AS BIGINT) AS best_match,
  CAST(min(q) AS BIGINT) AS first_token
FROM best WHERE n >= width - least({MISSES}, {MISSES} * width // {SPAN}) GROUP BY ALL
"""


def _pattern_regex(pattern: str) -> str:
    """A filter pattern as an expression over an address from its ``://`` on."""
    text = pattern.removeprefix("@@")
    start = "^://([^/?#]*[.])?" if text.startswith("||") else "^" if text.startswith("|") else ""
    body = text.lstrip("|")
    end = r"\z" if body.endswith("|") else ""
    separator = r"([^a-z0-9_.%-]|\z)"
    parts = [separator if c == "^" else ".*" if c == "*" else re.escape(c) for c in body.removesuffix("|")]
    return "(?s)" + start + "".join(parts) + end


def url_filters(table: str = "pages") -> str:
    """Every rule against every address, without an index."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    sites = ", ".join(f"('{r}', '{r[:r.index('/')]}', '{r[r.index('/'):]}', '{v}')" for r, v in SITE_RULES)
    patterns = ", ".join(
        f"('{p}', '{_pattern_regex(p)}', '{'allow' if p.startswith('@@') else 'block'}')" for p in PATTERNS)
    return f"""
WITH a AS (
  SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS mark FROM {table}),
b AS (SELECT *, CASE WHEN mark > 0 THEN substr(u, mark + 3) ELSE '' END AS rest FROM a),
c AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS given FROM b),
p AS (
  SELECT k, page_id, translate(given, '{upper}', '{lower}') AS host,
    regexp_extract(substr(rest, length(given) + 1), '^[^?#]*') AS path,
    translate(CASE WHEN mark > 0 THEN substr(u, mark) ELSE u END, '{upper}', '{lower}') AS whole FROM c),
sites AS (SELECT * FROM (VALUES {sites}) AS t(rule, h, start, verdict)),
patterns AS (SELECT * FROM (VALUES {patterns}) AS t(pattern, regex, verdict)),
by_site AS (
  SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN sites ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start) GROUP BY k),
by_pattern AS (
  SELECT k, arg_max(pattern, (verdict = 'allow', length(pattern), pattern)) AS pattern,
    arg_max(verdict, (verdict = 'allow', length(pattern), pattern)) AS verdict
  FROM p JOIN patterns ON regexp_matches(whole, regex) GROUP BY k)
SELECT page_id, host, path, by_site.rule AS rule,
  coalesce(by_site.verdict, by_pattern.verdict, 'allow') AS verdict,
  CASE WHEN by_site.rule IS NULL THEN pattern END AS pattern
FROM p LEFT JOIN by_site USING (k) LEFT JOIN by_pattern USING (k)
"""


def bit_plane_centroids(table: str = "embeddings") -> str:
    """Rounds of plain differences, squared and added up component by component."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - w[i]) * (v[i] - w[i])))"
    # Distance and centroid as one number, so that ties go to the smaller centroid.
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT k, any_value(vec_id) AS vec_id, any_value(v) AS v, min({square}::BIGINT * 64 + c) AS best FROM kept, c{r} GROUP BY k)""")
        if r < ROUNDS:
            steps.append(f"""
s{r} AS (
  SELECT best % 64 AS c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {COMPONENTS + 1}) AS t(i) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(moved, w) AS w FROM c{r} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM s{r} GROUP BY c) USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM {table} WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST) - 1 AS c, v AS w
  FROM kept QUALIFY c < {CENTROIDS}),{",".join(steps)},
placed AS (SELECT vec_id, best % 64 AS c, best // 64 AS distance FROM a{ROUNDS})
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM placed JOIN c{ROUNDS} USING (c)
"""


def spelling_variants(table: str = "documents") -> str:
    """Words that lack a character or differ in one, by joins; checksums byte by byte."""
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00c0-\u00ff]+')) AS run
  FROM {table}),
found AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL),
crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)) AS t),
bytes AS (
  SELECT id, run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch:
    CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END)) AS b FROM found),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295::BIGINT] || b,
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
spoiled AS (
  SELECT n, CASE WHEN h % {SPOILED} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spoiled WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {OCCURRENCES}),
holes AS (
  SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole,
    substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM holes AS a JOIN holes AS b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT word, short FROM holes WHERE short IN (SELECT word FROM words)
  UNION SELECT short, word FROM holes WHERE short IN (SELECT word FROM words)),
near AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY words.n DESC, b) AS b, max(words.n) AS most
  FROM pairs JOIN words ON b = words.word GROUP BY a),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {TIMES} * n THEN b END AS form,
    CASE WHEN most >= {TIMES} * n THEN most END AS form_n
  FROM words LEFT JOIN near USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON root = forms.word WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM chain JOIN forms USING (word)
WHERE root IN (SELECT word FROM forms WHERE form IS NULL)
"""
