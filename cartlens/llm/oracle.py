"""DuckDB texts of the registered queries that SQL can express."""

from __future__ import annotations

from cartlens.llm.quality import RULES, STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP10 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n FROM d),
s AS (SELECT doc_id, unnest(range(1, n - 11)) AS i FROM n WHERE n >= 13),
win AS (SELECT s.doc_id, s.i, list_slice(n.w, s.i, s.i + 12) AS g FROM s JOIN n USING (doc_id)),
lo AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT win.doc_id, win.i + k.k AS p
         FROM win JOIN lo USING (g), range(13) k(k) WHERE lo.m < win.doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, n + 1)) AS p FROM n),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS c
         FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p
         WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_words,
       CAST(n.n - coalesce(kept.c, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM n LEFT JOIN kept USING (doc_id)
"""

_CHECKS = " AND ".join(
    [f"{r.feature} >= {r.low}" for r in RULES if r.low is not None]
    + [f"{r.feature} <= {r.high}" for r in RULES if r.high is not None])
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
           FROM documents),
win AS (SELECT r, i, w[i:i+2] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win)
        WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k.k) AS c FROM dup, range(3) k(k) GROUP BY r),
f AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
             len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(rep.c, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop,
             len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_alpha,
             len(list_filter(w, lambda x: regexp_matches(
                 x, '^\\P{{Ll}}*\\p{{Lu}}\\P{{Ll}}*\\p{{Lu}}\\P{{Ll}}*$'))) AS n_upper,
             len(list_filter(l, lambda x: regexp_matches(x, '^\\s*[-*\u2022]'))) AS n_bullet,
             len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|\u2026)\\s*$')))
                 AS n_ellipsis
      FROM d LEFT JOIN rep USING (r)),
q AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
             coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
             coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
             coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_word_ratio,
             coalesce(n_stop / nullif(n_words, 0), 0) AS stop_word_ratio,
             coalesce(n_alpha / nullif(n_words, 0), 0) AS alpha_word_ratio,
             coalesce(n_upper / nullif(n_words, 0), 0) AS upper_word_ratio,
             coalesce(n_bullet / nullif(n_lines, 0), 0) AS bullet_line_ratio,
             coalesce(n_ellipsis / nullif(n_lines, 0), 0) AS ellipsis_line_ratio,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
      FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {_CHECKS} AS kept
FROM q
"""

FOLDED = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {FOLDED} AS w FROM documents),
b AS (SELECT item_id, {FOLDED} AS w FROM benchmark),
bn AS (SELECT item_id, w, len(w) AS n FROM b WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, least(n, 10) AS k, w[i:i + least(n, 10) - 1] AS g
         FROM (SELECT item_id, w, n, unnest(range(1, greatest(n - 9, 1) + 1)) AS i FROM bn)),
win AS (SELECT r, i, ks.k AS k, w[i:i + ks.k - 1] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
             (SELECT DISTINCT k FROM item) ks WHERE i + ks.k - 1 <= len(w)),
hit AS (SELECT win.r, win.i, win.k, item.item_id FROM win JOIN item USING (k, g)),
word AS (SELECT r, count(DISTINCT i + x.x) AS n_hit FROM (SELECT DISTINCT r, i, k FROM hit),
                range(10) x(x) WHERE x.x < k GROUP BY r),
ids AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS t
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL)
        GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(ids.n, 0)::BIGINT AS n_items, sha256(coalesce(ids.t, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN ids USING (r)
"""

ORACLES: dict[str, str] = {"op5_quality": OP5, "op10_substring": OP10,
                           "op13_decontaminate": OP13}
