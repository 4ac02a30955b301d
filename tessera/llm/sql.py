"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tessera.llm.queries import URL_HOST_RULES, url_block_words

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v) + "'" for v in r) + ")" for r in rows)


OP6 = f"""
WITH rules(rule, rule_verdict) AS (VALUES {_values(URL_HOST_RULES)}),
words(word) AS (VALUES {_values([(w,) for w in url_block_words()])}),
p AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
u AS (SELECT row_number() OVER () AS rn, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
fits AS (SELECT rn, max(struct_pack(len := length(rule), rule := rule, v := rule_verdict)) AS best FROM u JOIN rules
         ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
            AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY rn),
blocked AS (SELECT rn, max(struct_pack(len := length(word), word := word)) AS best FROM u JOIN words
            ON regexp_matches(host || path, '(?i)(^|[^A-Za-z0-9])' || word || '([^A-Za-z0-9]|$)') GROUP BY rn)
SELECT page_id, host, path, fits.best.rule AS rule,
       coalesce(fits.best.v, CASE WHEN blocked.best IS NOT NULL THEN 'block' END, 'allow') AS verdict, blocked.best.word AS pattern
FROM u LEFT JOIN fits USING (rn) LEFT JOIN blocked USING (rn)
"""

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rn, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT rn, doc_id, pos, line, translate(trim(line, {_TRIM}), {_AZ}) AS key FROM l),
owners AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (owner IS NOT NULL AND owner <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN owners USING (key) GROUP BY rn, k.doc_id
"""

_WORD = "'[^\\x20\\x09-\\x0D]+'"

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rn, doc_id, source, text, regexp_extract_all(text, {_WORD}) AS words FROM d),
x AS (SELECT rn, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT rn, i, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY rn ORDER BY i)),
twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, word, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT rn, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY rn),
l AS (SELECT rn, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT rn, doc_id, source, line, regexp_extract_all(line, {_WORD}) AS words FROM l),
lk AS (SELECT rn, doc_id, source, line, len(words) AS n, translate(array_to_string(words, ' '), {_AZ}) AS key FROM lw WHERE len(words) > 0),
dup AS (SELECT rn, count(*) - count(DISTINCT line) AS n_dup_lines FROM lk GROUP BY rn),
hosts AS (SELECT source, count(*) AS host_docs FROM (SELECT DISTINCT source, doc_id FROM d) GROUP BY source),
freq AS (SELECT source, key, count(*) AS n_docs FROM (SELECT DISTINCT source, key, doc_id FROM lk) GROUP BY source, key),
over AS (SELECT freq.source, key FROM freq JOIN hosts ON freq.source IS NOT DISTINCT FROM hosts.source WHERE n_docs > greatest(20.0, host_docs * 0.01)),
gone AS (SELECT rn, sum(n) AS removed FROM lk JOIN over ON lk.key = over.key AND lk.source IS NOT DISTINCT FROM over.source GROUP BY rn),
s AS (SELECT rn, doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda z: length(z))), 0) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
a AS (SELECT s.rn, doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(removed, 0) AS n_removed_words, n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
      FROM s LEFT JOIN dup USING (rn) LEFT JOIN covered USING (rn) LEFT JOIN gone USING (rn))
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words::BIGINT AS n_removed_words, base_failed,
       NOT base_failed AND NOT n_words - n_removed_words < 0.5 * n_words AS kept FROM a
"""

ORACLES = {"op10_quality": OP10, "op6_url_filter": OP6, "op8_line_dedup": OP8}
