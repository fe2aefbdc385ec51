"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from .url_filter import BLOCK_GLOBS, RULES

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _glob_regex(glob: str) -> str:
    out = ""
    for part in glob.replace("**", "\0").replace("*", "\1"):
        out += {"\0": "(.|\n)*", "\1": "[^/]*", "?": "(.|\n)", ".": "[.]"}.get(part, part)
    return out


_FITS = ", ".join(f"('{rule}', '{verdict}', {len(rule)})" for verdict, rule in RULES)
_EXTRA = " OR ".join(f"regexp_full_match(host || path, '{_glob_regex(g)}')" for g in BLOCK_GLOBS)

_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_GRAMS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

ORACLE: dict[str, str] = {
    # Checksums by the table method; the table of 256 numbers is eight steps of its recurrence.
    "op12_importance": f"""
WITH RECURSIVE steps(i, c, n) AS (
    SELECT i, i, 0 FROM range(256) t(i) UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM steps WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS entries FROM steps WHERE n = 8),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
doc_grams AS MATERIALIZED (SELECT r, unnest({_GRAMS}) AS g FROM docs),
target_grams AS MATERIALIZED (SELECT unnest({_GRAMS}) AS g FROM (SELECT {_WORDS} AS w FROM benchmark)),
kinds AS MATERIALIZED (SELECT g, hex(encode(g)) AS h FROM (SELECT g FROM doc_grams UNION SELECT g FROM target_grams)),
buckets AS MATERIALIZED (
    SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
        lambda c, b: xor(c // 256, entries[(xor(c, b) % 256) + 1])), 4294967295) % 10000 AS bucket FROM kinds, crc),
in_docs AS (SELECT bucket, count(*) AS s FROM doc_grams JOIN buckets USING (g) GROUP BY bucket),
in_target AS (SELECT bucket, count(*) AS t FROM target_grams JOIN buckets USING (g) GROUP BY bucket),
gains AS (
    SELECT b AS bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM doc_grams) + 10000))::DOUBLE
        / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM target_grams) + 10000))::DOUBLE))::BIGINT AS gain
    FROM range(10000) x(b) LEFT JOIN in_docs ON b = in_docs.bucket LEFT JOIN in_target ON b = in_target.bucket),
weights AS (
    SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM doc_grams JOIN buckets USING (g) JOIN gains USING (bucket) GROUP BY r),
scored AS (
    SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM docs LEFT JOIN weights USING (r)),
noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS k,
        count(*) OVER (PARTITION BY n_words >= 20) AS able FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= 25 * able // 100 THEN k END AS rank FROM ranked""",
    "op7_url_filter": f"""
WITH rules(rule, verdict, size) AS (VALUES {_FITS}),
cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
fit AS (
    SELECT p.*, r.rule, r.verdict, r.size FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules r
    ON (p.host = split_part(r.rule, '/', 1) OR ends_with(p.host, '.' || split_part(r.rule, '/', 1)))
    AND starts_with(p.path, substr(r.rule, strpos(r.rule, '/')))),
best AS (SELECT host, path, arg_max(rule, size) AS rule, arg_max(verdict, size) AS verdict FROM fit GROUP BY host, path)
SELECT p.page_id, p.host, p.path, b.rule,
    coalesce(b.verdict, CASE WHEN {_EXTRA.replace('host || path', 'p.host || p.path')} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path""",
}
