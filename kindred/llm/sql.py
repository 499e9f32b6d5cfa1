"""SQL twins of the queries that SQL can state."""

from kindred.llm.quality_rules import RULES, ladders

EXACT_DEDUP_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_points,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept,
    text_sha256
FROM d
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST)
"""

URL_FILTER_SQL = r"""
WITH u AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '://(.*)$', 1, 's') ELSE '' END AS rest FROM pages
), s AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM u
), p AS (
    SELECT page_id,
        translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
    FROM s
), r(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), m AS (
    SELECT p.page_id, host, path, rule_host || rule_path AS rule, verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS n
    FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""

WARC_SQL = r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

VECTOR_DEDUP_SQL = r"""
WITH RECURSIVE u AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reached.vec_id, links.b FROM reached JOIN links ON reached.other = links.a
), components AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counts AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""

_RATE = 0.02
_LADDERS = ladders(RULES)
_TESTS = ", ".join(
    f"({number}, {step}, '{name}', {cut!r}::DOUBLE)"
    for number, ladder in enumerate(_LADDERS)
    for step, cuts in enumerate(ladder)
    for name, cut in cuts.items()
)
_STATISTIC = " ".join(f"WHEN '{r.name}' THEN {r.statistic}" for r in RULES)

QUALITY_RULES_SQL = rf"""
WITH w AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), rep AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), cov AS (
    SELECT doc_id, sum(least(8, i - coalesce(before, i - 8)))::BIGINT AS n_repeat_words FROM rep GROUP BY doc_id
), f AS (
    SELECT w.doc_id, stratum, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN cov USING (doc_id)
), b AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f
), label AS (
    SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), tests(ladder, step, rule, cutoff) AS (
    VALUES {_TESTS}
), stat AS (
    SELECT doc_id, stratum, ladder, step, bool_or(coalesce(CASE rule {_STATISTIC} END > cutoff, false)) AS rejects
    FROM b, tests WHERE NOT base_failed GROUP BY ALL
), counts AS (
    SELECT stratum, ladder, step, count(*) FILTER (WHERE good) AS n,
        count(*) FILTER (WHERE good AND rejects) AS k, count(*) FILTER (WHERE NOT good AND rejects) AS junk,
        count(*) FILTER (WHERE NOT good) AS bad
    FROM stat JOIN label USING (doc_id) GROUP BY ALL HAVING count(*) FILTER (WHERE good) > 0
), tail AS (
    SELECT *,
        CASE WHEN k >= {_RATE!r} * n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
            lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE!r}) + (n - i) * ln(1 - {_RATE!r})))) END AS p,
        (SELECT count(DISTINCT stratum) FROM counts) * {len(_LADDERS)} AS n_tests
    FROM counts
), climbed AS (
    SELECT *, bool_and(p * n_tests <= 0.05) OVER (PARTITION BY stratum, ladder ORDER BY step) AS holds FROM tail
), chosen AS (
    SELECT stratum, ladder, step FROM climbed WHERE holds
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY junk DESC, CASE WHEN bad = 0 THEN -k ELSE k END, ladder, step) = 1
), rejected AS (
    SELECT DISTINCT doc_id FROM stat JOIN chosen USING (stratum, ladder, step) WHERE rejects
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM b
"""
