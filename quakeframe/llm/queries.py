"""The registered queries of this package and their comparison SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quakeframe.llm import bpe, collocations, divergence, exact_dedup, language, mixing, multiset, near_dedup, redirects, sanitise, spans, token_files, toxicity
from quakeframe.llm.common import table


TOKENIZER = "word_bpe_49k.json"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.fingerprints(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.without_repeats(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.judged(table(spark, sf_dir, "pages"), redirects.default_rules(spark))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language, op2_token_files, op3_fingerprints, op4_substring_dedup, op5_exact_dedup, op6_mixing, op7_url_filter, op8_bpe,
    op9_toxicity, op10_near_dedup, op11_divergence, op12_collocations, op13_personal_data,
)}

ORACLES = {
    "op5_exact_dedup": """
        WITH n AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM n WINDOW g AS (PARTITION BY text_sha256)""",
    # The pages name no redirect or canonical target, which the first part checks; then no URL hears of another.
    "op7_url_filter": r"""
        WITH linked AS (
            SELECT count(*) AS n FROM pages
            WHERE regexp_matches(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical') OR regexp_matches(html, '(?is)<meta\b[^>]*http-equiv\s*=\s*["'']?refresh')
        ), parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), rules(rule_host, rule_path, v) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ), best AS (
            SELECT p.page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(v, length(rule_host || rule_path)) AS v
            FROM parts p JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY p.page_id
        )
        SELECT p.page_id, host, path, rule, coalesce(v, CASE WHEN n = 0 THEN 'allow' END) AS verdict
        FROM parts p LEFT JOIN best USING (page_id), linked""",
    "op11_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), found AS (
            SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), counts AS (
            SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM found GROUP BY lang, source, term
        ), kept AS (
            SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 10
        ), langs AS (
            SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY lang
        ), groups AS (
            SELECT DISTINCT lang, source FROM d
        ), sizes AS (
            SELECT c.lang, c.source, sum(c.n) AS size FROM counts c JOIN kept k ON c.lang = k.lang AND c.term = k.term GROUP BY c.lang, c.source
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.size, 0) + 2 * l.v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (k.n + 2)) // (l.size + 2 * l.v)::HUGEINT AS q
            FROM groups g JOIN langs l ON g.lang = l.lang JOIN kept k ON g.lang = k.lang
            LEFT JOIN sizes s ON g.lang = s.lang AND g.source = s.source
            LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ), every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS r, lang, piece FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents) AS x
        ), lists AS (
            SELECT r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), words AS (
            SELECT r, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM lists
        ), suffixes AS (
            SELECT lang, w1, lead(w1, 1) OVER (PARTITION BY r ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY r ORDER BY i) AS w3 FROM words
        ), one AS (
            SELECT lang, w1, count(*)::HUGEINT AS f FROM suffixes GROUP BY lang, w1
        ), two AS (
            SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM suffixes WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10
        ), three AS (
            SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM suffixes WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
        ), longer AS (
            SELECT lang, w1, w2, max(f) AS most FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) AS x GROUP BY lang, w1, w2
        ), pairs AS (
            SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, 1000000::HUGEINT * t.f * t.f // (x.f * y.f) AS score
            FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
            LEFT JOIN longer m ON m.lang = t.lang AND m.w1 = t.w1 AND m.w2 = t.w2
            WHERE m.most IS NULL OR 100 * m.most < 50 * t.f
        ), cuts AS (
            SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x1.f AS l1, y1.f AS r1, x2.f AS l2, y2.f AS r2,
                   1000000::HUGEINT * t.f * t.f // (x1.f * y1.f) AS s1, 1000000::HUGEINT * t.f * t.f // (x2.f * y2.f) AS s2
            FROM three t JOIN one x1 ON x1.lang = t.lang AND x1.w1 = t.w1 JOIN two y1 ON y1.lang = t.lang AND y1.w1 = t.w2 AND y1.w2 = t.w3
            JOIN two x2 ON x2.lang = t.lang AND x2.w1 = t.w1 AND x2.w2 = t.w2 JOIN one y2 ON y2.lang = t.lang AND y2.w1 = t.w3
        ), scored AS (
            SELECT lang, phrase, a, l, r, score FROM pairs
            UNION ALL
            SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts
        ), sizes AS (
            SELECT lang, sum(f) AS n FROM one GROUP BY lang
        ), ranked AS (
            SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
            FROM scored s JOIN sizes z ON z.lang = s.lang
        )
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked WHERE rank <= 2000""",
}
