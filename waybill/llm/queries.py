"""The registered queries of the ten operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (
    bpe, collocations, decontaminate, html_text, license_scan, ngram_join, packing, quality_rules, substring_dedup, token_counts, toxicity, url_filter, whitening,
)
from waybill.sources.scratch import stored

URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = url_filter.build_index(spark, URL_RULES)
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), index).drop("url")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(documents, packing.tokenizer_file("piece_bpe_32k.model")).drop("text")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lm = toxicity.language_model(documents)
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), lm)
    return toxicity.score(documents, model, lm)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = stored(quality_rules.measured(table(spark, sf_dir, "documents")).drop("text", "source", "n_chars", "lang"), "op5")
    certified = stored(quality_rules.cutoffs(features, table(spark, sf_dir, "labels")), "op5")
    return quality_rules.judged(features, certified).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_file("word_bpe_49k.json"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN, out="ids", decoded="decoded")  # ids, then their bytes
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), min_count=10, top=2000)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"), components=4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_join": op3_ngram_join,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_text": op6_html_text,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_decontaminate": op9_decontaminate,
    "op10_packing": op10_packing,
    "op11_bpe": op11_bpe,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op1_url_filter": r"""
        WITH part AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), judged AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM part
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged
    """,
    "op12_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), p AS (
            SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM d
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p
        ), g AS (
            SELECT lang, ws[i] AS a1, ws[i + 1] AS a2, ws[i + 2] AS a3
            FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0)
        ), uni AS (
            SELECT lang, a1 AS w, count(*) AS f FROM g GROUP BY lang, a1
        ), n AS (
            SELECT lang, sum(f) AS n FROM uni GROUP BY lang
        ), bi AS (
            SELECT lang, a1, a2, count(*) AS f FROM g WHERE a2 IS NOT NULL GROUP BY lang, a1, a2
        ), tri AS (
            SELECT lang, a1, a2, a3, count(*) AS f FROM g WHERE a3 IS NOT NULL GROUP BY lang, a1, a2, a3
        ), two AS (
            SELECT b.lang, b.a1 || ' ' || b.a2 AS phrase, b.f AS a, u1.f AS l, u2.f AS r
            FROM bi b JOIN uni u1 ON u1.lang = b.lang AND u1.w = b.a1 JOIN uni u2 ON u2.lang = b.lang AND u2.w = b.a2
            WHERE b.f >= 10 AND NOT EXISTS (
                SELECT 1 FROM tri t WHERE t.lang = b.lang AND t.f >= 10 AND 100 * t.f >= 50 * b.f
                  AND ((t.a1 = b.a1 AND t.a2 = b.a2) OR (t.a2 = b.a1 AND t.a3 = b.a2)))
        ), three AS (
            SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3 AS phrase, t.f AS a,
                   u1.f AS l1, b23.f AS r1, b12.f AS l2, u3.f AS r2
            FROM tri t
            JOIN uni u1 ON u1.lang = t.lang AND u1.w = t.a1
            JOIN uni u3 ON u3.lang = t.lang AND u3.w = t.a3
            JOIN bi b12 ON b12.lang = t.lang AND b12.a1 = t.a1 AND b12.a2 = t.a2
            JOIN bi b23 ON b23.lang = t.lang AND b23.a1 = t.a2 AND b23.a2 = t.a3
            WHERE t.f >= 10
        ), scored AS (
            SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM two
            UNION ALL
            SELECT lang, phrase, a,
                   CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
            FROM (SELECT *, (1000000::HUGEINT * a * a) // (l1::HUGEINT * r1) AS s1, (1000000::HUGEINT * a * a) // (l2::HUGEINT * r2) AS s2 FROM three)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM scored
        )
        SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked r JOIN n ON n.lang = r.lang
        WHERE rank <= 2000
    """,
}
