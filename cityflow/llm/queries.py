"""The registered query of each operator: production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityflow.llm import (
    alignment,
    conversations,
    decontaminate,
    fingerprint,
    langid,
    ngram_join,
    packing,
    pii,
    quality,
    token_counts,
    token_files,
    url_rules,
    warc,
)
from cityflow.llm.common import held_out, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learned from."""
    return (
        table(spark, sf_dir, "labels")
        .where(~held_out())
        .select("doc_id", F.col("quality").alias("label"))
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents"))
    score = quality.fit(measured, quality_labels(spark, sf_dir)).score()
    return measured.select(
        "doc_id", held_out().alias("held_out"), F.round(score, 9).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        "captured", "range", "position",
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.redact(docs, count_col="n_mentions")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


# Fixed by the contract of the query.
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_rules.host_rule(*r) for r in HOST_RULES] + list(url_rules.WORD_RULES)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = decontaminate.removal_spans(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.report(spans).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    report = conversations.repair(conversations.damage(rows)).report
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    given = rows.select("conv_id").distinct().alias("g")
    joined = given.join(report.alias("r"), F.expr("g.conv_id <=> r.conv_id"), "left")
    return joined.select(
        "g.conv_id",
        *[F.coalesce(f"r.{n}", F.lit(0).cast("long")).alias(n) for n in counts],
        F.coalesce("r.audit", F.lit("")).alias("audit"),
        F.coalesce("r.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.align(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        digest.alias("groups_sha256"),
    )


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}

_FITS = " OR ".join(
    f"rule = '{(h + p).removesuffix('/')}/' AND (host = '{h}' OR ends_with(host, '.{h}')) "
    f"AND starts_with(path, '{p}')"
    for h, p, _ in HOST_RULES
)
_RULES = ", ".join(f"('{(h + p).removesuffix('/')}/', '{v}')" for h, p, v in HOST_RULES)
_WORDS = "|".join(url_rules.BLOCKED_WORDS)

ORACLES: dict[str, str] = {
    "op7_url_filters": f"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
    THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rest
), rules(rule, verdict) AS (VALUES {_RULES}),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule,
    arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON {_FITS}
  GROUP BY page_id
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN verdict
    WHEN regexp_matches(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '(^|[^a-z0-9])({_WORDS})([^a-z0-9]|$)')
      THEN 'block'
    ELSE 'allow' END AS verdict
FROM parts LEFT JOIN best USING (page_id)
""",
}
