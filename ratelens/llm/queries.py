"""The registered queries of this package: every operator over its whole table, with its own parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import bitsliced, decontaminate, html, jaccard, language, lexical, lines, mixing, quality, scoring, secrets, shard, variants
from ratelens.llm.common import table


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_documents(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op3_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components_of(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.scanned(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.judged(docs, table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "ratio",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", "dropped", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.searched(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard": op1_shard,
    "op2_main_text": op2_main_text,
    "op3_katz_score": op3_katz_score,
    "op4_mix": op4_mix,
    "op5_secrets": op5_secrets,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_language": op7_language,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_top_k": op12_top_k,
    "op13_ranked_search": op13_ranked_search,
}
