"""From raw documents to shards of a training mix: five stages, each written and read back by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return
the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import decontaminate, jaccard, mixing, quality, shard
from ratelens.llm.common import staged, table


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, so that no other column clashes with a result."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; the raw corpus is ``docs``, the trusted ones come from labels."""
    return quality.judged(packed(docs), table(spark, sf_dir, "labels")).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the smallest doc_id."""
    return jaccard.survivors(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.scanned(packed(docs), table(spark, sf_dir, "benchmark")).where("not contaminated").select("row.*")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix; a document that it takes twice is there twice."""
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document of the mix."""
    return shard.shard_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("sharding", sharding),
]

#: SQL expresses neither the fitted ratios nor the hash tree; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
