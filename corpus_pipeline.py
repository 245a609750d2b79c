"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns those it keeps,
with the columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from devmetrics.llm.mixing import mix_rows
from devmetrics.llm.packing import pack
from devmetrics.llm.pii import pseudonymised
from devmetrics.llm.quality import quality_filter
from devmetrics.llm.setjoin import one_per_group
from devmetrics.llm.staging import Workspace


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that the set join connects."""
    return one_per_group(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pseudonymised(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of its source asks for."""
    return mix_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises the documents and packs them."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("pii_surrogates", surrogates),
    ("mixing", mixture),
    ("packing", sequences),
]

# The stages draw at random and fold over blocks; SQL cannot say the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else work.write(out, name)
    return docs
