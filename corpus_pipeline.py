"""From raw documents to tokens: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written to
the shared folder and read again before the next stage.  All but the last return
the columns of their input.  NULLs, empty texts, repeated rows, extra columns and
empty tables are handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.llm import bpe, decontaminate, line_dedup, minhash_dedup, quality_rules
from assetops.llm.queries import table, tokenizer_file
from assetops.storage import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.kept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in one of them; ``n_chars``
    follows the text."""
    out = line_dedup.deduped(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return minhash_dedup.deduped(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's number of tokens and digests of its ids and of what they decode to."""
    return bpe.digest(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("decontaminate", benchmark),
    ("bpe", tokens),
]

#: SQL can't express the near-duplicate and tokenizer stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
