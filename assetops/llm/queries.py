"""The queries of this subpackage by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetops.llm import bpe, centroids, decontaminate, fill_in_middle, language_id, line_dedup, lm_score, minhash_dedup, quality_rules, secret_scan, suffix_dedup, url_filter, warc
from assetops.storage import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_minhash_dedup(spark, sf_dir):
    return minhash_dedup.classes(table(spark, sf_dir, "documents")).drop("_node")


@query
def op2_decontaminate(spark, sf_dir):
    return decontaminate.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.deduped(table(spark, sf_dir, "documents"), texts=False)


@query
def op5_warc(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query
def op6_secret_scans(spark, sf_dir):
    return secret_scan.digest(table(spark, sf_dir, "documents"), run_folder(spark, "ledger"), "run-1")


@query
def op7_lm_scoring(spark, sf_dir):
    return lm_score.scored(table(spark, sf_dir, "documents"))


@query
def op8_url_filters(spark, sf_dir):
    return url_filter.judged(table(spark, sf_dir, "pages"))


@query
def op9_quality_rules(spark, sf_dir):
    # Which rule fails first depends on the order; the verdict does not.
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("failed_rule")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The text of a public tokenizer file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query
def op10_bpe(spark, sf_dir):
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op11_language_id(spark, sf_dir):
    return language_id.identified(table(spark, sf_dir, "documents"))


@query
def op12_centroids(spark, sf_dir):
    return centroids.digest(table(spark, sf_dir, "embeddings"))


@query
def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle.digest(table(spark, sf_dir, "documents"))
