"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept, and all but the last return the columns of ``documents``:
languages that are none of the corpus' go, one document of each near-duplicate class stays, documents that hold a
benchmark window go, sources are replicated to their target weights, and what is left is dealt into shards.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns are treated as
the operators' modules say; a null or letterless text ends at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.llm import decontaminate, language_id, mixing, ngram_join, sharding
from metaweave.llm.common import written
from metaweave.llm.queries import held_out

#: A text of which a smaller part of the n-grams is known in the winning language is in none of the languages.
MIN_KNOWN_SHARE = 0.2


def _own_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` alone, under their own names: operators keep them first and rename those that clash."""
    return out.toDF(*[f"c{i}" for i in range(len(out.columns))]).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in no learned language."""
    named = language_id.identify(docs, language_id.train(docs.where(~held_out())))
    return _own_columns(named.where((F.col("lang_pred") != language_id.UND) & (F.col("known_share") >= MIN_KNOWN_SHARE)), docs)


def keep_one_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of documents with a shingle similarity of 0.8 or more."""
    return ngram_join.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _own_columns(decontaminate.remove_documents(decontaminate.scan_contamination(docs, benchmark)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicates documents so that sources weigh as the square roots of their sizes; shuffles all copies."""
    return _own_columns(mixing.poisson_mixture(docs), docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard`` and ``slot`` of a uniform shuffle into shards of equal row counts."""
    return sharding.shard_rows(docs, stored=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", keep_one_of_class),
    ("decontaminate", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Language filters, hashed draws and the shuffle are beyond SQL; tests hold each stage against its brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
