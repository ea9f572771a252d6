"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaweave.llm import ann, decontaminate, embedding_whitening, language_id, line_dedup, merkle_manifest, mixing, ngram_join, quality_rules, sharding, suffix_dedup, toxicity, warc
from metaweave.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> F.Column:
    """A fifth of the documents, by crc32 of the id: nothing is learned from them."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its number of lines and the numbers of those that repeat, or nearly repeat, an earlier one."""
    kept = line_dedup.kept_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as an archive in the shared folder and describes what is read back from it."""
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.deduplicated_records(_table(spark, sf_dir, "pages")), path)
    back = warc.read_warc(spark, path).where(F.col("warc_type").isin("response", "revisit"))

    def page(c):
        return F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    response = F.col("warc_type") == "response"
    return back.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), page(F.col("refers_to")).alias("refers_to"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    filters = language_id.train(docs.where(~held_out()))
    named = language_id.identify(docs.select("doc_id", "text"), filters)
    return named.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "known_share")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies with their texts, in global random order; targets are the square roots of the sources' sizes."""
    return mixing.poisson_mixture(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return sharding.shard_rows(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs.where(~held_out()), _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "class_id", "n_links", "n_text_links")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontaminate.scan_contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(_table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_signals", ",").alias("failed_signals"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the id's crc32, the proof is shown a document with one more character in its count."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    forged = F.when(tampered, merkle_manifest.leaf_digest(docs, n_chars=F.col("n_chars") + 1))
    proven = merkle_manifest.manifest(docs, forged)
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle_manifest.siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_warc": op3_warc,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_ann": op8_ann,
    "op9_ngram_join": op9_ngram_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_quality_rules": op11_quality_rules,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}
