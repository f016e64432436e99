"""One query per operator: production parameters, the whole table, the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import bpe_automaton
from wayfare.llm.common import Query, ship_package, table
from wayfare.llm.decontaminate import contaminated
from wayfare.llm.jaccard_join import similar_components
from wayfare.llm.language_id import language_id
from wayfare.llm.lexical_search import search
from wayfare.llm.license_scan import license_scan
from wayfare.llm.packing import pack
from wayfare.llm.quality_knn import quality_scores
from wayfare.llm.quality_rules import quality_rules
from wayfare.llm.suffix_dedup import remove_repeats
from wayfare.llm.token_alignment import alignment_counts
from wayfare.llm.token_counts import token_counts
from wayfare.llm.warc import read_packages, write_packages
from wayfare.session import scratch_path


def vocabulary(name: str) -> str:
    """Where the box keeps a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return similar_components(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes, n_kept = F.octet_length("_bytes").cast("long"), F.octet_length("_kept").cast("long")
    return cut.select(
        "doc_id", n_bytes.alias("n_bytes"), (n_bytes - n_kept).alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, vocabulary("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    folder = scratch_path(spark, "warc")
    packages = write_packages(table(spark, sf_dir, "pages"), folder)
    return read_packages(packages, folder, ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return language_id(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = vocabulary("word_bpe_49k.json")
    both = bpe_automaton.decode(bpe_automaton.encode(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return alignment_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_language_id": op8_language_id,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_bpe_automaton": op12_bpe_automaton,
    "op13_token_alignment": op13_token_alignment,
}
