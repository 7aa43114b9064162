"""The registered queries of this package: whole tables in, whole results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .conversation_repair import repair_digest
from .language_id import held_out, identify_language, train_on_documents
from .line_dedup import dedup_lines
from .minmax_hash import near_duplicate_classes
from .mixing import mix_digest
from .multi_index_hash import nearest
from .oracle import ORACLE_SQL  # noqa: F401  (read by __spark_entry__)
from .prefix_tokens import token_digest
from .quality import RULES, quality_rules
from .substring_dedup import drop_repeats
from .subword_sampling import sample_segmentations
from .token_alignment import alignment_digest
from .url_filter import judge_urls
from .warc import archive_round_trip


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-first verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", *[f"quality.{c}" for c in
                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                     "lost_words", *(f"n_{r}" for r in RULES))])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return judge_urls(read_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "block_score", "host_words")


def op3_subword_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with their ids and scores."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sample_segmentations(docs, tokenizer_file("piece_bpe_32k.model"), k=2).select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "perturbed", "log_inclusion",
        "decodes", "ids")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


def op5_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, similarity 0.85."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs, shingle=3, percent=85)


def op7_multi_index_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, by inner product."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizer files has ``name``."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; trained on rows not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_on_documents(docs)
    return identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document from its prefix counts."""
    docs = read_table(spark, sf_dir, "documents")
    return token_digest(docs, tokenizer_file("byte_bpe_50k.json"), limit=1024)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix_digest(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before, lines dropped and the digest of what stays, of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation, after damage."""
    return repair_digest(read_table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts, groups and links of two tokenizers over every document."""
    return alignment_digest(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                            tokenizer_file("piece_bpe_32k.model"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words before, words removed and the digest of what stays, of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeats(docs, min_words=20).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_url_filter": op2_url_filter,
    "op3_subword_sampling": op3_subword_sampling,
    "op4_warc": op4_warc,
    "op5_minmax_near_dedup": op5_minmax_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_multi_index_hash": op7_multi_index_hash,
    "op8_prefix_token_counts": op8_prefix_token_counts,
    "op9_mix_sources": op9_mix_sources,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_alignment": op12_token_alignment,
    "op13_substring_dedup": op13_substring_dedup,
}
