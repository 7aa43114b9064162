"""The corpus pipeline: five stages, each written as Parquet and reread.

1. ``language_id``   documents whose language cannot be told go;
2. ``line_dedup``    lines that three or more documents share stay in one of them;
3. ``near_dedup``    of each class of near-copies the least doc_id stays
                     (five-word shingles, similarity 0.8);
4. ``mix_sources``   documents are dropped or repeated to meet the sources' targets;
5. ``subword_samples`` two sampled segmentations of every document that is left.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from local_folder import set_if_local  # noqa: E402
from quarry.llm.common import read_table, scratch_path  # noqa: E402
from quarry.llm.language_id import UNDETERMINED, identify_language, train_on_documents  # noqa: E402
from quarry.llm.line_dedup import dedup_lines  # noqa: E402
from quarry.llm.minmax_hash import near_duplicate_classes  # noqa: E402
from quarry.llm.mixing import mixed_documents  # noqa: E402
from quarry.llm.queries import tokenizer_file  # noqa: E402
from quarry.llm.subword_sampling import sample_segmentations  # noqa: E402

# The score of language identification below which no language is told, in
# equal shares: of four languages an equal share is 0.25, clean text of a known
# language is above 0.45.  With one language there is nothing to compare.
MIN_SHARES = 1.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects text that is null, has no letter, or fits no language (score
    below :data:`MIN_SHARES` equal shares).  Without labelled rows there is no
    model, and only null text and text without a letter go."""
    model = train_on_documents(docs)
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    told = F.col("lang_pred") != UNDETERMINED
    if len(model.languages) > 1:
        told &= F.col("score") >= MIN_SHARES / len(model.languages)
    return identify_language(docs, model).filter(told).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep; a document whose
    text had words and has none left goes, ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cleaned.filter(F.coalesce(~emptied, F.lit(True))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays.  Rows that repeat a doc_id are one
    document with several texts and stay together; rows without one stay."""
    dropped = (near_duplicate_classes(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(dropped, docs.doc_id == F.col("__gone"), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it.  Rows without words have size 0
    and are never taken; a null source is one source; repeated rows count apart."""
    return mixed_documents(docs)


def subword_samples(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of every row, with ids, scores and whether they decode
    to the text.  Null and empty text has one without pieces; repeated rows give the same."""
    return sample_segmentations(docs.select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"), k=2).select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "perturbed", "log_inclusion",
        "decodes", "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("subword_samples", subword_samples),
]

# A kernel classifier, pivotal rounding and seeded sampling have no SQL form;
# tests/llm/test_pipeline.py checks the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    set_if_local(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
