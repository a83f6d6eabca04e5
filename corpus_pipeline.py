"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontamination,
    host_quality,
    line_alignment,
    near_duplicates,
    sentencepiece_lattice,
)
from ledgerloom.llm.common import fresh_name, stage


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list]:
    """``docs`` with every column but the used ones under a name that no operator adds, and the columns
    that give the former ones back: a column of the user's keeps its values whatever its name."""
    names = {c: c if c in used else fresh_name(docs, f"column_{i}") for i, c in enumerate(docs.columns)}
    apart = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return apart, [F.col(n).alias(c) for c, n in names.items()]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host is rejected, go."""
    docs, columns = _apart(docs, "doc_id", "text", "source")
    return host_quality.judge(docs).where("kept").select(*columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks shared with an earlier document go; a text of which no word is left goes whole."""
    names = docs.columns
    docs, columns = _apart(docs, "doc_id", "text")
    cut = line_alignment.delete_shared_lines(docs)
    shorter = F.col("n_deleted") > 0
    emptied = shorter & (F.translate("kept_text", host_quality.SPACES, "") == "")
    own = dict(zip(names, columns))
    own["text"] = F.col("kept_text").alias("text")
    if "n_chars" in own:
        own["n_chars"] = F.when(shorter, F.length("kept_text").cast("long")).otherwise(own["n_chars"]).alias("n_chars")
    return cut.where(~emptied).select(*own.values())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    docs, columns = _apart(docs, "doc_id", "text")
    return near_duplicates.keep_one(docs).select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, columns = _apart(docs, "doc_id", "text")
    marked = decontamination.mark_leaks(docs, benchmark)
    return marked.where("not contaminated").select(*columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the best segmentation, its alternatives, and the check of the decoding."""
    return sentencepiece_lattice.encode_texts(docs, carry=("doc_id",))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

# Alignment, sampling, tiling and the lattice search have no SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
