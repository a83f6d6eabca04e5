"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    centroid_clusters,
    chat_format,
    conversation_repair,
    decontamination,
    host_quality,
    license_scan,
    line_alignment,
    near_duplicates,
    quality_model,
    repeated_spans,
    sentencepiece_lattice,
    toxicity,
    warc,
)
from ledgerloom.llm.common import same


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four best segmentations of each text; ids as a digest, and the check of the decoding."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_lattice.encode_texts(docs, carry=("doc_id",))
    return encoded.select(
        "doc_id",
        "n_pieces",
        F.sha2(F.array_join("piece_ids", " "), 256).alias("ids_sha256"),
        F.transform("n_best", lambda p: p["score"]).alias("scores"),
        "n_best",
        "decoded_ok",
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "kept"
    )


def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # the text isn't needed after its rules are counted
    judged = host_quality.judge(docs, carry=("doc_id", "source"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "any_failed",
        F.round("host_rate", 6).alias("host_rate"),
        "host_rejected",
        "kept",
    )


def op4_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_alignment.delete_shared_lines(docs).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))

    def held_out(doc_id: Column) -> Column:
        return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0

    settings = toxicity.Settings()
    rows = toxicity.training_rows(docs, labels, "toxic", held_out, settings.sample)
    lexicon = toxicity.learn(rows, settings)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), lexicon, carry=("doc_id",))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "lexicon_rate",
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.mark_leaks(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "leaked_items", "top_coverage"
    )


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))

    def held_out(doc_id: Column) -> Column:
        return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2

    settings = quality_model.Settings()
    rows = toxicity.training_rows(docs, labels, "quality", held_out, settings.sample)
    model = quality_model.learn(rows, settings)
    scored = quality_model.score_quality(docs.select("doc_id", "text"), model, carry=("doc_id",))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = warc.read_archives(warc.archive_pages(pages), with_payload=False)

    def page(reference: str) -> Column:
        return F.regexp_extract(reference, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page("refers_to_id").alias("refers_to"),
    )


def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_spans.remove_repeats(docs, carry=("doc_id",)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    conflicting = spark.sql(
        "SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text "
        f"FROM VALUES (-7, 0, 'user', '{said}'), (-7, 1, 'assistant', '{said}') "
        "AS t(conv_id, turn, role, text)"
    )
    chats = chat_format.format_chats(conversations.unionByName(conflicting))
    masked = chat_format.masked_text(F.col("rendered"), F.col("loss_spans"))
    chats = chats.withColumn("loss", masked)
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("rendered").cast("long").alias("formatted_chars"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as they arrive broken: by their number one in four is lost, emptied, unpunctuated, doubled or of another role."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    number = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    rows = conversations.select(
        "conv_id",
        "turn",
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        (F.crc32(number.cast("binary")) % 20).alias("fate"),
    ).where("fate <> 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    reports, rows = conversation_repair.repair(damaged(conversations))
    digests = conversation_repair.row_digests(rows)
    convs = conversations.select("conv_id").distinct()
    found = convs.join(reports, same(convs["conv_id"], reports["conv_id"]), "left").join(
        digests, same(convs["conv_id"], digests["conv_id"]), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        convs["conv_id"],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroid_clusters.cluster_vectors(vectors).select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs, carry=("doc_id",)).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_sentencepiece,
        op2_near_duplicates,
        op3_host_quality,
        op4_line_alignment,
        op5_toxicity,
        op6_decontamination,
        op7_quality_model,
        op8_warc,
        op9_repeated_spans,
        op10_chat_format,
        op11_conversation_repair,
        op12_centroid_clusters,
        op13_license_scan,
    )
}

# The tables that each query reads.
TABLES = {name: ("documents",) for name in QUERIES} | {
    "op5_toxicity": ("documents", "labels"),
    "op6_decontamination": ("documents", "benchmark"),
    "op7_quality_model": ("documents", "labels"),
    "op8_warc": ("pages",),
    "op10_chat_format": ("conversations",),
    "op11_conversation_repair": ("conversations",),
    "op12_centroid_clusters": ("embeddings",),
}
