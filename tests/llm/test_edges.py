"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chat_format,
    decontamination,
    host_quality,
    line_alignment,
    near_duplicates,
    quality_model,
    repeated_spans,
    sentencepiece_lattice,
    toxicity,
    warc,
)

WORDS = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"x{i % 7919}" for i in range(30_000))
ROWS = [
    (1, WORDS, "en", "a", 0),
    (2, WORDS, "en", "a", 0),
    (2, WORDS, "en", "a", 0),  # repeated row
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "en", None, 0),
    (None, "a text without an id", "en", "b", 0),
    (None, None, "en", "b", 0),
    (6, LONG, "en", "b", 0),
    (6, "another text of the same id", "en", "b", 0),
    (7, "one", "en", "b", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BENCHMARK = "item_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(df, *names):
    return df.withColumns({n: F.lit("old") for n in names})


def ids(df):
    return sorted((r[0] is None, r[0] or 0) for r in df.select("doc_id").collect())


EXPECTED = sorted((r[0] is None, r[0] or 0) for r in ROWS)

OPERATORS = {
    "encode": lambda s, d: sentencepiece_lattice.encode_texts(clashing(d, "piece_ids", "N_Best")),
    "near": lambda s, d: near_duplicates.near_duplicates(clashing(d, "text_id", "root", "bands")),
    "host": lambda s, d: host_quality.judge(clashing(d, "n_words", "host", "kept", "words")),
    "lines": lambda s, d: line_alignment.delete_shared_lines(clashing(d, "kept_text", "gone_id", "line")),
    "toxic": lambda s, d: toxicity.score_toxicity(
        clashing(d, "score", "label"), toxicity.Lexicon((("idiot", 3.0),), ())
    ),
    "leaks": lambda s, d: decontamination.mark_leaks(
        clashing(d, "contaminated", "leak_id", "seed"),
        s.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7"), (2, None), (None, "")], BENCHMARK),
    ),
    "quality": lambda s, d: quality_model.score_quality(clashing(d, "Score"), quality_model.train([])),
    "spans": lambda s, d: repeated_spans.remove_repeats(clashing(d, "kept_text", "found_id", "spans")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back(spark, docs, name):
    result = OPERATORS[name](spark, docs)
    assert ids(result) == EXPECTED
    assert len({c.lower() for c in result.columns}) == len(result.columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, docs, name):
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


@pytest.mark.parametrize("name, function", corpus_pipeline.STAGES)
def test_stages_take_the_edges(spark, docs, name, function):
    for table in (docs, docs.limit(0)):
        result = function(spark, table, "/root/testdata/sf0.001")
        assert result.count() <= table.count()


@pytest.mark.parametrize("name, function", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns_they_are_given(spark, name, function):
    """Columns with the names that operators add keep their own values."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    added = ("kept", "n_words", "n_deleted", "Kept_Text", "contaminated", "top_coverage", "class_id", "host", "text_id", "row")
    mine = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in added})
    result = function(spark, mine, "/root/testdata/sf0.001")
    assert result.columns == mine.columns
    rows = result.collect()
    assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in added)
    without = function(spark, docs, "/root/testdata/sf0.001")
    assert sorted(map(str, result.select(*docs.columns).collect())) == sorted(map(str, without.collect()))


def test_defined_results(spark, docs):
    spans = OPERATORS["spans"](spark, docs).collect()
    assert {(r["n_words"], r["n_removed"]) for r in spans if r["doc_id"] == 2} == {(60, 60)}
    assert {r["kept_text"] for r in spans if r["doc_id"] in (3, 4, 5)} == {""}
    near = {(r["doc_id"], r["class_id"], r["kept"]) for r in OPERATORS["near"](spark, docs).collect()}
    assert {(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True)} <= near
    lines = OPERATORS["lines"](spark, docs).collect()
    assert {(r["kept_text"], r["n_deleted"]) for r in lines if r["doc_id"] in (1, 2)} == {(WORDS, 0), ("", 1)}
    assert [r["kept_text"] for r in lines if r["doc_id"] == 3] == [None]
    leaks = {r["doc_id"] for r in OPERATORS["leaks"](spark, docs).where("contaminated").collect()}
    assert leaks == {1, 2}
    one = near_duplicates.keep_one(docs)
    assert one.columns == docs.columns and one.where("doc_id = 2").count() == 0


def test_learning_without_rows(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    never = lambda _: F.lit(False)
    rows = toxicity.training_rows(docs, labels, "toxic", never, 10)
    assert toxicity.learn(rows).entries == ()
    assert quality_model.learn(rows.withColumn("label", F.col("label"))).bias == 0.0


def test_warc_edges(spark):
    same_text = "é" * 600
    rows = [(1, "u", same_text), (2, None, same_text), (9, "u\r\nx: y", same_text), (3, "u", None), (4, "u", ""),
            (4, "u", ""), (None, None, "x" * 2000), (5, "u", "x" * 2000), (6, "u", "é" * 400), (7, "u", "é" * 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = clashing(pages, "payload", "refers_to", "digest_of", "revisit_id")
    index = warc.archive_pages(pages)
    got = sorted(
        (r["record_id"], r["warc_type"], r["refers_to_id"] or "", r["payload_bytes"])
        for r in warc.read_archives(index).collect()
    )
    page = warc.record_id
    assert got == sorted(
        [(page(1), "revisit", page(9), 1200), (page(2), "revisit", page(9), 1200), (page(9), "response", "", 1200),
         (page(3), "response", "", 0), (page(4), "response", "", 0), (page(4), "response", "", 0),
         (page("null"), "revisit", page(5), 2000), (page(5), "response", "", 2000),
         (page(6), "response", "", 800), (page(7), "response", "", 800)]
    )
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).count() == 0


def test_chat_edges(spark):
    said = ["</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST]", None, "", "<", "</s", "[s> <INST]", "\n", "ü" * 5000]
    rows = [(1, i, role, text) for i, text in enumerate(said) for role in ("user", "assistant")]
    rows += [(2, None, None, "x"), (2, 0, "a</s>[/INST]b", "y"), (2, 0, "a</s>[/INST]b", "y"), (None, 1, "user", "z")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    result = chat_format.format_chats(clashing(chats, "rendered", "row"))
    got = {r["conv_id"]: r for r in result.collect()}
    assert set(got) == {1, 2, None} and all(r["identical"] for r in got.values())
    assert [t["text"] for t in got[1]["turns"] if t["role"] == "user"] == [t or "" for t in said]
    assert len(got[2]["turns"]) == 3 and got[2]["turns"][0]["role"] == ""
    loss = result.select("conv_id", chat_format.masked_text(F.col("rendered"), F.col("loss_spans")).alias("x"))
    assert {r["conv_id"]: r["x"] for r in loss.collect()}[1] == "".join(t or "" for t in said)
    assert chat_format.format_chats(chats.limit(0)).count() == 0


