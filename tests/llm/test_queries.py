"""Queries with SQL against it, and models against held-out labels, on small given tables."""

import oracle_check
import pytest

import __spark_entry__ as registered
from ledgerloom.llm.oracles import ORACLES
from ledgerloom.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def connection():
    return oracle_check.oracle_connection(SMALL)


@pytest.mark.parametrize("key", ORACLES)
def test_query_equals_its_sql(spark, connection, key):
    assert oracle_check.compare(spark, connection, SMALL, key)


def test_all_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(registered.queries())


@pytest.mark.parametrize(
    "key, label, least", [("op5_toxicity", "toxic", 0.97), ("op7_quality_model", "quality", 0.95)]
)
def test_held_out_accuracy(spark, key, label, least):
    scored = QUERIES[key](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(rows) > 500
    assert sum(r[0] == r[1] for r in rows) / len(rows) >= least


def test_pipeline_keeps_what_brute_force_keeps(spark):
    """Each stage against its definition, on its own input."""
    import corpus_pipeline
    from ledgerloom.llm.common import stage

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    sizes = [docs.count()]
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(function(spark, docs, SMALL), name)
        if name != "tokenize":
            assert docs.columns == names
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert all(len(t.split()) < 20 or i in after or _repetitive(t) for i, t in before.items())
        if name == "line_dedup":
            for i, row in after.items():
                assert set(row["text"].split("\n")) <= set(before[i].split("\n"))
                assert row["n_chars"] == len(row["text"])
        if name == "near_dedup":
            assert len({before[i] for i in after}) == len(after)
        sizes.append(len(after))
    assert all(r["decoded_ok"] for r in after.values())
    assert sizes[-1] >= 0.6 * sizes[0]


def _repetitive(text):
    words = text.split()
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {p for i, r in enumerate(runs) if runs.count(r) > 1 for p in range(i, i + 8)}
    return 100 * len(covered) > 30 * len(words)
