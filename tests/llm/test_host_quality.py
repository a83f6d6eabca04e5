"""Host verdicts: which hosts are rejected, and why."""

import duckdb
import pytest

from ledgerloom.llm import host_quality, queries
from ledgerloom.llm.oracles import HOST_QUALITY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
GOOD = "These are twenty different words of a plain text that says nothing at all but breaks no rule of any kind today"


def rows(host, sound, failing, start):
    """Documents of a host; what fails has too many symbols, which is no base rule."""
    bad = GOOD + " " + "#" * 60
    texts = [f"{GOOD} {start + i}" for i in range(sound)] + [f"{bad} {start + i}" for i in range(failing)]
    return [(start + i, t, "en", host, len(t)) for i, t in enumerate(texts)]


HOSTS = {
    "good": (900, 30), "also good": (300, 12), "bad": (20, 180), "small and bad": (0, 1), "small": (2, 1),
    "twice as bad": (170, 25), None: (10, 90), "": (5, 0),
}


@pytest.fixture(scope="module")
def docs(spark):
    table, start = [], 0
    for host, (sound, failing) in HOSTS.items():
        table += rows(host, sound, failing, start)
        start += 10_000
    return spark.createDataFrame(table, SCHEMA)


def test_hosts_go_by_their_posterior(spark, docs):
    judged = host_quality.judge(docs).collect()
    rejected = {r["source"]: r["host_rejected"] for r in judged}
    # one failure of one document proves nothing, nor does a rate that is not clearly beyond the limit
    assert rejected == {h: h in ("bad", None) for h in HOSTS}
    assert all(not r["base_failed"] for r in judged)
    assert {r["source"] for r in judged if not r["kept"]} == {"bad", None}
    assert all(r["kept"] for r in judged if r["source"] == "good" and r["any_failed"])
    # a stricter limit reaches the host in doubt, a larger factor none
    strict = host_quality.Settings(reject_factor=1.0, reject_deviations=0.0)
    assert {r["source"] for r in host_quality.judge(docs, settings=strict).where("host_rejected").collect()} >= {"bad"}
    loose = host_quality.Settings(reject_factor=9.0)
    assert host_quality.judge(docs, settings=loose).where("host_rejected").count() == 0


def test_the_prior_shrinks_small_hosts(spark, docs):
    rates = {r["source"]: r["host_rate"] for r in host_quality.judge(docs).select("source", "host_rate").distinct().collect()}
    failed = sum(f for _, f in HOSTS.values()) / sum(map(sum, HOSTS.values()))
    assert failed < rates["small and bad"] < 1 and 0 < rates[""] < failed
    assert abs(rates["good"] - 30 / 930) < 0.01


def test_query_with_rejected_hosts_equals_its_sql(spark, docs, tmp_path):
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    result = queries.op3_host_quality(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    expected = connection.sql(f"SELECT {', '.join(result.columns)} FROM ({HOST_QUALITY})").fetchall()
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, expected))
    assert result.where("host_rejected").count() == 300
