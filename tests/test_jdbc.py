"""What the JDBC connectors ask of Spark; no database runs here."""

from collections import Counter
from datetime import date, datetime
from types import SimpleNamespace

import duckdb
import pytest

from ledgerloom.sinks import jdbc as sink
from ledgerloom.sources import SOURCES
from ledgerloom.sources import jdbc

ENDPOINT = jdbc.JdbcEndpoint("jdbc:x://h/d", "a.Driver", "me", "secret")


class Recorder:
    """Stands for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return self.told

    def save(self):
        return None

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, **properties}


@pytest.fixture
def session():
    return SimpleNamespace(read=Recorder())


def test_endpoints_come_from_the_environment():
    env = {
        "MYSQL_HOST": "db",
        "MYSQL_PORT": "3307",
        "MYSQL_DATABASE": "shop",
        "MYSQL_USER": "u",
        "MYSQL_PASSWORD": "p",
        "POSTGRES_DW_HOST": "dw",
        "POSTGRES_DW_DB": "house",
        "POSTGRES_DW_USER": "w",
        "POSTGRES_DW_PASSWORD": "q",
    }
    source, target = jdbc.mysql_endpoint(env), jdbc.postgres_endpoint(env)
    assert source.url == "jdbc:mysql://db:3307/shop"
    assert target.url == "jdbc:postgresql://dw:5432/house"
    assert (source.user, source.password) == ("u", "p")
    with_options = jdbc.mysql_endpoint({**env, "MYSQL_URL_OPTIONS": "useSSL=false"})
    assert with_options.url.endswith("/shop?useSSL=false")


def test_passwords_have_no_default_and_are_not_shown():
    with pytest.raises(KeyError, match="MYSQL_PASSWORD"):
        jdbc.mysql_endpoint({"MYSQL_DATABASE": "d", "MYSQL_USER": "u"})
    assert "secret" not in repr(ENDPOINT)


def test_table_read(session):
    told = jdbc.read_table(session, ENDPOINT, "orders")
    assert told["format"] == "jdbc" and told["dbtable"] == "orders"
    assert told["driver"] == "a.Driver" and "partitionColumn" not in told


def test_split_table_read(session):
    split = jdbc.RangeSplit("orderNumber", "1", "900", 9)
    told = jdbc.read_table(session, ENDPOINT, "orders", split)
    assert told["partitionColumn"] == "orderNumber"
    assert (told["lowerBound"], told["upperBound"], told["numPartitions"]) == ("1", "900", "9")


def test_query_read(session):
    told = jdbc.read_query(session, ENDPOINT, "SELECT 1 AS one")
    assert told["query"] == "SELECT 1 AS one" and "dbtable" not in told


def test_predicates_cover_every_row_once(session, spark):
    predicates = jdbc.bucket_predicates("key", 3)
    told = jdbc.read_table_by_predicates(session, ENDPOINT, "products", predicates)
    assert told["predicates"] == predicates and told["url"] == ENDPOINT.url
    rows = spark.sql("SELECT * FROM VALUES (-4), (-3), (0), (1), (2), (3), (NULL) AS t(key)")
    found = [r.key for p in predicates for r in rows.where(p).collect()]
    assert sorted(found, key=str) == sorted([-4, -3, 0, 1, 2, 3, None], key=str)


def test_tables_are_split_by_their_leading_key(monkeypatch):
    asked = {}

    def read(how):
        def record(session, endpoint, table, detail=None):
            asked[table] = (how, detail)
            return table

        return record

    monkeypatch.setattr(jdbc, "read_table", read("whole or range"))
    monkeypatch.setattr(jdbc, "read_table_by_predicates", read("predicates"))
    monkeypatch.setattr(jdbc, "conform", lambda df, table: df)
    monkeypatch.setattr(jdbc, "find_range", lambda s, e, table, column, n: (column, n))
    jdbc.load_sources(None, ENDPOINT, 3, "CRC32({column})")
    assert set(asked) == set(SOURCES)
    assert asked["orderdetails"] == ("whole or range", ("orderNumber", 3))
    assert asked["payments"] == ("whole or range", ("customerNumber", 3))
    how, predicates = asked["products"]
    assert how == "predicates" and len(predicates) == 3
    assert "CRC32(productCode)" in predicates[0]
    jdbc.load_sources(None, ENDPOINT)
    assert {detail for _, detail in asked.values()} == {None}


def parted(database, table, key, partitions):
    """Rows of each part; every row is in exactly one."""
    starts = database.execute(jdbc.heights_query(table, key, partitions)).fetchall()
    sizes, found = [], Counter()
    for predicate in jdbc.height_predicates(key, starts):
        rows = database.execute(f"SELECT row_id FROM {table} WHERE {predicate}").fetchall()
        sizes.append(len(rows))
        found.update(r[0] for r in rows)
    assert len(found) == database.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    assert set(found.values()) <= {1}
    return sizes


@pytest.mark.parametrize("partitions", [1, 2, 7, 32])
def test_heights_of_lines_with_a_hot_order(partitions):
    database = duckdb.connect()
    database.execute(
        r"""CREATE TABLE lines AS SELECT row_number() OVER () AS row_id,
              CASE WHEN hash(l_orderkey) % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,
              concat(l_partkey, '''\', l_suppkey, '-', row_number() OVER ()) AS code
            FROM read_parquet('/root/testdata/sf0.01/lineitem.parquet')"""
    )
    assert database.execute("SELECT avg((l_orderkey = 77)::int) FROM lines").fetchone()[0] > 0.3
    for key in (["l_orderkey", "code"], ["code"]):
        sizes = parted(database, "lines", key, partitions)
        assert len(sizes) == partitions and max(sizes) - min(sizes) <= 1


def test_heights_of_odd_tables():
    database = duckdb.connect()
    database.execute("CREATE TABLE t (row_id int, a int, b date)")
    assert parted(database, "t", ["a", "b"], 4) == [0]
    days = [None, date(2020, 1, 1), date(2020, 1, 2)]
    rows = [(a, b) for a in (None, -5, 0, 3) for b in days] * 2
    database.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, *row) for i, row in enumerate(rows)])
    database.execute("DELETE FROM t WHERE a IS NULL OR b IS NULL")
    # repeated keys stay together
    assert parted(database, "t", ["a", "b"], 3) == [4, 4, 4]
    assert parted(database, "t", ["a", "b"], 50) == [2] * 6
    # rows that come after the keys were asked for, NULLs among them, are in one part each
    predicates = jdbc.height_predicates(["a", "b"], [(-5, days[1]), (0, days[1]), (3, days[2])])
    for row in [*rows, (-99, days[1]), (99, days[2])]:
        database.execute("CREATE OR REPLACE TABLE one AS SELECT ?::int AS a, ?::date AS b", row)
        held = [database.execute(f"SELECT count(*) FROM one WHERE {p}").fetchone()[0] for p in predicates]
        assert sum(held) == 1


def test_literals_of_keys():
    assert jdbc.literal("it's a \\") == "'it''s a \\'"
    assert jdbc.literal("a\\' OR 1=1", backslash_escapes=True) == "'a\\\\'' OR 1=1'"
    assert jdbc.literal(date(2020, 1, 2)) == "DATE '2020-01-02'" and jdbc.literal(-4) == "-4"
    for odd in (True, 1.5, None, datetime(2020, 1, 2)):
        with pytest.raises(TypeError):
            jdbc.literal(odd)


def test_tables_are_split_by_height_of_their_whole_key(monkeypatch):
    asked = {}
    monkeypatch.setattr(jdbc, "conform", lambda df, table: df)
    monkeypatch.setattr(
        jdbc, "read_table_by_height", lambda s, e, table, key, n: asked.setdefault(table, (key, n))
    )
    jdbc.load_sources(None, ENDPOINT, 5, equal_height=True)
    assert set(asked) == set(SOURCES)
    assert asked["orderdetails"] == (["orderNumber", "productCode"], 5)
    assert asked["payments"] == (["customerNumber", "checkNumber"], 5)


def test_table_read_by_height(session, monkeypatch):
    starts = [(1, "a"), (2, "b\\")]
    monkeypatch.setattr(jdbc, "read_query", lambda s, e, q: SimpleNamespace(collect=lambda: starts))
    mysql = jdbc.JdbcEndpoint("jdbc:mysql://h/d", "a.Driver", "me", "secret")
    told = jdbc.read_table_by_height(session, mysql, "payments", ["k", "c"], 2)
    assert told["table"] == "payments" and len(told["predicates"]) == 2
    assert "'b\\\\'" in told["predicates"][1]


def test_table_write():
    writer = Recorder()
    df = SimpleNamespace(write=writer)
    sink.write_table(df, ENDPOINT, "house", "dim_date", connections=4)
    assert writer.told["dbtable"] == "house.dim_date" and writer.told["mode"] == "overwrite"
    assert writer.told["truncate"] == "true" and writer.told["numPartitions"] == "4"
    sink.write_table(df, ENDPOINT, "house", "dim_date", mode="append")
    assert writer.told["mode"] == "append"


def test_database_as_catalog():
    conf, statements = {}, []
    session = SimpleNamespace(
        conf=SimpleNamespace(set=conf.__setitem__), sql=statements.append
    )
    sink.register_catalog(session, "dw", ENDPOINT)
    sink.ensure_schema(session, "dw", "house")
    assert conf["spark.sql.catalog.dw"].endswith("JDBCTableCatalog")
    assert conf["spark.sql.catalog.dw.url"] == ENDPOINT.url
    assert statements == ["CREATE NAMESPACE IF NOT EXISTS `dw`.`house`"]
