"""Repair against a plain shortest-path search, and its edges."""

import hashlib
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversation_repair as cr
from ledgerloom.llm import queries
from ledgerloom.llm.oracles import CONVERSATION_REPAIR

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def every_repair(initials, faults, most):
    """(cost, audit) of all edit sequences with at most ``most`` insertions."""
    n = len(initials)
    choices = [
        [("D", 4, "")]
        + ([("K", 3 * (f == "t"), i)] if f not in "bd" else [])
        + ([("R", 3 + 3 * (f == "t"), r) for r in "ua"] if f not in "bd" else [])
        for i, f in zip(initials, faults)
    ]
    inserts = [p for k in range(most + 1) for p in itertools.product(("", "u", "a"), repeat=k) if "" not in p]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=n + 1):
            if sum(map(len, gaps)) > most:
                continue
            roles = audit = ""
            cost = 3 * sum(map(len, gaps))
            for k in range(n + 1):
                roles += "".join(gaps[k])
                audit += "I" * len(gaps[k])
                if k < n:
                    audit, cost, roles = audit + edits[k][0], cost + edits[k][1], roles + edits[k][2]
            if GRAMMAR.fullmatch(roles):
                yield cost, audit


def cheapest(initials, faults):
    """Least (cost, audit), row by row over what was said last."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    ways = {"": (0, "")}

    def with_inserts():
        more = dict(ways)
        for _ in range(3):
            for said, (cost, audit) in list(more.items()):
                to = "a" if said == "u" else "u"
                more[to] = min(more.get(to, (1 << 30, "")), (cost + 3, audit + "I"))
        return more

    for initial, fault in zip(initials, faults):
        following = {}
        for said, (cost, audit) in with_inserts().items():
            made = [(said, cost + 4, "D")]
            if fault not in "bd":
                extra = 3 * (fault == "t")
                made.append(("a" if said == "u" else "u", cost + 3 + extra, "R"))
                if initial in after[said]:
                    made.append((initial, cost + extra, "K"))
            for to, spent, edit in made:
                following[to] = min(following.get(to, (1 << 30, "")), (spent, audit + edit))
        ways = following
    return min(way for said, way in with_inserts().items() if said in ("", "a"))


def test_reference_is_exhaustive():
    shuffled = random.Random(3)
    for _ in range(40):
        n = shuffled.randint(0, 3)
        initials = "".join(shuffled.choice("sua-") for _ in range(n))
        faults = "".join(shuffled.choice("  tbd") for _ in range(n))
        assert cheapest(initials, faults) == min(every_repair(initials, faults, 2))


@pytest.mark.parametrize("roles, faults", [("uuuaaas-", "    ttbd"), ("ua", " t"), ("uas", "  b"), ("-", "t ")])
def test_search_is_cheapest_and_least(roles, faults):
    shuffled = random.Random(roles)
    for _ in range(1500):
        n = shuffled.randint(0, 14)
        initials = "".join(shuffled.choice(roles) for _ in range(n))
        found = "".join(shuffled.choice(faults) for _ in range(n))
        result = cr.search(initials, found)
        assert (result.cost, result.audit) == cheapest(initials, found), (initials, found)
        # bounds grow up to the cost, and the estimate is never above it
        assert result.bounds == sorted(set(result.bounds)) and result.bounds[-1] == result.cost


def test_estimates_never_exceed_the_cost_from_any_state():
    shuffled = random.Random(8)
    prefix = {"": cr.NOTHING, "s": cr.SYSTEM, "su": cr.USER, "ua": cr.ASSISTANT}
    for _ in range(600):
        n = shuffled.randint(0, 7)
        initials = "".join(shuffled.choice("uuaas-") for _ in range(n))
        faults = "".join(shuffled.choice("   ttbd") for _ in range(n))
        estimates = cr.Estimates.of(initials, faults)
        for said, state in prefix.items():
            # rows that are dear to change stand for what was said
            least = min(
                (cost for cost, audit in all_ways(said, initials, faults) if audit.startswith("K" * len(said))),
                default=None,
            )
            assert least is None or estimates.at(0, state) <= least


def all_ways(said, initials, faults):
    """Least cost with the rows said so far kept as they are."""
    kept = cheapest_from(said, initials, faults)
    return [(kept, "K" * len(said))]


def cheapest_from(said, initials, faults):
    last = said[-1:]
    memo = {}

    def least(i, last, inserts):
        key = (i, last, inserts)
        if key not in memo:
            options = []
            if i == len(initials):
                options += [0] if last in ("", "a") else []
            else:
                options.append(4 + least(i + 1, last, 0))
                if faults[i] not in "bd":
                    extra = 3 * (faults[i] == "t")
                    options.append(3 + extra + least(i + 1, "a" if last == "u" else "u", 0))
                    if initials[i] == ("a" if last == "u" else "u") or (initials[i] == "s" and last == ""):
                        options.append(extra + least(i + 1, initials[i], 0))
            if inserts < 3:
                options.append(3 + least(i, "a" if last == "u" else "u", inserts + 1))
            memo[key] = min(options, default=1 << 20)
        return memo[key]

    return least(0, last, 0)


def test_long_conversations():
    shuffled = random.Random(5)
    n = 30_000
    initials = "".join("ua"[i % 2] if shuffled.random() < 0.9 else shuffled.choice("ua") for i in range(n))
    faults = "".join(shuffled.choice(" " * 17 + "tbd") for _ in range(n))
    result = cr.search(initials, faults)
    assert (result.cost, result.audit) == cheapest(initials, faults)
    assert result.visits < 4 * n


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 3, "user", "Yes."),
    (2, None, None, None), (2, 5, "system", "Be good."), (2, 5, "system", "Be good."), (2, 9, "user", "cut off"),
    (3, 0, "user", " \t\n"), (4, None, "user", "Hm."), (4, None, "user", "Hm."), (4, 2, "user", "Hm."),
    (None, 0, "usher", "Why?"), (None, 1, "Assistant", "So! "), (5, 7, "assistant", "x" * 200_000 + "!"),
]


def test_rows_and_reports(spark):
    table = spark.createDataFrame(ROWS, SCHEMA).withColumns({"audit": F.lit("old"), "said": F.lit("old")})
    reports, rows = cr.repair(table.repartition(3))
    got = {r["conv_id"]: r for r in reports.collect()}
    assert {k: (r["audit"], r["cost"]) for k, r in got.items()} == {
        1: ("KKDKI", 7), 2: ("DKDKI", 14), 3: ("D", 4), 4: ("KDDI", 11), None: ("KR", 3), 5: ("IK", 3),
    }
    assert (got[1]["duplicate"], got[1]["gaps"], got[1]["illegal"]) == (1, 1, 1)
    assert (got[2]["blank"], got[2]["duplicate"], got[2]["truncated"], got[2]["gaps"]) == (1, 1, 1, 3)
    assert (got[4]["duplicate"], got[4]["gaps"]) == (2, 0)
    repaired = {}
    for r in sorted(rows.collect(), key=lambda r: (str(r["conv_id"]), r["position"])):
        repaired.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["edit"]))
    assert [r[::2] for r in repaired[1]] == [("user", "K"), ("assistant", "K"), ("user", "K"), ("assistant", "I")]
    assert repaired[None] == [("usher", "Why?", "K"), ("assistant", "So! ", "R")]
    assert repaired[5][0] == ("user", "", "I") and len(repaired[5][1][1]) == 200_001
    assert 3 not in repaired
    for digest in cr.row_digests(rows).collect():
        said = "\n".join(f"{role}:{text}" for role, text, _ in repaired[digest["conv_id"]])
        assert digest["sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert [d.count() for d in cr.repair(table.limit(0))] == [0, 0]


def test_query_on_edges_equals_its_sql(spark, tmp_path):
    rows = ROWS + [(6, t, "user", "gone.") for t in range(60)] + [(7, t, None, None) for t in range(60)]
    rows += [(k, None, "user", "All turns are null") for k in range(8, 60)]
    rows += [(k, t, ("user", "assistant")[t % 2], f"Turn {t}.") for k in range(60, 130) for t in range(k % 9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    result = queries.op11_conversation_repair(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')"
    )
    names = ", ".join(result.columns)
    expected = connection.sql(f"SELECT {names} FROM ({CONVERSATION_REPAIR})").fetchall()
    assert sorted(map(str, map(tuple, result.collect()))) == sorted(map(str, expected))
    assert result.where("audit = '' AND cost = 0").count() > 0
