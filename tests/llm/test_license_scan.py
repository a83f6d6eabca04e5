"""License scan against all blocks and notices, and its edges."""

import random
import re
from math import ceil

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_words string, labels string"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(text, notices, threshold):
    """All (first word, notice, containment) by counting every block, and the phrases' places."""
    words = words_of(text)
    found = []
    for number, (_, notice) in enumerate(notices):
        own = words_of(notice)
        if not own:
            continue
        block = 16
        while block < 2 * len(own):
            block *= 2
        for start in range(0, max(len(words), 1), block // 2):
            common = len(set(own) & set(words[start : start + block]))
            if common >= ceil(threshold * len(set(own)) - 1e-9):
                found.append((start, number, common / len(set(own))))
    return words, sorted(found)


def scanned(spark, texts, **options):
    rows = [(i, text, "old", "old") for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r["doc_id"]: r for r in ls.scan_licenses(table, carry=("doc_id",), **options).collect()}


@pytest.mark.parametrize("threshold", [0.5, 0.85, 1.0])
def test_equals_counting_every_block(spark, threshold):
    shuffled = random.Random(threshold)
    common = [f"w{i}" for i in range(12)]
    notices = tuple(
        (f"l{n % 4}", " ".join(shuffled.choice(common + [f"rare{n}"]) for _ in range(shuffled.randint(1, 40))))
        for n in range(12)
    )
    texts = []
    for _ in range(150):
        text = [shuffled.choice(common + ["x", "y", "é", "Z9"]) for _ in range(shuffled.randint(0, 120))]
        if shuffled.random() < 0.5:
            at = shuffled.randint(0, len(text))
            passage = shuffled.choice(notices)[1].split()
            text[at:at] = [w for w in passage if shuffled.random() < 0.9]
        texts.append(shuffled.choice([" ", ", ", "\n"]).join(text).replace("w1", "W1"))
    texts += [texts[0]] * 70 + [None, ""]
    got = scanned(spark, texts, notices=notices, threshold=threshold, phrases=(("w1 w2", "pair"), ("w3", "three")))
    for i, text in enumerate(texts):
        words, found = plain(text, notices, threshold)
        # notices without words have no number of their own
        assert sorted((m["first_word"], m["notice"], m["containment"]) for m in got[i]["found"]) == found
        starts = [k for k in range(len(words)) if words[k : k + 2] == ["w1", "w2"]]
        singles = [k for k, w in enumerate(words) if w == "w3"]
        places = starts + singles
        assert (got[i]["n_words"], got[i]["n_base"]) == (len(words), len(places))
        assert got[i]["first_word"] == min(places, default=None) and got[i]["last_word"] == max(places, default=None)
        base = {x for x, own in (("pair", starts), ("three", singles)) if own}
        assert got[i]["base_labels"] == sorted(base)
        assert got[i]["labels"] == sorted(base | {notices[n][0] for _, n, _ in found})
        assert got[i]["score"] == (1.0 if base else max((c for *_, c in found), default=0.0))


def test_edges(spark):
    mit = ls.NOTICES[2][1]
    texts = [None, "", " \n", "MIT-License, mit license; MIT İ license", mit.replace(" ", "\n"), "x " * 40_000 + mit,
             "released under the license", "mit " * 30_000, "Licensed under CC BY-NC 4.0."]
    got = scanned(spark, texts)
    assert [got[i]["n_words"] for i in range(3)] == [0, 0, 0]
    # a no-break space is a character of words
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["base_labels"]) == (1, 0, ["mit"])
    assert got[4]["labels"] == got[5]["labels"] == ["mit"] and got[4]["base_labels"] == []
    assert got[4]["score"] == got[5]["score"] == 1.0 and {m["label"] for m in got[5]["found"]} == {"mit"}
    assert got[6]["labels"] == [] and got[6]["score"] == 0.0 and got[7]["score"] == 0.0
    assert (got[8]["base_labels"], got[8]["labels"]) == ([], ["cc"])
    table = spark.createDataFrame([(None, "Mit License", "a", "b"), (1, "x", "a", "b"), (1, "x", "a", "b")], SCHEMA)
    table = table.withColumn("row_key", F.lit("old")).withColumn("Best", F.lit("old"))
    result = ls.scan_licenses(table)
    assert result.columns == ["doc_id", "text", "row_key", "Best", *ls.NEW] and result.count() == 3
    assert ls.scan_licenses(table.limit(0)).count() == 0
    assert ls.scan_licenses(table, notices=()).where("score = 1").count() == 1
    with pytest.raises(ValueError):
        ls.scan_licenses(table, notices=(("big", " ".join(f"w{i}" for i in range(ls.MOST_WORDS + 1))),))
