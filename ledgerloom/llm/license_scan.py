"""License scan by an exact set-similarity join of text blocks and license notices.

1. Texts are lower-cased in A-Z and cut into words: runs of ASCII letters, digits and characters beyond ASCII. A
   notice of ``L`` words is looked for in blocks of the least power of two of at least ``2 * L`` (and 16) words, one starting
   every half block, so that a passage of ``L`` words always lies whole in some block.
2. A block meets a notice if it has at least ``threshold`` of the notice's different words (its containment): with ``n`` of
   them, ``need = ceil(threshold * n)``.
3. All words of notices are ordered by the number of texts that have them, rarest first, counted over all texts. A block
   is thought of as the set of those of its words that some notice has; no other word can add to an overlap.
   *Prefix*: two sets share ``need`` words only if the first ``n - need + 1`` of the notice and the first
   ``m - need + 1`` of the block have one in common. Only blocks with such a word are made, and they meet notices by an equi-join on it.
   *Length*: ``m >= need``. *Positions*: what is left behind the common word on both sides must reach ``need``. What passes is
   counted in full, once for each pair, at its rarest common word. Nothing is lost and nothing is approximate.
4. Beside that, places are found where the words of a fixed phrase follow each other.

Words are looked up by a 64-bit hash and then compared byte by byte. Notices are a curated table: their
words go to every task, and more than ``MOST_WORDS`` of them raise. Texts are read twice, once to count
words and once for blocks; only blocks with a rare word of a notice leave a task.

A null text is an empty one; it has no words and no labels. Rows are told apart by their place, so repeated ids and rows each
have their own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.common import (
    Words,
    fresh_name,
    hash_words,
    longs,
    map_arrow,
    ship,
    shuffles_removed,
    space_table,
    stage,
    text_blocks,
)

THRESHOLD = 0.85
LEAST_BLOCK = 16
MOST_WORDS = 100_000

# Phrases and the labels they stand for.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Notices by which authors put a work under a license, and families of licenses.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc", "Licensed under CC BY 4.0."),
    ("cc", "Licensed under CC BY-SA 4.0."),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

# All ASCII characters but digits and lower-case letters part words, once A-Z are lower-cased.
_GAPS = space_table(bytes(b for b in range(128) if not chr(b).isalnum() or chr(b).isupper()))
NEW = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "found", "score")


def _lowered(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, bounds in text_blocks(column):
        own = data[bounds[0] : bounds[-1]].copy()
        own[(own >= 65) & (own <= 90)] += 32
        yield at, to, hash_words(own, bounds - bounds[0], _GAPS)


def _word(words: Words, i: int) -> bytes:
    return words.data[words.starts[i] : words.ends[i]].tobytes()


@dataclass
class Notice:
    label: str
    words: list[bytes]  # in order of the text

    @property
    def block(self) -> int:
        return max(LEAST_BLOCK, 1 << (2 * len(self.words) - 1).bit_length())


def _split(texts: list[str | None]) -> list[tuple[list[bytes], list[int]]]:
    """Words and their hashes of each text."""
    split = []
    for _, _, words in _lowered(pa.array(texts, pa.string())):
        for low, high in zip(words.first[:-1], words.first[1:]):
            split.append(([_word(words, i) for i in range(low, high)], words.hashes[low:high].tolist()))
    return split


class _Vocabulary:
    """The notices' words by their rank, rarest first, and the notices as sets of ranks."""

    def __init__(self, hashes: dict[bytes, int], texts: dict[int, int], notices: list[Notice], threshold: float) -> None:
        self.words = sorted(hashes, key=lambda w: (texts.get(hashes[w], 0), w))
        rank = {w: r for r, w in enumerate(self.words)}
        by_hash = sorted((hashes[w], r) for w, r in rank.items())
        self.hashes = np.array([h for h, _ in by_hash], np.uint64)
        self.ranks = np.array([r for _, r in by_hash], np.int64)
        # (label, block, need, ranks) of each notice with words
        self.sets = [
            (n.label, n.block, ceil(threshold * len(set(n.words)) - 1e-9), sorted({rank[w] for w in n.words}))
            for n in notices
        ]
        self.least = {b: min(s[2] for s in self.sets if s[1] == b) for b in {s[1] for s in self.sets}}
        self.rare = {b: np.zeros(len(self.words), bool) for b in self.least}
        for _, block, need, ranks in self.sets:
            self.rare[block][ranks[: len(ranks) - need + 1]] = True

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes that are known, and their ranks."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[slot] == hashes)
        return at, self.ranks[slot[at]]


def _texts_with(texts: DataFrame, hashes: np.ndarray) -> dict[int, int]:
    """For each of some words' hashes (sorted), the number of texts that have it, over all texts."""

    def count(batches):
        total = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for _, _, words in _lowered(batch.column(0)):
                slot = np.minimum(np.searchsorted(hashes, words.hashes), len(hashes) - 1)
                at = np.flatnonzero(hashes[slot] == words.hashes)
                once = np.unique(words.rows()[at] * len(hashes) + slot[at])
                total += np.bincount(once % len(hashes), minlength=len(hashes))
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([longs(hashes[own]), pa.array(total[own])], ["word", "texts"])

    if not len(hashes):
        return {}
    ship(texts.sparkSession)
    with shuffles_removed(texts.sparkSession):
        rows = texts.mapInArrow(count, "word long, texts long").groupBy("word").agg(F.sum("texts").alias("texts"))
        return {r["word"] % (1 << 64): r["texts"] for r in rows.collect()}  # as many as notices have words


def _phrase_places(words: Words, phrases: list[tuple[list[bytes], list[int], str]]) -> list[tuple[int, str]]:
    """Places (word of all texts, label) of the phrases, in order."""
    places = []
    ends = words.row_ends()
    for own, hashes, label in phrases:
        at = np.flatnonzero(words.hashes == np.uint64(hashes[0]))
        at = at[at + len(own) <= ends[at]]
        for k in range(1, len(own)):
            at = at[words.hashes[at + k] == np.uint64(hashes[k])]
        places += [(int(i), label) for i in at if all(_word(words, i + k) == w for k, w in enumerate(own))]
    return sorted(places)


def _rare_blocks(words: Words, vocabulary: _Vocabulary) -> Iterator[tuple[int, dict]]:
    """Blocks (text, block) with a rare word of a notice and as many known words as one needs."""
    known, ranks = vocabulary.look_up(words.hashes)
    texts = np.searchsorted(words.first, known, "right") - 1
    for block, rare in vocabulary.rare.items():
        half = block // 2
        hits = np.flatnonzero(rare[ranks])
        rows, last = texts[hits], (known[hits] - words.first[texts[hits]]) // half
        # a word lies in the block that starts in its half and in the one before
        pairs = np.concatenate([np.stack([rows, last], 1), np.stack([rows, last - 1], 1)[last > 0]])
        for row, number in np.unique(pairs, axis=0).tolist():
            start = int(words.first[row]) + number * half
            stop = min(start + block, int(words.first[row + 1]))
            low, high = np.searchsorted(known, (start, stop))
            held = {
                r for i, r in zip(known[low:high].tolist(), ranks[low:high].tolist())
                if vocabulary.words[r] == _word(words, i)
            }
            if len(held) >= vocabulary.least[block]:
                yield row, {"block": block, "first_word": number * half, "n_words": stop - start, "held": sorted(held)}


_BLOCKS = "array<struct<block:int,first_word:long,n_words:long,held:array<int>>>"
_ARROW_BLOCKS = pa.list_(
    pa.struct([("block", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("held", pa.list_(pa.int32()))])
)


def _scanned(phrases, vocabulary: _Vocabulary):
    def run(batch: pa.RecordBatch):
        n = batch.num_rows
        n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first, last = [None] * n, [None] * n
        labels: list[set[str]] = [set() for _ in range(n)]
        blocks: list[list[dict]] = [[] for _ in range(n)]
        for at, to, words in _lowered(batch.column(batch.num_columns - 1)):
            n_words[at:to] = words.counts
            for i, label in _phrase_places(words, phrases):
                row = int(np.searchsorted(words.first, i, "right")) - 1
                place = i - int(words.first[row])
                row += at
                n_base[row] += 1
                first[row] = place if first[row] is None else first[row]
                last[row] = place
                labels[row].add(label)
            for row, block in _rare_blocks(words, vocabulary):
                blocks[row + at].append(block)
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in range(len(names))],
                pa.array(n_words),
                pa.array(n_base),
                pa.array(first, pa.int64()),
                pa.array(last, pa.int64()),
                pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                pa.array(blocks, _ARROW_BLOCKS),
            ],
            [*names, "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"],
        )

    return run


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    carry: tuple[str, ...] | None = None,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` (columns ``carry``, or all) with ``n_words``; ``n_base``, ``first_word``, ``last_word``, the number of
    places of phrases, the first and the last of them (null without any); ``base_labels``; ``labels`` (these and those of
    notices), ``found`` (blocks that meet a notice, with its number, label and containment) and ``score``: 1 with a
    phrase, else the greatest containment that was found, else 0. Columns of these names are replaced.
    """
    split = _split([text for _, text in notices])
    wanted = [Notice(label, words) for (label, _), (words, _) in zip(notices, split) if words]
    hashes = {w: h for words, own in split for w, h in zip(words, own)}
    if len(hashes) > MOST_WORDS:
        raise ValueError(f"notices have {len(hashes)} different words; at most {MOST_WORDS} go to every task")
    counted = np.sort(np.array(list(hashes.values()), np.uint64))
    vocabulary = _Vocabulary(hashes, _texts_with(docs.select(text_col), counted), wanted, threshold)
    said = [(*own, label) for (_, label), own in zip(phrases, _split([p for p, _ in phrases])) if own[0]]

    fields = [docs.schema[c] for c in (carry or docs.columns) if c.lower() not in NEW]
    names = [f.name for f in fields]
    key, blocks = fresh_name(docs, "row_key"), fresh_name(docs, "rare_blocks")
    result = [*fields, *_schema(f"{key} long, n_words long, n_base long, first_word long, last_word long, "
                                f"base_labels array<string>, {blocks} {_BLOCKS}")]  # fmt: skip
    source = docs.select(*names, F.monotonically_increasing_id().alias(key), docs[text_col])
    rows = stage(map_arrow(source, _scanned(said, vocabulary), StructType(result)), "license-blocks")
    found = stage(_matches(rows.select(key, F.inline(blocks)), key, vocabulary), "licenses")
    # a text's matches are no more than its blocks times the notices of their size
    by_row = found.groupBy(F.col(key).alias("of_row")).agg(
        F.array_sort(F.collect_list(F.struct("first_word", "n_words", "notice", "label", "containment"))).alias("found"),
        F.max("containment").alias("best"),
    )
    joined = rows.join(by_row, rows[key] == by_row["of_row"], "left")
    none = F.array().cast("array<struct<first_word:long,n_words:long,notice:int,label:string,containment:double>>")
    matched = F.coalesce(by_row["found"], none)
    return joined.select(
        *[rows[c] for c in names],
        *[rows[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")],
        F.array_sort(F.array_union(rows["base_labels"], F.transform(matched, lambda m: m["label"]))).alias("labels"),
        matched.alias("found"),
        F.when(rows["n_base"] > 0, 1.0).otherwise(F.coalesce(by_row["best"], F.lit(0.0))).alias("score"),
    )


def _schema(ddl: str) -> list:
    return StructType.fromDDL(ddl).fields


def _matches(blocks: DataFrame, key: str, vocabulary: _Vocabulary) -> DataFrame:
    """Every block and notice that share as many words as the notice needs."""
    spark = blocks.sparkSession
    sets = spark.createDataFrame(
        [
            (i, label, block, need, ranks, place, ranks[place])
            for i, (label, block, need, ranks) in enumerate(vocabulary.sets)
            for place in range(len(ranks) - need + 1)
        ],
        "notice int, label string, of_block int, need int, ranks array<int>, place int, rank int",
    )
    least = F.lit(0)
    for block, need in vocabulary.least.items():
        least = F.when(F.col("block") == block, need).otherwise(least)
    # where the notice that needs least needs k, a block of m words has it in its first m - k + 1
    prefix = F.slice("held", F.lit(1), F.size("held") - least + 1)
    candidates = blocks.select("*", F.posexplode(prefix).alias("at", "held_rank"))
    behind = F.least(F.size("ranks") - F.col("place"), F.size("held") - F.col("at"))
    pairs = candidates.join(
        F.broadcast(sets),  # at most MOST_WORDS words
        (F.col("held_rank") == F.col("rank"))
        & (F.col("block") == F.col("of_block"))
        & (F.size("held") >= F.col("need"))
        & (behind >= F.col("need")),
    ).withColumn("common", F.array_intersect("held", "ranks"))
    met = pairs.where((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("rank")))
    return met.select(
        key, "first_word", "n_words", "notice", "label", (F.size("common") / F.size("ranks")).alias("containment")
    )
