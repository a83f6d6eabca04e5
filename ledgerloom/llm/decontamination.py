"""Benchmark decontamination by greedy string tiling.

1. Every run of ``min_match`` tokens of a benchmark item is a seed; an item of fewer tokens is one
   seed as a whole. A table of bits of fixed size says which hashes can be seeds at all; it is
   broadcast, and only runs of documents that pass it are shuffled. It serves speed alone: the
   seeds are then joined exactly.
2. The hits of one document in one item (places in both) are tiled: the longest common run is
   marked first, then the longest of what is left, each token once on both sides, down to
   ``min_match`` tokens. Runs come from the rolling (Karp-Rabin) hashes of the seeds: adjacent
   seeds that agree make a longer match.
3. An item has leaked into a document if its marked tokens reach ``coverage`` of the item. As tiles
   may stand in any order, a reordered passage is caught like a plain one.

Tokens are runs of ASCII letters and digits and of all characters beyond ASCII, in lower case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    fresh_name,
    gram_hashes,
    hashed_counts,
    longs,
    map_arrow,
    same,
    space_table,
    stage,
    word_blocks,
)

MIN_MATCH = 5
COVERAGE = 0.5
FILTER_BITS = 22

# All ASCII characters but letters and digits part tokens.
_GAPS = space_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def _seeds(min_match: int):
    """Rows (key columns, place, tokens of the text, tokens of the seed, seed) of the seeds of items."""

    def run(batch: pa.RecordBatch):
        for at, _, words in word_blocks(batch.column(batch.num_columns - 1), _GAPS):
            for size in range(1, min_match + 1):
                starts, hashes = gram_hashes(words, size)
                if size < min_match:
                    whole = words.counts[np.searchsorted(words.first, starts, "right") - 1] == size
                    starts, hashes = starts[whole], hashes[whole]
                yield _seed_rows(batch, at, words, starts, hashes, size)

    return run


def _allowed_seeds(sizes: list[int], allowed):
    """The same of documents: runs of the sizes that items' seeds have, where the bits allow them."""

    def run(batch: pa.RecordBatch):
        for at, _, words in word_blocks(batch.column(batch.num_columns - 1), _GAPS):
            for size in sizes:
                starts, hashes = gram_hashes(words, size)
                bits = allowed.value
                shift = np.uint64(64 - FILTER_BITS)
                slot = (hashes >> shift).astype(np.int64)
                hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
                keep = np.flatnonzero(hit)
                yield _seed_rows(batch, at, words, starts[keep], hashes[keep], size)

    return run


def _seed_rows(batch: pa.RecordBatch, at: int, words, starts, hashes, size: int) -> pa.RecordBatch:
    rows = np.searchsorted(words.first, starts, "right") - 1
    take = pa.array(rows + at)
    names = batch.schema.names[:-1]
    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(c).take(take) for c in range(len(names))],
            pa.array(starts - words.first[rows]),
            pa.array(words.counts[rows]),
            pa.array(np.full(len(starts), size, np.int64)),
            longs(hashes),
        ],
        [*names, "place", "tokens", "seed_tokens", "seed"],
    )


Hit = tuple[int, np.ndarray]


def _runs(hits: list[Hit], free_b: np.ndarray):
    """For each place in a, the places in b where a seed agrees, and how many seeds in a row agree up to there.

    Places in b that are not free (any more) don't count.
    """
    none = np.zeros(0, np.int64)
    ends, counts, at = none, none, -2
    for a, places in hits:
        places = places[free_b[places]]
        now = np.ones(len(places), np.int64)
        if a == at + 1 and len(ends):
            before = np.minimum(np.searchsorted(ends, places - 1), len(ends) - 1)
            now += np.where(ends[before] == places - 1, counts[before], 0)
        if len(places):
            yield a, places, now
        ends, counts, at = places, now, a


def tile(seeds: list[tuple[list[int], list[int]]], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in a, start in b, length) from the places of each seed in a and in b.

    Longest first; of equal ones the first in a, then in b. What a tile leaves of a run stays in
    the game if it still has ``min_match`` tokens. Every length is searched in one pass over the places
    in a and marked in another, so memory goes with the places of both sides, not with their product.
    """
    left: list[Hit] = []
    for in_a, in_b in seeds:
        places = np.unique(np.array(in_b, np.int64))
        left += [(a, places) for a in set(in_a)]
    left.sort(key=lambda hit: hit[0])
    free_b = np.ones(1 + max((int(places[-1]) for _, places in left), default=-1), bool)
    tiles = []
    while left:
        most = max((int(now.max()) for _, _, now in _runs(left, free_b)), default=0)
        if not most:
            break
        stop, taken = -1, []
        for a, places, now in _runs(left, free_b):
            start_a = a - most + 1
            if start_a < stop:
                continue
            # places are taken while runs grow, so a run is looked at as a whole
            starts = places[now == most] - most + 1
            start_b = next((b for b in starts.tolist() if free_b[b : b + most].all()), None)
            if start_b is None:
                continue
            tokens = most + min_match - 1
            tiles.append((start_a, start_b, tokens))
            taken.append((start_a - min_match + 1, start_a + tokens))
            free_b[max(0, start_b - min_match + 1) : start_b + tokens] = False
            stop = start_a + tokens
        left = _outside(left, taken)
    return tiles


def _outside(hits: list[Hit], taken: list[tuple[int, int]]) -> list[Hit]:
    """Hits at places outside of some ranges; both go by place."""
    kept, ranges = [], iter(taken)
    now = next(ranges, None)
    for a, places in hits:
        while now is not None and a >= now[1]:
            now = next(ranges, None)
        if now is None or a < now[0]:
            kept.append((a, places))
    return kept


def _tiles(batch: pa.RecordBatch):
    covered, longest, counts = [], [], []
    for seed_tokens, hits in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
        tiles = tile([(hit["places"], hit["at_item"]) for hit in hits.as_py()], seed_tokens.as_py())
        covered.append(sum(t[2] for t in tiles))
        longest.append(max(t[2] for t in tiles))
        counts.append(len(tiles))
    yield pa.RecordBatch.from_arrays(
        [
            *[batch.column(c) for c in range(batch.num_columns - 2)],
            pa.array(covered, pa.int64()),
            pa.array(longest, pa.int64()),
            pa.array(counts, pa.int64()),
        ],
        [*batch.schema.names[:-2], "covered", "longest", "tiles"],
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = MIN_MATCH,
) -> DataFrame:
    """Every document and item that share a seed: ``doc_id, text_hash, item_id, item_tokens,
    covered, longest, tiles, coverage``.

    An item of fewer than ``min_match`` tokens is matched as a whole: it has leaked wherever its tokens stand
    together. Null or empty texts, and those without a token, match nothing. Items with one id and
    different texts are items of their own (by token count).
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"),
        F.xxhash64(item_text_col).alias("item_hash"),
        F.lower(item_text_col).alias("item_text"),
    ).where(F.col("item_text").isNotNull())
    seeds = map_arrow(
        items,
        _seeds(min_match),
        "item_id long, item_hash long, place long, tokens long, seed_tokens long, seed long",
    )
    # one row for a seed of an item, whatever its repeats
    seeds = stage(
        seeds.groupBy("seed", "seed_tokens", "item_id", "item_hash").agg(
            F.collect_set("place").alias("at_item"), F.first("tokens").alias("item_tokens")
        ),
        "leak-seeds",
    )

    def of_seeds(batch: pa.RecordBatch):
        yield batch.column(0).to_numpy().view(np.uint64)

    found = hashed_counts(seeds.select("seed"), of_seeds, FILTER_BITS) > 0
    allowed = spark.sparkContext.broadcast(np.packbits(found, bitorder="little"))
    # at most ``min_match`` sizes
    sizes = sorted(r[0] for r in seeds.select("seed_tokens").distinct().collect())
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.lower(text_col).alias("text"),
    ).where(F.col("text").isNotNull())
    hits = map_arrow(
        texts,
        _allowed_seeds(sizes, allowed),
        "doc_id long, text_hash long, place long, tokens long, seed_tokens long, seed long",
    ).drop("tokens")
    # repeated rows hit alike
    hits = (
        stage(hits, "leak-hits")
        .groupBy("doc_id", "text_hash", "seed", "seed_tokens")
        .agg(F.collect_set("place").alias("places"))
    )
    pairs = (
        hits.join(seeds, ["seed", "seed_tokens"])
        .groupBy("doc_id", "text_hash", "item_id", "item_hash")
        .agg(
            F.first("item_tokens").alias("item_tokens"),
            F.first("seed_tokens").alias("seed_tokens"),
            F.collect_list(F.struct("places", "at_item")).alias("hits"),
        )
    )
    tiled = map_arrow(
        pairs,
        _tiles,
        "doc_id long, text_hash long, item_id long, item_hash long, item_tokens long, "
        "covered long, longest long, tiles long",
    )
    return tiled.drop("item_hash").withColumn("coverage", F.col("covered") / F.col("item_tokens"))


def mark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
) -> DataFrame:
    """The rows of ``docs`` with ``contaminated``, ``leaked_items`` (ids, sorted; null ids left out)
    and ``top_coverage`` (of any item, 0 without a match); columns of these names are replaced.

    Documents are told apart by id and text, so repeated ids don't share their leaks.
    """
    found = leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, min_match)
    leaked = F.col("coverage") >= coverage
    names = [fresh_name(docs, n) for n in ("leak_id", "leak_hash", "leak_items", "leak_top", "leak_any")]
    by_doc = stage(
        found.groupBy(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).agg(
            F.array_sort(F.collect_set(F.when(leaked, F.col("item_id")))).alias(names[2]),
            F.max("coverage").alias(names[3]),
            F.max(leaked).alias(names[4]),
        ),
        "leaks",
    )
    new = ("contaminated", "leaked_items", "top_coverage")
    joined = docs.join(
        by_doc,
        same(docs[id_col].cast("long"), F.col(names[0])) & (F.xxhash64(docs[text_col]) == F.col(names[1])),
        "left",
    )
    return joined.select(
        *[docs[c] for c in docs.columns if c.lower() not in new],
        F.coalesce(names[4], F.lit(False)).alias("contaminated"),
        F.coalesce(names[2], F.array().cast("array<bigint>")).alias("leaked_items"),
        F.coalesce(names[3], F.lit(0.0)).alias("top_coverage"),
    )
