"""Line dedup by pairwise alignment: what a later document shares with an earlier one goes.

1. Lines of any length are found: alone if they have the words of a block, else together with
   their neighbours, up to those words. Lines of enough words, though too few for a block, are
   seeds besides, and shorter lines count together with the seed before them (or, at the start,
   after them), so that common short lines pair nothing. How many hold a key does not matter:
   it costs one row per document, as each document is paired with the key's first holder only,
   never with all others. A block is found whoever holds its single lines first.
2. Documents that share keys with a first holder form a pair with it. Both orders of lines are
   aligned by patience: lines unique in both anchor the alignment through the longest increasing
   run of their places, and each anchor grows over equal neighbours on both sides. Between anchors
   the same goes on with the lines unique there; where none is, the longest common run anchors.
3. Aligned blocks with enough words are deleted from the later document. An alignment has each
   line once and in order, so what is left is aligned with the earlier document again, until
   a pass finds no block: moved lines and further copies go in these passes. A shared line that no alignment
   has in a block stays, whatever its hash.

Documents are ordered by id, then by a hash of their text; the first one keeps its lines.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh_name, map_arrow, same, stage

MIN_LINE_WORDS = 5
MIN_BLOCK_WORDS = 8


def _hash(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"\0".join(parts), digest_size=16).digest()


def line_keys(text: bytes, min_words: int) -> list[tuple[bytes, int, int]]:
    """(key, number of the line, words) of each line with a word.

    A seed's key is the hash of the line without white space at its ends. The key of a shorter
    line includes its seed and the number of lines between.
    """
    lines = [(i, line.strip(), len(line.split())) for i, line in enumerate(text.split(b"\n"))]
    lines = [x for x in lines if x[2]]
    seeds = [j for j, x in enumerate(lines) if x[2] >= min_words]
    if not seeds:
        return []
    out, at, seed = [], 0, seeds[0]
    for j, (i, line, words) in enumerate(lines):
        if at < len(seeds) and seeds[at] == j:
            seed, at = j, at + 1
            out.append((_hash(line), i, words))
        else:
            out.append((_hash(lines[seed][1], str(j - seed).encode(), line), i, words))
    return out


def block_keys(text: bytes, min_words: int) -> list[tuple[bytes, int, list[int]]]:
    """(key, number of the first line, words of each line) of the least blocks of lines.

    From each line with fewer than ``min_words`` words one goes forward and one back until it has
    that many. Any longer block is covered by those within it, so it is found by their keys
    whoever holds its single lines first. Blank lines within a block count as lines of 0 words.
    """
    lines = [line.strip() for line in text.split(b"\n")]
    words = [len(line.split()) for line in lines]
    own = [i for i, n in enumerate(words) if n]
    spans = set()
    for j, i in enumerate(own):
        if words[i] < min_words:
            for step, stop in ((1, len(own)), (-1, -1)):
                k, n = j, words[i]
                while n < min_words and k + step != stop:
                    k += step
                    n += words[own[k]]
                if n >= min_words:
                    spans.add((min(i, own[k]), max(i, own[k]) + 1))
    return [(_hash(b"\n".join(lines[a:b])), a, words[a:b]) for a, b in sorted(spans)]


def _emit_lines(min_words: int, min_block_words: int):
    schema = pa.list_(pa.int32())

    def run(batch: pa.RecordBatch):
        rows, keys, places, sizes = [], [], [], []
        for row, text in enumerate(batch.column(2)):
            held: dict[bytes, list] = {}
            text = text.as_buffer().to_pybytes()
            for key, i, words in line_keys(text, min_words):
                held.setdefault(key, [[words]]).append(i)
            for key, i, words in block_keys(text, min_block_words):
                held.setdefault(key, [words]).append(i)
            for key, own in held.items():
                rows.append(row)
                keys.append(key)
                sizes.append(own[0])
                places.append(own[1:])
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array(keys, pa.binary()),
                pa.array(places, schema),
                pa.array(sizes, schema),
            ],
            ["doc_id", "text_hash", "line", "places", "words"],
        )

    return run


def _longest_run(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of (a, b), sorted by a, in which b grows too (patience)."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(anchors)
    for k, (_, b) in enumerate(anchors):
        pile = bisect_left(tops, b)
        if pile:
            before[k] = ends[pile - 1]
        if pile == len(tops):
            tops.append(b)
            ends.append(k)
        else:
            tops[pile], ends[pile] = b, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(anchors[k])
        k = before[k]
    return chain[::-1]


def _longest_common_run(a: list, b: list) -> tuple[int, int, int]:
    """Start in ``a``, start in ``b`` and length of the longest run of lines in both, 0 if none.

    ``a`` and ``b`` hold (line, lines since the one before); of equal runs the first in ``b``, then
    in ``a``. A suffix automaton of ``a``, in which the distance to the next line is a sign too.
    """
    links, lengths, nexts, ends = [-1], [0], [{}], [-1]
    last = 0
    signs = [sign for line, gap in a for sign in (-gap - 1, line)][1:]
    for at, sign in enumerate(signs):
        own, last_own = len(links), last
        links.append(0)
        lengths.append(lengths[last_own] + 1)
        nexts.append({})
        ends.append(at)
        while last_own >= 0 and sign not in nexts[last_own]:
            nexts[last_own][sign] = own
            last_own = links[last_own]
        if last_own >= 0:
            to = nexts[last_own][sign]
            if lengths[last_own] + 1 == lengths[to]:
                links[own] = to
            else:
                clone = len(links)
                links.append(links[to])
                lengths.append(lengths[last_own] + 1)
                nexts.append(dict(nexts[to]))
                ends.append(ends[to])
                while last_own >= 0 and nexts[last_own].get(sign) == to:
                    nexts[last_own][sign] = clone
                    last_own = links[last_own]
                links[to] = links[own] = clone
        last = own
    best, state, length = (0, 0, 0), 0, 0
    for at, sign in enumerate([sign for line, gap in b for sign in (-gap - 1, line)][1:]):
        while state and sign not in nexts[state]:
            state = links[state]
            length = lengths[state]
        if sign in nexts[state]:
            state = nexts[state][sign]
            length += 1
        n = (length + 1) // 2  # lines, where the run ends with one
        if at % 2 == 0 and n > best[2]:
            while lengths[links[state]] >= 2 * n - 1:  # the run alone, without a distance before it
                state = links[state]
            length = min(length, lengths[state])
            best = (ends[state] // 2 - n + 1, at // 2 - n + 1, n)
    return best


def _lines_of(shared) -> tuple[list[tuple[int, int]], list[tuple[int, int]], dict[int, int]]:
    """(place, line) of the earlier and the later text, in order, and words by place in the later.

    Lines are the same number if some key says that they are equal.
    """
    held: dict[tuple[int, int], tuple[int, int]] = {}

    def find(x):
        while held[x] != x:
            held[x] = x = held[held[x]]
        return x

    words: dict[int, int] = {}
    for in_a, in_b, sizes in shared:
        for step, n in enumerate([sizes] if isinstance(sizes, int) else sizes):
            if not n:
                continue
            own = [(0, a + step) for a in in_a] + [(1, b + step) for b in in_b]
            for x in own:
                held.setdefault(x, x)
                held[find(x)] = find(own[0])
            for b in in_b:
                words[b + step] = n
    number: dict[tuple[int, int], int] = {}
    sides: tuple[list, list] = ([], [])
    for x in sorted(held):
        sides[x[0]].append((x[1], number.setdefault(find(x), len(number))))
    return *sides, words


def _alike(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> dict[int, int]:
    """Place in the later text to place in the earlier one, by recursive patience."""
    matched: dict[int, int] = {}
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        low_a, high_a, low_b, high_b = gaps.pop()
        if low_a >= high_a or low_b >= high_b:
            continue
        at_a: dict[int, list[int]] = {}
        at_b: dict[int, list[int]] = {}
        for side, at, low, high in ((a, at_a, low_a, high_a), (b, at_b, low_b, high_b)):
            for x in range(low, high):
                at.setdefault(side[x][1], []).append(x)
        common = [line for line in at_a if line in at_b]
        if not common:
            continue
        anchors = sorted(
            (at_a[line][0], at_b[line][0]) for line in common if len(at_a[line]) == len(at_b[line]) == 1
        )
        if anchors:
            chain = _longest_run(anchors)
        else:
            own = []
            for side, low, high in ((a, low_a, high_a), (b, low_b, high_b)):
                own.append([(side[x][1], side[x][0] - side[max(x - 1, low)][0]) for x in range(low, high)])
            x, y, n = _longest_common_run(*own)
            chain = [(low_a + x + k, low_b + y + k) for k in range(n)]
        found: list[tuple[int, int]] = []
        for k, (x, y) in enumerate(chain):
            stop_a, stop_b = chain[k + 1] if k + 1 < len(chain) else (high_a, high_b)
            for step in (-1, 1):
                floor_a, floor_b = found[-1] if found else (low_a - 1, low_b - 1)
                i, j, side = x + step, y + step, []
                while (
                    floor_a < i < (stop_a if step > 0 else x)
                    and floor_b < j < (stop_b if step > 0 else y)
                    and a[i][1] == b[j][1]
                    and a[i][0] - b[j][0] == a[x][0] - b[y][0]
                ):
                    side.append((i, j))
                    i, j = i + step, j + step
                found += side[::-1] + [(x, y)] if step < 0 else side
        before = (low_a - 1, low_b - 1)
        for x, y in found:
            matched[b[y][0]] = a[x][0]
            gaps.append((before[0] + 1, x, before[1] + 1, y))
            before = (x, y)
        gaps.append((before[0] + 1, high_a, before[1] + 1, high_b))
    return matched


def align(shared: list[tuple[list[int], list[int], int | list[int]]], min_block_words: int) -> list[int]:
    """Lines of the later text in aligned blocks, over as many passes as find one.

    A pass aligns what earlier passes have left of the later text with the whole earlier one, so moved blocks and
    further copies are aligned in their turn. What no pass aligns in a block stays.

    ``shared`` has for each common key its places in the earlier and the later text, and its words:
    a number, or one for each line of a block (0 for a blank line). Lines between that the pair
    does not share (blank ones, or ones first held elsewhere) don't end a block as long as both
    sides advance alike.
    """
    a, left, words = _lines_of(shared)
    gone: list[int] = []
    while True:
        found = _blocks(_alike(a, left), words, min_block_words)
        if not found:
            return gone
        taken = set(found)
        # a line that is a block by itself: later passes would align its copies one by one
        whole = {line for place, line in left if place in taken and words[place] >= min_block_words}
        gone += found + [place for place, line in left if line in whole and place not in taken]
        left = [(place, line) for place, line in left if place not in taken and line not in whole]


def _blocks(matched: dict[int, int], words: dict[int, int], min_block_words: int) -> list[int]:
    """Places in the later text of aligned lines that advance alike and have the words of a block together."""
    gone, block, shift = [], [], None
    for b in sorted(matched):
        if matched[b] - b != shift:
            if sum(words[x] for x in block) >= min_block_words:
                gone += block
            block, shift = [], matched[b] - b
        block.append(b)
    if sum(words[x] for x in block) >= min_block_words:
        gone += block
    return gone


def _align(min_block_words: int):
    def run(batch: pa.RecordBatch):
        gone = [
            align([(s["in_a"], s["in_b"], s["words"]) for s in shared], min_block_words)
            for shared in batch.column(2).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))],
            ["doc_id", "text_hash", "gone"],
        )

    return run


def _masks(batch: pa.RecordBatch):
    masks = []
    for gone in batch.column(2).to_pylist():
        mask = np.zeros(gone[-1] + 1, bool)
        mask[gone] = True
        masks.append(mask)
    yield pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(masks, pa.list_(pa.bool_()))], [*batch.schema.names, "mask"]
    )


def shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_line_words: int = MIN_LINE_WORDS,
    min_block_words: int = MIN_BLOCK_WORDS,
) -> DataFrame:
    """Lines to delete: ``doc_id, text_hash, gone`` (numbers, sorted, without repeats) and the
    same as ``mask``, up to the last of them."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    ).where(F.length("text") > 0)
    lines = map_arrow(
        texts,
        _emit_lines(min_line_words, min_block_words),
        "doc_id long, text_hash long, line binary, places array<int>, words array<int>",
    )
    lines = stage(lines, "align-lines")
    # a written table, so that the join has exchanges of its own and AQE can split a hot line
    first = stage(
        lines.groupBy("line")
        .agg(
            F.min(F.struct(F.col("doc_id"), F.col("text_hash"), F.col("places"))).alias("first"),
            F.count("*").alias("holders"),
        )
        .where("holders > 1")
        .select(
            "line",
            F.col("first.doc_id").alias("a_id"),
            F.col("first.text_hash").alias("a_hash"),
            F.col("first.places").alias("in_a"),
        ),
        "align-first",
    )
    # a repeated row is the same document, so it does not follow itself
    later = lines.join(first, "line").where(
        ~(same(F.col("doc_id"), F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")))
    )
    pairs = later.groupBy("doc_id", "text_hash", "a_id", "a_hash").agg(
        F.collect_set(F.struct("line", "in_a", F.col("places").alias("in_b"), "words")).alias("shared")
    )
    aligned = map_arrow(
        pairs.select("doc_id", "text_hash", "shared"),
        _align(min_block_words),
        "doc_id long, text_hash long, gone array<int>",
    )
    gone = (
        aligned.select("doc_id", "text_hash", F.explode("gone").alias("line"))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("line")).alias("gone"))
    )
    schema = "doc_id long, text_hash long, gone array<int>, mask array<boolean>"
    return stage(map_arrow(gone, _masks, schema), "align-gone")


def delete_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_line_words: int = MIN_LINE_WORDS,
    min_block_words: int = MIN_BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` with ``kept_text``, ``n_lines`` and ``n_deleted``; columns of these
    names are replaced.

    ``kept_text`` joins the lines left by ``\\n``. A null text stays null, with 0 lines; an empty
    one has one line. Rows
    that repeat id and text are treated alike, and are not deleted for each other's sake.
    """
    gone = shared_lines(docs, id_col, text_col, min_line_words, min_block_words)
    names = ("gone_id", "gone_hash", "gone_lines", "gone_mask")
    at_id, at_hash, at_gone, at_mask = (fresh_name(docs, n) for n in names)
    gone = gone.toDF(at_id, at_hash, at_gone, at_mask)
    joined = docs.join(
        gone,
        same(docs[id_col].cast("long"), F.col(at_id)) & (F.xxhash64(docs[text_col]) == F.col(at_hash)),
        "left",
    )
    new = ("kept_text", "n_lines", "n_deleted")
    lines = F.split(docs[text_col], "\n")
    left = F.filter(lines, lambda _, i: ~F.coalesce(F.get(F.col(at_mask), i), F.lit(False)))
    return joined.select(
        *[docs[c] for c in docs.columns if c.lower() not in new],
        F.when(F.col(at_gone).isNull(), docs[text_col]).otherwise(F.concat_ws("\n", left)).alias("kept_text"),
        F.when(docs[text_col].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(at_gone).isNull(), 0).otherwise(F.size(at_gone)).cast("long").alias("n_deleted"),
    )
