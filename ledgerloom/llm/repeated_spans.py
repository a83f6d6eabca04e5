"""Substring dedup on a compacted De Bruijn graph of word k-mers.

Edges of the graph are runs of ``window`` consecutive words. Consecutive edges of a document
that share their minimizer (the run of ``anchor_words`` words with the smallest hash) form a path
piece; equal edges have equal minimizers, so all that can be equal meets under one minimizer.

1. Minimizers that occur once can't lie on a repeated path. They go first, by a count and a
   semi join of narrow rows.
2. Equal pieces collapse into one class with its first place (document, word). A minimizer with
   one class is a path without branches and is settled as a whole by the join of its places with
   that class.
3. Where a minimizer has several classes the path branches: the first place of each class is
   opened into single edges, which find their own first place.
4. What does not start at its first place becomes a span of its document, with the coordinates of that place, its
   source. The words at the source are read, once for each different span of it, and their SHA-256 goes to the
   copies. A span is removed only where the words at its own coordinates have the same.

Classes and edges are told apart by two 64-bit hashes over one 64-bit hash per word until then. Documents go by id
and text, so rows that share an id (or have none) are read apart. No group of places is ever
collected: hot passages are counted with partial aggregation and joined, and a skewed join is
split by AQE. Only the spans of one document meet in one row.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    Words,
    fresh_name,
    gram_hashes,
    lists,
    longs,
    map_arrow,
    same,
    span_hashes,
    stage,
    word_blocks,
)

WINDOW = 20
ANCHOR_WORDS = 6
FIRST_BASE = 0xC2B2AE3D27D4EB4F
SECOND_BASE = 0x165667B19E3779F9

_POSITION_BITS = np.uint64(24)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _pieces(words: Words, window: int, anchor_words: int):
    """Start, number of windows and minimizer of each path piece."""
    n = len(words.hashes)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none.astype(np.uint64)
    anchors = span_hashes(
        words.hashes, np.arange(n - anchor_words + 1), np.arange(anchor_words, n + 1), FIRST_BASE
    )
    # the hash orders, its place breaks ties: the leftmost of equal runs
    step = (1 << int(_POSITION_BITS)) - 2 * window
    found = []
    for at in range(0, n - window + 1, step):  # places are counted anew for each step
        own = anchors[at : at + step + window - anchor_words]
        packed = (own >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(own), dtype=np.uint64)
        least = _sliding_min(packed, window - anchor_words + 1)
        found.append((least & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64) + at)
    where = np.concatenate(found)[: n - window + 1]
    valid = np.arange(window, n + 1) <= words.row_ends()[: n - window + 1]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none, none, none.astype(np.uint64)
    where = where[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (where[1:] != where[:-1]) | (np.diff(starts) != 1)
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(starts)))
    return starts[heads], counts, anchors[where[heads]]


def _emit_anchors(window: int, anchor_words: int):
    def run(batch: pa.RecordBatch):
        for _, _, words in word_blocks(batch.column(0)):
            _, _, anchors = _pieces(words, window, anchor_words)
            yield pa.RecordBatch.from_arrays([longs(anchors)], ["anchor"])

    return run


def _emit_pieces(window: int, anchor_words: int):
    def run(batch: pa.RecordBatch):
        for at, _, words in word_blocks(batch.column(2)):
            starts, counts, anchors = _pieces(words, window, anchor_words)
            stops = starts + counts + window - 1
            rows = np.searchsorted(words.first, starts, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(rows + at)) for c in (0, 1)],
                    pa.array((starts - words.first[rows]).astype(np.int32)),
                    pa.array(counts.astype(np.int32)),
                    longs(anchors),
                    longs(span_hashes(words.hashes, starts, stops, FIRST_BASE)),
                    longs(span_hashes(words.hashes, starts, stops, SECOND_BASE)),
                ],
                ["doc_id", "text_hash", "start", "windows", "anchor", "h1", "h2"],
            )

    return run


def _spans_of(column: pa.ListArray, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row bounds and flat fields of a list<struct> column; a null is an empty list."""
    offsets = column.offsets.to_numpy()
    values = column.values
    return offsets, [values.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _emit_windows(window: int):
    """Single edges of the opened pieces, after a check that the piece stands where it says."""

    def run(batch: pa.RecordBatch):
        offsets, (start, count, check) = _spans_of(batch.column(3), ("start", "windows", "h1"))
        for at, to, words in word_blocks(batch.column(2)):
            own = slice(offsets[at], offsets[to])
            row = np.repeat(np.arange(to - at), np.diff(offsets[at : to + 1]))
            begin = words.first[row] + start[own]
            stop = begin + count[own] + window - 1
            fits = np.flatnonzero(stop <= words.first[row + 1])
            hashes = span_hashes(words.hashes, begin[fits], stop[fits], FIRST_BASE).view(np.int64)
            fits = fits[hashes == check[own][fits]]
            n = count[own][fits].astype(np.int64)
            base = np.repeat(np.cumsum(n) - n, n)
            places = np.repeat(begin[fits], n) + np.arange(n.sum()) - base
            rows = np.repeat(row[fits], n)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(pa.array(rows + at)) for c in (0, 1)],
                    pa.array((places - words.first[rows]).astype(np.int32)),
                    longs(span_hashes(words.hashes, places, places + window, FIRST_BASE)),
                    longs(span_hashes(words.hashes, places, places + window, SECOND_BASE)),
                ],
                ["doc_id", "text_hash", "start", "h1", "h2"],
            )

    return run


def _sha256(words: Words, begin: int, stop: int) -> bytes:
    """Digest of some words of a text, joined by one space."""
    raw = words.data[words.starts[begin] : words.ends[stop - 1]].tobytes()
    return hashlib.sha256(b" ".join(raw.split())).digest()


def _read_sources(batch: pa.RecordBatch):
    """The digest of each wanted span (start, length) of some texts."""
    offsets, (start, length) = _spans_of(batch.column(3), ("start", "length"))
    for at, to, words in word_blocks(batch.column(2)):
        own = slice(offsets[at], offsets[to])
        row = np.repeat(np.arange(to - at), np.diff(offsets[at : to + 1]))
        begin = words.first[row] + start[own]
        stop = begin + length[own]
        fits = np.flatnonzero(stop <= words.first[row + 1])
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(pa.array(row[fits] + at)) for c in (0, 1)],
                pa.array(start[own][fits].astype(np.int32)),
                pa.array(length[own][fits].astype(np.int32)),
                pa.array([_sha256(words, a, b) for a, b in zip(begin[fits], stop[fits])], pa.binary()),
            ],
            ["source_id", "source_hash", "source_start", "length", "digest"],
        )


def _remove(batch: pa.RecordBatch):
    offsets, (start, length) = _spans_of(batch.column(1), ("start", "length"))
    check = batch.column(1).values.field("digest")
    valid = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
    for at, to, words in word_blocks(batch.column(0)):
        own = slice(offsets[at], offsets[to])
        sizes = np.diff(offsets[at : to + 1]) * valid[at:to]
        row = np.repeat(np.arange(to - at), sizes)
        begin = words.first[row] + start[own]
        stop = begin + length[own]
        fits = np.flatnonzero(stop <= words.first[row + 1])
        wanted = check.slice(own.start, own.stop - own.start).to_pylist()
        fits = [i for i in fits if _sha256(words, begin[i], stop[i]) == wanted[i]]
        size = len(words.hashes) + 1
        cover = np.bincount(begin[fits], minlength=size) - np.bincount(stop[fits], minlength=size)
        keep = np.cumsum(cover)[:-1] == 0
        kept, removed = [], np.zeros(to - at, np.int64)
        for i in range(to - at):
            a, b = words.first[i], words.first[i + 1]
            if a == b:
                kept.append(b"")
                continue
            text = words.data[words.starts[a] : words.ends[b - 1]].tobytes().split()
            left = keep[a:b]
            n = int(np.count_nonzero(left))
            removed[i] = b - a - n
            if n < b - a:
                text = [text[j] for j in np.flatnonzero(left)]
            kept.append(b" ".join(text))
        # runs of removed words, text by text
        heads, tails = ~keep, ~keep
        heads[1:] &= keep[:-1] | (np.diff(words.rows()) > 0)
        tails[:-1] &= keep[1:] | (np.diff(words.rows()) > 0)
        heads, tails = np.flatnonzero(heads), np.flatnonzero(tails) + 1
        at_row = np.searchsorted(words.first, heads, "right") - 1
        runs = [pa.array(heads - words.first[at_row]), pa.array(tails - heads)]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).slice(at, to - at) for c in range(2, batch.num_columns)],
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(words.counts.astype(np.int64)),
                pa.array(removed),
                lists(
                    pa.StructArray.from_arrays(runs, ["start", "length"]),
                    np.bincount(at_row, minlength=to - at),
                ),
            ],
            [
                *batch.schema.names[2:],
                "kept_text",
                "n_words",
                "n_removed",
                "removed_spans",
            ],
        )


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor_words: int = ANCHOR_WORDS,
) -> DataFrame:
    """Spans of words that also start earlier: ``doc_id, text_hash, spans`` (start, length, digest of the source).

    "Earlier" is a smaller id, or the same id and an earlier word. Null ids come before all
    others. Rows with one id stand at one place: none of them is earlier than another, but each
    still repeats what an earlier id has.
    """
    if not 1 <= anchor_words <= window:
        raise ValueError("anchor_words must lie between 1 and the window")
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    texts = texts.where(F.col("text").isNotNull())
    anchors = map_arrow(texts.select("text"), _emit_anchors(window, anchor_words), "anchor long")
    anchors = stage(
        anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "repeat-anchors"
    )
    pieces = map_arrow(
        texts,
        _emit_pieces(window, anchor_words),
        "doc_id long, text_hash long, start int, windows int, anchor long, h1 long, h2 long",
    )
    pieces = stage(pieces.join(anchors, "anchor", "left_semi"), "repeat-pieces")

    key = ["anchor", "h1", "h2", "windows"]
    classes = pieces.groupBy(key).agg(
        F.min(F.struct("doc_id", "start", "text_hash")).alias("first"), F.count("*").alias("places")
    )
    # written tables, so that the joins have exchanges of their own, which AQE can split
    classes = stage(classes, "repeat-classes")
    shapes = stage(classes.groupBy("anchor").agg((F.count("*") > 1).alias("branching")), "repeat-shapes")
    classes = stage(classes.join(shapes, "anchor"), "repeat-branches")

    def copies(places: DataFrame, length: Column) -> DataFrame:
        """Places other than the first one of their words, and that one as their source."""
        return places.where(
            ~same(F.struct("doc_id", "start"), F.struct("first.doc_id", "first.start"))
        ).select(
            "doc_id", "text_hash", "start", length.cast("int").alias("length"),
            F.col("first.doc_id").alias("source_id"), F.col("first.text_hash").alias("source_hash"),
            F.col("first.start").alias("source_start"),
        )

    repeated = classes.where("places > 1").select(*key, "first")
    whole = copies(pieces.join(repeated, key), F.col("windows") + (window - 1))

    opened = (
        classes.where("branching")
        .select("first.*", "windows", "h1")
        .groupBy(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"))
        .agg(F.collect_list(F.struct("start", "windows", "h1")).alias("pieces"))
    )
    at_text = same(F.col("doc_id"), F.col("at_id")) & (F.col("text_hash") == F.col("at_hash"))
    edges = texts.join(opened, at_text).select("doc_id", "text_hash", "text", "pieces")
    edges = stage(
        map_arrow(edges, _emit_windows(window), "doc_id long, text_hash long, start int, h1 long, h2 long"),
        "repeat-edges",
    )
    firsts = stage(
        edges.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "start", "text_hash")).alias("first"), F.count("*").alias("places"))
        .where("places > 1")
        .drop("places"),
        "repeat-firsts",
    )
    single = copies(edges.join(firsts, ["h1", "h2"]), F.lit(window))
    # rows that repeat id and text have the same spans
    spans = stage(whole.union(single).distinct(), "repeat-copies")

    wanted = (
        spans.select("source_id", "source_hash", "source_start", "length")
        .distinct()
        .groupBy(F.col("source_id").alias("at_id"), F.col("source_hash").alias("at_hash"))
        .agg(F.collect_list(F.struct(F.col("source_start").alias("start"), "length")).alias("wanted"))
    )
    sources = texts.join(wanted, at_text).select("doc_id", "text_hash", "text", "wanted")
    place = ["source_id", "source_hash", "source_start", "length"]
    read = map_arrow(
        sources, _read_sources, "source_id long, source_hash long, source_start int, length int, digest binary"
    )
    read = stage(read.distinct(), "repeat-sources").toDF(*[f"at_{c}" for c in place], "digest")
    at_place = reduce(lambda a, b: a & b, [same(F.col(c), F.col(f"at_{c}")) for c in place])
    spans = spans.join(read, at_place).groupBy("doc_id", "text_hash")
    return stage(
        spans.agg(F.collect_list(F.struct("start", "length", "digest")).alias("spans")),
        "repeat-spans",
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor_words: int = ANCHOR_WORDS,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with ``kept_text``, ``n_words``, ``n_removed`` and ``removed_spans``.

    Words are runs of other characters than ASCII white space; ``kept_text`` has those left,
    joined by one space. Null and empty texts have no words and an empty ``kept_text``. Columns
    of ``docs`` that bear one of these names are replaced. ``carry`` names the columns to keep
    (all if None).
    """
    new = ("kept_text", "n_words", "n_removed", "removed_spans")
    own = [c for c in (docs.columns if carry is None else carry) if c.lower() not in new]
    spans = repeated_spans(docs, id_col, text_col, window, anchor_words)
    names = ("found_id", "found_hash", "found_spans")
    at_id, at_hash, found = (fresh_name(docs, n) for n in names)
    text = fresh_name(docs, "words_of")
    spans = spans.toDF(at_id, at_hash, found)
    at_text = same(docs[id_col].cast("long"), F.col(at_id)) & (F.xxhash64(docs[text_col]) == F.col(at_hash))
    joined = docs.join(spans, at_text, "left")
    joined = joined.select(F.col(text_col).alias(text), found, *own)
    schema = joined.select(*own).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return map_arrow(
        joined,
        _remove,
        f"{fields}, kept_text string, n_words long, n_removed long, "
        "removed_spans array<struct<start: long, length: long>>",
    )
