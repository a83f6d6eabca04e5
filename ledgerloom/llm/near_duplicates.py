"""Near duplicates: consistent weighted sampling of TF-IDF shingles, banded, then verified.

1. Document frequencies of all shingles of all documents go into a table of counters of fixed
   size. A shingle's weight is ``tf * (1 + idf_gain * idf)`` with ``idf`` scaled to 0..1, so that
   what a large group of copies shares still weighs about as much as what they differ in.
2. Improved consistent weighted sampling draws ``bands * rows`` samples from each text: sample k
   is the shingle with the smallest ``ln c - r (floor(ln w / r + beta) - beta) - r`` where r, c
   (gamma) and beta (uniform) are drawn for k and the shingle. Two texts draw the same sample
   with a probability of their weighted Jaccard similarity.
3. Equal texts collapse first. Texts that agree on a whole band share a bucket.
4. Within buckets, the text that shares most buckets with others (a hub) is compared with all
   texts not yet in its class, then four more hubs are. Buckets that are one class by then are
   settled. Of the others, small ones compare their remaining pairs. The texts of large ones are
   put in new buckets by the rarest of those shingles that several classes have, of which similar
   texts of two classes must share one, and there compared with those of another class. So no link
   that could change a class is left out, while a group of copies costs about one comparison per
   copy.
5. A pair counts if the weighted Jaccard similarity of the whole texts reaches the threshold.
   Classes are the connected components of these links.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    Words,
    fresh_name,
    hashed_counts,
    lists,
    longs,
    map_arrow,
    mixed,
    same,
    single_marks,
    span_hashes,
    stage,
    word_blocks,
)
from ledgerloom.llm.components import components

SHINGLE_BASE = 0xD6E8FEB86659FD93
# Random variates are drawn for this many classes of shingles per sample.
POOL_BITS = 15
HUB_GROWTH = 4
# All pairs of a bucket with no more members than this are compared.
SMALL_BUCKET = 32
# Slots that tell which shingles only one class of compared texts has, as a power of two.
PRIVATE_BITS = 22
# Texts are worked on in blocks of about this many bytes: what a worker takes counts beside the JVM.
TEXT_BLOCK = 256 * 1024
# Width of a weight class, as a natural logarithm.
CLASS_STEP = 0.03


@dataclass(frozen=True)
class Settings:
    """``df_bits``: counters of document frequencies, as a power of two; they are broadcast with
    one byte each. More counters tell rarer shingles apart; none is left out for their number."""

    words: int = 5
    threshold: float = 0.8
    bands: int = 16
    rows: int = 5
    idf_gain: float = 0.15
    df_bits: int = 20
    seed: int = 7


# --- shingles ------------------------------------------------------------------------------


def _blocks(column: pa.Array):
    return word_blocks(column, block=TEXT_BLOCK)


def _shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle; a text of fewer than k words is one shingle."""
    counts = words.counts
    n = len(words.hashes)
    starts = np.flatnonzero(np.arange(k, n + k) <= words.row_ends())
    rows = np.searchsorted(words.first, starts, "right") - 1
    hashes = span_hashes(words.hashes, starts, starts + k, SHINGLE_BASE)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = span_hashes(words.hashes, words.first[short], words.first[short + 1], SHINGLE_BASE)
        order = np.argsort(np.concatenate([rows, short]), kind="stable")
        rows = np.concatenate([rows, short])[order]
        hashes = np.concatenate([hashes, whole])[order]
    return rows, hashes


def _distinct(rows: np.ndarray, hashes: np.ndarray, n_rows: int):
    """Bounds, distinct shingles (sorted within a text) and their counts."""
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    out, tf, sizes = [], [], np.zeros(n_rows, np.int64)
    for i in range(n_rows):
        if bounds[i] < bounds[i + 1]:
            own, count = np.unique(hashes[bounds[i] : bounds[i + 1]], return_counts=True)
            out.append(own)
            tf.append(count)
            sizes[i] = len(own)
    if not out:
        return sizes, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return sizes, np.concatenate(out), np.concatenate(tf)


def _document_hashes(settings: Settings):
    def run(batch: pa.RecordBatch):
        for at, to, words in _blocks(batch.column(0)):
            yield _distinct(*_shingles(words, settings.words), to - at)[1]

    return run


def idf_levels(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Scaled idf (0 to 255) by upper bits of the hash, from counts over all documents.

    Counters hold several shingles each; what they hold on average is taken off. The number of
    documents stands for the most frequent shingle.
    """
    counts = hashed_counts(texts.select("text"), _document_hashes(settings), settings.df_bits)
    documents = max(2, texts.count())
    shared = (counts.sum() - counts) / max(1, len(counts) - 1)
    df = np.clip(counts - shared, 1, documents)
    return np.rint(255 * (1 - np.log(df) / np.log(documents))).astype(np.uint8)


class Weights:
    def __init__(self, levels: np.ndarray, settings: Settings) -> None:
        self.levels, self.gain = levels, np.float32(settings.idf_gain / 255)
        self.shift = np.uint64(64 - settings.df_bits)

    def __call__(self, shingles: np.ndarray, tf: np.ndarray) -> np.ndarray:
        idf = self.levels[(shingles >> self.shift).astype(np.int64)]
        return tf.astype(np.float32) * (1 + self.gain * idf.astype(np.float32))


# --- sampling ------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _variates(samples: int, seed: int):
    """For each sample and shingle class: r, 1/r, beta and ln c - r."""
    random = np.random.default_rng(seed)
    shape = (samples, 1 << POOL_BITS)
    r, c, beta = (np.empty(shape, np.float32) for _ in range(3))
    # row by row: the generator's numbers of double width would take more than what is kept
    for out in (r, c):
        for row in out:
            row[:] = random.gamma(2.0, size=len(row))
    random.random(dtype=np.float32, out=beta)
    multipliers = random.integers(1 << 62, 1 << 63, samples, dtype=np.uint64) | np.uint64(1)
    inverse = 1 / r
    np.log(c, out=c)
    c -= r
    return r, inverse, beta, c, multipliers


def sample(shingles: np.ndarray, weights: np.ndarray, sizes: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """Samples of texts as hashes of (shingle, level): one row per text with shingles."""
    r, inverse, beta, base, multipliers = _variates(samples, seed)
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    logs = np.log(weights)
    out = np.empty((len(sizes), samples), np.uint64)
    shift = np.uint64(64 - POOL_BITS)
    for k in range(samples):
        at = ((shingles * multipliers[k]) >> shift).astype(np.int64)
        own_beta = beta[k][at]
        level = np.floor(logs * inverse[k][at] + own_beta)
        value = base[k][at] - r[k][at] * (level - own_beta)
        least = np.minimum.reduceat(value, starts)
        hits = np.flatnonzero(value == np.repeat(least, sizes))
        # of equal values the first, that is the smallest shingle
        first = hits[np.searchsorted(hits, starts)]
        out[:, k] = mixed(shingles[first] + mixed(level[first].astype(np.int64).view(np.uint64)))
    return out


def band_hashes(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(samples), bands), np.uint64)
    for b in range(bands):
        own = np.full(len(samples), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            own = mixed(own + samples[:, k])
        out[:, b] = own
    return out


def _sign(levels, settings: Settings):
    def run(batch: pa.RecordBatch):
        weigh = Weights(levels.value, settings)
        for at, to, words in _blocks(batch.column(2)):
            sizes, shingles, tf = _distinct(*_shingles(words, settings.words), to - at)
            rows = np.flatnonzero(sizes)
            bands = np.zeros((0, settings.bands), np.uint64)
            if len(rows):
                weights = weigh(shingles, tf)
                drawn = sample(shingles, weights, sizes, settings.bands * settings.rows, settings.seed)
                bands = band_hashes(drawn, settings.bands, settings.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, to - at),
                    batch.column(1).slice(at, to - at),
                    lists(longs(bands.reshape(-1)), np.where(sizes > 0, settings.bands, 0)),
                ],
                ["doc_id", "text_id", "bands"],
            )

    return run


# --- verification --------------------------------------------------------------------------


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - least
    return least / total if total else 0.0


def _verify(levels, settings: Settings):
    def features(column: pa.Array, weigh: Weights) -> list:
        found = []
        for at, to, words in _blocks(column):
            sizes, shingles, tf = _distinct(*_shingles(words, settings.words), to - at)
            weights = weigh(shingles, tf)
            stops = np.cumsum(sizes)
            found += [(shingles[b - n : b], weights[b - n : b]) for n, b in zip(sizes, stops)]
        return found

    def run(batch: pa.RecordBatch):
        _variates.cache_clear()  # a worker that verifies signs no more
        weigh = Weights(levels.value, settings)
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            hubs = part.column(2).dictionary_encode()
            of_hub = features(hubs.dictionary, weigh)
            of_other = features(part.column(3), weigh)
            scores = np.array(
                [similarity(of_hub[h], o) for h, o in zip(hubs.indices.to_pylist(), of_other)]
            )
            take = pa.array(np.flatnonzero(scores >= settings.threshold))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), part.column(1).take(take)], ["u", "v"]
            )

    return run


# --- classes -------------------------------------------------------------------------------


def _rooted_hashes(settings: Settings):
    """Shingles of each text with the hash of its root, from rows of root hash and text."""

    def run(batch: pa.RecordBatch):
        _variates.cache_clear()
        roots = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
        for at, to, words in _blocks(batch.column(1)):
            rows, shingles = _shingles(words, settings.words)
            yield shingles, roots[at:to][rows]

    return run


def _prefixes(levels, private, settings: Settings):
    """The rarest shingles of a text, by which it can meet a similar one.

    Shingles are ordered alike in all texts, rare ones first, without those that ``private`` marks:
    no other class of compared texts has them. Two similar texts share a weight of
    at least ``a = threshold / (1 + threshold)`` of both together. For the lighter one, of weight
    s, that is ``2 a s``; for the heavier one, of weight w, it is ``a (w + s)``. So the shingles up
    to which less than that is left must include a common one, and the bucket is that shingle
    with the weight class of the lighter text: a text gives the rows of both parts. ``shared`` is
    the weight of all shingles that are left.
    """
    private_shift = np.uint64(64 - PRIVATE_BITS)
    share = settings.threshold / (1 + settings.threshold) * (1 - 1e-6)
    names = ["text_id", "heavier", "shingle", "class", "weight", "shared"]

    def run(batch: pa.RecordBatch):
        weigh = Weights(levels.value, settings)
        for at, to, words in _blocks(batch.column(1)):
            sizes, shingles, tf = _distinct(*_shingles(words, settings.words), to - at)
            weights = weigh(shingles, tf).astype(np.float64)
            rare = weigh.levels[(shingles >> weigh.shift).astype(np.int64)].astype(np.int64)
            alone = private.value[(shingles >> private_shift).astype(np.int64)]
            found: list[tuple[int, int, int, float, float, np.ndarray]] = []
            stops = np.cumsum(sizes)
            for i in np.flatnonzero(sizes):
                own = slice(stops[i] - sizes[i], stops[i])
                order = np.lexsort((shingles[own], -rare[own]))
                order = order[~alone[own][order]]
                ranked = shingles[own][order]
                left = weights[own][order][::-1].cumsum()[::-1]
                total = weights[own].sum()
                shared = left[0] if len(left) else 0.0
                least = settings.threshold * total * (1 - 1e-6)
                top = math.floor(math.log(total) / CLASS_STEP)
                keep = np.count_nonzero(left >= 2 * share * total)
                found.append((i + at, 0, top, total, shared, ranked[:keep]))
                for c in range(math.floor(math.log(least) / CLASS_STEP), top + 1):
                    low = max(math.exp(c * CLASS_STEP), least)
                    keep = np.count_nonzero(left >= share * (total + low))
                    found.append((i + at, 1, c, total, shared, ranked[:keep]))
            if found:
                n = [len(f[5]) for f in found]
                columns = [np.repeat([f[k] for f in found], n) for k in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(columns[0])),
                        pa.array(columns[1] == 1),
                        longs(np.concatenate([f[5] for f in found])),
                        *[pa.array(c) for c in columns[2:]],
                    ],
                    names,
                )

    return run


class _Linker:
    """Links texts of shared buckets until no pair of a bucket is left that could join classes."""

    def __init__(self, texts: DataFrame, levels, settings: Settings) -> None:
        self.texts, self.levels, self.settings = texts, levels, settings
        self.classes: DataFrame | None = None

    def unsettled(self, members: DataFrame) -> DataFrame:
        """Members of buckets with several classes: ``bucket, text_id, degree, root, size``."""
        if self.classes is None:
            placed = members.withColumn("root", F.col("text_id"))
        else:
            placed = members.join(self.classes, F.col("text_id") == F.col("node"), "left").select(
                *members.columns, F.coalesce("root", "text_id").alias("root")
            )
        placed = stage(placed, "near-placed")
        mixed_up = stage(
            placed.groupBy("bucket")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
            .where("low != high")
            .select("bucket", "size"),
            "near-buckets",
        )
        return stage(placed.join(mixed_up, "bucket"), "near-members")

    def link(self, pairs: DataFrame) -> None:
        """Compare pairs (u, v) and join the classes of those that are similar."""
        pairs = stage(
            pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
            "near-pairs",
        )
        with_v = pairs.join(self.texts.withColumnRenamed("text", "v_text"), F.col("v") == F.col("text_id"))
        both = with_v.select("u", "v", "v_text").join(
            self.texts.withColumnRenamed("text", "u_text"), F.col("u") == F.col("text_id")
        )
        verify = _verify(self.levels, self.settings)
        both = both.select("u", "v", "u_text", "v_text")
        links = stage(map_arrow(both, verify, "u binary, v binary"), "near-links")
        if not links.head(1):
            return
        if self.classes is not None:
            links = links.union(self.classes.select(F.col("node").alias("u"), F.col("root").alias("v")))
        self.classes = components(links)

    def with_hubs(self, members: DataFrame, hubs: int) -> DataFrame:
        """Compare all members with the hubs of their bucket; the members that are none are left."""
        part = F.pmod(F.xxhash64("text_id", F.lit(hubs)), F.lit(hubs))
        chosen = (
            members.groupBy("bucket", part.alias("part"))
            .agg(F.max(F.struct("degree", "text_id", "root")).alias("hub"))
            .select("bucket", F.col("hub.text_id").alias("hub"), F.col("hub.root").alias("hub_root"))
        )
        chosen = stage(chosen, "near-hubs")
        joined = members.join(chosen, "bucket").where("root != hub_root")
        self.link(joined.select(F.col("text_id").alias("u"), F.col("hub").alias("v")))
        done = chosen.select("bucket", F.col("hub").alias("text_id"))
        return members.select("bucket", "text_id", "degree").join(done, ["bucket", "text_id"], "left_anti")

    def all_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of small buckets that are not in one class."""
        left = members.select("bucket", F.col("text_id").alias("u"), F.col("root").alias("u_root"))
        right = members.select("bucket", F.col("text_id").alias("v"), F.col("root").alias("v_root"))
        return left.join(right, "bucket").where("u < v and u_root != v_root").select("u", "v")

    def near_pairs(self, rare: DataFrame) -> DataFrame:
        """Pairs that meet in a bucket of rare shingles, whose weights allow them to be similar, and
        that are not in one class."""
        share = self.settings.threshold / (1 + self.settings.threshold) * (1 - 1e-6)
        rare = rare.select(
            F.xxhash64("shingle", "class").alias("bucket"), "text_id", "heavier", "weight", "shared"
        )
        left = self.unsettled(rare)
        own = ("text_id", "root", "weight", "shared")
        u = left.where("not heavier").select("bucket", *[F.col(c).alias(f"u_{c}") for c in own])
        v = left.where("heavier").select("bucket", *[F.col(c).alias(f"v_{c}") for c in own])
        fits = F.least("u_shared", "v_shared") >= share * (F.col("u_weight") + F.col("v_weight"))
        order = F.struct("u_weight", "u_text_id") < F.struct("v_weight", "v_text_id")
        both = u.join(v, "bucket").where((F.col("u_root") != F.col("v_root")) & order & fits)
        return both.select(F.col("u_text_id").alias("u"), F.col("v_text_id").alias("v"))

    def run(self, members: DataFrame) -> DataFrame | None:
        """Root of each text that is linked to another: ``node, root``."""
        members = members.join(members.groupBy("text_id").agg(F.count("*").alias("degree")), "text_id")
        hubs = 1
        for _ in range(2):
            left = self.unsettled(members)
            members = self.with_hubs(left, hubs)
            hubs *= HUB_GROWTH
        left = self.unsettled(members)
        small, large = left.where(F.col("size") <= SMALL_BUCKET), left.where(F.col("size") > SMALL_BUCKET)
        pairs = self.all_pairs(small)
        if large.head(1):
            compared = self.texts.join(large.select("text_id", "root").distinct(), "text_id")
            compared = stage(compared, "near-large")
            rooted = compared.select(F.xxhash64("root").alias("root_hash"), "text")
            alone = single_marks(rooted, _rooted_hashes(self.settings), PRIVATE_BITS)
            private = compared.sparkSession.sparkContext.broadcast(alone)
            rare = map_arrow(
                compared.select("text_id", "text").repartition("text_id"),
                _prefixes(self.levels, private, self.settings),
                "text_id binary, heavier boolean, shingle long, class long, weight double, "
                "shared double",
            )
            pairs = pairs.union(self.near_pairs(rare))
        self.link(pairs)
        return self.classes


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Classes of texts that are copies or near copies: ``doc_id, text_id, class_id, class_size,
    kept``, one row per row of ``docs``.

    ``text_id`` is the MD5 of the text. ``class_id`` is the smallest id of the class and
    ``kept`` marks its rows. Null texts, and texts without a word, are like no other: each is a
    class of its own. Repeated rows (same id, same text) are kept alike. Null ids count as
    larger than all others when the row to keep is chosen.
    """
    table = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.md5(F.col(text_col))).alias("text_id"),
        F.col(text_col).alias("text"),
    )
    texts = table.where(F.col("text").isNotNull())
    context = docs.sparkSession.sparkContext
    levels = context.broadcast(idf_levels(texts, settings))
    signed = stage(
        map_arrow(table, _sign(levels, settings), "doc_id long, text_id binary, bands array<long>"),
        "near-bands",
    )
    comparable = F.size("bands") > 0
    unique = signed.where(comparable).groupBy("text_id").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))
    unique = stage(unique, "near-texts")
    in_bands = unique.select("text_id", F.posexplode("bands").alias("band", "hash")).select(
        "text_id", F.xxhash64("band", "hash").alias("bucket")
    )
    shared = in_bands.groupBy("bucket").count().where("count > 1").select("bucket")
    shared = stage(shared, "near-buckets")
    members = stage(in_bands.join(shared, "bucket", "left_semi").select("bucket", "text_id"), "near-members")
    compared = unique.join(members.select("text_id").distinct(), "text_id", "left_semi").select(
        F.col("text_id").alias("own_text"), F.col("doc_id").alias("own_id")
    )
    # one row holds the text to compare; the join is on the id, of which there are few rows each
    held = texts.join(
        compared, same(F.col("doc_id"), F.col("own_id")) & (F.col("text_id") == F.col("own_text"))
    )
    held = stage(held.groupBy("text_id").agg(F.first("text").alias("text")), "near-compared")
    linked = _Linker(held, levels, settings).run(members)

    rows = signed.where(comparable).select("doc_id", "text_id")
    if linked is None:
        rooted = rows.withColumn("root", F.col("text_id"))
    else:
        rooted = rows.join(linked, F.col("text_id") == F.col("node"), "left").select(
            "doc_id", "text_id", F.coalesce("root", "text_id").alias("root")
        )
    rooted = stage(rooted, "near-rooted")
    sizes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    # of one id with several texts in a class, one text stays
    holder = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id")).alias("best")
    )
    classed = (
        rooted.join(sizes.join(holder, "root"), "root")
        .select(
            "doc_id",
            "text_id",
            "class_id",
            "class_size",
            (same(F.col("best.doc_id"), F.col("doc_id")) & (F.col("best.text_id") == F.col("text_id"))).alias("kept"),
        )
    )
    alone = signed.where(~comparable).select(
        "doc_id",
        "text_id",
        F.col("doc_id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(True).alias("kept"),
    )
    return stage(classed.union(alone), "near-classes")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``docs`` of which one per class stays, repeated rows as well."""
    kept = near_duplicates(docs, id_col, text_col, settings).where("kept")
    at_id, at_text = fresh_name(docs, "kept_id"), fresh_name(docs, "kept_text")
    kept = kept.select(F.col("doc_id").alias(at_id), F.col("text_id").alias(at_text)).distinct()
    own = docs.columns
    with_text = docs.withColumn(fresh_name(docs, "text_id"), F.unhex(F.md5(F.col(text_col))))
    key = fresh_name(docs, "text_id")
    stays = with_text.join(
        kept, same(docs[id_col].cast("long"), F.col(at_id)) & same(F.col(key), F.col(at_text)), "left_semi"
    )
    # rows that repeat id and text are copies of each other too
    return stays.dropDuplicates([id_col, key]).select(*own)
