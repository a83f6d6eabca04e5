"""Quality classifier on supervised subword embeddings.

A text is the bag of its words, its pairs of adjacent words and the 3- to 5-byte runs inside its
words, each hashed into a table of embedding vectors; a word that repeats the one before it has a
bucket of its own. The vectors are averaged per text and go through a softmax layer. Vectors and
layer are learned together by stochastic gradient descent in numpy.

Learning takes a bounded sample of the labelled rows (a parameter); their features are made by
Spark tasks. As the output of an average of vectors is linear in the bag, a learned model is
one number per bucket, and scoring is one look-up per feature, over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import lists, map_arrow, mixed, stage, word_blocks

GRAMS = (3, 4, 5)
GRAM_BASE = 0x27D4EB2F165667C5


@dataclass(frozen=True)
class Settings:
    """``sample``: bound on labelled rows to learn from; ``bits``: buckets as a power of two."""

    sample: int = 2_500
    bits: int = 16
    size: int = 12
    epochs: int = 8
    batch: int = 16
    rate: float = 0.8
    decay: float = 1e-6
    seed: int = 11


def features(words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every feature of a block of texts, in no order."""
    shift = np.uint64(64 - bits)
    rows = words.rows()
    out_rows, out = [rows], [mixed(words.hashes + np.uint64(1)) >> shift]
    if len(rows) > 1:
        left = np.flatnonzero(rows[1:] == rows[:-1])
        a, b = words.hashes[left], words.hashes[left + 1]
        pair = np.where(a == b, np.uint64(2), mixed(a * np.uint64(3) + b))
        out_rows.append(rows[left])
        out.append(mixed(pair) >> shift)
    # byte runs inside words: all bytes of all words, each with the end of its word
    lengths = words.ends - words.starts
    if len(lengths):
        first = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) + np.repeat(words.starts - first, lengths)
        signs = words.data[places].astype(np.uint64)
        ends = np.repeat(words.ends, lengths)
        own = np.repeat(rows, lengths)
        power = np.uint64(GRAM_BASE)
        value = np.zeros(len(signs), np.uint64)
        for k in range(max(GRAMS)):
            shifted = np.zeros_like(signs)
            shifted[: len(signs) - k] = signs[k:] + np.uint64(1)
            value = value * power + shifted
            if k + 1 in GRAMS:
                inside = np.flatnonzero(places + (k + 1) <= ends)
                out_rows.append(own[inside])
                out.append(mixed(value[inside] + np.uint64(k)) >> shift)
    return np.concatenate(out_rows), np.concatenate(out).astype(np.int64)


def _bags(bits: int):
    """Distinct buckets and their share of each text."""

    def run(batch: pa.RecordBatch):
        for at, to, words in word_blocks(batch.column(0)):
            rows, slots = features(words, bits)
            keys, counts = np.unique((rows.astype(np.int64) << bits) | slots, return_counts=True)
            of = keys >> bits
            sizes = np.bincount(of, minlength=to - at)
            totals = np.bincount(of, counts, minlength=to - at)
            share = (counts / totals[of]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).slice(at, to - at),
                    batch.column(2).slice(at, to - at),
                    lists(pa.array((keys & ((1 << bits) - 1)).astype(np.int32)), sizes),
                    lists(pa.array(share), sizes),
                ],
                ["train_id", "label", "slots", "shares"],
            )

    return run


@dataclass(frozen=True)
class Model:
    """What each bucket adds to the log odds of label 1, and what every text starts from."""

    weights: np.ndarray
    bias: float
    bits: int


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings = Settings()) -> Model:
    """Embedding vectors and softmax layer from (label, buckets, shares), by minibatch SGD.

    Both classes weigh as they occur, so scores are probabilities. Without rows of both labels
    the model gives the smoothed share of label 1.
    """
    size = 1 << settings.bits
    labels = np.array([b[0] for b in bags], np.int64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    flat = Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))), settings.bits)
    if len(set(labels.tolist())) < 2:
        return flat
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (size, settings.size)).astype(np.float32) / settings.size
    layer = np.zeros((settings.size, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps = settings.epochs * -(-len(bags) // settings.batch)
    step = 0
    for _ in range(settings.epochs):
        order = random.permutation(len(bags))
        for at in range(0, len(order), settings.batch):
            chosen = order[at : at + settings.batch]
            rate = np.float32(settings.rate * (1 - step / steps))
            step += 1
            slots = np.concatenate([bags[i][1] for i in chosen])
            shares = np.concatenate([bags[i][2] for i in chosen])
            sizes = np.array([len(bags[i][1]) for i in chosen])
            of = np.repeat(np.arange(len(chosen)), sizes)
            hidden = np.zeros((len(chosen), settings.size), np.float32)
            weighted = vectors[slots] * shares[:, None]
            full = sizes > 0
            starts = np.cumsum(sizes) - sizes
            if full.any():
                hidden[full] = np.add.reduceat(weighted, starts[full], axis=0)
            logits = hidden @ layer + bias
            logits -= logits.max(axis=1, keepdims=True)
            odds = np.exp(logits)
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            back = error @ layer.T
            layer -= rate * (hidden.T @ error / len(chosen) + np.float32(settings.decay) * layer)
            bias -= rate * error.mean(axis=0)
            # rare buckets get as large a step as frequent ones, as each text moves its own vectors
            push = (rate * shares[:, None]) * back[of] * np.sqrt(sizes)[of][:, None].astype(np.float32)
            np.subtract.at(vectors, slots, push)
    return Model(
        np.ascontiguousarray(vectors @ (layer[:, 1] - layer[:, 0])), float(bias[1] - bias[0]), settings.bits
    )


def learn(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """Model from rows (train_id, text, label); their number is bounded by ``settings.sample``."""
    bags = map_arrow(
        rows.select("text", "train_id", "label"),
        _bags(settings.bits),
        "train_id long, label int, slots array<int>, shares array<float>",
    )
    held = stage(bags, "quality-bags").orderBy("train_id").limit(settings.sample).toArrow()
    slots, shares = held.column("slots").combine_chunks(), held.column("shares").combine_chunks()
    offsets = slots.offsets.to_numpy()
    flat, weights = slots.values.to_numpy(), shares.values.to_numpy()
    labels = held.column("label").to_pylist()
    return train(
        [(y, flat[a:b].astype(np.int64), weights[a:b]) for y, a, b in zip(labels, offsets, offsets[1:])],
        settings,
    )


def _score(model):
    def run(batch: pa.RecordBatch):
        held = model.value
        out = np.zeros(batch.num_rows)
        for at, to, words in word_blocks(batch.column(0)):
            rows, slots = features(words, held.bits)
            sums = np.bincount(rows, held.weights[slots], minlength=to - at)
            counts = np.bincount(rows, minlength=to - at)
            z = held.bias + sums / np.maximum(counts, 1)
            out[at:to] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in range(1, batch.num_columns)], pa.array(out)],
            [*batch.schema.names[1:], "score"],
        )

    return run


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1, probability of label 1); such a column is replaced.

    Each text is read whole. Null and empty texts have no features: their score is what the bias
    gives.
    """
    own = [c for c in (docs.columns if carry is None else carry) if c.lower() != "score"]
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*own).schema
    )
    return map_arrow(docs.select(docs[text_col].alias("_text"), *own), _score(held), f"{fields}score double")
