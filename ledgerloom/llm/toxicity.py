"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Texts are folded first: lower case, look-alike letters of other scripts and digits or signs that
stand for letters become plain letters, invisible characters go. Lexicon entries are whole words
or word stems, and match at word starts only. Where an exception phrase matches, entries inside
it don't count.

The lexicon is learned from labelled documents: an entry is kept if it occurs in enough toxic
documents and nearly only in those; its weight is its smoothed log odds. Where an entry occurs in clean
documents, the word before or after it makes an exception phrase if enough clean documents have the phrase
and no toxic one does. Entries and exceptions can be given by hand as well. The score is a logistic
function of the weights found, normalised by the text's length.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_arrow, ship, stage

# Letters that look like these Latin ones, and signs that stand for them.
LOOKALIKES = {
    "a": "аαɑ４4@", "b": "Ьв", "c": "сϲ", "d": "ԁ", "e": "еεё3€", "g": "ɡ", "h": "һн", "i": "іι1!|ı",
    "j": "ј", "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ",
    "s": "ѕ5$", "t": "тτ7", "u": "υս", "v": "ν", "w": "ѡԝ", "x": "хχ", "y": "уγ", "z": "ᴢ",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
LETTERS = str.maketrans(
    {sign: letter for letter, signs in LOOKALIKES.items() for sign in signs if ord(sign) > 127}
    | dict.fromkeys(INVISIBLE)
)
SIGNS = str.maketrans(
    {sign: letter for letter, signs in LOOKALIKES.items() for sign in signs if ord(sign) < 128}
)
# Signs stand for letters before a letter; digits after one, too.
SIGN_RUNS = re.compile(r"[013457@$!|]+(?=[a-z])|(?<=[a-z])[013457]+")

# Phrases in which a lexicon word is meant otherwise, beside the learned ones.
EXCEPTIONS = ("clown fish", "clownfish", "trash can", "trash bin", "lose weight", "sore loser clause")

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """``sample``: bound on the labelled rows that are learned from, taken by a hash of their id.

    An entry needs ``support`` toxic documents and a share of at least ``precision`` of them. All such entries are
    kept; ``learn`` raises beyond ``entries``, as they are held by every task. Stems have between
    ``least_stem`` and ``most_stem`` letters: a longer one only tells apart words that share its first
    ``most_stem``, and those are entries as whole words. An exception needs ``exception_support`` clean documents."""

    sample: int = 20_000
    support: int = 6
    precision: float = 0.97
    least_stem: int = 4
    most_stem: int = 8
    entries: int = 100_000
    exception_support: int = 3
    exceptions: tuple[str, ...] = EXCEPTIONS
    given: tuple[tuple[str, float], ...] = ()


def fold(text: str) -> str:
    low = text.lower()
    if not low.isascii():
        low = low.translate(LETTERS)
    return SIGN_RUNS.sub(lambda m: m[0].translate(SIGNS), low)


def _terms(settings: Settings):
    """Distinct words and stems (with a star) of each training text, counted per task."""

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(fold(text or "")))
                found = set(words)
                for word in words:
                    for k in range(settings.least_stem, min(len(word), settings.most_stem) + 1):
                        found.add(f"{word[:k]}*")
                for term in found:
                    counts.setdefault(term, [0, 0])[toxic] += 1
            if len(counts) > 500_000:
                yield _term_batch(counts)
                counts = {}
        yield _term_batch(counts)

    return run


def _term_batch(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(counts), pa.string()),
            pa.array([c[0] for c in counts.values()], pa.int64()),
            pa.array([c[1] for c in counts.values()], pa.int64()),
        ],
        ["term", "clean", "toxic"],
    )


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, held_out, sample: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Text and label of up to ``sample`` labelled documents that are not held out.

    Rows with a null id or label, and ids with contradictory labels, teach nothing.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("other"))
        .where("label = other and label in (0, 1)")
        .drop("other")
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("train_id"), F.col(text_col).alias("text"))
    return texts.join(known, F.col("train_id") == F.col("label_id")).select("train_id", "text", "label")


@dataclass(frozen=True)
class Lexicon:
    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    bias: float = -4.0
    slope: float = 1.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.entries:
            stem = term.endswith("*")
            found.add_word(term.rstrip("*"), (len(term.rstrip("*")), weight, not stem))
        for phrase in self.exceptions:
            folded = fold(phrase)
            if folded not in found:
                found.add_word(folded, (len(folded), 0.0, True))
        found.make_automaton()
        return found


def find(automaton, folded: str) -> float:
    """Sum of weights: at each word start the longest match counts, unless an exception holds it."""
    best: dict[int, tuple[int, float]] = {}
    n = len(folded)
    for end, (length, weight, whole) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalnum():
            continue
        if whole and end + 1 < n and folded[end + 1].isalnum():
            continue
        if start not in best or best[start][0] < length:
            best[start] = (length, weight)
    if not best:
        return 0.0
    total, guarded = 0.0, -1
    for start in sorted(best):
        length, weight = best[start]
        if weight == 0.0:
            guarded = max(guarded, start + length)
        elif start >= guarded:
            total += weight
    return total


def feature(weight: float, words: int) -> float:
    """Weights found per word, on a scale on which a rate counts by its order of magnitude."""
    return math.log1p(1000.0 * weight / max(words, 1))


@lru_cache(maxsize=2)
def _automaton(lexicon: Lexicon):
    return lexicon.automaton()


def _features(lexicon):
    def run(batch: pa.RecordBatch):
        held = lexicon.value
        automaton = _automaton(held) if held.entries else None
        out = []
        for text in batch.column(0):
            text = text.as_py()
            if not text or automaton is None:
                out.append(0.0)
                continue
            weight = find(automaton, fold(text))
            out.append(feature(weight, len(text.split())) if weight else 0.0)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in range(1, batch.num_columns)], pa.array(out, pa.float64())],
            [*batch.schema.names[1:], "lexicon_rate"],
        )

    return run


def _calibrate(rates: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve by Newton steps, with a little ridge."""
    x = np.column_stack([np.ones(len(rates)), rates])
    w = np.array([-4.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + 0.05 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def phrases_around(automaton, folded: str) -> set[str]:
    """Every word that an entry matches with the word before and with the word after, one space between."""
    spans = [m.span() for m in WORD.finditer(folded)]
    found = set()
    for i, (start, stop) in enumerate(spans):
        if not find(automaton, folded[start:stop]):
            continue
        for first, last in ((i - 1, i), (i, i + 1)):
            if first < 0 or last == len(spans):
                continue
            (left, end), (begin, right) = spans[first], spans[last]
            if folded[end:begin] == " ":
                found.add(folded[left:right])
    return found


def _exceptions(rows: DataFrame, lexicon, settings: Settings) -> list[str]:
    """Phrases around entries that only clean documents have."""

    def run(batch: pa.RecordBatch):
        automaton = _automaton(lexicon.value) if lexicon.value.entries else None
        phrases, labels = [], []
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_py()
            if text and automaton is not None:
                found = phrases_around(automaton, fold(text))
                phrases.extend(found)
                labels.extend([label] * len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], ["phrase", "label"]
        )

    kept = (
        map_arrow(rows.select("text", "label"), run, "phrase string, label int")
        .groupBy("phrase")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("documents"))
        .where((F.col("toxic") == 0) & (F.col("documents") >= settings.exception_support))
        .limit(settings.entries + 1)
        .collect()
    )
    if len(kept) > settings.entries:
        raise ValueError(f"more than {settings.entries} exception phrases; ask for more exception_support")
    return [r["phrase"] for r in kept]


def learn(rows: DataFrame, settings: Settings = Settings()) -> Lexicon:
    """Lexicon and calibration from rows (train_id, text, label), a bounded number of them."""
    rows = stage(rows, "toxic-training")
    ship(rows.sparkSession)
    clean, toxic = rows.agg(
        F.sum((F.col("label") == 0).cast("long")), F.sum((F.col("label") == 1).cast("long"))
    ).first()
    clean, toxic = clean or 0, toxic or 0
    counts = rows.select("text", "label").mapInArrow(_terms(settings), "term string, clean long, toxic long")
    # counts of terms: entries are few, whatever the number of words
    kept = (
        counts.groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= settings.support) & (F.col("toxic") >= settings.precision * (F.col("toxic") + F.col("clean"))))
        .limit(settings.entries + 1)
        .collect()
    )
    if len(kept) > settings.entries:
        raise ValueError(f"more than {settings.entries} lexicon entries; ask for more support or precision")
    entries: dict[str, float] = {}
    stems: set[str] = set()
    for row in sorted(kept, key=lambda r: (len(r["term"].rstrip("*")), not r["term"].endswith("*"), r["term"])):
        word = row["term"].rstrip("*")
        covered = any(word[:k] in stems for k in range(settings.least_stem, len(word) + 1))
        if covered:
            continue
        if row["term"].endswith("*"):
            stems.add(word)
        odds = (row["toxic"] + 0.5) * (clean + 1) / ((row["clean"] + 0.5) * (toxic + 1))
        entries[row["term"]] = max(math.log(odds), 0.1)
    entries.update(dict(settings.given))
    # a stem and a word of the same letters are one key of the automaton: the stem matches both
    merged = {t: w for t, w in entries.items() if t.endswith("*") or f"{t}*" not in entries}
    lexicon = Lexicon(tuple(sorted(merged.items())), settings.exceptions)
    if not clean or not toxic:
        return lexicon
    spark = rows.sparkSession
    phrases = _exceptions(rows, spark.sparkContext.broadcast(lexicon), settings)
    lexicon = Lexicon(lexicon.entries, tuple(sorted({*settings.exceptions, *phrases})))
    held = spark.sparkContext.broadcast(lexicon)
    scored = map_arrow(rows.select("text", "label"), _features(held), "label int, lexicon_rate double").collect()
    rates = np.array([r["lexicon_rate"] for r in scored])
    bias, slope = _calibrate(rates, np.array([r["label"] for r in scored], float))
    return Lexicon(lexicon.entries, lexicon.exceptions, bias, slope)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``lexicon_rate`` and ``score`` (0 to 1); such columns are replaced.

    Each text is read whole. Null and empty texts have rate 0, and so the lowest score.
    """
    own = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("lexicon_rate", "score")]
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    fields = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*own).schema
    )
    table = docs.select(docs[text_col].alias("_text"), *own)
    rated = map_arrow(table, _features(held), f"{fields}lexicon_rate double")
    z = F.lit(lexicon.bias) + F.lit(lexicon.slope) * F.col("lexicon_rate")
    return rated.withColumn("score", 1 / (1 + F.exp(-z)))
