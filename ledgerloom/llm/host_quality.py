"""Quality rules by host: rule failures are counted per host, shrunk towards what hosts are like
in general, and the verdict on a host is joined back to its documents.

DataFrame functions only. Rules of a document are computed once and written; hosts are then
counted with partial aggregation, so a host with a third of all rows sends one row per task. The
prior is fitted on four sums over the hosts. The join back is skewed by the hot host on the
side of the documents only, which AQE splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_SPACE, fresh_name, same, stage

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    """Limits of the rules. A host is rejected if its shrunk failure rate lies above ``reject_factor``
    times the rate of all documents, by ``reject_deviations`` standard deviations of its posterior."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_mean_word: int = 25
    reject_factor: float = 2.0
    reject_deviations: float = 2.0
    least_strength: float = 1.0
    most_strength: float = 1000.0


# The names that the operator adds.
RULES = ("fails_short", "fails_repeats", "fails_symbols", "fails_lines", "fails_word_length")
NEW = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    *RULES, "base_failed", "any_failed", "host_docs", "host_failed", "host_rate",
    "host_rejected", "kept",
)


def _covered(places: Column) -> Column:
    """Words covered by windows that start at these (sorted) places."""
    last = F.size(places) - 1
    return F.aggregate(
        F.sequence(F.lit(0), last),
        F.lit(0).cast("long"),
        lambda total, i: total
        + F.when(i == last, F.lit(WINDOW)).otherwise(F.least(F.get(places, i + 1) - F.get(places, i), F.lit(WINDOW))),
    )


def _with_counts(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Adds the counts of each text under ``names``; each step reads columns of the step before,
    so that no array is built anew inside a lambda."""
    words, lines, windows, order = (names[n] for n in ("words", "lines", "windows", "order"))
    empty = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn(words, F.filter(F.split(empty, WORD_SPACE), lambda w: w != ""))
    docs = docs.withColumn(lines, F.filter(F.split(empty, "\n"), lambda x: F.translate(x, SPACES, "") != ""))
    # a window is told by the hash of its words' hashes
    hashed = names["hashed"]
    docs = docs.withColumn(hashed, F.transform(words, lambda w: F.xxhash64(w)))
    docs = docs.withColumn(
        windows,
        F.when(
            F.size(words) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col(hashed), i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # only texts with a repeated window are sorted
    docs = docs.withColumn(
        order,
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        order,
        lambda x, i: (F.get(F.col(order), i + 1)["h"] == x["h"]) | (F.get(F.col(order), i - 1)["h"] == x["h"]),
    )
    # beside the ends of the array the comparison is null, which filters like false unless the
    # other neighbour agrees
    docs = docs.withColumn(names["places"], F.sort_array(F.transform(twice, lambda x: x["i"])))
    kept = [c for c in docs.columns if c not in (order, windows, hashed)]
    return docs.select(
        *kept,
        F.size(words).cast("long").alias(names["n_words"]),
        F.length(F.translate(empty, SPACES, "")).cast("long").alias(names["word_chars"]),
        (F.length(empty) - F.length(F.translate(empty, SYMBOLS, ""))).cast("long").alias(names["n_symbols"]),
        F.size(lines).cast("long").alias(names["n_lines"]),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(names["n_dup_lines"]),
        F.when(F.size(names["places"]) > 0, _covered(F.col(names["places"])))
        .otherwise(0)
        .cast("long")
        .alias(names["n_repeat_words"]),
    ).drop(words, lines, names["places"])


def rule_failures(
    docs: DataFrame,
    text_col: str = "text",
    settings: Settings = Settings(),
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with the counts and the outcome of every rule."""
    new = {n.lower() for n in NEW}
    own = [c for c in docs.columns if c.lower() not in new]
    temporary = ("words", "lines", "hashed", "windows", "order", "places")
    names = {n: fresh_name(docs, f"{n}_of_text") for n in temporary} | {n: n for n in NEW}
    counted = _with_counts(docs.select(*own), text_col, names)
    n, chars = F.col("n_words"), F.col("word_chars")
    if carry is not None:
        counted = counted.select(*[c for c in own if c in carry], *[n for n in NEW if n in counted.columns])
    counted = counted.withColumns(
        {
            "fails_short": n < settings.min_words,
            "fails_repeats": 100 * F.col("n_repeat_words") > settings.max_repeat_percent * n,
            "fails_symbols": 100 * F.col("n_symbols") > settings.max_symbol_percent * chars,
            "fails_lines": 100 * F.col("n_dup_lines") > settings.max_dup_line_percent * F.col("n_lines"),
            "fails_word_length": chars > settings.max_mean_word * n,
        }
    )
    failed = F.lit(False)
    for rule in RULES:
        failed = failed | F.col(rule)
    return counted.withColumns(
        {"base_failed": F.col("fails_short") | F.col("fails_repeats"), "any_failed": failed}
    )


def host_verdicts(rules: DataFrame, host_col: str, settings: Settings = Settings()) -> DataFrame:
    """One row per host (null is a host too): documents, failures, shrunk rate and verdict.

    The beta prior has the failure rate of all documents as its mean. Its strength comes from the
    spread of the hosts' rates around that mean, less what chance alone would give, by moments:
    hosts that are all alike give the strongest prior, hosts that differ widely the weakest.

    A host's posterior is a beta distribution as well. The host is rejected where even a rate some
    standard deviations below the posterior's mean is a multiple of the rate of all documents: a host with a few documents
    stays unless hosts differ widely in general, one with many goes by its own failures.
    """
    hosts = rules.groupBy(F.col(host_col).alias("host")).agg(
        F.count("*").alias("host_docs"), F.sum(F.col("any_failed").cast("long")).alias("host_failed")
    )
    rate = F.col("host_failed") / F.col("host_docs")
    mean = F.sum("host_failed") / F.sum("host_docs")
    hosts = stage(hosts, "host-counts")
    docs, mean, squares, n = hosts.agg(
        F.sum("host_docs"), mean, F.sum(F.col("host_docs") * rate * rate), F.count("*")
    ).first()
    mean, strength = mean or 0.0, settings.most_strength
    if docs:
        # variance among the hosts' true rates: observed spread less the binomial part
        chance = mean * (1 - mean) * n / docs
        variance = squares / docs - mean * mean - chance
        if variance * (settings.most_strength + 1) > mean * (1 - mean):
            strength = max(settings.least_strength, mean * (1 - mean) / variance - 1)
    shrunk = (F.col("host_failed") + mean * strength) / (F.col("host_docs") + strength)
    rate = F.col("host_rate")
    deviation = F.sqrt(rate * (1 - rate) / (F.col("host_docs") + strength + 1))
    return hosts.withColumn("host_rate", shrunk).withColumn(
        "host_rejected", rate - settings.reject_deviations * deviation > settings.reject_factor * mean
    )


def judge(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    settings: Settings = Settings(),
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with counts, rules, the host's figures and ``kept``.

    A document stays unless it fails the base rules (too short, too repetitive) or its host is
    rejected. Null and empty texts have no words and fail; their failure counts for the host. A
    null host is a host. Columns of ``docs`` that bear a name of ``NEW`` are replaced. ``carry``
    names the columns to keep (all if None), the host's among them.
    """
    rules = stage(rule_failures(docs, text_col, settings, carry), "host-rules")
    host = fresh_name(rules, "host")
    verdicts = host_verdicts(rules, host_col, settings).withColumnRenamed("host", host)
    joined = rules.join(verdicts, same(rules[host_col], F.col(host)), "left").drop(host)
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
