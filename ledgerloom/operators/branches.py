"""Inner joins that count, while they run, which rows they leave out."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ENTERED = "entered"
_MATCHED = "branch_matched"


class Branches:
    """The rows that enter a chain of joins, and those that each join drops.

    A counted join is a left join whose unmatched rows are observed and go at once, before any
    further shuffle: the same rows as an inner join gives, at no further pass over the left side.
    The rows that should come out follow without the joins' result: those that entered, less
    those dropped. A key that the right side repeats shows as more rows than that.

    Tasks that run again after their executor was lost may be observed twice, so ``expected``
    is a witness to compare with, not a proof.
    """

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}

    def _observe(self, rows: DataFrame, step: str, counted) -> DataFrame:
        self._steps[step] = Observation()
        return rows.observe(self._steps[step], F.count(counted).alias("rows"))

    def enter(self, rows: DataFrame) -> DataFrame:
        return self._observe(rows, ENTERED, F.lit(1))

    def join(self, rows: DataFrame, other: DataFrame, key: str, step: str) -> DataFrame:
        joined = rows.join(other.withColumn(_MATCHED, F.lit(True)), key, "left")
        seen = self._observe(joined, step, F.when(F.col(_MATCHED).isNull(), 1))
        return seen.where(F.col(_MATCHED)).drop(_MATCHED)

    def counts(self) -> dict[str, int]:
        """What was observed, once the frame has been written; steps that no stage ran are missing."""
        found = {step: _rows_of(seen) for step, seen in self._steps.items()}
        return {step: rows for step, rows in found.items() if rows is not None}

    def agreed(self, rows: int) -> dict[str, int]:
        """The counts if they are complete and give the rows written, else none: then only a recount can tell."""
        counts = self.counts()
        return counts if set(counts) == set(self._steps) and expected(counts) == rows else {}


def _rows_of(seen: Observation) -> int | None:
    """What a finished write observed. Spark cuts the rest of a plan off once a side turns out empty;
    asked for an observation in that part, it fails to assert that there is a row."""
    try:
        return seen.get.get("rows")
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return None


def expected(counts: Mapping[str, int]) -> int | None:
    """The rows that should have come out, or None if the entering rows were not counted."""
    if ENTERED not in counts:
        return None
    return counts[ENTERED] - sum(rows for step, rows in counts.items() if step != ENTERED)


def inner_join(
    rows: DataFrame, other: DataFrame, key: str, branches: Branches | None, step: str
) -> DataFrame:
    return rows.join(other, key) if branches is None else branches.join(rows, other, key, step)
