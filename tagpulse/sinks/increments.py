"""Incremental batch layer (E3, S2): each run reads the archive folders that no run before has read.

Which folders are done is a manifest of ranges of batch numbers, committed in one step after the run's rows are written.  A run that
dies before that leaves the manifest as it was: the next one reads the same folders and overwrites what the dead one wrote.
Readers take the increments that the manifest has, so they see no half-done run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tagpulse.schemas import SENTIMENT
from tagpulse.sinks import manifest
from tagpulse.sinks.keyed import SMALLEST, KeyedView
from tagpulse.sinks.writers import batches


def ranges(numbers: Iterable[int]) -> list[list[int]]:
    """Numbers as sorted ``[first, last]`` ranges: as long as no batch is left out there is one, however many batches there are."""
    out: list[list[int]] = []
    for n in sorted(set(numbers)):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _joined(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(a + b):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


class SentimentIncrements:
    """The sentiment view as a keyed view that grows by increments of the archive."""

    def __init__(self, spark: SparkSession, archive: str, path: str) -> None:
        self.spark, self.archive, self.path = spark, archive.rstrip("/"), path.rstrip("/")
        self.view = KeyedView(spark, f"{self.path}/view", SENTIMENT, prefer=SMALLEST)

    def done(self) -> tuple[int, list[list[int]]]:
        """The last committed increment (-1: none) and the batches it and those before have taken."""
        found = manifest.read(self.spark, self.path)
        return (found[0], found[1]["batches"]) if found else (-1, [])

    def exists(self) -> bool:
        return self.done()[0] >= 0

    def new_batches(self) -> list[int]:
        """Completely written archive batches that no committed increment has taken."""
        taken = self.done()[1]
        return [b for b in batches(self.spark, self.archive) if not any(first <= b <= last for first, last in taken)]

    def folders(self, numbers: list[int]) -> list[str]:
        return [f"{self.archive}/batch_id={b}" for b in numbers]

    def run(self, sentiment: Callable[[DataFrame], DataFrame]) -> list[int]:
        """One increment: ``sentiment`` makes ``_id, text, sentiment`` rows of the new folders' lines (``value``)."""
        number, taken = self.done()
        new = self.new_batches()
        if new:
            lines = self.spark.read.text(self.folders(new)).select("value")
            self.view.upsert(sentiment(lines), number + 1)
            manifest.commit(self.spark, self.path, number + 1, {"batches": _joined(taken, ranges(new))})
            manifest.forget(self.spark, self.path, keep=2)
        return new

    def read(self) -> DataFrame:
        """``_id, text, sentiment`` of all committed increments, one row per post (the smallest, as in the full batch)."""
        return self.view.read(last=self.done()[0])

    def compact(self) -> int | None:
        """Take the committed increments into the keyed base."""
        return self.view.merge(last=self.done()[0])
