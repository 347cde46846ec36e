"""An append-only log of numbered commits, by which a table's folders become visible all at once.

A commit is one small JSON file that is never changed; the greatest number is the state. Data are
written to fresh folders first and named by the commit that follows, so that a job that fails
half way leaves nothing but folders no commit names, and readers keep what they have opened.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from veritally.sources import files

DIGITS = 20


class CommitConflict(RuntimeError):
    """Another writer has committed the same number."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:0{DIGITS}d}.json"

    def numbers(self) -> list[int]:
        names = (name for name, _, _ in files.listed(self.spark, self.folder))
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def read(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self.path(number)))

    def latest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def append(self, number: int, entry: dict) -> None:
        """Commit ``entry``; of two writers of one number the second fails and has changed nothing."""
        if not files.write_new(self.spark, self.path(number), json.dumps(entry)):
            raise CommitConflict(f"commit {number} of {self.folder} is taken")

    def expire(self, keep: int) -> list[dict]:
        """Remove all but the last ``keep`` commits, of which one must stay; return those that stay."""
        numbers = self.numbers()
        for number in numbers[: -max(1, keep)]:
            files.remove(self.spark, self.path(number))
        return [self.read(n) for n in numbers[-max(1, keep) :]]
