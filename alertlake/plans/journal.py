"""The journal of a workspace: one record per run and stage, written ahead of its effects.

A stage first computes: it writes partitions that belong to its run alone.  Then one file records that they
are whole, with the stage's report; then the stage's effects on shared tables (ledger, key index, summaries) are
applied, each at most once.  A run that died is started again under its own id: stages that are recorded are not
computed again, only their effects are applied where they are missing; the first stage without a record
starts over and replaces its partitions.  So a replay gives the tables of an undisturbed run.

Until a stage is recorded, its partitions are not part of the tables: readers leave out the partitions of
runs that are open and have no record of that stage.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import SparkSession

from alertlake.sources import files


def quoted(run: str) -> str:
    """A run id as a file name."""
    return re.sub(r"[^A-Za-z0-9.-]", lambda m: f"_{ord(m[0]):x}_", run)


def unquoted(name: str) -> str:
    return re.sub(r"_([0-9a-f]+)_", lambda m: chr(int(m[1], 16)), name)


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, run: str, stage: str) -> str:
        return f"{self.root}/runs/{quoted(run)}/{stage}.json"

    def begin(self, run: str, facts: dict) -> dict:
        """Open a run, or find it open; the facts of its first start hold (table versions, time)."""
        if self.record(run, "begin") is None:
            files.create_once(self.spark, self._path(run, "begin"), json.dumps(facts))
        if self.record(run, "done") is None:
            files.create_once(self.spark, f"{self.root}/open/{quoted(run)}", "")
        return self.record(run, "begin")

    def record(self, run: str, stage: str) -> dict | None:
        path = self._path(run, stage)
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else None

    def stage(self, run: str, name: str, compute: Callable[[], dict], apply: Callable[[], None] | None = None) -> dict:
        """The report of a stage: computed and recorded unless it is recorded; then its effects."""
        report = self.record(run, name)
        if report is None:
            files.create_once(self.spark, self._path(run, name), json.dumps(compute()))
            report = self.record(run, name)
        if apply is not None and self.record(run, f"{name}-applied") is None:
            apply()
            files.create_once(self.spark, self._path(run, f"{name}-applied"), "{}")
        return report

    def close(self, run: str, report: dict) -> None:
        files.create_once(self.spark, self._path(run, "done"), json.dumps(report))
        files.delete(self.spark, f"{self.root}/open/{quoted(run)}")

    def unfinished(self, stage: str) -> list[str]:
        """Open runs without a record of that stage (few: those running now, or dead and not started again)."""
        runs = [unquoted(n) for n in files.names(self.spark, f"{self.root}/open") if not n.startswith(".")]
        return [r for r in runs if self.record(r, stage) is None]
