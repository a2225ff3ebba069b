"""A journal of finished steps, so that a job of several steps goes on where it broke off."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import functions as F

from ..files import exists
from ..store import Store

#: A finished step: its run, place and name, a digest of the tables it read, and its result.
JOURNAL = "run string, place int, step string, inputs string, result string, finished_at timestamp"


def listing(store: Store, names: Sequence[str]) -> str:
    """Digest of the file names of the given tables, one line a day; no file is opened."""
    lines = [
        f"{name} {row['day']} {row['files']}"
        for name in names
        for row in sorted(store.day_files(name).collect())
    ]
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


class Journal:
    """Steps of one run in their order, noted under the store as they finish."""

    def __init__(self, store: Store, run: str):
        self.store, self.run, self.place, self.fresh = store, run, 0, False
        self.path = f"{store.root}/journal"
        self.noted = {}
        if exists(store.spark, self.path):
            rows = store.spark.read.schema(JOURNAL).parquet(self.path).filter(F.col("run") == run)
            # Of a step that was repeated the last note counts.
            for row in sorted(rows.collect(), key=lambda r: r["finished_at"]):
                self.noted[row["place"]] = row

    def step(self, name: str, work: Callable[[], str | None], reads: Sequence[str] = ()) -> str | None:
        """Do the step, or give its noted result where it is finished.

        A step counts as finished while it and all before it are noted and the tables it read
        have the same files; from the first other step on all are done again.  So a step must be
        one that can be repeated, as upserts are.
        """
        place, self.place = self.place, self.place + 1
        inputs, row = listing(self.store, reads), self.noted.get(place)
        if not self.fresh and row is not None and (row["step"], row["inputs"]) == (name, inputs):
            return row["result"]
        self.fresh = True
        result = work()
        note = self.store.spark.createDataFrame(
            [(self.run, place, name, inputs, result)], JOURNAL.rsplit(", ", 1)[0]
        ).withColumn("finished_at", F.current_timestamp())
        note.coalesce(1).write.mode("append").parquet(self.path)
        return result
