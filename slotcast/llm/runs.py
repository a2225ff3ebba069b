"""Periodic runs of words, caught online, and texts with the repeats of each run removed.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at
least ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods.  Words arrive one after another, in
chunks of any size.  Each completed block of a power of two opens a catcher; every word that
is appended compares the suffix of the block's length with the block.  Where they are equal
the distance is a period; the stretch is extended back and on, and once it holds a square it
is reported.  Squares that end with the text so far stay open and merge with what follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, parts, settings, text_of

#: A run has at least so many words, and so many times its period.
MIN_LENGTH, MIN_PERIODS = 24, 3
#: Smallest block: 2 ** 3 words.  A run of 24 words leaves room for one at all its periods up to 8.
FIRST_LEVEL = 3
#: Words of one catcher in a task; texts of a batch follow each other in it, a longer text is alone.
STREAM_WORDS = 200_000

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _grown(low: np.ndarray, far: int) -> np.ndarray:
    """Names of windows twice as long, from the names of their two halves."""
    if len(low) <= far:
        return np.empty(0, np.uint64)
    named = (low[:-far] * _STEP) ^ (low[far:] + _MIX)
    return (named ^ (named >> np.uint64(31))) * _MIX


class Catchers:
    """Squares of a growing sequence of word numbers, merged into runs.

    ``append`` takes further words; what it finds does not depend on how they are cut into
    chunks.  ``reach`` bounds the length of a run's text: levels of blocks beyond a third of
    it are not kept.
    """

    def __init__(self, reach: int | None = None):
        self.reach = reach
        self.words = np.empty(0, np.int64)
        #: Names of all complete windows of 2 ** level words, one array a level.
        self.names: list[np.ndarray] = []
        #: How many windows of each level have been compared.
        self.compared: list[int] = []
        #: period -> first word of the stretch that reaches the end of the sequence.
        self.open: dict[int, int] = {}
        #: period -> end of the last stretch that a further word ended.
        self.closed: dict[int, int] = {}
        #: (first word, end) -> smallest period.
        self.found: dict[tuple[int, int], int] = {}

    def append(self, words: np.ndarray) -> None:
        known = len(self.words)
        self.words = np.concatenate([self.words, words])
        for period, start in list(self.open.items()):
            self._advance(period, start, known)
        for level in range(self._levels() + 1):
            self._name(level)
            if level >= FIRST_LEVEL:
                self._catch(level)

    def runs(self) -> list[tuple[int, int, int]]:
        """(first word, length, period) by first word and period, the sequence ending here."""
        found = dict(self.found)
        for period, start in self.open.items():
            self._report(found, start, len(self.words), period)
        return sorted((start, end - start, period) for (start, end), period in found.items())

    def _levels(self) -> int:
        """Highest level whose smallest period fits three times into the text."""
        longest = min(len(self.words), self.reach or len(self.words))
        return max(FIRST_LEVEL, (longest // MIN_PERIODS).bit_length() - 1)

    def _name(self, level: int) -> None:
        """Names of the windows that the appended words complete."""
        if level == 0:
            have = len(self.names[0]) if self.names else 0
            new = self.words[have:].astype(np.uint64) * _MIX
        else:
            half = 1 << (level - 1)
            have = len(self.names[level]) if len(self.names) > level else 0
            new = _grown(self.names[level - 1][have:], half)
        if len(self.names) <= level:
            self.names.append(new)
            self.compared.append(0)
        else:
            self.names[level] = np.concatenate([self.names[level], new])

    def _catch(self, level: int) -> None:
        """Compare the suffix at every appended word with the catchers that it is in reach of.

        A stretch of three periods q >= 2 ** level holds, in its first two, a whole block that
        starts at a multiple of 2 ** level; the first level serves all smaller periods too.
        """
        size = 1 << level
        near, far = (1 if level == FIRST_LEVEL else size), 2 * size
        names, fresh = self.names[level], self.compared[level]
        self.compared[level] = len(names)
        for distance in range(near, far):
            first = max(0, -(-(fresh - distance) // size)) * size
            if first + distance >= len(names):
                continue
            equal = names[first : len(names) - distance : size] == names[first + distance :: size]
            if equal.any():
                for block in (first + np.flatnonzero(equal) * size).tolist():
                    self._extend(distance, block)

    def _extend(self, period: int, block: int) -> None:
        """The whole stretch of this period around a block that has occurred again."""
        if self.open.get(period, block + 1) <= block or block < self.closed.get(period, 0) - period:
            return
        words = self.words
        at, step = block, 16
        while at > 0:
            low = max(0, at - step)
            differs = np.flatnonzero(words[low:at] != words[low + period : at + period])
            if len(differs):
                at = low + int(differs[-1]) + 1
                break
            at, step = low, 2 * step
        self._advance(period, at, block + period)

    def _advance(self, period: int, start: int, known: int) -> None:
        """Append words from ``known`` on to the stretch; report it where it ends."""
        words, at, step = self.words, max(known, start + period), 16
        while at < len(words):
            high = min(len(words), at + step)
            differs = np.flatnonzero(words[at:high] != words[at - period : high - period])
            if len(differs):
                self.closed[period] = at + int(differs[0])
                self._report(self.found, start, self.closed[period], period)
                self.open.pop(period, None)
                return
            at, step = high, 2 * step
        self.open[period] = start

    @staticmethod
    def _report(found: dict, start: int, end: int, period: int) -> None:
        """Squares of one stretch are one run.  Of several periods the smallest is kept: a
        stretch of three periods that has a smaller one too has a divisor as a period."""
        if end - start >= max(MIN_LENGTH, MIN_PERIODS * period):
            found[start, end] = min(period, found.get((start, end), period))


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs (first word, length, period) of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    # Texts of like length share a catcher; shorter ones than a run's least have none.
    order = sorted((k for k, words in enumerate(texts) if len(words) >= MIN_LENGTH), key=lambda k: len(texts[k]))
    numbers: dict = {}
    chosen, size = [], 0
    for at, k in enumerate(order):
        chosen.append(k)
        size += len(texts[k]) + 1
        if size < STREAM_WORDS and at + 1 < len(order):
            continue
        catchers = Catchers(reach=len(texts[k]))
        stream, starts = [], []
        for text in chosen:
            starts.append(len(stream))
            stream += [numbers.setdefault(w, len(numbers)) for w in texts[text]]
            stream.append(-1 - text)  # no word equals the end of a text
        catchers.append(np.array(stream, np.int64))
        begins = np.array(starts)
        for start, length, period in catchers.runs():
            place = int(np.searchsorted(begins, start, "right")) - 1
            out[chosen[place]].append((start - starts[place], length, period))
        chosen, size = [], 0
        numbers.clear()
    return out


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, out in zip(words, gone) if not out]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_DDL = "struct<start:bigint,length:bigint,period:bigint>"
_MADE = [
    pa.field("n_words", pa.int64()),
    pa.field("runs", pa.list_(_RUN)),
    pa.field("strongest", _RUN),
    pa.field("collapsed", pa.string()),
]
_MADE_DDL = f"n_words bigint, runs array<{_RUN_DDL}>, strongest {_RUN_DDL}, collapsed string"


def _found(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(run):
        return dict(zip(("start", "length", "period"), run)) if run else None

    for whole in frames:
        for batch in parts(whole, "_text"):
            texts = [t.split() for t in columns(batch, "_text")[0]]
            found = runs_of(texts)
            collapsed = [b" ".join(kept_words(w, r)) for w, r in zip(texts, found)]
            made = [
                batch.column(0),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.array([[row(r) for r in runs] for runs in found], pa.list_(_RUN)),
                pa.array([row(strongest(runs)) for runs in found], _RUN),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(made, schema=pa.schema([batch.schema[0], *_MADE]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, strongest, collapsed), one row for each row of ``docs``.

    runs: array of (start, length, period) by start, then period; strongest: the one with the
    greatest length / period, null without a run; collapsed: the words that no run holds after
    its first period, joined by one space.

    Defined cases: a null text is an empty one; a text without words has no run and collapses
    to the empty text; repeated rows and a null id each give their row; an empty table gives an
    empty result; other columns are not read, and the id's name may be any.  A text is handled
    whole in its row's task, whatever its length.
    """
    settings(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(_found, f"_id {kind}, {_MADE_DDL}")
    return found.select(F.col("_id").alias(id_col), "n_words", "runs", "strongest", "collapsed")
