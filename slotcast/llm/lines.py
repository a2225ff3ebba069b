"""Line dedup by winnowing over line hashes.

A run of lines that stands, word for word, at an earlier place (order: doc_id, then line)
and has MIN_WORDS words or more is deleted; the first place keeps it.

Stretches are the shortest runs with MIN_WORDS words, from each line on and up to each line.
Each stretch selects its line with the smallest hash as fingerprint, so equal stretches
select equal fingerprints, and any two equal runs of MIN_WORDS words share one.  Only
stretches around fingerprints that occur twice are compared: from a joined position a match
is extended both ways, by the stretches that hold it, which chain to the whole run.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.session import stage

from .common import columns, plain_docs, settings

MIN_WORDS = 50


def stretches(words: list[int], least: int) -> list[tuple[int, int, bool]]:
    """(start, end, forward) of the shortest runs with ``least`` words."""
    out, n, end, total = [], len(words), 0, 0
    for start in range(n):
        while end < n and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        out.append((start, end, True))
        total -= words[start]
    start, total = 0, 0
    for end in range(1, n + 1):
        total += words[end - 1]
        while total - words[start] >= least:
            total -= words[start]
            start += 1
        if total >= least:
            out.append((start, end, False))
    return out


def line_parts(text: bytes) -> list[tuple[int, bytes, int]]:
    """(line number, digest, words) of the lines with a word; gaps count as one blank."""
    out = []
    for number, line in enumerate(text.split(b"\n")):
        words = line.split()
        if words:
            out.append((number, blake2b(b" ".join(words), digest_size=16).digest(), len(words)))
    return out


def minimum(digests: list[bytes], start: int, end: int) -> int:
    """The line with the smallest digest, the last of equal ones."""
    return max(range(start, end), key=lambda i: (-int.from_bytes(digests[i][:8], "big"), i))


def _described(least: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_lines", "numbers", "digests", "words", "prints"]
        for batch in frames:
            out: list[list] = [[] for _ in names]
            for row, doc_id, text in zip(*columns(batch, "row", "doc_id", "text")):
                parts = line_parts(text)
                digests, words = [p[1] for p in parts], [p[2] for p in parts]
                chosen = {minimum(digests, s, e) for s, e, _ in stretches(words, least)}
                values = (
                    row, doc_id, text.count(b"\n") + 1 if text else 0, [p[0] for p in parts], b"".join(digests), words,
                    [int.from_bytes(digests[i][:8], "big", signed=True) for i in sorted(chosen)],
                )
                for column, value in zip(out, values):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)

    return run


def _extended(least: int):
    """Stretches around the positions of repeated fingerprints, with a key of their content."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "start", "end", "key"]
        for batch in frames:
            out: list[list] = [[] for _ in names]
            for row, doc_id, packed, words, prints in zip(*columns(batch, "row", "doc_id", "digests", "words", "prints")):
                digests = [packed[i : i + 16] for i in range(0, len(packed), 16)]
                repeated = set(prints)
                for start, end, forward in stretches(words, least):
                    at = minimum(digests, start, end)
                    if int.from_bytes(digests[at][:8], "big", signed=True) in repeated:
                        key = blake2b(packed[16 * start : 16 * end] + (b"f" if forward else b"b"), digest_size=16).digest()
                        for column, value in zip(out, (row, doc_id, start, end, key)):
                            column.append(value)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)

    return run


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(row, doc_id, text, n_lines, numbers, runs): the lines that are repeated, for each row.

    ``docs`` has (row, doc_id, text) with ``row`` unique.  numbers: line numbers of the lines
    with a word; runs: (start, end) among them.
    """
    described = stage(
        docs.mapInArrow(
            _described(least),
            "row long, doc_id long, n_lines long, numbers array<int>, digests binary, words array<int>, prints array<long>",
        )
    )
    prints = described.select("row", F.explode("prints").alias("print"))
    shared = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    inside = described.where(F.size("prints") > 0).select("row", "doc_id", "digests", "words")
    positions = prints.join(stage(shared), "print").groupBy("row").agg(F.collect_set("print").alias("prints"))
    found = stage(
        inside.join(positions, "row")
        .select("row", "doc_id", "digests", "words", "prints")
        .mapInArrow(_extended(least), "row long, doc_id long, start int, end int, key binary")
    )
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "row", "start")
    first = found.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = (
        found.join(first, "key")
        .where((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    )
    return described.select("row", "n_lines", "numbers").join(later, "row", "left")


def _cleaned(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_lines", "n_removed", "removed", "text"]
    for batch in frames:
        out: list[list] = [[] for _ in names]
        for doc_id, text, n_lines, numbers, runs in zip(*columns(batch, "doc_id", "text", "n_lines", "numbers", "runs")):
            gone = sorted({numbers[i] for r in runs or () for i in range(r["start"], r["end"])})
            if gone:
                drop = set(gone)
                text = b"\n".join([line for i, line in enumerate(text.split(b"\n")) if i not in drop])
            for column, value in zip(out, (doc_id, n_lines, len(gone), gone, text.decode())):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed, text): every document without its repeated runs.

    removed: numbers of the deleted lines, from 0.  Lines are compared with gaps as one blank;
    lines without a word belong to no run and stay.

    Defined cases: null and empty texts have no lines and stay empty; a text of fewer than
    ``least`` words loses nothing; of rows with one doc_id any may count as the earlier; a
    null doc_id comes after all others; runs that overlap their own first place lose what
    lies in a later stretch; an empty table gives an empty result; other columns are not read.
    """
    settings(docs.sparkSession)
    rows = stage(plain_docs(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    runs = repeated_runs(rows, least)
    return (
        rows.join(runs, "row")
        .select("doc_id", "text", "n_lines", "numbers", "runs")
        .mapInArrow(_cleaned, "doc_id long, n_lines long, n_removed long, removed array<int>, text string")
    )


