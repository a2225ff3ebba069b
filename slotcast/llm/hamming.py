"""Near duplicates by signatures: b-bit MinHash and a multi-index Hamming join.

A set's signature has CHUNKS * SYMBOLS symbols of BITS bits, one for each of as many hash
functions: the low bits of the least hash of its shingles.  Two signatures that differ in
fewer than CHUNKS * (ERRORS + 1) symbols have, by the pigeonhole principle, a chunk in which
at most ERRORS symbols differ.  Every signature lists, for each chunk and each choice of
ERRORS symbols left out, the others as one number, so all pairs below that distance meet in a
list.  Pairs that meet are confirmed on their whole sets.

With similarity j a symbol differs with probability 1 - j.  At j = 0.85 a chunk of five has
two or more differences with probability 0.165, all nine chunks have with 9e-8: that is the
share of such links that are not listed.  Pairs that meet are not refused by their distance.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.session import stage, staged

from .common import columns, components, parts, plain_docs, settings
from .near import shingle_set

#: Similarity as a fraction: linked when DEN * |a & b| >= NUM * |a | b|.
NUM, DEN = 85, 100
CHUNKS, SYMBOLS, ERRORS, BITS = 9, 5, 1, 11
#: Pairs of signatures that differ in at most so many symbols share a listed number.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Choices of symbols that a chunk's listed numbers keep.
KEPT = list(itertools.combinations(range(SYMBOLS), SYMBOLS - ERRORS))
#: Classes of shingles in a sketch.
CLASSES = 1024
#: Members that are confirmed with one copy of their partner's set.
GROUP = 64
#: Width of a size band; linked sets lie in one band or two neighbouring ones.
BAND = -math.log(NUM / DEN - 0.01)

_DRAWS = np.random.default_rng(20240101)
_XOR = _DRAWS.integers(0, 2**63, CHUNKS * SYMBOLS, np.int64).astype(np.uint64)
_ODD = _DRAWS.integers(0, 2**63, CHUNKS * SYMBOLS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signature(s: np.ndarray) -> np.ndarray:
    """The symbols of a set of 64-bit hashes that is not empty."""
    least = np.full(len(_XOR), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        h = (s[at : at + 4096, None] ^ _XOR) * _ODD
        h ^= h >> np.uint64(32)
        np.minimum(least, (h * _ODD).min(axis=0), out=least)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.uint16)


def sketch(s: np.ndarray) -> np.ndarray:
    """For each class of hashes whether their number is odd; each class in which two sets
    differ holds a shingle of one of them only."""
    odd = np.bincount((s >> np.uint64(7)).astype(np.int64) % CLASSES, minlength=CLASSES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("set_key", pa.binary()),
        ("signature", pa.binary()),
        ("sketch", pa.list_(pa.int64())),
    ]
)
SETS_DDL = "doc_id long, n long, set_key binary, signature binary, sketch array<long>"


def _described(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in frames:
        for part in parts(batch, "text"):
            out: list[list] = [[] for _ in SETS]
            for doc_id, text in zip(*columns(part, "doc_id", "text")):
                s = shingle_set(text)
                values = (doc_id, 0, None, None, None)
                if len(s):
                    key = blake2b(s.tobytes(), digest_size=16).digest()
                    values = (doc_id, len(s), key, signature(s).tobytes(), sketch(s))
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(out, SETS)], schema=SETS)


def listed_numbers(signatures: np.ndarray) -> np.ndarray:
    """For each row of symbols: each chunk with each choice of ERRORS symbols left out."""
    chunked = signatures.reshape(len(signatures), CHUNKS, SYMBOLS).astype(np.int64)
    listed = np.empty((len(signatures), CHUNKS, len(KEPT)), np.int64)
    for choice, kept in enumerate(KEPT):
        number = np.arange(CHUNKS, dtype=np.int64)[None, :] * len(KEPT) + choice
        for symbol in kept:
            number = (number << BITS) | chunked[:, :, symbol]
        listed[:, :, choice] = number
    return listed.reshape(len(signatures), -1)


def _listed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in frames:
        ids, signatures = batch.column(0), columns(batch, "signature")[0]
        if not signatures:
            continue
        numbers = listed_numbers(np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), -1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers.ravel()), pa.array(np.repeat(ids.to_numpy(), numbers.shape[1]))], ["number", "id"]
        )


def _may_link(n: str, m: str, left: str, right: str) -> str:
    """What sizes and sketches say: linked sets differ in so many shingles at most."""
    total = f"({n} + {m})"
    differ = " + ".join(f"bit_count({left}[{k}] ^ {right}[{k}])" for k in range(CLASSES // 64))
    allowed = f"{total} - 2 * (({NUM} * {total} + {NUM + DEN - 1}) div {NUM + DEN})"
    return f"{DEN} * least({n}, {m}) >= {NUM} * greatest({n}, {m}) and {differ} <= {allowed}"


def _whole_sets(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in frames:
        for part in parts(batch, "text"):
            sets = [shingle_set(t).tobytes() for t in columns(part, "text")[0]]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])


def _linked(own: np.ndarray, s: np.ndarray) -> bool:
    if not len(own) or not len(s):
        return False
    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
    same = int((own[at] == s).sum())
    return DEN * same >= NUM * (len(own) + len(s) - same)


def _confirm(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (b, share), the partner's own set first (several where its id has several
    texts); it is kept for its members."""
    held, members = [], False
    for batch in frames:
        out_a, out_b = [], []
        for b, a, shingles in zip(*columns(batch, "b", "a", "shingles")):
            s = np.frombuffer(shingles, np.uint64)
            if a is None:
                held = [*([] if members else held), s]
            elif any(_linked(own, s) for own in held):
                out_a.append(a)
                out_b.append(b)
            members = a is not None
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b), b <> a, whose whole sets are linked, written to the shared folder.

    A partner b's set moves once for each share of about GROUP of its members, not once a pair.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    held = docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
    shares = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP).alias("shares"))
    dealt = pairs.join(shares, "b").select("a", "b", F.pmod(F.xxhash64("a"), "shares").alias("share"))
    with staged(held.mapInArrow(_whole_sets, "id long, shingles binary")) as sets:
        partners = dealt.select("b", "share").distinct().join(sets.withColumnRenamed("id", "b"), "b")
        members = dealt.join(sets.withColumnRenamed("id", "a"), "a")
        rows = partners.select("b", "share", F.lit(None).cast("long").alias("a"), "shingles").union(
            members.select("b", "share", "a", "shingles")
        )
        dealt_rows = rows.repartition("b", "share").sortWithinPartitions("b", "share", F.col("a").asc_nulls_first())
        return stage(dealt_rows.select("b", "a", "shingles").mapInArrow(_confirm, "a long, b long").distinct())


def _band(n: Column) -> Column:
    return F.floor(F.log(n) / BAND).cast("int")


def links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links of ``sets`` (id, n, signature, sketch), enough for their components.

    In each list every member is tried with one centre, the member that meets most others; of
    a text and its altered copies mostly the text itself.  In lists whose members are not in one
    component then, all members of different components are tried whose sizes and sketches
    allow a link, size band by size band.
    """
    listed = sets.select("id", "signature").mapInArrow(_listed, "number long, id long")
    lists = listed.groupBy("number").agg(F.count("*").alias("k")).where(F.col("k") > 1)
    members = stage(listed.join(lists, "number"))
    weight = members.groupBy("id").agg(F.sum("k").alias("weight"))
    centre = (
        members.join(weight, "id")
        .groupBy("number")
        .agg(F.max(F.struct("weight", -F.col("id"))).alias("c"))
        .select("number", (-F.col("c.col2")).alias("b"))
    )
    met = members.select("number", F.col("id").alias("a")).join(centre, "number").where("a <> b").select("a", "b").distinct()
    known = sets.select("id", "n", "sketch")
    tried = stage(
        met.join(known.toDF("a", "n", "left"), "a")
        .join(known.toDF("b", "m", "right"), "b")
        .where(_may_link("n", "m", "left", "right"))
        .select("a", "b")
    )
    first = confirmed(tried, docs)
    reached = stage(components(first))
    rest = members.drop("k").join(reached.withColumnRenamed("node", "id"), "id", "left")
    rest = rest.withColumn("component", F.coalesce("component", "id"))
    mixed = rest.groupBy("number").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rest = stage(rest.join(mixed.select("number"), "number").join(known, "id").withColumn("band", _band(F.col("n"))))
    other = rest.select(
        "number", F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("c"), F.col("sketch").alias("right"),
        F.explode(F.array("band", F.col("band") + 1)).alias("band"),
    )
    pairs = (
        rest.join(other, ["number", "band"])
        .where("(n > m or n = m and id > b) and component <> c and " + _may_link("n", "m", "sketch", "right"))
        .select(F.col("id").alias("a"), "b")
        .distinct()
    )
    done = tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    further = confirmed(stage(pairs.join(done, ["a", "b"], "left_anti")), docs)
    return reached.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b").union(further)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row of ``docs``.

    A-Z is lower-cased; a document's set holds its distinct five-word shingles.  Documents link
    when 100 * |a & b| >= 85 * |a | b|; component_id is the smallest doc_id that links reach,
    and the document that carries it is kept.  Equal sets are one set from the start.

    Defined cases: a text without words has no shingle, is linked with nothing and is kept;
    fewer than five words are one shingle; repeated rows each give a row; different texts
    under one doc_id count as linked; a null doc_id gets its set's component
    where the set has a numbered document, else null, and kept is null with it; an empty table
    gives an empty result; other columns are not read.
    """
    settings(docs.sparkSession)
    docs = plain_docs(docs, id_col, text_col)
    described = stage(docs.mapInArrow(_described, SETS_DDL))
    numbered = described.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    sets = stage(
        numbered.groupBy("set_key").agg(
            F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "signature", "sketch")]
        )
    )
    owned = docs.join(sets.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    # A doc_id with several texts is one document: its sets' names are linked through it.
    several = numbered.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo < hi")
    own = numbered.join(several, "doc_id", "left_semi").join(sets, "set_key").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    reached = stage(components(links(sets, owned).union(own)))
    named = sets.join(reached.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id")
    )
    found = described.join(named, "set_key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"),
    )
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
