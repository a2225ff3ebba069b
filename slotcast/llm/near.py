"""Near duplicates: a size-aware, heavy-light similarity join on word shingles.

Small sets are light: each lists all subsets of the size that two similar sets must share,
and sets that list the same subset are similar, with nothing left to verify.  Large sets
are heavy: each scans the inverted lists of its rarest shingles.  The boundary between the
two is the one with the lowest estimated cost over the sizes of all sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotcast.session import stage, staged

from .common import bounded_batches, columns, components, most_frequent, plain_docs

WIDTH = 5
#: Similarity as a fraction: linked when DEN * |a & b| >= NUM * |a | b|.
NUM, DEN = 80, 100
#: Sets above this size are never light; below, cost decides.
LIGHT_MAX = 20
#: Cost of one inverted-list entry (shuffle, candidate, check) in listed subsets.
ENTRY_COST = 16
#: Shingles counted as frequent: at least HOT_MIN rows; the most frequent HOT_MAX are told
#: to every task (16 bytes each).  They only order the lists; no result depends on them.
HOT_MIN, HOT_MAX = 64, 150_000
#: Members of a frequent shingle's list that one group holds on average.
HOT_GROUP = 500
BITS = 1024
#: Ids of texts to read again that are told to every task (a map of about 32 MB); more are joined.
TOLD_IDS = 1_000_000


def needed(m: int, n: int) -> int:
    """Shingles that sets of m and n must share to be linked."""
    return -(-NUM * (m + n) // (NUM + DEN))


def partners(n: int) -> range:
    """Sizes of sets that can be linked with one of n."""
    return range(-(-NUM * n // DEN), DEN * n // NUM + 1)


def prefix_size(n: int) -> int:
    """So many of a set's rarest shingles hold one of any linked set's rarest."""
    return n - -(-NUM * n // DEN) + 1


_STEP, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Fewer than five words are one shingle as a whole; no word, no shingle.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, WIDTH)
    s = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        s = (s ^ (s >> np.uint64(29))) * _STEP + h[k : n - width + 1 + k]
    s = (s ^ (s >> np.uint64(32))) * _LAST
    s = np.sort(s ^ (s >> np.uint64(29)))
    return s[np.r_[True, s[1:] != s[:-1]]]


def _frequent(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        keep = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(values[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["h", "n"]
        )

    for batch in frames:
        for text in columns(batch, "text")[0]:
            held.append(shingle_set(text))
            size += len(held[-1])
            if size > 4_000_000:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent shingles of all documents."""
    counted = stage(
        docs.select("text")
        .mapInArrow(_frequent, "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= HOT_MIN)
    )
    rows = most_frequent(counted, HOT_MAX).toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("n").to_numpy()[order]


SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.binary()),
        ("tokens", pa.list_(pa.int64())),
        ("groups", pa.list_(pa.int32())),
        ("sketch", pa.list_(pa.int64())),
        ("parities", pa.binary()),
    ]
)
SETS_DDL = "doc_id long, n_shingles long, set_key binary, tokens array<long>, groups array<int>, sketch array<long>, parities binary"


def _parities(s: np.ndarray) -> np.ndarray:
    """For each of four to eight classes a shingle whether their number is odd.

    The number of classes is a power of two, so a longer row folds to a shorter one.
    """
    bits = max(BITS, 1 << (4 * len(s) - 1).bit_length()) if len(s) else BITS
    at = ((s >> np.uint64(7)) % np.uint64(bits)).astype(np.int64)
    return np.bincount(at, minlength=bits).astype(np.uint8) & 1


def _described(hot_hash: np.ndarray, hot_count: np.ndarray):
    """Task that describes each document's set.

    tokens: the rarest shingles as far as the prefix goes, of small sets all; groups: into
    how many parts a frequent shingle's list is split, a power of two, so that sets that share
    many of them meet the same few first members, 0 for others; parities: the set's size and
    finest sketch; sketch: the same folded to 1,024 classes.
    """

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            out: list[list] = [[] for _ in SETS]
            for doc_id, text in zip(*columns(batch, "doc_id", "text")):
                s = shingle_set(text)
                n = len(s)
                key = blake2b(s.tobytes(), digest_size=16).digest() if n else None
                count = np.zeros(n, np.int64)
                if len(hot_hash) and n:
                    at = np.minimum(np.searchsorted(hot_hash, s), len(hot_hash) - 1)
                    count = np.where(hot_hash[at] == s, hot_count[at], 0)
                order = np.argsort(count, kind="stable")
                if n > LIGHT_MAX:
                    order = order[: prefix_size(n)]
                odd = _parities(s)
                sketch = np.packbits(np.bitwise_xor.reduce(odd.reshape(-1, BITS), axis=0)).view(np.int64)
                parts = -(-count[order] // HOT_GROUP)
                groups = np.where(parts > 0, 2 ** np.ceil(np.log2(np.maximum(parts, 1))), 0)
                fine = n.to_bytes(8, "little") + np.packbits(odd).tobytes()
                values = (doc_id, n, key, s[order].view(np.int64), groups.astype(np.int32), sketch, fine)
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(out, SETS)], schema=SETS)

    return run


def listed_subsets(n: int) -> int:
    """Subsets that a light set of size n lists."""
    return sum(math.comb(n, needed(n, m)) for m in partners(n) if needed(n, m) <= n)


def boundary(sizes: dict[int, int]) -> int:
    """Largest light size: the one with the least cost over all sets (size: how many)."""

    def cost(b: int) -> float:
        light = sum(k * listed_subsets(n) for n, k in sizes.items() if 0 < n <= b)
        return light + sum(k * prefix_size(n) * ENTRY_COST for n, k in sizes.items() if n >= partners(b + 1)[0])

    return min(range(LIGHT_MAX + 1), key=lambda b: (cost(b), b))


def _subsets(limit: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "other", "key"]
        for batch in frames:
            out: list[list] = [[], [], [], []]
            for id_, n, tokens in zip(*columns(batch, "id", "n", "tokens")):
                tokens = [t.to_bytes(8, "little", signed=True) for t in sorted(tokens)]
                for other in partners(n):
                    if other > limit or needed(n, other) > n:
                        continue
                    head = bytes((min(n, other), max(n, other)))
                    for chosen in itertools.combinations(tokens, needed(n, other)):
                        for column, value in zip(out, (id_, n, other, xxhash.xxh3_128_digest(head + b"".join(chosen)))):
                            column.append(value)
                if len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names)
                    out = [[], [], [], []]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names)

    return run


def light_links(sets: DataFrame, limit: int) -> DataFrame:
    """(a, b): all links between sets of at most ``limit`` shingles, as stars.

    Two sets that list the same subset for the same pair of sizes share enough shingles by
    construction, so all sets of a bucket that holds both sizes belong together.
    """
    listed = sets.where((F.col("n") > 0) & (F.col("n") <= limit)).select("id", "n", "tokens")
    listed = listed.mapInArrow(_subsets(limit), "id long, n long, other long, key binary")
    first = (
        listed.groupBy("key")
        .agg(F.min("id").alias("b"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("other").alias("o"), F.count("*").alias("k"))
        .where((F.col("k") > 1) & ((F.col("lo") < F.col("hi")) | (F.col("lo") == F.col("o"))))
        .select("key", "b")
    )
    return listed.select("key", F.col("id").alias("a")).join(first, "key").where("a <> b").select("a", "b").distinct()


def _differ(left: str, right: str, bits: int) -> str:
    """Classes of shingles whose parity differs: each holds a shingle of one set only."""
    return " + ".join(f"bit_count({left}[{k}] ^ {right}[{k}])" for k in range(bits // 64))


def _may_link(n: str, m: str, left: str, right: str, bits: int = BITS) -> str:
    """What sizes and sketches say; sets that are similar differ in so many shingles at most."""
    total = f"({n} + {m})"
    allowed = f"{total} - 2 * (({NUM} * {total} + {NUM + DEN - 1}) div {NUM + DEN})"
    return f"{DEN} * least({n}, {m}) >= {NUM} * greatest({n}, {m}) and {_differ(left, right, bits)} <= {allowed}"


def _screen(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose fine sketches allow a link; each differing class is a differing shingle."""
    for batch in frames:
        out_a, out_b = [], []
        for a, b, left, right in zip(*columns(batch, "a", "b", "left", "right")):
            n, m = int.from_bytes(left[:8], "little"), int.from_bytes(right[:8], "little")
            long, short = (np.frombuffer(x, np.uint8, offset=8) for x in sorted((left, right), key=len, reverse=True))
            while len(long) > len(short):
                half = len(long) // 2
                long = long[:half] ^ long[half:]
            if int(np.bitwise_count(long ^ short).sum()) <= n + m - 2 * needed(n, m):
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in frames:
        sets = [shingle_set(t).tobytes() for t in columns(batch, "text")[0]]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])


def _verify(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in frames:
        out_a, out_b = [], []
        for a, b, left, right in zip(*columns(batch, "a", "b", "left", "right")):
            both = np.sort(np.frombuffer(left + right, np.uint64), kind="stable")
            same = int((both[1:] == both[:-1]).sum())
            if DEN * same >= NUM * (len(both) - same):
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def _texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts that pairs name.  Up to TOLD_IDS ids are told to every task; of more, both sides
    of the join are shuffled."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    if wanted.count() <= TOLD_IDS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, "doc_id", "left_semi").select("doc_id", "text")


def _side_by_side(pairs: DataFrame, held: DataFrame) -> DataFrame:
    return (
        pairs.join(held.toDF("a", "left"), "a")
        .join(held.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
    )


def verified(near: DataFrame, docs: DataFrame, fine: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar.

    Fine sketches (id, parities), a sixteenth to an eighth of a set's bytes and described with
    the set, refuse nearly all other pairs first, so texts are read again and whole sets move
    for links alone.
    """
    likely = stage(_side_by_side(near, fine).mapInArrow(_screen, "a long, b long").distinct())
    with staged(_texts_of(likely, docs).mapInArrow(_packed, "id long, shingles binary")) as full:
        return stage(_side_by_side(likely, full).mapInArrow(_verify, "a long, b long").distinct())


def heavy_links(sets: DataFrame, limit: int, docs: DataFrame, fine: DataFrame) -> DataFrame:
    """(a, b): links with a set of more than ``limit`` shingles, enough for components.

    Lists of one member go at once.  In each list every member is tried with the list's
    centre, the member whose lists are longest in all: of a text and its altered copies
    mostly the text itself.  Lists whose members are then in one component are done.  Only
    members of different components of the rest are tried in pairs, where sizes, positions
    and sketches (folded to half their classes) allow a link.
    """
    smallest = partners(limit + 1)[0]
    probe = sets.where(F.col("n") >= smallest).select(
        "id", "n", F.posexplode(F.slice("tokens", F.lit(1), F.expr(f"int(n - (n * {NUM} + {DEN - 1}) div {DEN} + 1)"))).alias("pos", "token"), "groups"
    )
    probe = probe.select("token", "id", "n", "pos", (F.get("groups", F.col("pos")) > 0).alias("hot"), F.when(
        F.get("groups", F.col("pos")) > 1, F.pmod(F.xxhash64("id"), F.get("groups", F.col("pos")))
    ).otherwise(0).alias("part"))
    own = Window.partitionBy("token", "part")
    members = stage(
        probe.withColumn("k", F.count("*").over(own)).where((F.col("k") > 1) | F.col("hot")).drop("hot", "part")
    )
    weight = members.groupBy("id").agg(F.sum("k").alias("weight"))
    centre = (
        members.select("token", "id", "n")
        .join(weight, "id")
        .groupBy("token")
        .agg(F.max(F.struct("weight", -F.col("id"), "n")).alias("c"))
        .select("token", (-F.col("c.col2")).alias("b"), F.col("c.n").alias("m"))
    )
    stars = (
        members.select("token", F.col("id").alias("a"), "n")
        .join(centre, "token")
        .where(f"a <> b and greatest(n, m) > {limit} and {DEN} * least(n, m) >= {NUM} * greatest(n, m)")
        .select("a", "n", "b", "m")
        .distinct()
    )
    sketch = sets.select("id", "sketch")
    stars = stage(
        stars.join(sketch.toDF("a", "left"), "a")
        .join(sketch.toDF("b", "right"), "b")
        .where(_may_link("n", "m", "left", "right"))
        .select("a", "b")
    )
    links = verified(stars, docs, fine)
    joined = components(links)
    rest = members.drop("k").join(joined.withColumnRenamed("node", "id"), "id", "left")
    rest = rest.withColumn("component", F.coalesce("component", "id"))
    mixed = rest.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    half = F.transform(F.sequence(F.lit(0), F.lit(BITS // 128 - 1)), lambda i: F.get("sketch", i).bitwiseXOR(F.get("sketch", i + BITS // 128)))
    folded = sets.select("id", half.alias("sketch"))
    rest = stage(rest.join(mixed.select("token"), "token").join(folded, "id"))
    bound = f"least(l.n - l.pos, r.n - r.pos) >= (({NUM} * (l.n + r.n) + {NUM + DEN - 1}) div {NUM + DEN})"
    # Both sides read the same columns of the same files, so one shuffle serves both.
    pairs = (
        rest.alias("l")
        .join(rest.alias("r"), F.expr("l.token = r.token"))
        .where(f"l.id < r.id and l.component <> r.component and greatest(l.n, r.n) > {limit} and {bound}")
        .where(_may_link("l.n", "r.n", "l.sketch", "r.sketch", BITS // 2))
        .select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
        .distinct()
    )
    tried = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = stage(pairs.join(tried, ["a", "b"], "left_anti"))
    return links.union(verified(pairs, docs, fine))


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    A-Z is lower-cased; a document's set holds its distinct five-word shingles.  Documents
    link when 100 * |a & b| >= 80 * |a | b|; component_id is the smallest doc_id that links
    reach.  Equal sets are one set from the start, so copies are never paired.

    Defined cases: a text without words has no shingle and is linked with nothing; fewer
    than five words are one shingle; repeated rows each give a row; texts under one doc_id
    count as linked; a null doc_id gets its set's component where the set has a numbered
    document, else null; an empty table gives an empty result; other columns are not read.
    """
    docs = plain_docs(docs, id_col, text_col)
    with bounded_batches(docs.sparkSession):
        hot_hash, hot_count = frequent_shingles(docs)
        with staged(docs.mapInArrow(_described(hot_hash, hot_count), SETS_DDL)) as whole:
            described = stage(whole.select("doc_id", "n_shingles", "set_key"))
            numbered = whole.where(F.col("n_shingles") > 0)
            first = stage(numbered.groupBy("set_key").agg(F.min("doc_id").alias("id")))
            sets = stage(
                numbered.where(F.col("doc_id").isNotNull())
                .join(first.select("set_key", F.col("id").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
                .select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "tokens", "groups", "sketch")
            )
            counts = sets.groupBy("n").count().where(F.col("n") <= 2 * LIGHT_MAX).collect()
            limit = boundary({r["n"]: r["count"] for r in counts})
            owned = docs.where(F.col("doc_id").isNotNull())
            fine = numbered.where(F.col("doc_id").isNotNull()).select("doc_id", "parities")
            links = light_links(sets, limit).union(heavy_links(sets, limit, owned, fine))
            reached = stage(components(links))
    named = first.join(reached.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id")
    )
    return described.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))).alias("component_id")
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each class the row with the
    smallest doc_id.  Rows with a null doc_id stay."""
    gone = (
        similarity_classes(docs, id_col, text_col)
        .where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias(id_col))
        .distinct()
    )
    return docs.join(stage(gone), id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
