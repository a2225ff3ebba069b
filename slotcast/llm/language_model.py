"""A log-bilinear language model, trained by noise-contrastive estimation.

Outcomes.  The most frequent tokens are outcomes by themselves; every other word belongs to
the class of its ending, and has its add-one share within the class.  A token's probability
is the model's for its outcome given the two tokens before, times that share: it sums to
one over all words, seen or not.

Training.  Texts become sequences of outcomes once.  A hash of the id and the sequence deals
them to shards of about SHARD tokens, and the shards to rounds, whose number is the square
root of the shards'.  In a round every shard trains a replica in numpy from the average of the
round before, with noise words from the unigram distribution; replicas and the sums that scale
their steps are averaged by the tokens they saw.  So what is learned depends on the rows, not
on their partitions, and with more text both more replicas and more rounds in a row train.
Scoring normalises over all outcomes by batched matrix products.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.session import shared_folder, stage

from .common import columns, most_frequent, parts, plain_docs, settings

#: The end of a text; no word holds white space.
END = b"\n"
SINGLES, CLASSES = 640, 256
#: Words whose counts every task holds (about 40 bytes each); the rest is joined.
HELD = 131_072
WIDTH = 24
BATCH, NOISE, RATE = 8192, 96, 0.08
#: Tokens that one replica sees in a round, about.
SHARD = 2_000_000
HELD_OUT, FOLDS = 2, 7


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def held_out(id_: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


COUNTED = ["word", "class", "n"]


def _count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def told() -> pa.RecordBatch:
        words = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([ending(w) for w in words], pa.int32()), pa.array(list(seen.values()), pa.int64())],
            COUNTED,
        )

    for batch in frames:
        for text in columns(batch, "text")[0]:
            seen.update(text.lower().split())
            seen[END] += 1
        if len(seen) > 400_000:
            yield told()
            seen.clear()
    if seen:
        yield told()


@dataclass
class Outcomes:
    """What a task must know of the counts: sizes bounded by HELD, SINGLES and CLASSES."""

    index: dict[bytes, int]
    log_count: np.ndarray
    outcome: np.ndarray
    log_share: np.ndarray
    frequency: np.ndarray
    tokens: int
    types: int

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((self.index.get(w, -1) for w in words), np.int64, len(words))

    def outcomes(self, words: list[bytes], ids: np.ndarray) -> np.ndarray:
        out = self.outcome[ids]
        for at in np.flatnonzero(ids < 0):
            out[at] = SINGLES + ending(words[at])
        return out


def outcomes(counts: DataFrame) -> Outcomes:
    """From the counts of all training tokens; only the HELD most frequent words and the
    classes' sums reach the driver."""
    top = sorted(most_frequent(counts, HELD).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    sums = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    tokens, types = sum(r["n"] for r in sums), sum(r["k"] for r in sums)
    plus_one = np.zeros(CLASSES)
    total = np.zeros(CLASSES)
    for r in sums:
        plus_one[r["class"]], total[r["class"]] = r["n"] + r["k"], r["n"]
    singles = {bytes(r["word"]) for r in top[: SINGLES - 1]} | {END}
    n = len(top)
    index, outcome, log_count = {}, np.zeros(n + 1, np.int64), np.zeros(n + 1)
    frequency = np.zeros(SINGLES + CLASSES)
    single = 0
    for i, r in enumerate(top):
        word = bytes(r["word"])
        index[word] = i
        log_count[i] = np.log10(r["n"] + 1)
        outcome[i] = SINGLES + r["class"]
        if word in singles:
            outcome[i] = single
            frequency[single] = r["n"]
            plus_one[r["class"]] -= r["n"] + 1
            total[r["class"]] -= r["n"]
            single += 1
    frequency[SINGLES:] = total
    log_share = np.concatenate([np.zeros(SINGLES), -np.log10(np.maximum(plus_one, 0) + 1)])
    return Outcomes(index, log_count, outcome, log_share, frequency, tokens, types)


@dataclass
class Model:
    """near, far: context vectors of the last token and the one before (one more row for the
    beginning); target and bias: of the outcomes."""

    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, frequency: np.ndarray, width: int = WIDTH) -> Model:
        made = np.random.default_rng(7)
        size = len(frequency)
        draw = lambda rows: made.normal(0, 0.15, (rows, width)).astype(np.float32)
        p = (frequency + 0.5) / (frequency + 0.5).sum()
        return cls(draw(size + 1), draw(size + 1), draw(size), np.log(p).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.near, self.far, self.target, self.bias[:, None]]

    def log_norm(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """log of the sum over all outcomes for each context, by blocks of contexts."""
        out = np.empty(len(near))
        for at in range(0, len(near), 4096):
            q = self.near[near[at : at + 4096]] + self.far[far[at : at + 4096]]
            scores = q @ self.target.T + self.bias
            most = scores.max(axis=1, keepdims=True)
            out[at : at + 4096] = np.log(np.exp(scores - most).sum(axis=1)) + most[:, 0]
        return out

    def log_probability(self, near: np.ndarray, far: np.ndarray, outcome: np.ndarray) -> np.ndarray:
        """Natural log of the normalised probability; equal contexts are normalised once."""
        size = len(self.bias) + 1
        distinct, place = np.unique(near * size + far, return_inverse=True)
        norm = self.log_norm(distinct // size, distinct % size)
        q = self.near[near] + self.far[far]
        return np.einsum("ij,ij->i", q, self.target[outcome]) + self.bias[outcome] - norm[place]


def _added(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Values summed by row."""
    out = np.zeros((size, values.shape[1]), np.float32)
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out[rows[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def contexts(sequence: np.ndarray, lengths: list[int], beginning: int) -> tuple[np.ndarray, np.ndarray]:
    """Last token and the one before it for each token of texts laid end to end."""
    near, far = np.empty_like(sequence), np.empty_like(sequence)
    near[1:], far[2:] = sequence[:-1], sequence[:-2]
    starts = np.cumsum([0, *lengths])[:-1]
    near[starts] = beginning
    far[starts] = beginning
    second = starts[np.asarray(lengths) > 1] + 1
    far[second] = beginning
    return near, far


@dataclass
class State:
    """A model and the sums of squared gradients that scale its steps."""

    model: Model
    squares: list[np.ndarray]

    @classmethod
    def start(cls, frequency: np.ndarray) -> State:
        model = Model.start(frequency)
        return cls(model, [np.full_like(p, 1e-6) for p in model.parts()])

    def blocks(self) -> list[np.ndarray]:
        return self.model.parts() + self.squares

    @classmethod
    def of(cls, blocks: list[np.ndarray]) -> State:
        near, far, target, bias, *squares = [b.astype(np.float32) for b in blocks]
        return cls(Model(near, far, target, bias[:, 0]), squares)


class Training:
    """Adaptive steps of noise-contrastive estimation on one replica."""

    def __init__(self, state: State, frequency: np.ndarray, shard: int = 0):
        own = State.of([b.copy() for b in state.blocks()])
        self.model, self.squares = own.model, own.squares
        noise = (frequency + 0.5) / (frequency + 0.5).sum()
        self.noise_log = np.log(noise * NOISE).astype(np.float32)
        self.edges = np.cumsum(noise)
        self.random = np.random.default_rng([11, shard])
        self.seen = 0

    def step(self, near: np.ndarray, far: np.ndarray, outcome: np.ndarray) -> None:
        """One batch: each token against NOISE words, which the batch shares."""
        m, n = self.model, len(outcome)
        noise = np.minimum(np.searchsorted(self.edges, self.random.random(NOISE)), len(self.edges) - 1)
        q = m.near[near] + m.far[far]
        own, other = m.target[outcome], m.target[noise]
        true = np.einsum("ij,ij->i", q, own) + m.bias[outcome] - self.noise_log[outcome]
        false = q @ other.T + (m.bias[noise] - self.noise_log[noise])
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
        d_q = up[:, None] * own + down @ other
        size = len(m.bias)
        d_target = _added(outcome, up[:, None] * q, size) + _added(noise, down.T @ q, size)
        d_bias = np.bincount(outcome, up, size) + np.bincount(noise, down.sum(axis=0), size)
        steps = [_added(near, d_q, size + 1), _added(far, d_q, size + 1), d_target, d_bias[:, None].astype(np.float32)]
        for part, square, step in zip(m.parts(), self.squares, steps):
            step /= n
            square += step * step
            part += RATE * step / np.sqrt(square)
        self.seen += n


REPLICA_COLUMNS = ["shard", "block", "tokens", "values"]


def _blocks(shard: int, tokens: int, values: list[np.ndarray]) -> pa.RecordBatch:
    n = len(values)
    raw = [v.astype(np.float64).tobytes() for v in values]
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([tokens] * n, pa.int64()), pa.array(raw, pa.binary())],
        REPLICA_COLUMNS,
    )


def _trained(state: State, frequency: np.ndarray):
    """Task: trains a replica on each of its shards, whose rows follow one another, and gives
    (shard, block, tokens, values), a row for each part and its sums."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, training, size = None, None, 0
        held: list[np.ndarray] = []

        def use() -> None:
            nonlocal size
            if held:
                sequence = np.concatenate(held)
                near, far = contexts(sequence, [len(h) for h in held], len(frequency))
                order = training.random.permutation(len(sequence))
                for at in range(0, len(order), BATCH):
                    chosen = order[at : at + BATCH]
                    training.step(near[chosen], far[chosen], sequence[chosen])
            held.clear()
            size = 0

        for batch in frames:
            for shard, raw in zip(*columns(batch, "shard", "sequence")):
                if shard != now:
                    if training:
                        use()
                        yield _blocks(now, training.seen, State(training.model, training.squares).blocks())
                    now, training = shard, Training(state, frequency, shard)
                held.append(np.frombuffer(raw, "<u2").astype(np.int64))
                size += len(held[-1])
                if size > 500_000:
                    use()
        if training:
            use()
            yield _blocks(now, training.seen, State(training.model, training.squares).blocks())

    return run


def _weighed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Average of the replicas that a task has, weighed by their tokens, as one replica."""
    sums: dict[int, np.ndarray] = {}
    tokens: Counter = Counter()
    for batch in frames:
        for block, n, values in zip(*columns(batch, "block", "tokens", "values")):
            value = np.frombuffer(values, np.float64) * n
            sums[block] = sums[block] + value if block in sums else value
            tokens[block] += n
    if sums:
        yield _blocks(0, tokens[0], [sums[b] / tokens[b] for b in sorted(sums)])


REPLICA = "shard long, block int, tokens long, values binary"


def _averaged(state: State, replicas: DataFrame) -> State:
    """In two steps: sixteen tasks, whatever the number of replicas, then their sixteen results,
    which are all that reaches the driver."""
    few = replicas.repartition(16, F.col("shard") % 16).sortWithinPartitions("shard", "block")
    shapes = [b.shape for b in state.blocks()]
    sums, tokens = [np.zeros(s) for s in shapes], 0
    for r in few.mapInArrow(_weighed, REPLICA).collect():
        sums[r["block"]] += np.frombuffer(r["values"], np.float64).reshape(shapes[r["block"]]) * r["tokens"]
        tokens += r["tokens"] if r["block"] == 0 else 0
    return State.of([s / tokens for s in sums]) if tokens else state


def train(sequences: DataFrame, known: Outcomes) -> Model:
    """The model after all rounds over (doc_id, sequence).

    Every text is in one shard of one round.  Shards are dealt and put in order by hashes of the
    rows, so other files, partitions or executors give the same model up to rounding.
    """
    spark = sequences.sparkSession
    shards = max(1, round(known.tokens / SHARD))
    rounds = math.isqrt(shards - 1) + 1
    order = F.xxhash64("doc_id", "sequence")
    path = shared_folder(spark)
    (
        sequences.select(F.pmod(order, F.lit(shards)).alias("shard"), order.alias("order"), "sequence")
        .repartition("shard")
        .withColumn("round", (F.col("shard") % rounds).cast("int"))
        .write.partitionBy("round")
        .parquet(path)
    )
    dealt = spark.read.schema("shard long, order long, sequence binary, round int").parquet(path)
    state = State.start(known.frequency)
    for number in range(rounds):
        own = (
            dealt.where(F.col("round") == number)
            .select("shard", "order", "sequence")
            .repartition(-(-shards // rounds), "shard")
            .sortWithinPartitions("shard", "order", "sequence")
        )
        state = _averaged(state, stage(own.mapInArrow(_trained(state, known.frequency), REPLICA)))
    return state.model


ENCODED = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("share", pa.float64()),
        ("sequence", pa.binary()),
        ("tail", pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))),
    ]
)
ENCODED_DDL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, share double, "
    "sequence binary, tail array<struct<word: binary, times: int>>"
)


def _encoded(known: Outcomes):
    """Task: a text's outcomes, as 16-bit numbers, and what held words say; words that are not
    held are listed."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for frame in frames for p in parts(frame, "text")):
            rows, doc_ids, out, texts = columns(batch, "row", "doc_id", "held_out", "text")
            ids, sequences, lengths, tails = [], [], [], []
            for text in texts:
                words = text.lower().split()
                words.append(END)
                own = known.ids(words)
                ids.append(own)
                sequences.append(known.outcomes(words, own))
                lengths.append(len(words))
                tail = Counter([words[at] for at in np.flatnonzero(own < 0)])
                tails.append([{"word": w, "times": n} for w, n in tail.items()])
            sequence, flat = np.concatenate(sequences), np.concatenate(ids)
            log_count = known.log_count[flat]
            share = known.log_share[sequence] + np.where(sequence >= SINGLES, log_count, 0.0)
            at = np.cumsum([0, *lengths])[:-1]
            sums = [np.add.reduceat(v, at) for v in ((flat >= 0).astype(np.int64), log_count, share)]
            raw = [s.astype("<u2").tobytes() for s in sequences]
            values = [rows, doc_ids, out, lengths, *sums, raw, tails]
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(values, ENCODED)], schema=ENCODED)

    return run


PLAIN = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "share"]
SCORED_DDL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, share double, model double"


def _scored(model: Model):
    """Task: the model's log10 probability of each sequence of outcomes."""
    beginning = len(model.bias)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for frame in frames for p in parts(frame, "sequence", 4_000_000)):
            sequences = [np.frombuffer(s, "<u2") for s in columns(batch, "sequence")[0]]
            lengths = [len(s) for s in sequences]
            sequence = np.concatenate(sequences).astype(np.int64)
            near, far = contexts(sequence, lengths, beginning)
            score = model.log_probability(near, far, sequence) / np.log(10)
            sums = np.add.reduceat(score, np.cumsum([0, *lengths])[:-1])
            yield batch.select(PLAIN).append_column("model", pa.array(sums, pa.float64()))

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each
    row of ``docs``.

    Tokens: words with A-Z lower-cased, then one end.  base_score: add-one unigram model of
    the training tokens.  score: log10 probability of the text by the log-bilinear model.
    Counts of the HELD most frequent words are told to every task; all other words of a text
    are joined with the counts, so no count is left out at any size of the vocabulary.

    Defined cases: a null or empty text is the end alone; repeated rows each give a row; a
    null doc_id stays null and is trained on; without training texts all counts are zero and
    the model is its start; an empty table gives an empty result; other columns are not read.
    """
    settings(docs.sparkSession)
    texts = plain_docs(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))
    training = texts.where(~F.col("held_out")).select("text")
    counts = stage(
        training.mapInArrow(_count, "word binary, class int, n long")
        .groupBy("word", "class")
        .agg(F.sum("n").alias("n"))
    )
    known = outcomes(counts)
    encoded = stage(
        texts.withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "held_out", "text")
        .mapInArrow(_encoded(known), ENCODED_DDL)
    )
    model = train(encoded.where(~F.col("held_out")).select("doc_id", "sequence"), known)
    scored = encoded.select(*PLAIN, "sequence").mapInArrow(_scored(model), SCORED_DDL)
    tail = (
        encoded.select("row", F.explode("tail").alias("t"))
        .select("row", "t.word", "t.times")
        .join(counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("added"))
    )
    per_token = float(np.log10(known.tokens + known.types + 1))
    added = F.coalesce("added", F.lit(0.0))
    return scored.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + added - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("model") + F.col("share") + added).alias("score"),
    )
