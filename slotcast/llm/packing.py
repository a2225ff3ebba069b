"""Packing by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotcast.session import stage

from .bpe import byte_letters
from .common import count_partitions, parts, plain_docs, settings
from .pretokens import BARE, SPECIAL, Remembered, falls_apart, piece, units

VOCABULARY = "byte_bpe_50k.json"
SIZE = 2048
END = 1
LINE_END = "\n"
#: Between units that are encoded in one call; each but the bare ones begins with a blank.
JOIN = LINE_END + " "
#: Units, and words, encoded in one call.
TOGETHER, WORDS = 256, 2048
#: Units whose ids one task remembers, twice over (about 200 bytes each).
UNITS = 400_000
#: Units that hold white space other than one or two line ends between other characters, or the
#: special token's string.
_ALONE = re.compile(rf"[^\S\n]|\n{{3}}|^\0?\n|^\0?$|\n\Z|{re.escape(SPECIAL)}").search
#: Letters up to U+024F, which are letters in every version of Unicode.
_LETTERS = "[A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f]+"
#: A word is one pre-token; the ASCII marks behind it, if any, are another.
_WORD = re.compile(rf"(\0?{_LETTERS})([!-/:-@\[-`{{-~]*)").fullmatch
#: Bytes of text whose units are told apart at once.
AT_ONCE = 16_000_000


def _joined(keys: list[str]) -> str:
    return (JOIN + JOIN.join(keys)).replace(JOIN + BARE, LINE_END)[1:]


def _parts(key: str) -> list[str]:
    """Keys of the parts of a unit that encode independently: its line ends, what lies between
    them, and marks behind a word."""
    out: list[str] = []
    for at, line in enumerate(key.split(LINE_END)):
        if at:
            out.append(BARE + LINE_END)
            line = line and BARE + line
        found = _WORD(line)
        if found and found[2]:
            out += found[1], BARE + found[2]
        elif line:
            out.append(line)
    return out


class Ids:
    """Ids of units by the tokenizers library, as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.coder = Tokenizer.from_file(path)
        self.coder.no_padding()
        self.coder.no_truncation()
        self.known = Remembered(UNITS)
        self.line_end = self.coder.token_to_id("Ċ")
        # The same model for words that are pre-tokens already, in the vocabulary's letters.
        self.words = Tokenizer(self.coder.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.letters = {b: letter for letter, b in byte_letters().items()} | {ord(LINE_END): " "}
        vocabulary = self.coder.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, at in vocabulary.items():
            self.width[at] = len(token)

    def learn(self, texts_units: list[list[str]]) -> None:
        """Ids of the units that are not known yet.

        Units fall into words, marks and line ends where they can.  Words are encoded many at
        once, given as pre-tokens.  Other parts are encoded many at once with line ends between:
        a line end before a blank or a character that is no white space is always a token of its
        own, and so is each of one or two line ends inside a unit.  Units with other white space
        are encoded alone.
        """
        new = self.known.unknown(texts_units)
        now, older = self.known.now, self.known.older
        words: set[str] = set()
        alone: list[str] = []
        marked, heads, tails = [], [], []
        split: dict[str, list[str]] = {}
        for key in new:
            found = _WORD(key)
            if found:
                if found[2]:
                    marked.append(key)
                    heads.append(found[1])
                    tails.append(BARE + found[2])
                else:
                    words.add(key)
            elif _ALONE(key):
                alone.append(key)
            else:
                split[key] = _parts(key)
        now[BARE + LINE_END] = np.asarray([self.line_end], "<u4").tobytes()
        together: set[str] = set()
        for key in set(heads).union(tails, *split.values()).difference(now, words):
            if key in older:
                now[key] = older[key]
            else:
                (words if _WORD(key) else together).add(key)
        for key, coded in zip(alone, self.coder.encode_batch_fast([piece(k) for k in alone], add_special_tokens=False)):
            now[key] = np.asarray(coded.ids, "<u4").tobytes()
        self._learn_words(list(words))
        self._learn_together(list(together))
        find = now.__getitem__
        now.update(zip(marked, map(add, map(find, heads), map(find, tails))))
        for key, parts_ in split.items():
            if len(parts_) > 1:
                now[key] = b"".join(map(find, parts_))

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), WORDS):
            keys = words[at : at + WORDS]
            raw = _joined(keys).encode()
            text = raw.decode("latin-1").translate(self.letters)
            ids = np.asarray(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            gaps = np.flatnonzero(np.frombuffer(raw, np.uint8) == ord(LINE_END))
            ends = np.append(gaps, len(raw)) - np.arange(len(keys))
            reached = np.cumsum(self.width[ids])
            last = np.searchsorted(reached, ends)
            if reached[-1] != ends[-1] or (reached[last] != ends).any():
                raise ValueError("a token spans two words")
            self._keep(keys, ids.tobytes(), (last + 1).tolist())

    def _learn_together(self, units_: list[str]) -> None:
        for at in range(0, len(units_), TOGETHER):
            keys = units_[at : at + TOGETHER]
            ids = np.asarray(self.coder.encode_batch_fast([_joined(keys)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.line_end)
            if len(cuts) != len(keys) - 1:
                raise ValueError("a line end between units is not a token of its own")
            self._keep(keys, ids.tobytes(), [*cuts.tolist(), len(ids)], 1)

    def _keep(self, keys: list[str], raw: bytes, ends: list[int], gap: int = 0) -> None:
        starts = [0, *[end + gap for end in ends[:-1]]]
        self.known.now.update(zip(keys, [raw[4 * a : 4 * b] for a, b in zip(starts, ends)]))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text.  Units of texts that fall apart at blanks are told apart by Arrow."""
        rows = texts.to_pylist()
        out = [b""] * len(rows)
        at_blanks = [k for k, text in enumerate(rows) if text and falls_apart(text)]
        if at_blanks:
            whole = texts if len(at_blanks) == len(rows) else texts.take(pa.array(at_blanks))
            bare, nothing, blank = (pa.scalar(x, whole.type) for x in (BARE, "", " "))
            parts_ = pc.split_pattern(pc.binary_join_element_wise(bare, whole, nothing), " ")
            found = parts_.flatten().dictionary_encode()
            listed = pa.ListArray.from_arrays([0, len(found.dictionary)], found.dictionary)
            keys = pc.binary_join(listed, blank)[0].as_py().split(" ")
            self.learn([keys])
            ids = pa.array(list(map(self.known.now.__getitem__, keys)), pa.binary()).take(found.indices)
            ends = np.frombuffer(ids.buffers()[1], np.int32)[np.cumsum(pc.list_value_length(parts_).to_numpy())].tolist()
            raw, start = memoryview(ids.buffers()[2]), 0
            for k, end in zip(at_blanks, ends):
                out[k], start = bytes(raw[start:end]), end
        others = {k: units(rows[k]) for k in set(range(len(rows))).difference(at_blanks)}
        self.learn(list(others.values()))
        for k, keys in others.items():
            out[k] = b"".join(map(self.known.now.__getitem__, keys))
        return out


@lru_cache(maxsize=1)
def ids_of(path: str) -> Ids:
    return Ids(path)


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
)
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _gathered(frames: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold so many bytes, as many units come back within a few batches."""
    held, size = [], 0
    for batch in frames:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _cut(path: str, size: int):
    end = np.asarray([END], "<u4").tobytes()

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that ran other stages still holds their Arrow memory, about 50 MB.
        pa.default_memory_pool().release_unused()
        own = ids_of(path)
        for batch in (part for whole in _gathered(frames, AT_ONCE) for part in parts(whole, "text", AT_ONCE)):
            out: list[list[int]] = [[] for _ in PIECES]
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1))):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(out, PIECES)], schema=PIECES)

    return run


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns and how often each is used, from {length: how many}.

    Lengths are placed longest first, each into the packs that are shortest so far, in as
    many of them as there are pieces; pieces that find no room open packs of their own.
    Packs that are alike are one pattern with a count, so the work depends on the lengths,
    not on the number of pieces.
    """
    by_total: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    shortest: list[int] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        total = sum(pattern)
        if not by_total[total]:
            heappush(shortest, total)
        by_total[total][pattern] = by_total[total].get(pattern, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not shortest or shortest[0] + length > size:
                many = min(size // length, left)
                put((length,) * many, left // many)
                left %= many
                continue
            packs = by_total[shortest[0]]
            pattern = min(packs)
            n = packs.pop(pattern)
            if not packs:
                heappop(shortest)
            used = min(n, left)
            if n > used:
                put(pattern, n - used)
            put(pattern + (length,), used)
            left -= used
    return [(p, n) for t in sorted(by_total) for p, n in sorted(by_total[t].items())]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a pack, first pack, offset) for each pattern and
    length: the pieces of a length take their places in order of rank."""
    out, taken, first = [], defaultdict(int), 0
    for pattern, n in patterns:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            k = pattern.count(length)
            out.append((length, taken[length], taken[length] + n * k, k, first, at))
            taken[length] += n * k
            at += k * length
        first += n
    return out


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, path: str | None = None
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document's ids end with id 1; it is cut at multiples of ``size`` and what is left over
    is one piece more.  Texts are read once and neither they nor their ids move: only the
    pieces' lengths do.  Ranks within a length are counted in groups of (length, bucket), so
    a length that a third of all pieces have is spread over all buckets.  The driver holds
    the histogram of at most ``size`` lengths and the patterns, whose number depends on it.

    Defined cases: null and empty texts are the end id alone; repeated rows each give their
    pieces; a null doc_id stays null; an empty table gives an empty result; other columns
    are not read.
    """
    spark = docs.sparkSession
    settings(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    pieces = plain_docs(docs, id_col, text_col).mapInArrow(_cut(path, size), PIECES_DDL)
    buckets = count_partitions(spark)
    pieces = stage(
        pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    )
    held = pieces.groupBy("length", "bucket").count()
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("own", F.row_number().over(order) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("earlier") + F.col("own"))
    )
    found = pa.Table.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*slots(shortest_pack_first(histogram, size)))] or [pa.array([], pa.int64())] * 6,
        ["length", "lo", "hi", "k", "first", "at"],
    )
    places = spark.createDataFrame(found)
    inside = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    at = F.col("rank") - F.col("lo")
    return (
        ranked.join(F.broadcast(places), "length")
        .where(inside)
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            F.expr("first + (rank - lo) div k").alias("sequence_id"),
            (F.col("at") + F.pmod(at, F.col("k")) * F.col("length")).alias("offset"),
        )
    )
