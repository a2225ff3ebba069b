"""BPE encoding and decoding with a pair occurrence index.

All distinct pre-tokens of a batch lie in one linked list of symbols.  An index maps each
pair that can merge to all its positions; the lowest rank is merged everywhere, which
changes the lists of the neighbouring pairs only, until no indexed pair is left.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_docs, settings
from .pretokens import SPECIAL, Remembered, piece, pretokens, special_parts, units

VOCABULARY = "byte_bpe_50k.json"
#: Distinct pre-tokens that share one index.
BLOCK = 4096


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary, merges = stored["model"]["vocab"], stored["model"]["merges"]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.content = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if token not in self.special}
        self.content |= {i: token.encode() for token, i in self.special.items()}
        self.of_byte = [vocabulary[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.follow: dict[int, dict[int, int]] = {i: {} for i in vocabulary.values()}
        self.merged: list[tuple[int, int, int]] = []
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.follow[a].setdefault(b, rank)
            self.merged.append((a, b, c))
        self.symbol = np.asarray(self.of_byte, np.int64)
        self.first_rank = np.asarray([[self.follow[a].get(b, -1) for b in self.of_byte] for a in self.of_byte])
        self.decimal = {i: str(i) for i in self.content}
        self.known = Remembered()
        self.pieces = Remembered()

    def encode_batch(self, words: list[str]) -> list[list[int]]:
        """Token ids of each pre-token, block by block."""
        return [ids for at in range(0, len(words), BLOCK) for ids in self._encode_block(words[at : at + BLOCK])]

    def _encode_block(self, words: list[str]) -> list[list[int]]:
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        if not coded:
            return []
        raw = np.frombuffer(b"".join(coded), np.uint8)
        ends = np.cumsum([len(w) for w in coded])
        starts = [0, *ends[:-1].tolist()]
        symbols = self.symbol[raw].tolist()
        place = np.arange(len(raw))
        after, before = place + 1, place - 1
        after[ends - 1], before[starts] = -1, -1
        pair = np.full(len(raw), -1)
        pair[:-1] = self.first_rank[raw[:-1], raw[1:]]
        pair[ends - 1] = -1
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0) :]
        found, cuts = np.unique(pair[order], return_index=True)
        index = {r: at.tolist() for r, at in zip(found.tolist(), np.split(order, cuts[1:]))} if len(order) else {}
        after, before = after.tolist(), before.tolist()
        follow, merged = self.follow, self.merged
        active = list(index)
        heapify(active)
        while active:
            r = heappop(active)
            a, b, c = merged[r]
            positions = index.pop(r)
            if a == b:
                positions.sort()
            right_ranks = follow[c]
            for at in positions:
                right = after[at]
                if right < 0 or symbols[at] != a or symbols[right] != b:
                    continue
                symbols[at], symbols[right] = c, -1
                after[at] = far = after[right]
                if far >= 0:
                    before[far] = at
                    new = right_ranks.get(symbols[far])
                    if new is not None:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heappush(active, new)
                left = before[at]
                if left >= 0:
                    new = follow[symbols[left]].get(c)
                    if new is not None:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heappush(active, new)
        out = []
        for at in starts:
            ids = []
            while at >= 0:
                ids.append(symbols[at])
                at = after[at]
            out.append(ids)
        return out

    def learn(self, texts_units: list[list[str]]) -> None:
        """Ids of all units of a batch that are not known yet: their number, their decimals, the
        ids themselves and what they decode to."""
        new = self.known.unknown(texts_units)
        split = [special_parts(piece(u)) if SPECIAL in u else pretokens(piece(u)) for u in new]
        missing = [w for w in self.pieces.unknown(split) if w not in self.special]
        pieces = self.pieces.now
        pieces.update(zip(missing, self.encode_batch(missing)))
        for word, number in self.special.items():
            pieces[word] = [number]
        decimal, content, now = self.decimal.__getitem__, self.content.__getitem__, self.known.now
        for unit, words in zip(new, split):
            ids = pieces[words[0]] if len(words) == 1 else [i for w in words for i in pieces[w]]
            spelled = b"".join(map(content, ids)).decode("utf-8", "replace")
            now[unit] = (len(ids), ",".join(map(decimal, ids)), tuple(ids), spelled)

    def encode(self, text: str) -> list[int]:
        parts = units(text)
        self.learn([parts])
        return [i for u in parts for i in self.known.now[u][2]]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        content = self.content
        return b"".join([content[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


CODES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def _digests(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in frames:
            ids_, texts = batch.column(0), [units(t) for t in batch.column(1).to_pylist()]
            coder.learn(texts)
            find, rows = coder.known.now.__getitem__, []
            for parts in texts:
                counts, decimals, _, spelled = zip(*map(find, parts)) if parts else ((), (), (), ())
                rows.append(
                    (
                        sum(counts),
                        sha256(",".join(decimals).encode()).hexdigest(),
                        sha256("".join(spelled).encode()).hexdigest(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [ids_, *(pa.array([r[k] for r in rows], CODES[k + 1].type) for k in range(3))], schema=CODES
            )

    return run


def _coded(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in frames:
            ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _spelled(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in frames:
            texts = [coder.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of each whole text, one row for each row of ``docs``.

    Defined cases: null and empty texts have no ids; repeated rows each give a row; a null
    doc_id stays null; an empty table gives an empty result; other columns are not read.
    """
    settings(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    return plain_docs(docs, id_col, text_col).mapInArrow(_coded(path), "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids count as none."""
    settings(coded.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    return coded.select("doc_id", "ids").mapInArrow(_spelled(path), "doc_id long, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes each whole text.

    The same cases as ``encode_documents``.  Ids are hashed in decimal, joined by commas.
    """
    settings(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    return plain_docs(docs, id_col, text_col).mapInArrow(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
