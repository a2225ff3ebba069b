"""Token counts by trie-shared dynamic programming over a unigram vocabulary.

A text's pre-tokens are segmented into vocabulary pieces with the highest total score.
Distinct pre-tokens of a batch are inserted into a trie; a node holds the best forward
score of its prefix and the pieces it takes, computed once however many pre-tokens share
the prefix.  The count at a pre-token's terminal node is its number of tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_docs, settings
from .pretokens import Remembered, piece, pretokens, ranks, units

VOCABULARY = "byte_bpe_50k.tiktoken"
NODES = 1_500_000


def piece_scores(rank_of: dict[bytes, int]) -> dict[bytes, int]:
    """Log-probabilities in millionths by Zipf's law of the rank; whole, so ties are ties."""
    total = math.log(sum(1 / (r + 3) for r in rank_of.values()))
    return {piece: round(1e6 * (-math.log(r + 3) - total)) for piece, r in rank_of.items()}


class Trie:
    def __init__(self, scores: dict[bytes, int]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.reset()

    def reset(self) -> None:
        self.child: dict[int, int] = {}
        self.score = [0]
        self.pieces = [0]

    def count(self, word: bytes) -> int:
        """Tokens of a pre-token; of equal scores the one with fewer tokens counts."""
        child, score, pieces, known = self.child, self.score, self.pieces, self.scores.get
        node, path, longest = 0, [0], self.longest
        for end, byte in enumerate(word, 1):
            step = node << 8 | byte
            node = child.get(step, -1)
            if node < 0:
                best, fewest = None, 0
                for start in range(end - longest if end > longest else 0, end):
                    own = known(word[start:end])
                    if own is not None:
                        at = path[start]
                        own += score[at]
                        if best is None or own > best or own == best and pieces[at] < fewest:
                            best, fewest = own, pieces[at]
                node = child[step] = len(score)
                score.append(best)
                pieces.append(fewest + 1)
            path.append(node)
        return pieces[node]


class Counter:
    def __init__(self, path: str):
        self.trie = Trie(piece_scores(ranks(path)))
        self.known = Remembered()
        self.words = Remembered()

    def learn(self, texts_units: list[list[str]]) -> None:
        new = self.known.unknown(texts_units)
        split = [pretokens(piece(u)) for u in new]
        missing = self.words.unknown(split)
        words = self.words.now
        for word in sorted(missing):
            words[word] = self.trie.count(word.encode("utf-8", "surrogatepass"))
            if len(self.trie.score) > NODES:
                self.trie.reset()
        for unit, parts in zip(new, split):
            self.known.now[unit] = (len(parts), sum([words[w] for w in parts]))


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def _counted(path: str):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in frames:
            texts = [units(t, special=False) for t in batch.column(1).to_pylist()]
            own.learn(texts)
            known = own.known.now
            found = [[known[u] for u in t] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([sum([x[k] for x in f]) for f in found], pa.int64()) for k in (0, 1)],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens), one row for each row of ``docs``; nothing is shuffled.

    Defined cases: null and empty texts count zero; special tokens' strings are ordinary
    text; repeated rows each give a row; a null doc_id stays null; an empty table gives an
    empty result; other columns are not read.
    """
    settings(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    return plain_docs(docs, id_col, text_col).mapInArrow(
        _counted(path), "doc_id long, n_pretokens long, n_tokens long"
    )
