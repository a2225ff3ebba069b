"""Spelling variants: words one letter apart, found through an index of variable-length grams.

A dictionary of grams is pruned by frequency: a gram that many words hold is replaced by the
longer grams that begin with it.  Every place of a word then begins exactly one gram, and
which one only the letters of that gram decide, so one edit touches no gram but those that
cover it.  The most grams that cover one place are the word's bound: of a word's grams, all
but so many stay in every word one edit away, and the inverted lists of its rarest
bound + 1 grams hold all of them.  Only those lists are merged; pairs are then verified.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.session import stage, staged

from .common import columns, parts, settings

#: Least code points and occurrences of a word, and how often a form is the word.
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Lengths of grams.  The longest is shorter than any word, so a word's bound leaves a gram.
QMIN, QMAX = 2, 5
#: A gram in more words than this is extended; with many words the figure grows with them, so
#: that at most FREQUENT_MAX grams are told to every task.
LIST_SIZE, FREQUENT_MAX = 64, 100_000
#: Different words that a task counts before it passes them on.
HELD = 400_000
#: Stands for places behind a word's end.
END = "\0"

Change = Callable[[int | None, dict[bytes, int]], dict[bytes, int]]


def _counted(min_letters: int, change: Change | None):
    # A letter is a-z or U+00C0 to U+00FF, which UTF-8 writes as C3 and one more byte.
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % min_letters).findall

    def flushed(held: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = Counter()
        for batch in frames:
            for part in parts(batch, "_text"):
                for doc_id, text in zip(*columns(part, "_id", "_text")):
                    found = Counter(runs(text.lower()))
                    for word, n in (change(doc_id, found) if change else found).items():
                        held[word] += n
                    if len(held) > HELD:
                        yield flushed(held)
                        held = Counter()
        if held:
            yield flushed(held)

    return task


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    change: Change | None = None,
) -> DataFrame:
    """(word, n): maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case, with
    at least ``min_letters`` letters and ``min_count`` occurrences in all texts.

    ``change`` may replace the counts of one document's words (UTF-8), given its id.  Runs of
    fewer letters are not passed to it.  A null text has no words; repeated rows count again.
    """
    settings(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return (
        rows.mapInArrow(_counted(min_letters, change), "word string, n long")
        .where(F.char_length("word") >= min_letters)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def frequent_grams(words: DataFrame, longest: int) -> frozenset[str]:
    """Grams shorter than ``longest`` that the dictionary extends.

    With p places in all words and k lengths fewer than k * p / t grams occur more than t
    times, so a t of k * p / FREQUENT_MAX or more bounds what reaches the driver and the tasks.
    """
    lengths = range(QMIN, longest)
    places = words.agg(F.coalesce(F.sum(F.char_length("word")), F.lit(0))).first()[0]
    least = max(LIST_SIZE, -(-len(lengths) * places // FREQUENT_MAX))
    padded = F.concat("word", F.lit(END * longest))
    grams = [
        F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda at, q=q: F.substr(padded, at, F.lit(q)))
        for q in lengths
    ]
    if not grams:
        return frozenset()
    rows = words.select(F.explode(F.concat(*grams)).alias("gram")).groupBy("gram").count()
    return frozenset(r["gram"] for r in rows.where(F.col("count") > least).collect())


def decompose(word: str, frequent: frozenset[str], longest: int) -> tuple[list[str], int]:
    """The gram that begins at each place, and the most grams that one edit can touch."""
    padded = word + END * longest
    grams, cover = [], [0] * (len(word) + longest)
    for at in range(len(word)):
        end = at + QMIN
        while end - at < longest and padded[at:end] in frequent:
            end += 1
        grams.append(padded[at:end])
        for place in range(at, end):
            cover[place] += 1
    return grams, max(cover[: len(word)], default=0)


def _decomposed(frequent: frozenset[str], longest: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("grams", pa.list_(pa.string())), ("bound", pa.int32())])

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            made = [decompose(w, frequent, longest) for w in batch.column(0).to_pylist()]
            grams = pa.array([g for g, _ in made], pa.list_(pa.string()))
            bounds = pa.array([b for _, b in made], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], grams, bounds], schema=schema)

    return task


def near_words(words: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(a, n_a, b, n_b), each pair once: words that differ by one letter put in, out or in place
    of another.  ``words`` has distinct (word, n), each of ``min_letters`` letters or more.

    Two such words share a gram at the same place counted from the edit's side: equally long
    words at the same place, else the longer one there or one place on.  The first shared gram
    in the order of rarity is among the rarest bound + 1 of both, so lists are joined by gram,
    length and place.
    """
    longest = min(QMAX, min_letters - 1)
    if longest < QMIN:
        raise ValueError(f"words need more than {QMIN} letters")
    frequent = frequent_grams(words, longest)
    made = words.mapInArrow(_decomposed(frequent, longest), "word string, n long, grams array<string>, bound int")
    with staged(made) as whole:
        places = whole.select("word", "n", "bound", F.posexplode("grams").alias("pos", "gram"))
        lists = places.groupBy("gram").agg(F.count("*").alias("size"))
        rarest = (
            places.join(lists, "gram")
            .groupBy("word", "n", "bound")
            .agg(F.array_sort(F.collect_list(F.struct("size", "gram", "pos"))).alias("grams"))
            .select("word", "n", F.explode(F.slice("grams", F.lit(1), F.col("bound") + 1)).alias("g"))
        )
        entries = stage(rarest.select("word", "n", F.char_length("word").alias("length"), "g.gram", "g.pos"))
    # An entry of the other side: itself, and the two places it may have in a longer word.
    length, pos = F.col("length"), F.col("pos")
    places = [F.struct((length + k).alias("length"), (pos + j).alias("pos"), F.lit(k).alias("longer")) for k, j in ((0, 0), (1, 0), (1, 1))]
    other = entries.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "gram", F.explode(F.array(*places)).alias("_at"))
    other = other.select("b", "n_b", "gram", "_at.*")
    pairs = entries.withColumnsRenamed({"word": "a", "n": "n_a"}).join(other, ["gram", "length", "pos"])
    pairs = pairs.where((F.col("longer") == 1) | (F.col("a") < F.col("b")))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form), found by doubling the steps."""
    at = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        further = stage(at.join(on, "root", "left").select("word", "root", "_on"))
        if further.where(F.col("_on").isNotNull()).isEmpty():
            return at
        at = further.select("word", F.coalesce("_on", "root").alias("root"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each row of ``words`` (word, n).

    Near words differ by exactly one letter put in, out or in place of another.  A word's form
    is its most frequent near word (ties: the smallest by code points), if that occurs
    ``ratio`` times as often as the word or more, else null; root: what forms lead to.  As n
    grows along the forms, they end, after few steps.

    Defined cases: words are distinct; an empty table gives an empty result; words of any
    length are handled whole; columns besides word and n are not read.
    """
    if ratio <= 1:
        raise ValueError("a form must occur more often than its word")
    words = stage(words.select("word", "n"))
    pairs = stage(near_words(words, min_letters))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).union(
        pairs.select("b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("_best")
    )
    enough = -F.col("_best.less") >= ratio * F.col("n")
    made = stage(
        words.join(best, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("_best.other")).alias("form"),
            F.when(enough, -F.col("_best.less")).alias("form_n"),
        )
    )
    roots = _roots(made.where(F.col("form").isNotNull()))
    return made.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
