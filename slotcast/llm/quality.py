"""Quality by weak supervision (DataFrame operations only).

Rules vote good (1), bad (-1) or abstain (0) on each document.  How reliable each rule is
comes from the votes alone: expectation-maximisation over the histogram of vote patterns.
A document's posterior probability of being good replaces the demand that all rules pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.session import stage

from .common import GAP, GAP_CHARS, let, text_of

WINDOW = 5
ROW = "_source_row"
SYMBOLS = "[#*$%&|<>]"

#: Frequent short words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for was on be with as by this are not or "
    "der die das und ist in zu von mit sich den des im für nicht auf ein eine als "
    "le la les de des et un une du en est que qui dans pour au sur pas par "
    "el los las del y que se por con para una su al lo como no es"
).split()


def _windows(words: Column) -> Column:
    """A 64-bit hash for each run of five words."""
    step = lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, WINDOW)])
    return F.when(
        F.size(words) >= WINDOW, F.slice(F.transform(words, step), F.lit(1), F.size(words) - (WINDOW - 1))
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words that lie in windows found twice or more: repeated windows' starts, united."""

    def starts(order: Column) -> Column:
        repeated = F.filter(
            order,
            lambda x, i: (x["h"] == F.get(order, i + 1)["h"])
            | ((i > 0) & (x["h"] == F.get(order, F.greatest(i - 1, F.lit(0)))["h"])),
        )
        return F.array_sort(F.transform(repeated, lambda x: x["i"]))

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    total = lambda at: F.aggregate(
        at,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda seen, i: F.struct(
            (i + WINDOW).alias("end"),
            (seen["n"] + (i + WINDOW) - F.greatest(seen["end"], i)).alias("n"),
        ),
        lambda seen: seen["n"],
    )
    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        let(ordered, lambda order: total(starts(order))),
    ).otherwise(F.lit(0))


def features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The measured values of each document, one row for each row of ``docs``.

    n_words; word_chars, code points in words; n_symbols, characters of ``[#*$%&|<>]``;
    n_lines and n_dup_lines, lines with a word and those equal to an earlier one;
    n_repeat_words, words in five-word windows found twice or more; n_upper, capitals;
    n_function, function words; n_tied, runs of exclamation and other end marks; n_ends, words
    with an end mark last.
    A null or empty text gives zeros.  ``carry`` names columns that come along.
    """
    text = text_of(text_col)
    words = F.btrim(text, F.lit(GAP_CHARS))
    words = F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, GAP))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    measured = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(_windows(w), _covered).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*FUNCTION_WORDS))).cast("long").alias("n_function"),
        ),
    )
    counted = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        measured.alias("m"),
        counted.alias("c"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[!?.]{3,}|[.!?]!|!!")).cast("long").alias("n_tied"),
        F.regexp_count(text, F.lit("[.?!](?:[\\x20\\x09-\\x0D]|$)")).cast("long").alias("n_ends"),
        *carry,
    ).select("doc_id", "m.*", "c.*", "n_symbols", "n_upper", "n_tied", "n_ends", *carry)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else not at all."""

    name: str
    bad: str
    good: str


#: Shares are written as products, so that no division by zero needs a case of its own.
RULES = (
    Rule("length", "n_words < 10", "false"),
    Rule("word_length", "word_chars > 14 * n_words or word_chars < 2 * n_words", "false"),
    Rule("symbols", "10 * n_symbols > n_words", "false"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "false"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "false"),
    Rule("capitals", "n_words >= 5 and 10 * n_upper > 3 * word_chars", "false"),
    Rule("marks", "10 * n_tied > n_words", "false"),
    Rule("prose", "n_words >= 50 and 100 * n_function < n_words", "n_words >= 10 and 100 * n_function >= 12 * n_words"),
    Rule("sentences", "n_words >= 100 and n_ends = 0", "n_ends > 0 and 60 * n_ends >= n_words and 50 * n_symbols <= n_words and 50 * n_tied <= n_words"),
)


def votes(measured: DataFrame, rules=RULES) -> DataFrame:
    """A column ``vote_<name>`` of -1, 0 or 1 for each rule; an empty text gets zeros but for
    what its rules say of no words."""
    return measured.select(
        "*",
        *[
            F.when(F.coalesce(F.expr(r.bad), F.lit(False)), -1)
            .when(F.coalesce(F.expr(r.good), F.lit(False)), 1)
            .otherwise(0)
            .alias(f"vote_{r.name}")
            for r in rules
        ],
    )


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and for each rule how often its votes are right."""

    prior: float
    accuracy: tuple[float, ...]

    def weights(self) -> list[float]:
        """What a rule's vote adds to (good) or takes from (bad) the log-odds of good."""
        return [math.log(a / (1 - a)) for a in self.accuracy]

    def posterior(self, pattern) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        odds += sum(w * vote for w, vote in zip(self.weights(), pattern))
        return 1 / (1 + math.exp(-odds))


def fit(
    patterns: list[tuple[tuple[int, ...], int]],
    n_rules: int,
    balance: float = 0.6,
    start: float = 0.85,
    rounds: int = 50,
) -> LabelModel:
    """Expectation-maximisation over (votes, count) patterns, 3 ** n_rules at most.

    E: the posterior of each pattern; M: a rule's accuracy is the share of its votes that
    the posterior agrees with.  An abstaining rule says nothing.  ``balance``, the share of
    good documents before any vote, is given, as votes alone do not tell it; accuracies
    begin at ``start``, which says which class is called good, and are averaged with it, as
    if each rule had once more as many votes, so that a rule that no other rule speaks to
    keeps its say.  Without documents, or for a rule without votes, the start is returned.
    """
    model = LabelModel(balance, (start,) * n_rules)
    for _ in range(rounds):
        right, cast = [0.0] * n_rules, [0.0] * n_rules
        for pattern, n in patterns:
            good = model.posterior(pattern)
            for j, vote in enumerate(pattern):
                if vote:
                    cast[j] += n
                    right[j] += n * (good if vote > 0 else 1 - good)
        model = LabelModel(
            balance, tuple((r + start * c) / (2 * c) if c else start for r, c in zip(right, cast))
        )
    return model


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules=RULES,
    threshold: float = 0.5,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Features, base_failed, votes, quality and kept for each row of ``docs``.

    base_failed: under ten words, or more than a fifth of the words in repeated windows.
    kept: not base_failed, and the posterior probability is ``threshold`` or more.  Texts
    are read once; the measured values are written to the shared folder, every document's
    votes enter the histogram, and only its patterns reach the driver.

    Defined cases: a null or empty text fails (no words); repeated rows are judged alike and
    each gives a row; a null doc_id stays null; an empty table gives an empty result.
    """
    names = [f"vote_{r.name}" for r in rules]
    voted = stage(votes(features(docs, id_col, text_col, carry), rules))
    found = voted.groupBy(*names).count().collect()
    model = fit([(tuple(r[n] for n in names), r["count"]) for r in found], len(rules))
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for name, weight in zip(names, model.weights()):
        odds = odds + F.col(name) * F.lit(weight)
    quality = 1 / (1 + F.exp(-odds))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("quality", quality)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with all their columns.

    The rows travel beside their votes as one nested column, so neither repeated nor null
    ids nor the names of other columns matter, and no join moves the texts again.
    """
    carried = docs.withColumn(ROW, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    verdicts = judged(carried, id_col, text_col, carry=(ROW,))
    return verdicts.where("kept").select(f"{ROW}.*")
