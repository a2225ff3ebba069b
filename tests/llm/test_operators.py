"""Edge cases of the corpus operators, each against a plain computation."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotcast.llm import bpe, common, exact, language_model, licenses, lines, near, packing, quality, unigram, urls
from slotcast.llm.pretokens import piece, pretokens, ranks, units

LONG = "wörter und mehr worte hier " * 9000
TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "One  two\tthree four five six seven eight nine ten"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "it's 12 apples,  don't!\n\n  <|endoftext|> x<|endoftext|>\u00a0\u2003 ende\x1c \U0001f600 \x00a"),
    (8, "a b c"),
    (9, "a b c"),
    (None, "a b c"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, very long, repeated, and columns whose names clash with results."""
    return spark.createDataFrame(TEXTS, SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("kept", "keep_id", "row", "component_id", "row_key", "n", "word", "a", "length")]
    )


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.mark.parametrize(
    "operator",
    [
        exact.exact_groups, near.similarity_classes, quality.judged, packing.pack, bpe.round_trip, unigram.count_tokens,
        lines.dedup_lines, licenses.scan_licenses, language_model.score_documents, exact.drop_exact, near.drop_near, quality.keep_good,
    ],
)
def test_empty_table(empty, operator):
    assert operator(empty).count() == 0


def test_exact_groups(docs):
    rows = {(r.doc_id, r.text_sha256): r for r in exact.exact_groups(docs).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows[(8, sha("a b c"))].group_size == 3
    assert [rows[(i, sha("a b c"))].kept for i in (8, 9, None)] == [True, False, False]
    assert rows[(4, sha(""))].keep_id == 3 and rows[(3, sha(""))].kept
    assert rows[(5, sha(" "))].group_size == 1
    assert len(rows) == len(TEXTS)


def test_hashes_that_collide_are_told_apart(docs):
    few = lambda chunk: F.xxhash64(F.length(chunk))
    key = lambda r: (r.doc_id is None, r.doc_id)
    plain = sorted(exact.exact_groups(docs).collect(), key=key)
    other = docs.withColumn("text", F.when(F.col("doc_id") == 9, "a b d").otherwise(F.col("text")))
    assert sorted(exact.exact_groups(docs, hashed=few).collect(), key=key) == plain
    assert {r.doc_id for r in exact.exact_groups(other, hashed=few).where("group_size = 1 and kept").collect()} >= {9}


def test_exact_groups_give_every_row(spark):
    """Repeated rows each count; rows of one id with different texts are told apart.  Counted plainly."""
    rows = [(1, "a b"), (1, "a b"), (2, "a  b"), (2, "a b"), (2, "c"), (3, None), (3, ""), (3, None), (4, "c " * 3000), (4, "c " * 3000)]
    norm = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    want = []
    for i, t in rows:
        same = [j for j, u in rows if norm(u) == norm(t)]
        want.append((i, min(same), len(same), i == min(same), hashlib.sha256(norm(t).encode()).hexdigest()))
    few = lambda chunk: F.xxhash64(F.length(chunk))
    given = spark.createDataFrame(rows, SCHEMA)
    for hashed in (exact.chunk_hash, few):
        assert sorted(map(tuple, exact.exact_groups(given, hashed=hashed).collect())) == sorted(want)
    assert sorted(r.doc_id for r in exact.drop_exact(given).collect()) == [1, 2, 3, 4]
    largest = spark.createDataFrame([(2**63 - 1, "a"), (None, "a")], SCHEMA)
    assert exact.drop_exact(largest).count() == 1


def test_drop_exact_keeps_columns_and_one_of_repeated_rows(docs):
    kept = exact.drop_exact(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7, 8]


def test_similarity_classes(spark):
    base = [f"w{i}" for i in range(60)]
    changed = [*base]
    changed[0] = "other"
    rows = [
        (9, " ".join(base)), (4, " ".join(changed)), (5, " ".join(base).upper()), (2, "a b c d e f g h i"),
        (3, "a b c d e f g h"), (6, None), (7, "  "), (8, "x y"), (10, "x y"), (11, "x z"), (None, "x y"),
    ]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near.similarity_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {
        (9, 56, 4), (4, 56, 4), (5, 56, 4), (2, 5, 2), (3, 4, 2), (6, 0, 6), (7, 0, 7), (8, 1, 8), (10, 1, 8), (11, 1, 11), (None, 1, 8),
    }


@pytest.mark.parametrize("limit", [0, 3, 8, 20])
def test_links_do_not_depend_on_the_boundary(spark, monkeypatch, limit):
    made = np.random.default_rng(3)
    texts = []
    for _ in range(40):
        words = [f"v{x}" for x in made.integers(0, 30, made.integers(3, 26))]
        texts += [words, words[:-1], words[1:], [*words, "end"]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for w in texts]
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 80 * len(x | y) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if v == high else v for v in label]
    monkeypatch.setattr(near, "boundary", lambda sizes: limit)
    got = near.similarity_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


@pytest.mark.parametrize("told", [0, 1_000_000])
def test_long_sets_are_linked_whether_ids_are_told_or_joined(spark, monkeypatch, told):
    made = np.random.default_rng(5)
    texts = []
    for n in (80, 400, 3000):
        words = [f"u{x}" for x in made.integers(0, 10**6, n)]
        for share in (0.0, 0.015, 0.03, 0.2):
            texts.append([f"new{n}{share}{i}" if made.random() < share else w for i, w in enumerate(words)])
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    label = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 80 * len(x | y) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if v == high else v for v in label]
    assert len(set(label)) < len(label)
    monkeypatch.setattr(near, "TOLD_IDS", told)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = near.similarity_classes(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), label[i]) for i, s in enumerate(sets)}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_components_of_a_long_chain(spark):
    edges = spark.range(40).selectExpr("id + 1 AS a", "id AS b")
    assert {tuple(r) for r in common.components(edges).collect()} == {(i, 0) for i in range(41)}


def test_quality_counts_and_label_model(docs):
    rows = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert (rows[1].n_words, rows[1].word_chars, rows[1].base_failed) == (10, 39, False)
    assert rows[6].base_failed and rows[6].n_repeat_words == 45000
    assert rows[3].base_failed and rows[3].n_words == 0 and not rows[3].kept
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.kept}


def test_rules_that_agree_gain_weight():
    patterns = [((1, 1, 1), 500), ((-1, -1, 1), 300), ((1, 1, -1), 200)]
    model = quality.fit(patterns, 3)
    assert model.accuracy[0] == model.accuracy[1] > model.accuracy[2]
    assert quality.fit([], 3).accuracy == (0.85,) * 3


def test_bpe_is_the_library(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    for id_, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[id_].n_tokens == len(ids), id_
        assert got[id_].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[id_].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    decoded = bpe.decode_documents(bpe.encode_documents(docs))
    assert {r.doc_id: r.text for r in decoded.collect()} == {i: t or "" for i, t in TEXTS}


@pytest.mark.parametrize("text", [t for _, t in TEXTS if t] + ["  a", "a  b", "a \n b ", "\n", "x\u00a0 y"])
def test_units_are_the_text(text):
    assert "".join(map(piece, units(text))) == text


def test_token_counts_are_the_best_segmentation(docs):
    scores = unigram.piece_scores(ranks(public_tokenizers.path(unigram.VOCABULARY)))

    def best(word: bytes) -> int:
        at = [(0, 0)]
        for end in range(1, len(word) + 1):
            at.append(max((at[s][0] + scores[word[s:end]], at[s][1] - 1) for s in range(end) if word[s:end] in scores))
        return -at[-1][1]

    got = {r.doc_id: r.n_tokens for r in unigram.count_tokens(docs).collect()}
    for id_, text in TEXTS:
        assert got[id_] == sum(best(w.encode()) for w in pretokens(text or ""))


def test_packing_places_every_id_once(docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs).collect()
    for id_, text in TEXTS:
        ids, at = [*library.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted((r for r in rows if r.doc_id == id_), key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.SIZE


@pytest.mark.parametrize("remembered", [400_000, 50])
def test_ids_of_units_put_together_are_those_of_the_library(monkeypatch, remembered):
    monkeypatch.setattr(packing, "UNITS", remembered)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own, draw = Tokenizer.from_file(path), packing.Ids(path), random.Random(5)
    pool = [
        "a", "Word", "é", "ÿ", "×", "ɏ", "ɐ", "Ж", "中", "12", "'", "'s", "'ll", "!", "...", "|", "\n", "\n\n", "\n\n\n", "\t", " ", " ", "  ",
        "\x85", "\0", "<|endoftext|>", "\U0001f600", "e\u0301", "Ċ", "Ġ", "_",
    ]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(20))) for _ in range(3000)]
    texts += [" ".join("".join(draw.choice(pool[:18]) for _ in range(draw.randrange(1, 5))) for _ in range(9)) for _ in range(3000)]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        want = [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(part, add_special_tokens=False)]
        assert own.encode(pa.array(["before", *part]).slice(1)) == want


def test_a_word_is_encoded_once_whatever_stands_behind_it(monkeypatch):
    own = packing.Ids(public_tokenizers.path("byte_bpe_50k.json"))
    asked = []
    for name in ("_learn_words", "_learn_together"):
        keep = getattr(own, name)
        monkeypatch.setattr(own, name, lambda keys, keep=keep: (asked.extend(keys), keep(keys)))
    own.encode(pa.array(["Étoile station, étoile! station. station", "a station\nstation!!! étoile..."]))
    own.encode(pa.array(["the station! étoile,"]))
    assert len(asked) == len(set(asked)) and sum("station" in key for key in asked) == 2  # after a blank and bare
    assert not any(re.search(r"\w[^\w]", key) for key in asked)


def test_patterns_hold_the_histogram():
    histogram = {2048: 5, 1500: 7, 700: 3, 500: 11, 48: 20, 1: 9}
    patterns = packing.shortest_pack_first(histogram)
    assert all(sum(p) <= 2048 for p, _ in patterns)
    assert {n: sum(p.count(n) * k for p, k in patterns) for n in histogram} == histogram


def test_lines(spark, docs):
    run = "\n".join(f"line {i} " + "word " * 12 for i in range(6))
    rows = [(2, "own start\n" + run + "\nown end"), (1, run), (3, run.split("\n")[0]), (4, "other\n\n" + run.replace(" ", "  "))]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed == 0
    assert got[2].text == "own start\nown end" and got[4].text == "other\n"
    assert lines.dedup_lines(docs).count() == len(TEXTS)


def test_urls(spark):
    given = ["https://A.Example.ORG/es/1?x=b.org/", "http://example.org/en/12", "http://x.com?y=b.org/", None, "nothing", "http://fr.com/fr/", "http://notexample.org/es/", "http://ads-track.example.net/q", "x://h.net/Login?u=1"]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages).collect()}
    assert got == {
        0: ("a.example.org", "/es/1", "example.org/es/", "block"),
        1: ("example.org", "/en/12", "example.org/en/1", "block"),
        2: ("x.com", "", None, "allow"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("fr.com", "/fr/", "com/fr/", "allow"),
        6: ("notexample.org", "/es/", "org/", "allow"),
        7: ("ads-track.example.net", "/q", None, "block"),
        8: ("h.net", "/Login", None, "block"),
    }
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_licenses(docs, spark):
    rows = [(1, "Text.\nreleased under the  MIT license"), (2, "All rights reserved"), (3, "no"), (4, None)]
    got = {(r.doc_id, r.license, r.dice) for r in licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "MIT", 1.0), (2, "proprietary", 1.0)}
    assert licenses.scan_licenses(docs).count() == 0


def test_language_model_sums_to_one_and_learns(spark):
    texts = ["red green blue " * 30, "uno dos tres " * 30] * 40
    rows = language_model.score_documents(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    model = language_model.Model.start(np.arange(1.0, 9.0))
    near_, far = np.zeros(8, np.int64), np.full(8, 3)
    assert np.exp(model.log_probability(near_, far, np.arange(8))).sum() == pytest.approx(1, abs=1e-5)
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}


def test_language_model_edge_cases(docs):
    rows = {r.doc_id: r for r in language_model.score_documents(docs).collect()}
    assert len(rows) == len(TEXTS) and rows[3].n_tokens == rows[4].n_tokens == rows[5].n_tokens == 1


def test_language_model_counts_equal_plain_ones_with_a_joined_tail(spark, monkeypatch):
    """Base columns by counting, with so few words held that most are joined."""
    monkeypatch.setattr(language_model, "HELD", 20)
    made = random.Random(5)
    pool = [f"W{i}" for i in range(300)]
    rows = [(i, " ".join(made.choice(pool) for _ in range(made.randrange(60)))) for i in range(80)]
    rows += [(None, "w1 null id"), (200, None), (201, ""), (202, "w2 \t\n\x0bw3"), (202, "w2 \t\n\x0bw3"), (203, "only here " * 500)]
    words = lambda t: [*re.findall("[^ \t-\r]+", (t or "").lower()), None]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, t in rows for w in words(t) if not out(i))
    n = sum(counts.values())
    want = Counter()
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words(t))
        want[(i, out(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(base, 6))] += 1
    got = language_model.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_language_model_does_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD", 700)
    made = random.Random(6)
    rows = [(i, " ".join(made.choice(["red green blue", "uno dos tres", "x"]) for _ in range(30))) for i in range(60)]
    rows += [(500, None), (500, "")]
    given = spark.createDataFrame(rows, SCHEMA)
    few, many = (
        sorted((r.doc_id, r.n_tokens, r.score) for r in language_model.score_documents(given.repartition(k)).collect()) for k in (1, 9)
    )
    assert [r[:2] for r in few] == [r[:2] for r in many]
    assert [r[2] for r in few] == pytest.approx([r[2] for r in many], rel=1e-5)
