"""Word runs, signatures and spelling variants against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from slotcast.llm import hamming, queries, runs, spelling
from slotcast.llm.near import shingle_set

GAP = "[\x20\x09-\x0d]+"


def words_of(text):
    return [w for w in re.split(GAP, text or "") if w]


# --- runs ----------------------------------------------------------------------------------


def plain_runs(words):
    """For each period the stretches that keep it; of one stretch the smallest period."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(24, 3 * q):
                found.setdefault((at, end + q), q)
            at = max(end, at + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def periodic_texts(count):
    draw = random.Random(7)
    for _ in range(count):
        letters, words = draw.choice([1, 2, 2, 3, 5, 40]), []
        while len(words) < draw.choice([10, 40, 120, 400]):
            unit = [draw.randrange(letters) for _ in range(draw.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 31, 40]))]
            words += (unit * draw.choice([1, 2, 3, 4, 9]))[: draw.randrange(1, 300)]
        yield words


def test_runs_equal_a_plain_search():
    texts = list(periodic_texts(600))
    assert runs.runs_of(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("chunk", [1, 5, 64])
def test_catchers_do_not_depend_on_the_chunks(chunk):
    for words in periodic_texts(60):
        catchers = runs.Catchers()
        for at in range(0, len(words), chunk):
            catchers.append(np.array(words[at : at + chunk]))
        assert catchers.runs() == plain_runs(words)


def test_a_stretch_has_its_smallest_period_and_ends_where_it_breaks():
    words = list("xy") + list("ab") * 20 + list("z") + ["c"] * 23
    assert runs.runs_of([words]) == [[(2, 40, 2)]]
    assert runs.kept_words(words, [(2, 40, 2)]) == list("xyabz") + ["c"] * 23


def test_strongest_run_by_exact_ratio_then_start():
    assert runs.strongest([(50, 48, 3), (10, 64, 4), (0, 30, 10)]) == (10, 64, 4)
    assert runs.strongest([]) is None


def expected_op11(doc_id, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, left)]
    return doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha


def test_op11_on_a_small_table(spark, tmp_path):
    draw = random.Random(3)
    texts = ["  ".join(f"w{draw.randrange(500)}" for _ in range(draw.randrange(1, 300))) for _ in range(80)]
    texts += [None, "", " \n\t", "a " * 30, "é è " * 9000, "one two", "one two"]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(3, texts[3], "x"), (None, "a b " * 40, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, n_words string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [expected_op11(d, t) for d, t, _ in rows]
    assert sum(r[1] for r in want) > 5
    assert sorted(got, key=str) == sorted(want, key=str)


def test_runs_of_an_empty_table_and_a_text_id(spark):
    docs = spark.createDataFrame([("k", "a b " * 12)], "name string, body string")
    found = runs.find_runs(docs, "name", "body")
    assert [(r.name, r.n_words, r.runs[0].period, r.collapsed) for r in found.collect()] == [("k", 24, 2, "a b")]
    assert runs.find_runs(docs.limit(0), "name", "body").count() == 0


# --- signatures ----------------------------------------------------------------------------


def near_texts():
    draw = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([6, 12, 40, 150, 600]))]
        texts.append(base)
        for _ in range(draw.randrange(8)):
            copy = list(base)
            for _ in range(draw.randrange(1, max(2, len(base) // 40))):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(9)}"
            texts.append(copy)
    passage = [f"p{k}" for k in range(60)]
    texts += [passage + [f"q{draw.randrange(9000)}" for _ in range(draw.choice([4, 9, 20]))] for _ in range(25)]
    return [" ".join(t) for t in texts]


def plain_classes(rows):
    """Smallest id over links of at least 85 hundredths, over all pairs."""
    sets = [(d, {tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))} if w else set())
            for d, w in ((d, words_of(t.lower() if t else t)) for d, t in rows)]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets)


def test_near_classes_equal_all_pairs(spark):
    rows = list(enumerate(near_texts()))
    random.Random(1).shuffle(rows)
    rows += [(900, "Two Words"), (901, "two\nwords"), (902, None), (903, " "), (904, rows[0][1]), (rows[1][0], rows[1][1])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int")
    got = sorted(tuple(r) for r in hamming.near_classes(docs).collect())
    assert got == plain_classes(rows)
    assert len({r[2] for r in got}) < len({r[0] for r in got}) - 5


def test_a_null_id_and_several_texts_of_one_id(spark):
    long = " ".join(f"w{k}" for k in range(80))
    rows = [(1, long), (2, long + " end"), (2, "other text"), (3, "other  text"), (None, "other text"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in hamming.near_classes(docs).collect()), key=str)
    assert got == sorted([(1, 76, 1, True), (2, 77, 1, False), (2, 1, 1, False), (3, 1, 1, False),
                          (None, 1, 1, None), (None, 1, None, None)], key=str)
    assert hamming.near_classes(docs.limit(0)).count() == 0


def test_all_pairs_below_the_distance_share_a_number():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << hamming.BITS, (300, hamming.CHUNKS * hamming.SYMBOLS), np.int64)
    other = base.copy()
    for row in other:
        row[draw.permutation(len(row))[: hamming.DISTANCE]] ^= 1
    left, right = hamming.listed_numbers(base), hamming.listed_numbers(other)
    assert all(set(a) & set(b) for a, b in zip(left.tolist(), right.tolist()))


def test_symbols_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(4)
    same = []
    for _ in range(60):
        pool = draw.integers(0, 2**63, 1150, np.int64).astype(np.uint64)
        same.append((hamming.signature(np.sort(pool[:1000])) == hamming.signature(np.sort(pool[150:]))).mean())
    assert abs(np.mean(same) - 850 / 1150) < 0.03


def test_sketches_differ_in_no_more_classes_than_shingles():
    a, b = (shingle_set(" ".join(f"w{k}" for k in range(n)).encode()) for n in (300, 290))
    differ = int(np.bitwise_count((hamming.sketch(a) ^ hamming.sketch(b)).view(np.uint64)).sum())
    assert 0 < differ <= len(np.setxor1d(a, b))


def test_one_large_group_of_altered_copies(spark):
    draw = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 400):
        copy = list(base)
        copy[draw.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert hamming.near_classes(docs).select("component_id").distinct().collect() == [(0,)]


# --- spelling ------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= ratio * counts[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def vocabulary(size, draw):
    words = {}
    while len(words) < size:
        base = "".join(draw.choice(["ab", "re", "tion", "é", "st", "a", "in", "ment"]) for _ in range(draw.randrange(3, 6)))
        for _ in range(draw.randrange(1, 5)):
            if len(base) >= 6:
                words[base] = draw.choice([5, 5, 7, 30, 30, 200, 1000])
            at = draw.randrange(len(base) + 1)
            base = base[:at] + draw.choice(["", "x", "é"]) + base[at + draw.randrange(2) :]
    return words


@pytest.mark.parametrize("list_size", [64, 3])
def test_variants_equal_a_plain_search(spark, monkeypatch, list_size):
    monkeypatch.setattr(spelling, "LIST_SIZE", list_size)
    counts = vocabulary(500, random.Random(11))
    words = spark.createDataFrame([(w, n, 0) for w, n in counts.items()], "word string, n long, form int")
    got = sorted((tuple(r) for r in spelling.spelling_variants(words).collect()), key=lambda r: r[0])
    want = plain_variants(counts)
    assert got == want
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] != r[2] for r in want if r[1])


def test_one_edit_touches_no_more_grams_than_the_bound(spark):
    draw = random.Random(13)
    counts = vocabulary(300, draw)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    frequent = spelling.frequent_grams(words, 5)
    assert frequent
    for word in counts:
        at, new = draw.randrange(len(word)), draw.choice("axé")
        grams, bound = spelling.decompose(word, frequent, 5)
        assert bound < len(word)
        for other in (word[:at] + word[at + 1 :], word[:at] + new + word[at:], word[:at] + new + word[at + 1 :]):
            kept = Counter(grams) & Counter(spelling.decompose(other, frequent, 5)[0])
            assert sum(kept.values()) >= len(word) - bound


def test_op13_on_a_small_table(spark, tmp_path):
    draw = random.Random(17)
    pool = ["station", "Étoile", "étoilé", "MOUNTAIN", "montain", "mountains", "short", "naïveté", "x÷y×zab", "stations", "statione"]
    texts = [" ".join(draw.choice(pool) for _ in range(draw.randrange(60))) + ",9" for _ in range(150)]
    texts += [None, "", "station" * 3000, texts[0]]
    rows = [(k, t, 0) for k, t in enumerate(texts)] + [(0, texts[0], 0)]
    spark.createDataFrame(rows, "doc_id long, text string, word int").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text, _ in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = sorted(tuple(r) for r in queries.op13_spelling_variants(spark, str(tmp_path)).collect())
    assert [r[0] for r in got] == sorted(counts)
    assert got == plain_variants(counts)


def test_a_planted_slip_takes_the_letter_that_its_checksum_names():
    doc_id = next(k for k in range(10_000) if zlib.crc32(f"{k}:étoiles".encode()) % 199 == 0)
    at = zlib.crc32(f"{doc_id}:étoiles".encode()) % 7
    word = "étoiles"
    assert queries.dropped_letters(doc_id, {word.encode(): 2}) == {(word[:at] + word[at + 1 :]).encode(): 2}
    assert queries.dropped_letters(None, {b"word": 1}) == {b"word": 1}


def test_a_slip_into_a_word_that_slips_too_moves_only_its_own_occurrences():
    def slip(doc_id, word):
        h = zlib.crc32(f"{doc_id}:{word}".encode())
        return word[: h % len(word)] + word[h % len(word) + 1 :] if h % 199 == 0 else word

    long = "établissements"
    doc_id = next(k for k in range(10**6) if slip(k, long) != long and slip(k, slip(k, long)) != slip(k, long))
    middle = slip(doc_id, long)
    want = {middle.encode(): 20, slip(doc_id, middle).encode(): 3, b"others": 1}
    for words in ([(long, 20), (middle, 3), ("others", 1)], [(middle, 3), ("others", 1), (long, 20)]):
        assert queries.dropped_letters(doc_id, {w.encode(): n for w, n in words}) == want


def test_forms_form_chains_to_one_root(spark):
    words = [("station", 1000), ("stations", 200), ("statione", 40), ("stationee", 8), ("other", 7), ("oneword", 5)]
    got = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame(words, "word string, n long"), min_letters=5).collect()}
    assert got["stationee"].form == "statione" and got["stationee"].root == "station"
    assert got["oneword"].n_near == 0 and got["oneword"].form_n is None and got["oneword"].root == "oneword"


def test_empty_vocabulary_and_refused_settings(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.word_counts(empty)
    assert spelling.spelling_variants(words).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(words, ratio=1)
    with pytest.raises(ValueError):
        spelling.near_words(words, min_letters=2)
