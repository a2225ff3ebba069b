"""The corpus pipeline and the counts of the quality rules against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from slotcast.llm import quality

GAP = "[\x20\x09-\x0d]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row_key int"


def words_of(text):
    return [w for w in re.split(GAP, text or "") if w]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(21)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "min", "tra") for b in ("ne", "su", "po") for c in ("", "t", "ra", "den")]
    sentence = lambda n: " ".join(draw.choice(vocabulary) + ("." if k % 9 == 8 else "") for k in range(n))
    texts = [sentence(draw.randrange(30, 400)) for _ in range(40)]
    texts += [texts[k].replace(" ", "  ", 3) for k in range(5)]  # equal but for gaps
    for k in range(6, 14):  # near copies
        words = texts[k].split()
        words[draw.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", " \n ", "few words", "again and again " * 60, "#$%& <> | " * 30, sentence(9000), texts[20], texts[21]]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    rows = [(i, t, "en", "s", len(t or ""), "x", 0) for i, t in zip(ids, texts)]
    return rows + [rows[2]]  # a repeated row


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def plain_counts(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        sum(n - 1 for n in Counter(lines).values()), len(covered),
    )


def test_counts_of_the_rules(spark, rows):
    got = quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = Counter((r[0], *plain_counts(r[1])) for r in rows)
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def smallest_of_equal_texts(rows):
    keep = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        keep.setdefault(re.sub(GAP, " ", text or ""), (doc_id, text))
    return list(keep.values())


def one_of_near_texts(rows):
    sets, root = {}, {}
    for doc_id, text in rows:
        words = words_of((text or "").lower())
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        root[doc_id] = doc_id

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(d, t) for d, t in rows if find(d) == d]


def test_pipeline_equals_its_stages_done_plainly(spark, rows, folder):
    judged = quality.judged(spark.createDataFrame(rows, SCHEMA)).where("kept").select("doc_id").distinct()
    good = {r.doc_id for r in judged.collect()}
    assert 30 < len(good) < len(rows)
    texts = one_of_near_texts(smallest_of_equal_texts({(r[0], r[1]) for r in rows if r[0] in good}))
    assert len(texts) < len(good) - 5
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.no_padding()
    coder.no_truncation()
    ids = {d: np.array([*coder.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in texts}
    pieces = corpus_pipeline.run(spark, folder).collect()
    own = defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
    assert set(own) == set(ids)
    for doc_id, parts in own.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[doc_id])
            assert p.ids_crc32 == zlib.crc32(ids[doc_id][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[doc_id])
    packs = defaultdict(list)
    for p in pieces:
        packs[p.sequence_id].append((p.offset, p.length))
    for held in packs.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


def test_all_stages_but_the_last_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = out
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, folder).count() == 0
