"""The words without which no unit can match a license template."""

from __future__ import annotations

import random
import re

from slotcast.llm import licenses


def pairs(text):
    words = re.findall("[a-z0-9]+", text.lower())
    return {*zip(words, words[1:])}


def test_every_matching_unit_holds_an_anchor():
    draw, words = random.Random(1), licenses.anchors()
    assert len(words) < 60
    matched = 0
    for _, template in licenses.TEMPLATES:
        whole = template.split()
        # Take away anchors first, then any words, as long as the text still matches.
        for _ in range(30):
            left = list(whole)
            order = sorted(range(len(whole)), key=lambda k: (not any(a in whole[k].lower() for a in words), draw.random()))
            for k in order:
                tried = list(left)
                tried[k] = ""
                own, known = pairs(" ".join(tried)), pairs(template)
                if 2 * len(own & known) / max(1, len(own) + len(known)) >= licenses.THRESHOLD:
                    left = tried
            text = " ".join(left).lower()
            assert any(a in re.findall("[a-z0-9]+", text) for a in words), template
            matched += 1
    assert matched == 30 * len(licenses.TEMPLATES)


def test_upper_case_and_inner_matches_pass_the_filter(spark):
    docs = spark.createDataFrame([(1, "THE LICENSE"), (2, "sublicensed"), (3, "nothing here"), (4, None), (5, "")], "id long, t string")
    got = docs.where(licenses.holds_one(docs.t, ["license"])).select("id").collect()
    assert sorted(r.id for r in got) == [1, 2]


def test_whole_templates_are_found_between_other_text(spark):
    rows = [(k, f"some words before\n\n{t}\n\nsome words after") for k, (_, t) in enumerate(licenses.TEMPLATES)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), best=True).collect()
    names = {(r.doc_id, r.license) for r in found}
    assert {(k, name) for k, (name, _) in enumerate(licenses.TEMPLATES)} <= names
