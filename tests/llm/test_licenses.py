"""Licenses of one family: the stated one scores highest."""

from __future__ import annotations

import pytest

from slotcast.llm import licenses

GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} "
    "License as published by the Free Software Foundation; either version {} of the License, or (at your option) "
    "any later version."
)
MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
STATED = {
    "GPL-2.0": GNU.format("General Public", "2"),
    "GPL-3.0": GNU.format("General Public", "3"),
    "LGPL-3.0": GNU.format("Lesser General Public", "3"),
    "LGPL-2.1": GNU.format("Lesser General Public", "2.1").replace("program", "library"),
    "AGPL-3.0": GNU.format("Affero General Public", "3"),
    "MPL-2.0": MPL,
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(STATED.values())), "doc_id long, text string").persist()


def test_the_stated_license_scores_highest(docs):
    rows = licenses.scan_licenses(docs).collect()
    for k, name in enumerate(STATED):
        own = {r["license"]: r["dice"] for r in rows if r["doc_id"] == k}
        assert max(own, key=own.get) == name, (name, own)


def test_best_keeps_one_license_and_ties(spark, docs):
    rows = licenses.scan_licenses(docs, best=True).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == list(enumerate(STATED))
    bsd = [(0, next(t for n, t in licenses.TEMPLATES if n == "BSD-2-Clause"))]
    tied = licenses.scan_licenses(spark.createDataFrame(bsd, "doc_id long, text string"), best=True)
    assert sorted(r["license"] for r in tied.collect()) == ["BSD-2-Clause", "BSD-3-Clause"]
