"""License scans: Dice coefficient over word bigrams against templates (DataFrame only)."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, lower_ascii, text_of

#: Notices and short texts of common licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("proprietary", "All rights reserved."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)

THRESHOLD = 0.85


def words_of(text: Column) -> Column:
    """Normalised words: A-Z lower-cased, everything but a-z and 0-9 a gap."""
    clean = F.trim(F.regexp_replace(lower_ascii(text), "[^a-z0-9]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def bigrams_of(words: Column) -> Column:
    """The distinct word pairs; of one word or none, an empty array."""
    pair = lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))
    return F.when(
        F.size(words) > 1,
        F.array_distinct(F.slice(F.transform(words, pair), F.lit(1), F.size(words) - 1)),
    ).otherwise(F.array().cast("array<string>"))


def template_table(spark: SparkSession, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(size, template_id, license, grams): each template under every size that can reach
    the threshold: Dice >= t needs b * t / (2 - t) <= a <= b * (2 - t) / t."""
    rows = [
        F.struct(F.lit(i).alias("template_id"), F.lit(name).alias("license"), F.lit(text).alias("t"))
        for i, (name, text) in enumerate(templates)
    ]
    listed = (
        spark.range(1)
        .select(F.explode(F.array(*rows)).alias("x"))
        .select("x.template_id", "x.license", let(words_of(F.col("x.t")), bigrams_of).alias("grams"))
    )
    low = F.ceil(F.size("grams") * F.lit(threshold / (2 - threshold)) - 1e-9).cast("int")
    high = F.floor(F.size("grams") * F.lit((2 - threshold) / threshold) + 1e-9).cast("int")
    return listed.withColumn("size", F.explode(F.sequence(low, high)))


def size_limits(templates=TEMPLATES, threshold: float = THRESHOLD) -> int:
    """No unit with fewer words can match any template."""
    import re

    fewest = min(len(set(zip(w, w[1:]))) for _, t in templates for w in [re.findall("[a-z0-9]+", t.lower())])
    return math.ceil(fewest * threshold / (2 - threshold) - 1e-9) + 1


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every unit that matches a template holds one.

    A unit of a pairs that reaches the threshold t shares at least t * (a + b) / 2 of a
    template's b pairs, with a no less than b * t / (2 - t).  So it misses few enough of them
    that one is left among those that hold an anchor.  Long words come first, as they are rarer.
    """
    import re

    pairs = [{*zip(w, w[1:])} for _, t in templates for w in [re.findall("[a-z0-9]+", t.lower())]]
    shared = [math.ceil(threshold / 2 * (math.ceil(len(p) * threshold / (2 - threshold) - 1e-9) + len(p)) - 1e-9) for p in pairs]
    open_ = [len(p) - least + 1 for p, least in zip(pairs, shared)]
    chosen: list[str] = []
    while any(n > 0 for n in open_):
        held = Counter(w for p, n in zip(pairs, open_) if n > 0 for pair in p for w in set(pair))
        word = max(held, key=lambda w: (held[w] * (len(w) >= 7), held[w], w))
        chosen.append(word)
        for k, p in enumerate(pairs):
            hit = {pair for pair in p if word in pair}
            open_[k] -= len(hit)
            pairs[k] = p - hit
    return chosen


def holds_one(text: Column, words: list[str]) -> Column:
    """Whether a text holds one of the words, in either case, perhaps inside longer ones.

    Lower-casing all letters only adds to what A-Z alone would match.
    """
    listed = F.array(*[F.lit(w) for w in words])
    return let(F.lower(text), lambda low: F.exists(listed, lambda w: F.contains(low, w)))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    best: bool = False,
) -> DataFrame:
    """(doc_id, license, dice, n_units): the licenses that a document states.

    ``best`` keeps of each unit the licenses with its highest coefficient; the query, as its
    SQL says, keeps every license a unit reaches, so a GPL-2.0 notice also reaches GPL-3.0.

    Compared units are every line, every paragraph (between blank lines) and the whole text,
    equal ones of a document once.  A unit meets only the templates whose size is in reach,
    by an equality join on the number of bigrams; texts and units without a word of which every
    match holds one are left out before they are normalised.  The template side is the given list times
    its sizes, a few hundred rows however many documents there are.  dice: the best unit's
    coefficient; n_units: units at or above the threshold.

    Defined cases: null, empty and one-word texts match nothing; ties keep every license
    reached; repeated rows of one doc_id count as one document's units; a null doc_id is one
    more document; other columns are not read.
    """
    words = anchors(templates, threshold)
    text = text_of("text")
    units = F.array_distinct(
        F.concat(F.split(text, "\n"), F.split(text, "\\n[ \\t\\r]*\\n"), F.array(text))
    )
    few = size_limits(templates, threshold)
    lines = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .where(holds_one(F.col("text"), words))
        .select("doc_id", F.explode(F.filter(units, lambda unit: holds_one(unit, words))).alias("unit"))
        .withColumn("words", words_of(F.col("unit")))
        .where(F.size("words") >= few)
        .withColumn("grams", bigrams_of(F.col("words")))
        .select("doc_id", F.size("grams").alias("size"), F.col("grams").alias("own"), F.xxhash64("unit").alias("unit"))
    )
    known = template_table(docs.sparkSession, templates, threshold)
    both = F.size(F.array_intersect("own", "grams"))
    dice = 2.0 * both / (F.size("own") + F.size("grams"))
    reached = (
        lines.join(F.broadcast(known), "size")
        .withColumn("dice", dice)
        .where(F.col("dice") >= threshold)
        .groupBy("doc_id", "license", "unit")
        .agg(F.max("dice").alias("dice"))
    )
    if best:
        top = F.max("dice").over(Window.partitionBy("doc_id", "unit"))
        reached = reached.withColumn("top", top).where("dice = top").drop("top")
    return (
        reached.groupBy("doc_id", "license")
        .agg(F.max("dice").alias("dice"), F.count("*").alias("n_units"))
    )
