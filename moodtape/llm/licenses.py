"""Licence statements in documents, by the Dice coefficient over word bigrams.

A passage is a line, a paragraph (lines up to a blank one), a whole text or a window of words.  It is normalised (lower
case, anything but letters and digits one space) and compared with every licence template by 2 * common / (bigrams of both), counted
with repeats.  With a limit t, only templates with t / (2 - t) to (2 - t) / t times the passage's bigrams can reach
it, so passages whose size fits no template are dropped before any bigram is made, and a template meets a passage
only within these bounds.  The rest is one join of bigrams with the templates' bigrams, a table of fixed, small size.
At least t / (2 - t) of a template's bigrams stand in a passage that reaches the limit, so every such text has one of
a few words per template (``_anchors``); texts without any are dropped first, at no loss.

Windows find statements inside a line or paragraph and those that span several.  They run over the words of the whole
text, whatever its lines.  A bigram of a template adds one to all windows that hold it, less those that hold it as
often as the template already, so the common bigrams of all windows of one size are a running sum over the text.
All sizes within the bounds are tried for templates up to 47 bigrams, beyond that the template's own size and every
(size / 24)th one, so a window's score falls short of the best one's by a few hundredths at most.  A statement
is a window whose score no other reaches within half a template.  Statements that overlap each other count once; those
that overlap a line, paragraph or whole text that reaches the limit for the same licence count with that passage, and
those inside of it leave its score as it is.

Everything is DataFrame operations.  A passage that occurs in very many documents is counted for each on its own, in
rows spread by row and passage, so no group is larger than a passage's common bigrams.

Edge cases.  A null, empty or wordless text matches nothing and has no row.  One-word passages have no bigram and
match nothing.  Where line, paragraph and text coincide they count once.  Repeated rows are counted each, then summed
under their doc_id; rows with a null doc_id are summed together.  Ties can't arise: every template reached is
returned.  An empty table gives an empty result.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtape.llm.common import staged, whole_text

LIMIT = 0.8

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
    "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
    "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is "
    "furnished to do so"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software."
)
_EPL = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
    "available at https://www.eclipse.org/legal/epl-2.0/"
)
# Licences named by a tag in source files; what a tag says of later versions makes no other licence.
_TAGGED = (
    "0BSD AGPL-3.0 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 EPL-2.0 GPL-2.0 GPL-3.0 "
    "ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense WTFPL Zlib"
).split()

# Public licence texts, notices and usual short statements.
TEMPLATES = [
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("ISC", _ISC),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", _GPL.format("2")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", _GPL.format("3")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", _MPL),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSL-1.0", _BOOST),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", _ZLIB),
    ("EPL-2.0", _EPL),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-2.0", "Licensed under GPLv2"),
    ("GPL-3.0", "Licensed under GPLv3"),
    *((name, f"License-Identifier: {name}") for name in _TAGGED),
]

#: Words of the templates that many texts hold; texts are told by others first.
COMMON_WORDS = frozenset(
    "a all and any as at be by can copy do for free from following general have if in is it law like may not of on or other "
    "notice obtain obtained obtaining people person project public purpose same shall terms that the this to under use used "
    "version with without work you your 0 1 2 3 4".split()
)


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _pairs(words: str) -> Column:
    places = F.sequence(F.lit(0), F.size(words) - 2)
    return F.transform(places, lambda i: F.concat_ws(" ", F.col(words)[i], F.col(words)[i + 1]))


def _bigrams(words: str) -> Column:
    return F.explode(_pairs(words))


def _templates(docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """template, license, t_size, bigram, t_times: the templates' bigrams."""
    rows = [(k, name, text) for k, (name, text) in enumerate(templates)]
    table = docs.sparkSession.createDataFrame(rows, "template int, license string, text string")
    table = table.withColumn("words", _words(F.col("text")))
    table = table.select("template", "license", (F.size("words") - 1).alias("t_size"), _bigrams("words").alias("bigram"))
    return table.groupBy("template", "license", "t_size", "bigram").agg(F.count("*").alias("t_times"))


def _anchors(known: list, low: float) -> list[str]:
    """Words of which each text that reaches a template has at least one: most telling (longest) words first.

    A passage that reaches the limit lacks at most 1 - ``low`` of the template's bigrams.  The chosen words stand in
    more of them than that, so not all bigrams with such a word can be lacking.
    """
    out: set[str] = set()
    for template in sorted({r["template"] for r in known}):
        own = [(set(r["bigram"].split(" ")), r["t_times"]) for r in known if r["template"] == template]
        size = sum(n for _, n in own)
        lacking = size - math.ceil(low * size - 1e-9)
        chosen: set[str] = set()
        for word in sorted({w for pair, _ in own for w in pair}, key=lambda w: (w in COMMON_WORDS, -len(w), w)):
            if sum(n for pair, n in own if pair & chosen) > lacking:
                break
            chosen.add(word)
        out |= chosen
    return sorted(out)


def _parts() -> Column:
    """The different lines, paragraphs and whole text of a text."""
    return F.array_distinct(F.flatten(F.array(*_cuts())))


def _cuts() -> list[Column]:
    return [F.split("text", "\n"), F.split("text", r"\n[ \t\r]*\n\s*"), F.array("text")]


def _passages(held: DataFrame) -> DataFrame:
    """row, doc_id, place, words of the parts of each row."""
    # Words are made inside the generator: a filter on them would otherwise be pushed below and split the text again.
    return held.select("row", "doc_id", F.posexplode(F.transform(_parts(), _words)).alias("place", "words"))


def _spans(held: DataFrame, best: DataFrame) -> DataFrame:
    """row, doc_id, license, first, last: the words of the whole text that a passage that reaches the limit takes up."""
    held = held.join(best.select("row").distinct(), "row", "left_semi")
    found = held.select("row", F.posexplode(_parts()).alias("place", "piece")).join(best, ["row", "place"])
    cuts = held.select("row", F.posexplode(F.array(*_cuts())).alias("cut", "pieces"))
    pieces = cuts.select("row", "cut", F.posexplode("pieces").alias("nth", "piece")).withColumn("n", F.size(_words(F.col("piece"))))
    last = F.sum("n").over(Window.partitionBy("row", "cut").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)) - 1
    pieces = pieces.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)
    return found.join(pieces, ["row", "piece"]).select("row", "doc_id", "license", "first", "last")


def _windows(held: DataFrame, known: DataFrame, times: list[int], limit: float) -> DataFrame:
    """row, doc_id, license, first, last, score: windows of words that reach the limit, the best around each place."""
    low, high = limit / (2 - limit), (2 - limit) / limit
    unit = 1000  # places are counted in thousandths of a template where a range of them depends on the template

    def around(column: str, least: int, most: int):
        order = F.floor(F.col(column) * unit / F.col("t_size")).cast("long")
        return Window.partitionBy("row", "template").orderBy(order).rangeBetween(least, most)

    worded = held.select("row", "doc_id", F.explode(F.array(_words(F.col("text")))).alias("words")).where(F.size("words") > 1)
    hits = worded.select("row", "doc_id", F.posexplode(_pairs("words")).alias("pos", "bigram")).join(known, "bigram")
    reach = int(high * unit) + 2
    hits = hits.withColumn("near", F.count("*").over(around("pos", -reach, reach))).where(F.col("near") >= F.col("t_size") * low - 1e-9)
    same = Window.partitionBy("row", "template", "bigram").orderBy("pos")
    full = F.lit(None).cast("int")
    for n in times:
        full = F.when(F.col("t_times") == n, F.lag("pos", n).over(same)).otherwise(full)
    t = F.col("t_size")
    step = F.greatest(F.lit(1), F.floor(t / 24).cast("int"))
    least, most = F.greatest(F.lit(1), F.ceil(t * low - 1e-9).cast("int")), F.floor(t * high + 1e-9).cast("int")
    sized = hits.withColumn("full", full).withColumn("size", F.explode(F.array_union(F.sequence(least, most, step), F.array(t))))
    begin = F.greatest(F.lit(0), F.col("pos") - F.col("size") + 1, F.col("full") + 1)
    change = F.explode(F.array(F.struct(begin.alias("first"), F.lit(1).alias("n")), F.struct((F.col("pos") + 1).alias("first"), F.lit(-1).alias("n"))))
    group = ["row", "doc_id", "template", "license", "t_size", "size"]
    events = sized.select(*group, change.alias("change")).groupBy(*group, "change.first").agg(F.sum("change.n").alias("n"))
    common = F.sum("n").over(Window.partitionBy("row", "template", "size").orderBy("first").rowsBetween(Window.unboundedPreceding, 0))
    scored = events.withColumn("score", 2.0 * common / (F.col("size") + t)).where(F.col("score") >= limit)
    top = scored.withColumn("top", F.max("score").over(around("first", -unit // 2, unit // 2))).where(F.col("score") == F.col("top"))
    return top.select("row", "doc_id", "license", "first", (F.col("first") + F.col("size") - 1).alias("last"), "score")


def _statements(windows: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, license, score, n of each run of overlapping windows; n is 0 where the run meets one of the spans.

    A window inside a span is that passage and does not change its score.
    """
    every = windows.withColumn("known", F.lit(False)).unionByName(spans.withColumn("known", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy("row", "license").orderBy("first", F.desc("known"), "last")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce((F.col("first") > F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    covered = F.coalesce(F.max(F.when(F.col("known"), F.col("last"))).over(so_far) >= F.col("last"), F.lit(False))
    runs = every.withColumn("starts", starts).withColumn("covered", covered).withColumn("run", F.sum("starts").over(so_far))
    score, known = F.max(F.when(~F.col("covered"), F.col("score"))), F.max("known")
    runs = runs.groupBy("row", "doc_id", "license", "run").agg(score.alias("score"), F.when(known, 0).otherwise(1).alias("n"))
    return runs.where(F.col("score").isNotNull()).select("doc_id", "license", "score", "n")


def _ranges(sizes: list[int], low: float, high: float) -> list[tuple[float, float]]:
    """The passage sizes that fit any template, as few ranges."""
    out: list[tuple[float, float]] = []
    for size in sorted(sizes):
        least, most = size * low - 1e-9, size * high + 1e-9
        if out and least <= out[-1][1] + 1:
            out[-1] = (out[-1][0], most)
        else:
            out.append((least, most))
    return out


def find_licenses(docs: DataFrame, limit: float = LIMIT, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, license, score (the best Dice coefficient), n_passages (different passages that reach the limit)."""
    templates = templates or TEMPLATES
    known = staged(_templates(docs, templates), "license-bigrams")  # as a file its small size is known, and it is broadcast
    low, high = limit / (2 - limit), (2 - limit) / limit
    own = known.collect()
    anchors = F.array(*[F.lit(w) for w in _anchors(own, low)]).cast("array<string>")
    text = whole_text()
    held = docs.where(F.arrays_overlap(_words(text), anchors)).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"), text.alias("text"))
    held = staged(held, "license-texts")
    size = F.size("words") - 1
    fits = F.lit(False)
    for least, most in _ranges(sorted({r["t_size"] for r in own}), low, high):
        fits = fits | size.between(least, most)
    passages = _passages(held).where(fits)
    pairs = passages.select("row", "doc_id", "place", size.alias("size"), _bigrams("words").alias("bigram"))
    met = pairs.join(known, "bigram").where((F.col("size") >= F.col("t_size") * low - 1e-9) & (F.col("size") <= F.col("t_size") * high + 1e-9))
    passage = ["row", "doc_id", "place", "size", "template", "license", "t_size"]
    common = met.groupBy(*passage, "bigram", "t_times").agg(F.count("*").alias("times"))
    common = common.groupBy(*passage).agg(F.sum(F.least("times", "t_times")).alias("common"))
    dice = (2.0 * F.col("common")) / (F.col("size") + F.col("t_size"))
    best = common.withColumn("score", dice).where(F.col("score") >= limit)
    best = best.groupBy("row", "doc_id", "place", "license").agg(F.max("score").alias("score"))
    best = staged(best, "license-passages")
    windows = _windows(held, known, sorted({r["t_times"] for r in own}), limit)
    spans = _spans(held, best.drop("score"))
    best = best.select("doc_id", "license", "score", F.lit(1).alias("n")).unionByName(_statements(windows, spans))
    return best.groupBy("doc_id", "license").agg(F.max("score").alias("score"), F.sum("n").alias("n_passages"))
