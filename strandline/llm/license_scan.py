"""License scans: a trained paragraph classifier whose predictions templates confirm.

A paragraph is a line with a word, or several such lines in a row that are found
to be of one licence (licence texts are often wrapped; of these the lines that only
have phrases of several licences aren't counted). A sparse word 1- and
2-gram logistic regression (softmax over the licence families and `unknown`) is
trained on passages of the templates and on sentences that are no licence; its
temperature and the threshold, below which a prediction is `unknown`, are
calibrated on passages that it wasn't trained on. A predicted family is confirmed
by comparing the line with the family's templates: MIN_SHARE of its 3-word
shingles must be theirs (a line of fewer words is one shingle), and one of these
at least must be distinctive, that is in no other family's templates.

The templates are main paragraphs of the public licence texts, and references
("Licensed under the ...", SPDX identifiers) made by rule from the families' names.

Everything on the main path is DataFrame operations. Every distinctive shingle has
a seed, its longest word that isn't a common one; lines without any seed are left
out by one look at their words, in the scan, and the others are stored once, with
their numbers. Seeds, shingles and weights are this module's own tables of fixed,
small size and are therefore broadcast.

Edge cases: null and empty texts have no paragraph and no licence; equal
paragraphs each count; rows that share a doc_id are each reported with what all
rows of that doc_id have; documents without a licence have family null and 0
paragraphs; of families with equally many paragraphs, or equal probabilities, the
first by name is given; texts are read whole, whatever their length; a null doc_id
never matches a licence; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import json
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.store import stored

#: By family its names, SPDX identifiers and main paragraphs of its public text.
FAMILIES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "mit": (["MIT License", "MIT/Expat license", "Expat License"], ["MIT"], [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ]),
    "isc": (["ISC License"], ["ISC"], [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ]),
    "bsd": (["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "New BSD License", "Simplified BSD License"], ["BSD-2-Clause", "BSD-3-Clause"], [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ]),
    "apache": (["Apache License", "Apache License, Version 2.0", "Apache 2.0 License"], ["Apache-2.0"], [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ]),
    "gpl": (["GNU General Public License", "GNU General Public License, version 2", "GNU General Public License, version 3", "GNU GPL", "GPL", "GPL v2", "GPL v3", "GPLv2", "GPLv3"], ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"], [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ]),
    "lgpl": (["GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1", "GNU Library General Public License", "LGPL", "LGPL 2.1", "LGPL v3", "LGPLv3"], ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only"], [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation.",
    ]),
    "agpl": (["GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL", "AGPL v3", "AGPLv3"], ["AGPL-3.0-only", "AGPL-3.0-or-later"], [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ]),
    "mpl": (["Mozilla Public License", "Mozilla Public License, Version 2.0", "MPL 2.0"], ["MPL-2.0"], [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ]),
    "epl": (["Eclipse Public License", "Eclipse Public License, Version 2.0", "EPL 2.0"], ["EPL-1.0", "EPL-2.0"], [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE. ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ]),
    "unlicense": (["Unlicense", "The Unlicense"], ["Unlicense"], [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
        "For more information, please refer to https://unlicense.org",
    ]),
    "cc0": (["CC0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0 1.0 Universal Public Domain Dedication"], ["CC0-1.0"], [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.",
    ]),
    "cc": (["Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC 4.0", "CC BY-ND 4.0", "CC BY-NC-SA 4.0"], ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"], [
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
        "By exercising the Licensed Rights, You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License.",
    ]),
    "boost": (["Boost Software License", "Boost Software License, Version 1.0"], ["BSL-1.0"], [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    ]),
    "zlib": (["zlib License", "zlib/libpng License"], ["Zlib"], [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ]),
    "busl": (["Business Source License", "Business Source License 1.1"], ["BUSL-1.1"], [
        "The Licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use of the Licensed Work. The Licensor may make an Additional Use Grant, above, permitting limited production use.",
        "Effective on the Change Date, or the fourth anniversary of the first publicly available distribution of a specific version of the Licensed Work under this License, whichever comes first, the Licensor hereby grants you rights under the terms of the Change License.",
    ]),
}
#: How texts refer to a licence by its name.
REFERENCES = [
    "{}", "The {}", "License: {}", "Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.", "Published under the {}.", "Available under the {}.",
    "This project is licensed under the terms of the {}.", "This project is licensed under the {} - see the LICENSE file for details.", "This project uses the {}.", "This work is licensed under a {}.", "This work is licensed under the {}.",
    "This software is released under the {}.", "This program is distributed under the terms of the {}.", "See the {} for more details.", "The code is made available under the {}.", "You may use it under the {}.",
]
#: Sentences that are no licence, many of which use its words.
NEUTRAL = [
    "The driver must carry a valid license at all times and show it to any officer who asks.",
    "She lost her fishing license in the river and had to ask the office for another copy.",
    "The committee will publish the conditions of sale next week, without further notice.",
    "Software for this printer can be found on the disc in the box, with a warranty card.",
    "The general public was invited to the opening of the new library on Monday.",
    "Apache helicopters were seen over the valley in the early morning.",
    "He studied at MIT and then moved to a small town to work as a public school teacher.",
    "Free coffee is served to any person who buys a ticket for the evening.",
    "Under the bridge the water was cold, and nobody wanted to swim.",
    "All rights of way across the field are marked on the map of the region.",
    "The foundation will distribute copies of the report to its members, version two in May.",
    "Creative people often work at night; commons and parks are their favourite places.",
    "Permission to land was given after a long delay, and the crew was tired.",
    "The new version of the play is shorter, and the second act is much better.",
    "The shop was licensed to sell wine under the terms of a law from the last century.",
    "Mozilla and other companies sent speakers to the conference.",
    "The agreement covers all works, and the parties are not liable for any damages or loss of profits.",
    "All rights reserved by the publisher; no part of this book may be copied without written permission.",
    "By using this website you agree to the terms of use and to our privacy policy.",
    "The museum grants free admission to any person under eighteen, subject to the following hours:",
    "The warranty covers parts and labour for two years and is limited to the original buyer.",
    "Members may use the hall for any purpose, provided that the floor is swept and the lights are out.",
    "The source of the river is in the hills, and its conditions change with the season.",
    "The public library has a general collection and a version of the old map.",
    "An eclipse of the moon could be seen by the public from the bridge.",
    "The boost to trade was small, and the software firm closed its second office.",
    "Business was slow, and the source of the rumour was never found.",
    "The university gave the free software course again, and fifty students came.",
    "The commons were open to all, and creative work was done there in summer.",
    "He was granted a copy of the report, free of charge, by the clerk.",
    "A driving licence is required by law; see the notice at the door for details.",
    "The affair is subject to the law of the country where the contract was signed.",
]
UNKNOWN = "unknown"
SEED_LETTERS = 3
#: Words of that length that are never seeds: they are in texts of any kind.
COMMON = frozenset("the and for any are may not can you its was see but all that this with will from have been were your other which work free under such more use out available see terms project".split())
MIN_SHARE = 0.5
WORD = r"[^0-9a-z]+"
EPOCHS, RATE, PENALTY = 150, 20.0, 1e-4


def tokens(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w and not w.isdigit()]


def grams(words: list[str]) -> list[str]:
    return sorted({*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))})


def shingles(words: list[str]) -> list[str]:
    """The distinct runs of three words; fewer words are one."""
    return sorted({" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}) if words else []


def templates(family: str) -> list[str]:
    names, spdx, paragraphs = FAMILIES[family]
    return [*paragraphs, *(r.format(name) for name in names for r in REFERENCES), *(f"SPDX-License-Identifier: {i}" for i in spdx)]


def _seed(shingle: str) -> str | None:
    words = [w for w in shingle.split() if len(w) >= SEED_LETTERS and w not in COMMON]
    return max(words, key=lambda w: (len(w), w)) if words else None


class Templates:
    """The families' shingles; distinctive are those of one family only that have a seed."""

    def __init__(self):
        self.of = {f: {s for t in templates(f) for s in shingles(tokens(t))} for f in FAMILIES}
        in_families = Counter(s for own in self.of.values() for s in own)
        self.distinctive = {s for s, n in in_families.items() if n == 1 and _seed(s)}
        self.seeds = sorted({_seed(s) for s in self.distinctive})


def _passages(seed: int = 5) -> list[tuple[list[str], str]]:
    """Templates and neutral sentences, whole and in pieces, some with neutral words around them."""
    rng, out = random.Random(seed), []
    sentences = [tokens(s) for s in NEUTRAL]
    filler = [w for s in sentences for w in s]
    for family in FAMILIES:
        for text in templates(family):
            words = tokens(text)
            out.append((words, family))
            for _ in range(8 if len(words) > 12 else 0):
                at = rng.randrange(len(words) - 6)
                out.append((words[at : at + rng.randint(6, 20)], family))
            if rng.random() < 0.3:
                some = rng.sample(filler, rng.randint(1, 5))
                out.append((some + words, family) if rng.random() < 0.5 else (words + some, family))
    for words in sentences:
        out += [(words, UNKNOWN)] * 4
        for _ in range(8):
            at = rng.randrange(max(1, len(words) - 5))
            out.append((words[at : at + rng.randint(3, 12)], UNKNOWN))
    out += [(rng.sample(filler, rng.randint(2, 25)), UNKNOWN) for _ in range(500)]
    rng.shuffle(out)
    return out


class Classifier:
    """Weights by n-gram and family, with temperature and threshold."""

    def __init__(self):
        self.families = [*sorted(FAMILIES), UNKNOWN]
        self.weights: dict[str, np.ndarray] = {}
        self.bias, self.temperature, self.threshold = np.zeros(len(self.families)), 1.0, 0.5

    def scores(self, words: list[str]) -> np.ndarray:
        """Null scores where no n-gram is known."""
        found = [self.weights[g] for g in grams(words) if g in self.weights]
        return self.bias + sum(found, np.zeros(len(self.families))) / np.sqrt(max(1, len(found)))

    def probabilities(self, words: list[str], temperature: float | None = None) -> np.ndarray:
        return _softmax(self.scores(words)[None] / (temperature or self.temperature))[0]

    def fit(self, passages: list[tuple[list[str], str]]) -> Classifier:
        """Gradient descent over all passages at once; every family weighs the same. Every fifth passage is for the calibration."""
        held, train = passages[::5], [p for i, p in enumerate(passages) if i % 5]
        number = {g: i for i, g in enumerate(sorted({g for words, _ in train for g in grams(words)}))}
        found = [np.array([number[g] for g in grams(words)], int) for words, _ in train]
        row = np.repeat(np.arange(len(train)), [len(f) for f in found])
        cell, share = np.concatenate(found), np.concatenate([np.full(len(f), 1 / np.sqrt(max(1, len(f)))) for f in found])
        y = np.array([self.families.index(f) for _, f in train])
        even = 1 / np.bincount(y, minlength=len(self.families))[y] / len(self.families)
        weights = np.zeros((len(number), len(self.families)))
        for _ in range(EPOCHS):
            score = np.stack([np.bincount(row, weights[cell, k] * share, len(train)) for k in range(len(self.families))], axis=1) + self.bias
            err = _softmax(score)
            err[np.arange(len(y)), y] -= 1
            err *= even[:, None]
            weights *= 1 - RATE * PENALTY
            for k in range(len(self.families)):
                weights[:, k] -= RATE * np.bincount(cell, err[row, k] * share, len(number))
            self.bias -= err.sum(axis=0)
        self.weights = {g: w for g, w in zip(sorted(number), weights.round(6), strict=True)}
        self.bias = self.bias.round(6)
        loss = lambda t: -sum(np.log(self.probabilities(w, t)[self.families.index(f)] + 1e-12) for w, f in held)
        self.temperature = float(min((0.2 * 1.25**k for k in range(16)), key=loss))
        others = sorted(self.probabilities(w)[:-1].max() for w, f in held if f == UNKNOWN)
        self.threshold = float(min(0.9, max(0.4, others[int(0.99 * (len(others) - 1))])))  # 1 in 100 neutral passages passes at most
        return self


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_trained: list[Classifier] = []


def classifier() -> Classifier:
    if not _trained:
        _trained.append(Classifier().fit(_passages()))
    return _trained[0]


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), WORD), lambda w: (w != "") & ~w.rlike("^[0-9]+$"))


def _runs(words: Column, n: int) -> Column:
    """The distinct runs of n words; fewer words are one."""
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    return F.array_distinct(F.transform(places, lambda s: F.array_join(F.slice(words, s, n), " ")))


def _local(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of this module's own, written once and marked for broadcast."""
    made = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")
    return F.broadcast(stored(made, "license-table"))


def paragraphs(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """doc_id, row, line (number), paragraph, family, probability, share of each line that is confirmed as a licence."""
    spark, model, known = docs.sparkSession, model or classifier(), Templates()
    marks = _local(spark, [{"shingle": s, "family": f, "own": s in known.distinctive} for f, own in known.of.items() for s in sorted(own)], "shingle:string,family:string,own:boolean")
    weights = _local(spark, [{"gram": g, "w": w.tolist()} for g, w in sorted(model.weights.items())], "gram:string,w:array<double>")

    lines = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    seeded = lines.withColumn("w", F.split(F.lower("paragraph"), WORD)).where(F.arrays_overlap("w", F.lit(known.seeds)))
    seeded = stored(seeded.withColumn("w", _words(F.col("paragraph"))), "license-lines")

    # the templates' part: shingles of each family
    shingled = seeded.select("row", "line", F.explode(_runs(F.col("w"), 3)).alias("shingle"))
    total = seeded.select("row", "line", "doc_id", "paragraph", F.size(_runs(F.col("w"), 3)).alias("shingles"))
    share = shingled.join(marks, "shingle").groupBy("row", "line", "family").agg(F.count("*").alias("met"), F.bool_or("own").alias("own")).where("own")

    # the classifier's part, for the lines that any family can be confirmed for
    likely = stored(share, "license-shares")
    found = seeded.join(likely.select("row", "line").distinct(), ["row", "line"], "left_semi")
    found = found.select("row", "line", F.explode(F.array_distinct(F.concat("w", F.when(F.size("w") > 1, _runs(F.col("w"), 2)).otherwise(F.array().cast("array<string>"))))).alias("gram")).join(weights, "gram")
    k = range(len(model.families))
    sums = found.groupBy("row", "line").agg(F.count("*").alias("n"), *[F.sum(F.col("w")[i]).alias(f"s{i}") for i in k])
    score = [(F.lit(float(model.bias[i])) + F.col(f"s{i}") / F.sqrt("n")) / model.temperature for i in k]
    scored = sums.select("row", "line", F.array(*score).alias("s")).withColumn("top", F.array_max("s"))
    e = F.transform("s", lambda x: F.exp(x - F.col("top")))
    p = scored.select("row", "line", (F.lit(1.0) / F.aggregate(e, F.lit(0.0), lambda a, x: a + x)).alias("probability"), F.element_at(F.lit(model.families), F.array_position("s", F.col("top")).cast("int")).alias("family"))
    guess = p.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))

    both = guess.join(likely, ["row", "line", "family"]).join(total, ["row", "line"]).withColumn("share", F.col("met") / F.col("shingles"))
    return both.where(F.col("share") >= MIN_SHARE).select("doc_id", "row", "line", "paragraph", "family", "probability", "share")


def _starts(lines: Column) -> Column:
    """How many of the line numbers don't follow another one."""
    zero = F.struct(F.lit(-2).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(x.alias("last"), (acc["n"] + (x != acc["last"] + 1).cast("long")).alias("n"))
    return F.aggregate(F.array_sort(lines), zero, step, lambda acc: acc["n"])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs (confirmed), families (sorted, comma-joined) and family (of most paragraphs; null without)."""
    found = paragraphs(docs).where("doc_id IS NOT NULL").groupBy("doc_id", "row", "family").agg(_starts(F.collect_set("line")).alias("n"))
    by = found.groupBy("doc_id", "family").agg(F.sum("n").alias("n")).groupBy("doc_id")
    per = by.agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.min_by("family", F.struct(-F.col("n"), F.col("family"))).alias("family"))
    return docs.select("doc_id").join(per, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families"), "family")
