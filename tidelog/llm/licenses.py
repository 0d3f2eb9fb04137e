"""Licence scan: passages and word windows compared with templates by the Dice coefficient over word bigrams. Expressions only."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.documents import once
from tidelog.llm.common import Scratch

LEAST = 0.8
# Necessary words up to this length are looked for as words of their own, as short ones stand inside many others.
SHORT = 4
# Words of most English texts, which tell little; other necessary words are taken before them.
FREQUENT = frozenset("a and any as at be by for from in is it may not of on or that the this to with you".split())

# Notices and whole short licences by name; fixed public wording.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "MIT notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "All rights reserved": "All rights reserved.",
}

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {} THIS
SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Further common texts. They are apart because TEMPLATES is what the SQL of the query holds.
COMMON = {
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format("""3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""),
    "GPL-2.0 header": TEMPLATES["GPL-3.0 header"].replace("version 3", "version 2"),
    "LGPL-3.0 header": TEMPLATES["GPL-3.0 header"].replace("General Public", "Lesser General Public"),
    "AGPL-3.0 header": TEMPLATES["GPL-3.0 header"].replace("General Public", "Affero General Public"),
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may
not be removed or altered from any source distribution.""",
}


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalised(text: Column) -> Column:
    """The words of a text: A-Z in lower case, runs of anything but letters and digits are one separator."""
    return F.filter(F.split(lowered(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))


def template_bigrams(text: str) -> list[str]:
    """As ``bigrams`` of ``normalised``, for a template."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def sizes(n: int, least: float) -> range:
    """Sizes of bigram sets that can reach ``least`` with a set of ``n``: 2 min / (n + other) >= least."""
    return range(math.ceil(n * least / (2 - least) - 1e-9), math.floor(n * (2 - least) / least + 1e-9) + 1)


def anchors(templates: dict[str, str], least: float) -> list[str]:
    """Words of which every matching passage contains at least one.

    At Dice ``least`` a passage shares least / (2 - least) of the template's bigrams or more. Words
    that stand in more than the rest of the bigrams cannot all be missing; long words are taken
    first, as they are rare in other texts, and frequent words last.
    """
    chosen: set[str] = set()
    for text in templates.values():
        grams = template_bigrams(text)
        spare = len(grams) * (1 - least / (2 - least))
        mine: set[str] = set()
        for word in sorted({w for g in grams for w in g.split(" ")}, key=lambda w: (w not in chosen, w in FREQUENT, -len(w), w)):
            if sum(not mine.isdisjoint(g.split(" ")) for g in grams) > spare + 1e-9:
                break
            mine.add(word)
        chosen |= mine
    return sorted(w for w in chosen if not any(other != w and len(other) > SHORT and other in w for other in chosen))


def passages(docs: DataFrame, holding: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, place, words) of passages that are ``holding``: every line, every run of lines without an empty one, and the whole text; what is the same comes once."""
    lines = F.split("text", "\n")
    blocks = F.split("text", r"\n[\x20\t\r]*\n")
    parts = F.array_distinct(F.concat(lines, blocks, F.array("text")))
    whole = docs.where("text IS NOT NULL").where(holding(F.col("text")))
    return whole.select("doc_id", F.posexplode(parts).alias("place", "passage")).where(holding(F.col("passage"))).select(
        "doc_id", "place", normalised(F.col("passage")).alias("words"))


def _held(text: Column, templates: dict[str, str], least: float) -> Column:
    """Whether a text has any of the necessary words: long ones anywhere, short ones as words of their own."""
    words = anchors(templates, least)
    short = "|".join(w for w in words if len(w) <= SHORT)

    def has(t: Column) -> Column:
        found = reduce(or_, [F.contains(t, F.lit(w)) for w in words if len(w) > SHORT], F.lit(False))
        return found | F.rlike(t, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{short})(?![\p{{L}}\p{{N}}])")) if short else found

    return once(F.lower(text), has)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, licence, dice, n_passages): licences with a passage of the document at Dice ``least`` or more.

    dice is the best of n_passages such passages. ``docs`` needs doc_id and text; other columns are
    ignored. Null, empty and unlicensed texts give no row; rows that repeat a doc_id count together,
    null doc_ids too. Passages of other sizes than a template allows never meet it: templates are
    joined by the sizes they allow, a table whose size is fixed by the templates.
    """
    spark = docs.sparkSession
    rows = [(name, grams, size) for name, text in sorted(templates.items()) if (grams := template_bigrams(text)) for size in sizes(len(grams), least)]
    schema = T.StructType([T.StructField("licence", T.StringType()), T.StructField("grams", T.ArrayType(T.StringType())), T.StructField("n", T.IntegerType())])
    allowed = F.broadcast(spark.createDataFrame(rows, schema))
    fits = sorted({size for *_, size in rows})
    if not fits:
        return spark.createDataFrame([], "doc_id long, licence string, dice double, n_passages long")

    # A passage has at least as many pairs as other words than one, and fewer than words: what can have no fitting size goes here.
    words = F.size(F.array_distinct("words"))
    parts = passages(docs, lambda text: _held(text, templates, least)).where((F.size("words") > min(fits)) & (words <= max(fits) + 1))
    parts = parts.select("doc_id", bigrams(F.col("words")).alias("pairs")).withColumn("n", F.size("pairs"))
    met = parts.join(allowed, "n").withColumn(
        "dice", 2.0 * F.size(F.array_intersect("pairs", "grams")) / (F.col("n") + F.size("grams"))).where(F.col("dice") >= least)
    return met.groupBy("doc_id", "licence").agg(F.max("dice").alias("dice"), F.count("*").alias("n_passages"))


def windows(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, licence, dice, n_windows): licences with a run of words, anywhere in the text, at Dice ``least`` or more.

    dice is the best of all runs of whole words, across lines and empty lines; n_windows counts
    runs that do not overlap. No run is left out. The best begins and ends with a pair of the template
    that it holds once, as anything else can be taken off its ends; so each place of such a pair
    begins one reach, up to the next place of the pair. The reach ends earlier where the text has
    brought more new pairs that are not the template's than a match can have: Dice ``least`` allows
    (2 - least) / least - 1 of the template's number. Reaches with too few pairs of the template are not walked.
    """
    spark = docs.sparkSession
    rows = [(name, grams) for name, text in sorted(templates.items()) if (grams := template_bigrams(text))]
    if not rows:
        return spark.createDataFrame([], "doc_id long, licence string, dice double, n_windows long")
    known = F.broadcast(spark.createDataFrame(rows, "licence string, grams array<string>"))
    t = F.size("grams")
    need = F.ceil(t * (least / (2 - least)) - 1e-9).cast("int")
    other = F.floor(t * ((2 - least) / least - 1) + 1e-9).cast("int")
    held = docs.where("text IS NOT NULL").where(_held(F.col("text"), templates, least))
    words = held.select("doc_id", normalised(F.col("text")).alias("words"))
    words = words.where(F.size("words") > 1)
    n = F.size("words") - 1
    pairs = words.select("doc_id", F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)).alias("pairs"))
    pairs = pairs.withColumn("n", F.size("pairs")).withColumn("kinds", F.array_distinct("pairs"))
    met = pairs.crossJoin(known).withColumn("mine", F.array_intersect("kinds", "grams")).where(F.size("mine") >= need)

    def placed(by_pair: Column) -> Column:
        """Every pair in order of place, with where it stood before and stands again: its neighbours in the order of (pair, place)."""
        def entry(x: Column, k: Column) -> Column:
            before, after = F.get(by_pair, k - 1), F.get(by_pair, k + 1)
            return F.struct(x["i"].alias("i"), F.when(before["p"] == x["p"], before["i"]).otherwise(-1).alias("prev"),
                            F.when(after["p"] == x["p"], after["i"]).otherwise(F.col("n")).alias("next"), F.array_contains("mine", x["p"]).alias("hit"))

        return F.sort_array(F.transform(by_pair, entry))

    def reaches(marks: Column) -> Column:
        # A hit's number among hits and first places of other pairs less its number among hits is how many others come before.
        numbered = F.transform(marks, lambda x, u: F.struct(x["i"].alias("i"), x["next"].alias("next"), x["hit"].alias("hit"), u.alias("u")))

        def split(m: Column) -> Column:
            return once(F.struct(F.filter(m, lambda x: x["hit"]).alias("hits"), F.filter(m, lambda x: ~x["hit"]).alias("others")), measured)

        def measured(b: Column) -> Column:
            def reach(x: Column, k: Column) -> Column:
                at = x["u"] - k + other
                stop = F.get(b["others"], at)
                return F.struct(x["i"].alias("i"), F.least(x["next"], F.coalesce(stop["i"], F.col("n"))).alias("end"),
                                (F.coalesce(stop["u"] - at, F.size(b["hits"])) - k).alias("most"))

            return F.filter(F.transform(b["hits"], reach), lambda x: x["most"] >= need)

        return once(numbered, split)

    def best(s: Column, places: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            fresh = x["prev"] < s["i"]
            n = acc["n"] + fresh.cast("int")
            h = acc["h"] + (fresh & x["hit"]).cast("int")
            dice = F.lit(2.0) * h / (n + t)
            better = dice > acc["dice"]
            return F.struct(n.alias("n"), h.alias("h"), F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
                            F.when(better, x["i"]).otherwise(acc["end"]).alias("end"))

        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("h"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end"))
        return F.aggregate(F.slice(places, s["i"] + 1, s["end"] - s["i"]), zero, step,
                           lambda a: F.struct(s["i"].alias("i"), a["end"].alias("end"), a["dice"].alias("dice")))

    def runs(places: Column) -> Column:
        starts = reaches(F.filter(places, lambda x: x["hit"] | (x["prev"] < 0)))
        return F.filter(F.transform(starts, lambda s: best(s, places)), lambda x: x["dice"] >= least)

    def count(acc: Column, x: Column) -> Column:
        apart = x["i"] > acc["end"]
        taken = apart | (x["dice"] > acc["dice"])
        return F.struct((acc["n"] + apart.cast("long")).alias("n"), F.when(taken, x["end"]).otherwise(acc["end"]).alias("end"),
                        F.when(taken, x["dice"]).otherwise(acc["dice"]).alias("dice"), F.greatest(acc["top"], x["dice"]).alias("top"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end"), F.lit(0.0).alias("dice"), F.lit(0.0).alias("top"))
    by_pair = F.sort_array(F.transform("pairs", lambda p, i: F.struct(p.alias("p"), i.alias("i"))))
    summed = once(once(by_pair, placed), lambda places: F.aggregate(runs(places), none, count))
    # A generator, as values are not computed again for a filter above it.
    met = met.select("doc_id", "licence", F.inline(F.array(summed))).where("n > 0").select("doc_id", "licence", F.col("top").alias("dice"), "n")
    return met.groupBy("doc_id", "licence").agg(F.max("dice").alias("dice"), F.sum("n").alias("n_windows"))


def licences(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, name: str = "licences") -> DataFrame:
    """(doc_id, licence, dice, n_passages): as ``scan``, and licences that no line, block or whole text holds, by their ``windows``.

    A licence with passages of its own has their dice and number; of any other, dice is that of its
    best run of words and n_passages the number of its runs. By default COMMON is looked for too.
    The texts are read once: those that hold a necessary word of a template are stored, and both look at them alone.
    """
    templates = TEMPLATES | COMMON if templates is None else templates
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL").where(_held(F.col("text"), templates, least))
    docs = Scratch(docs.sparkSession, name).store(held, "held")
    found = scan(docs, templates, least).withColumn("by", F.lit(0))
    runs = windows(docs, templates, least).select("doc_id", "licence", "dice", F.col("n_windows").alias("n_passages"), F.lit(1).alias("by"))
    first = F.min(F.struct("by", "dice", "n_passages")).alias("x")
    return found.unionByName(runs).groupBy("doc_id", "licence").agg(first).select("doc_id", "licence", "x.dice", "x.n_passages")
