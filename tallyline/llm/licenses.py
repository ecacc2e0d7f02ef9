"""License scan by sentence rules.

Sentences are normalised and mapped to identifiers of known licence sentences; the identifier sequence
of a document is then matched against ordered licence rules, the longest first. A text is cut into
sentences in two ways, with line ends as boundaries and with wrapped lines joined, and matches of both
count. Only documents that hold a word common to known sentences are cut at all; every known sentence
holds one, so nothing is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "apache2-ref": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "This work is licensed under the Apache License, Version 2.0."],
    "apache2-head": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'],
    "apache2-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache2-asis": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'],
    "apache2-see": ["See the License for the specific language governing permissions and limitations under the License."],
    "mit-ref": ["Released under the MIT License.", "Licensed under the MIT License.", "This work is licensed under the MIT License."],
    "mit-grant": ['Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mit-asis": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 3."],
    "gpl-free-3": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-free-2": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "gpl-details": ["See the GNU General Public License for more details."],
    "bsd-use": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "cc-by-ref": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-ref": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-ref": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "mpl2-form": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# Ordered rules (licence, kind, sentence identifiers).
RULES = [
    ("MIT", "text", ("mit-grant", "mit-notice", "mit-asis", "mit-liability")),
    ("Apache-2.0", "notice", ("apache2-head", "apache2-copy", "apache2-asis", "apache2-see")),
    ("Apache-2.0", "notice", ("apache2-head", "apache2-copy")),
    ("BSD-3-Clause", "text", ("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "text", ("bsd-use", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", "notice", ("gpl-free-3", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", "notice", ("gpl-free-2", "gpl-hope", "gpl-details")),
    ("Apache-2.0", "reference", ("apache2-ref",)),
    ("MIT", "reference", ("mit-ref",)),
    ("GPL-3.0-only", "reference", ("gpl3-ref",)),
    ("CC-BY-4.0", "reference", ("cc-by-ref",)),
    ("CC-BY-SA-4.0", "reference", ("cc-by-sa-ref",)),
    ("CC-BY-NC-4.0", "reference", ("cc-by-nc-ref",)),
    ("MPL-2.0", "notice", ("mpl2-form",)),
]
#: Unknown sentences that may stand between two sentences of a rule.
GAP = 2
# the point of "v. 2.0" ends no sentence: else versions of a licence would look alike
ENDS = r"(?<=[.!?:])(?<!\b[vV]\.)\s+|\n+"


def normalised(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip(" ")


def normalised_column(text: Column) -> Column:
    """The same as ``normalised`` for a column (lower case of ASCII letters only matters)."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def cut_sentences(text: str) -> list[str]:
    """Normalised pieces between sentence ends, as known sentences are cut too."""
    return [n for s in re.split(ENDS, text) if (n := normalised(s))]


def known(sentences: dict[str, list[str]] = SENTENCES) -> dict[str, str]:
    """Identifier by normalised sentence; a sentence that is cut in two counts by its longest piece."""
    return {max(cut_sentences(text), key=len): name for name, texts in sentences.items() for text in texts}


def anchors(sentences: list[str]) -> list[str]:
    """A few words of which every sentence holds at least one, the most common first."""
    left, found = [set(s.split()) for s in sentences], []
    while left:
        words = sorted({w for s in left for w in s if len(w) > 3} or {w for s in left for w in s}, key=lambda w: (-sum(w in s for s in left), -len(w), w))
        found.append(words[0])
        left = [s for s in left if words[0] not in s]
    return found


def match(items: list[tuple[int, str]], rules: list[tuple[str, str, tuple[str, ...]]] = RULES, gap: int = GAP) -> list[tuple[str, str, int, int]]:
    """Matches (licence, kind, first, last position) in identifiers ordered by position.

    At each identifier the longest rule wins, and its sentences belong to no other match.
    """
    return [(licence, kind, at[0], at[-1]) for licence, kind, at in matched(items, rules, gap)]


def matched(items: list[tuple[int, str]], rules: list[tuple[str, str, tuple[str, ...]]] = RULES, gap: int = GAP) -> list[tuple[str, str, list[int]]]:
    """The same with the positions of all sentences of a match."""
    ordered, found, used = sorted(rules, key=lambda r: -len(r[2])), [], set()
    for i in range(len(items)):
        for licence, kind, wanted in ordered if i not in used else ():
            at, j = [], i
            for name in wanted:
                while j < len(items) and (items[j][1] != name or j in used) and (not at or items[j][0] - items[at[-1]][0] <= gap):
                    j += 1 if at else len(items)
                if j >= len(items) or items[j][1] != name or (at and items[j][0] - items[at[-1]][0] > gap + 1):
                    break
                at.append(j)
                j += 1
            if len(at) == len(wanted):
                used.update(at)
                found.append((licence, kind, [items[k][0] for k in at]))
                break
    return found


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Licence matches: ``key, licence, kind, wrapped, first_sentence, last_sentence``.

    ``wrapped`` tells which way of cutting gave the match. A match of wrapped lines is left out only if
    one of the same licence and kind from the other way holds all its sentences, at the same places of
    the text. Documents without a match (also null and empty texts) have no row. Repeated rows give
    their matches once.
    """
    table = known()
    kind = docs.schema[key].dataType.simpleString()
    body = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.lower("text").rlike("|".join(anchors(list(table)))))
    joined = F.regexp_replace("text", r"(?<![.!?:\n])[ \t]*\r?\n[ \t]*(?!\n)", " ")
    ways = {"plain": F.split("text", ENDS), "wrapped": F.split(joined, ENDS)}
    hits = lambda way: F.filter(F.transform(way, lambda raw, i: F.struct(i.alias("pos"), normalised_column(raw).alias("sentence"))), lambda s: s["sentence"].isin(list(table)))
    # a generator of one row, as a filter on its result is not moved below it: sentences are looked up once
    looked = body.select("key", "text", F.explode(F.array(F.struct(*(hits(way).alias(name) for name, way in ways.items())))).alias("hits"))
    # letters and digits of each piece: line ends and signs don't count, so both ways give a sentence one place
    sizes = lambda way: F.transform(way, lambda raw: F.length(F.regexp_replace(F.lower(raw), "[^a-z0-9]+", "")))
    found = looked.where("size(hits.plain) + size(hits.wrapped) > 0").select("key", "hits", F.struct(*(sizes(way).alias(name) for name, way in ways.items())).alias("sizes"))

    def places(hits: list[dict], sizes: list[int]) -> list[tuple[str, str, int, int, set[int]]]:
        starts = list(accumulate(sizes, initial=0))
        return [(licence, kind, at[0], at[-1], {starts[i] for i in at}) for licence, kind, at in matched([(x["pos"], table[x["sentence"]]) for x in hits])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, hit, size in zip(*(batch.column(c).to_pylist() for c in ("key", "hits", "sizes"))):
                plain, wrapped = (places(hit[way], size[way]) for way in ("plain", "wrapped"))
                rows += [(k, *m[:2], False, *m[2:4]) for m in plain]
                held: dict[tuple[str, str, int], set[int]] = {(*m[:2], start): m[4] for m in plain for start in m[4]}
                rows += [(k, *m[:2], True, *m[2:4]) for m in wrapped if not m[4] <= held.get((*m[:2], min(m[4])), set())]
            kinds = [batch.schema.field("key").type, pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["key", "licence", "kind", "wrapped", "first_sentence", "last_sentence"])

    matches = found.mapInArrow(run, f"key {kind}, licence string, kind string, wrapped boolean, first_sentence int, last_sentence int")
    return matches.withColumnRenamed("key", key).distinct()
