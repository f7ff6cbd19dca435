"""License scans: TF-IDF cosine of headers and licence files to templates, and inheritance along directories.

A file's units are its lines, two and three lines in a row, its blocks (lines in a row that are all
comment or all not) and the whole file. A unit can only reach the bar if it holds one of a
template's strong words, the few without which the rest of the template weighs too little; most files
have none and are left at that. The other units are held against a bound that needs the
template words' weights alone, and what passes is weighed over the whole corpus.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.session import written

BETWEEN = r"[^\p{L}\p{N}]+"
WORD = re.compile(r"[^\W_]+")
#: What opens a line of a comment.
LEADER = re.compile(r"\s*(?:#|//|/?\*|;|--|%|<!--|\.\. )")

# Notices, standard headers, titles and whole texts of common licences, by their usual identifiers.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
}
TITLES = {
    "Apache-2.0": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "GPL-3.0": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "ISC": "ISC License (ISC)",
    "MIT": "The MIT License (MIT)",
    "MPL-2.0": "Mozilla Public License Version 2.0",
}
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details. You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
NO_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
    DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
    SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
    LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
    CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
    SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TWO_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
THIRD_CLAUSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
WHOLE = {
    "BSD-2-Clause": f"{TWO_CLAUSES} {NO_WARRANTY}",
    "BSD-3-Clause": f"{TWO_CLAUSES} {THIRD_CLAUSE} {NO_WARRANTY}",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
        IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
SPDX = {name: f"SPDX-License-Identifier: {name}" for name in sorted({*NOTICES, *TITLES, *HEADERS, *WHOLE})}


def standard_templates() -> list[tuple[str, str]]:
    """(licence, text) of all the above."""
    return [pair for texts in (NOTICES, TITLES, HEADERS, WHOLE, SPDX) for pair in texts.items()]


@dataclass(frozen=True)
class Scan:
    templates: tuple[tuple[str, str], ...] = field(default_factory=lambda: tuple(standard_templates()))
    least_cosine: float = 0.8


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def template_words(spark: SparkSession, scan: Scan) -> DataFrame:
    """(template, license, word, tf)."""
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(scan.templates)], "template int, license string, text string")
    return rows.select("template", "license", F.explode(_words(F.col("text"))).alias("word")).groupBy(
        "template", "license", "word").agg(F.count("*").alias("tf"))


def document_counts(files: DataFrame) -> DataFrame:
    """(word, n): in how many files each word of the corpus stands; map tasks reduce to their distinct words."""
    return files.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def idf(counts: DataFrame, words: DataFrame, n_files: int) -> DataFrame:
    """(word, idf) of the given distinct words, by :func:`document_counts` of all files; 1 at least."""
    n = counts.join(words, "word", "left_semi")
    return words.join(n, "word", "left").select("word", F.expr(f"ln((1 + {n_files}) / (1 + coalesce(n, 0))) + 1").alias("idf"))


class Templates:
    """What a task needs to know of the templates."""

    def __init__(self, rows: list[tuple[int, str, float, float]], least: float):
        self.least, self.idf = least, {}
        vectors: dict[int, dict[str, float]] = defaultdict(dict)
        for template, word, tf, idf_ in rows:
            vectors[template][word] = tf * idf_
            self.idf[word] = idf_
        self.norms = {t: sum(w * w for w in v.values()) ** 0.5 for t, v in vectors.items()}
        self.by_word: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.strong: set[str] = set()
        for t, vector in vectors.items():
            rest = self.norms[t] ** 2
            for word, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                self.by_word[word].append((t, weight))
                if rest >= least**2 * self.norms[t] ** 2 * (1 - 1e-9):
                    self.strong.add(word)
                rest -= weight * weight

    def could_reach(self, words: list[str]) -> bool:
        """Whether the cosine could reach the bar if every other word weighed as little as a word can."""
        own, dots = 0.0, defaultdict(float)
        for word, times in Counter(words).items():
            known = self.by_word.get(word)
            x = times * self.idf.get(word, 1.0)
            own += x * x
            for t, weight in known or ():
                dots[t] += x * weight
        return any(dot >= self.least * self.norms[t] * own**0.5 * (1 - 1e-9) for t, dot in dots.items())


def units(lines: list[str]) -> Iterator[tuple[int, int]]:
    """(first line, number of lines): lines, pairs and triples, blocks, the whole file; lines without a word
    begin and end none of them."""
    worded = [bool(WORD.search(line)) for line in lines]
    places = [i for i, w in enumerate(worded) if w]
    if not places:
        return
    found = {(places[0], places[-1] + 1 - places[0])}
    comment = [bool(LEADER.match(line)) for line in lines]
    start = places[0]
    for i in range(places[0], places[-1] + 2):
        ends = i > places[-1] or not worded[i] or (i > start and worded[i - 1] and comment[i] != comment[i - 1])
        if ends and i > start and worded[start]:
            found.add((start, i - start))
        if ends:
            start = i if i <= places[-1] and worded[i] else i + 1
    for i in places:
        found |= {(i, n) for n in (1, 2, 3) if i + n <= len(lines) and all(worded[i:i + n])}
    yield from sorted(found)


def able_units(files: DataFrame, rows: list[tuple[int, str, float, float]], scan: Scan) -> DataFrame:
    """(path, line_no, n_lines, is_whole, unit): units that could reach the bar; ``is_whole`` has all words of its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(rows, scan.least_cosine)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.string())
        for batch in batches:
            out = []
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                if not text or known.strong.isdisjoint(WORD.findall(text.lower())):
                    continue
                lines = text.split("\n")
                words = [WORD.findall(line.lower()) for line in lines]
                held = [not known.strong.isdisjoint(w) for w in words]
                total = sum(map(len, words))
                for i, n in units(lines):
                    if any(held[i:i + n]):
                        unit = [w for line in words[i:i + n] for w in line]
                        if known.could_reach(unit):
                            out.append((path, i, n, len(unit) == total, "\n".join(lines[i:i + n])))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["path", "line_no", "n_lines", "is_whole", "unit"])

    return files.mapInArrow(run, "path string, line_no int, n_lines int, is_whole boolean, unit string").distinct()


def licensed_units(files: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """(path, line_no, n_lines, is_whole, license, cosine, of_header): units near enough to a template, with the best
    one, and whether that is a standard header.

    Ties go to the first identifier. NULL and empty texts have no units. Files without a path are not
    scanned: nothing could name or inherit their licence.
    """
    files = files.where("path IS NOT NULL").select("path", "text")
    spark, n_files = files.sparkSession, files.count()
    templates = written(template_words(spark, scan))
    counts = written(document_counts(files))
    weights = written(idf(counts, F.broadcast(templates.select("word").distinct()), n_files))  # the templates' words
    vectors = templates.join(weights, "word").withColumn("weight", F.expr("tf * idf"))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.expr("weight * weight"))).alias("norm"))
    vectors = written(vectors.join(norms, "template").select("template", "license", "word", "tf", "idf", "weight", "norm"))

    rows = [(r.template, r.word, r.tf, r.idf) for r in vectors.collect()]  # the templates' words
    unit = ["path", "line_no", "n_lines", "is_whole"]
    able = written(able_units(files, rows, scan).withColumn("unit_id", F.xxhash64("path", "line_no", "n_lines", "unit")))

    words = able.select(*unit, "unit_id", F.explode(_words(F.col("unit"))).alias("word"))
    counted = words.groupBy(*unit, "unit_id", "word").agg(F.count("*").alias("tf"))
    own = written(idf(counts, written(words.select("word").distinct()), n_files))
    weighed = written(counted.join(own, "word").select(*unit, "unit_id", "word", F.expr("tf * idf").alias("own")))
    unit_norm = weighed.groupBy(*unit, "unit_id").agg(F.sqrt(F.sum(F.expr("own * own"))).alias("unit_norm"))
    dots = weighed.join(vectors.select("template", "license", "word", "weight", "norm"), "word").groupBy(
        *unit, "unit_id", "template", "license", "norm").agg(F.sum(F.expr("own * weight")).alias("dot"))
    headers = [i for i, (_, text) in enumerate(scan.templates) if text in HEADERS.values()]
    scored = dots.join(unit_norm, [*unit, "unit_id"]).select(
        *unit, "license", F.expr("dot / (norm * unit_norm)").alias("cosine"), F.col("template").isin(headers).alias("of_header"))
    best = scored.where(f"cosine >= {scan.least_cosine}").groupBy(*unit).agg(
        F.min(F.struct((-F.round("cosine", 12)).alias("c"), "license", "cosine", "of_header")).alias("best"))
    return best.select(*unit, "best.license", "best.cosine", "best.of_header")


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(directories: DataFrame, declared: DataFrame) -> DataFrame:
    """(dir) and declared (dir, license) -> (dir, license, from_dir) of the nearest ancestor that
    declares one; the directory itself is the nearest."""
    up = directories.select("dir", F.explode(F.expr(
        "transform(sequence(0, size(split(dir, '/'))), i -> array_join(slice(split(dir, '/'), 1, i), '/'))")).alias("from_dir"))
    known = declared.select(F.col("dir").alias("from_dir"), "license")
    met = up.distinct().join(known, "from_dir")
    nearest = met.groupBy("dir").agg(F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "license")).alias("m"))
    return nearest.select("dir", "m.license", "m.from_dir")


def scan_files(files: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """(path, text) -> path, license, cosine, line_no, n_lines, is_license_file, origin, from_dir.

    ``origin`` is ``own`` where a unit of the file names a licence (the best unit counts, of equals the
    first and shortest), ``inherited`` where the nearest directory upwards with a licence file has one, else
    NULL. A licence file is told by its content: the whole of it is near a template; where that is a header, which a file
    carries for itself, no part of the file is nearer to one. Two licence files in one directory: the
    first path counts. Rows that repeat a path are scanned as one file and each returned; a NULL path
    has no licence. Nothing else is read.
    """
    found = written(licensed_units(files, scan))
    nearness = (-F.round("cosine", 12)).alias("c")
    own = found.groupBy("path").agg(
        F.min(F.struct(nearness, "line_no", "n_lines", "license", "cosine")).alias("own"),
        F.min(F.when(F.expr("is_whole AND NOT of_header"), F.struct(nearness, "license"))).alias("text"),
        F.min(F.when(F.expr("is_whole AND of_header"), F.struct(nearness, "license"))).alias("header"))
    whole = F.least("text", F.when(F.expr("header.c <= own.c"), F.col("header")))
    own = written(own.select(F.col("path").alias("own_path"), "own.license", "own.cosine", "own.line_no", "own.n_lines",
                             whole.isNotNull().alias("whole"), whole["license"].alias("states")))
    declared = own.where("whole").select(directory(F.col("own_path")).alias("dir"), F.col("own_path").alias("path"), F.col("states").alias("license"))
    declared = written(declared.groupBy("dir").agg(F.expr("min_by(license, path)").alias("license")))
    placed = files.select("path", directory(F.col("path")).alias("dir"))
    inherits = written(inherited(placed.where("path IS NOT NULL").select("dir").distinct(), declared)).select(
        F.col("dir").alias("in_dir"), F.col("license").alias("dir_license"), "from_dir")
    joined = placed.join(own, F.col("path") == F.col("own_path"), "left").join(inherits, F.col("dir") == F.col("in_dir"), "left")
    return joined.select(
        "path", F.coalesce("license", "dir_license").alias("license"), "cosine", "line_no", "n_lines",
        F.coalesce("whole", F.lit(False)).alias("is_license_file"),
        F.expr("CASE WHEN license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'inherited' END").alias("origin"),
        F.expr("CASE WHEN license IS NULL THEN from_dir END").alias("from_dir"))
