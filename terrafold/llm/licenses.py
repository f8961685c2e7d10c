"""License scans (DataFrame only): sparse TF-IDF cosine of lines, header blocks and whole license files to
license templates, then inheritance from the nearest ancestor directory.

A file's own license is that of its best part, over the whole text: a line, or a block of consecutive lines
as long as a template, or all of a license file. Idf weights come from the number of files that hold each word.
A part's cosine is at most the norm of the template's words that it holds, so texts and parts whose words weigh less
than the threshold are dropped before any word is counted. That bound leaves few texts: it is the rare words of a template that weigh.

Files named like a license file speak for their directory. A file without a license of its own
takes that of its nearest ancestor directory which has one: each file's ancestor paths are
joined to the directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.textops import written

# License statements, file headers and whole license texts by SPDX name; a name may have several.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("CC-BY-4.0", """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""),
    ("CC-BY-NC-4.0", """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
]
THRESHOLD = 0.75
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
_SPLIT = "[^a-z0-9]+"


def _words(text):
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def template_weights(spark: SparkSession, templates: list[tuple[str, str]], counts: DataFrame, files: int) -> DataFrame:
    """(no, license, word, idf, weight): unit-length TF-IDF vectors of the templates by number. ``counts``: word, df over all files."""
    t = spark.createDataFrame([(i, *x) for i, x in enumerate(templates)], "no int, license string, template string")
    tf = t.select("no", "license", F.explode(_words(F.col("template"))).alias("word")).groupBy("no", "license", "word").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(counts, "word", "left").withColumn("idf", _idf(files)).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("no")))
    return w.select("no", "license", "word", "idf", (F.col("w") / norm).alias("weight"))


def _idf(files: int):
    return F.log((F.lit(float(files)) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1


def own_license(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (key, text and, if there, whole) -> (key, own_license, own_score) of the files of which a part reaches ``threshold``.

    Parts are each line and, where ``whole`` is true, the whole text, against every template; and for each
    template the blocks of consecutive lines, from each line on, up to and just beyond its number of words (a header or license text over
    several lines), against that template. The score is the cosine of a part's TF-IDF vector and a template's; every word, in a template or not, has the idf of its own count. Ties go to the smaller license name."""
    spark = files.sparkSession
    vocab = sorted({w for _, t in templates for w in _plain_words(t)})
    whole = F.coalesce(F.col("whole"), F.lit(False)) if "whole" in files.columns else F.lit(False)
    low = files.select("key", F.lower("text").alias("text"), whole.alias("whole")).where("text is not null")
    # document counts of every word, over all files and whole texts; partial counts first, so a frequent word is one row per task
    held = low.select(F.explode(F.array_distinct(F.split("text", _SPLIT))).alias("word"))
    counts = written(held.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "license")
    n = files.count()
    weights = written(template_weights(spark, templates, counts, n), "license")
    # the weights of the templates, which the driver holds anyway: per template its words and their squared weights
    ours = {}
    for r in weights.collect():
        ours.setdefault(r["no"], []).append((r["word"], r["weight"] ** 2))
    plain = {i: _plain_words(templates[i][1]) for i in ours}
    words_of = {i: _constant([w for w, _ in sorted(ours[i])]) for i in ours}
    squares = {i: _constant([repr(x) for _, x in sorted(ours[i])]).cast("array<double>") for i in ours}
    # scores are rounded to 6 digits
    least = (threshold - 1e-6) ** 2 if threshold > 0 else 0.0

    def fits(words, i):
        """Do the template's words among these weigh enough?"""
        shared = F.array_intersect(words, words_of[i])
        return F.aggregate(shared, F.lit(0.0), lambda acc, w: acc + F.element_at(squares[i], F.array_position(words_of[i], w).cast("int"))) >= least

    def fits_any(words):
        has = F.lit(False)
        for i in ours:
            has = has | fits(words, i)
        return has

    present = low.withColumn("present", F.array_intersect(F.split("text", _SPLIT), _constant(vocab))).where(F.size("present") > 0)
    # evaluated once: the condition below it reads a column, not the split text
    present = present.select("key", "whole", "text", F.explode(F.array("present")).alias("present")).where(fits_any(F.col("present")))
    # few texts hold enough of a template's words; the texts are read once for all that follows
    texts = written(present.select("key", "whole", "present", F.filter(F.transform(F.split("text", "\n"), _words), lambda ws: F.size(ws) > 0).alias("lines")), "license")
    # (words, number of the template they are scored against, -1: every one)
    against = lambda words, i: F.transform(words, lambda ws: F.struct(ws.alias("ws"), F.lit(i).alias("no")))
    parts = [against(F.filter("lines", lambda ws: fits_any(ws)), -1), F.when(F.col("whole"), against(F.array(F.flatten("lines")), -1))]

    none = F.array().cast("array<string>")

    def from_each_line(i):
        size = len(plain[i])
        near = F.transform(F.sequence(F.lit(1), F.size("lines")), lambda at: F.slice("lines", at, F.lit(size)))
        reach = F.transform(near, lambda b: F.aggregate(b, none, lambda acc, ws: F.when(F.size(acc) < size, F.concat(acc, ws)).otherwise(acc)))
        short = F.transform(near, lambda b: F.aggregate(b, F.struct(none.alias("ws"), F.lit(True).alias("more")), lambda acc, ws: F.struct(
            F.when(acc["more"] & (F.size(acc["ws"]) + F.size(ws) <= size), F.concat(acc["ws"], ws)).otherwise(acc["ws"]).alias("ws"),
            (acc["more"] & (F.size(acc["ws"]) + F.size(ws) <= size)).alias("more")), lambda acc: acc["ws"]))
        return F.when(fits(F.col("present"), i), F.filter(F.concat(reach, short), lambda ws: fits(ws, i)))

    parts += [against(from_each_line(i), i) for i in ours]
    lines = texts.select("key", F.explode(F.concat(*[F.coalesce(x, F.array().cast("array<struct<ws:array<string>,no:int>>")) for x in parts])).alias("p"))
    lines = written(lines.select("key", F.xxhash64("p.ws").alias("line"), "p.no", "p.ws").dropDuplicates(["key", "line", "no"]), "license")
    tf = lines.select("line", "ws").dropDuplicates(["line"]).select("line", F.explode("ws").alias("word")).groupBy("line", "word").agg(F.count(F.lit(1)).alias("tf"))
    # every word of a part is a word of some file, so it has a count; a word's weights in all templates lie side by side, and one pass gives the norm and all products
    by_word = weights.groupBy("word").agg(*[F.sum(F.when(F.col("no") == i, F.col("weight"))).alias(f"in{i}") for i in ours])
    tf = tf.join(counts.join(by_word, "word", "left"), "word").withColumn("w", F.col("tf") * _idf(n))
    sums = tf.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *[F.sum(F.col("w") * F.col(f"in{i}")).alias(f"dot{i}") for i in ours])
    dots = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(templates[i][0]).alias("license"), F.col(f"dot{i}").alias("dot")) for i in ours])
    score = sums.select("line", "norm", F.explode(dots).alias("d")).select("line", "d.i", "d.license", F.round(F.col("d.dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    hits = lines.select("key", "line", "no").join(score, "line").where((F.col("no") < 0) | (F.col("no") == F.col("i")))
    return (hits.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
            .select("key", F.col("b.license").alias("own_license"), (-F.col("b.s")).alias("own_score")))


def _constant(words: list[str]):
    """An array of words in one call (folded to a literal)."""
    return F.split(F.lit(" ".join(words)), " ")


def _plain_words(text: str) -> list[str]:
    import re

    return [w for w in re.split(_SPLIT, text.lower()) if w]


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text; other columns are ignored) -> one row per row: path, own_license, own_score, license,
    license_from, distance.

    license is the file's own, else that of the nearest ancestor directory that has a license file with a license of its
    own; license_from is the path of the file it comes from (itself, or the license file), distance the number of directories up
    (0: same directory; null without a license). In one directory the license file of the highest score speaks,
    ties to the smaller path. Scores are rounded to 6 digits. Null and empty texts have no license of their own and may
    inherit; a null path has no directory, so it inherits nothing. Rows that share a path are scanned apart, and repeated rows give
    equal rows; empty tables give no rows. The number of templates is a parameter held by the driver."""
    f = files.select(F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text")).withColumn("key", F.xxhash64("path", "text"))
    named = F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False))
    own = written(own_license(f.select("key", "text", named.alias("whole")), templates, threshold), "license")
    d = written(f.select("path", "key").join(own, "key", "left"), "license")
    # '/a/b/c' has the ancestors '/a/b', '/a', '' at distance 0, 1, 2
    parts = F.split("path", "/")
    folder = F.slice(parts, F.lit(1), F.size(parts) - 1)
    speak = (d.where(F.col("own_license").isNotNull() & F.col("path").rlike(LICENSE_FILE))
             .groupBy(F.array_join(folder, "/").alias("dir"))
             .agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("path").alias("p"), F.col("own_license").alias("l"))).alias("b")))
    lacking = d.where(F.col("own_license").isNull() & F.col("path").isNotNull()).select(folder.alias("folder")).distinct()
    ups = lacking.select(F.array_join("folder", "/").alias("from"), "folder", F.posexplode(F.sequence(F.size("folder"), F.lit(0))).alias("distance", "depth"))
    ups = ups.where((F.col("depth") > 0) | (F.size("folder") == 0)).select("from", "distance", F.array_join(F.slice("folder", F.lit(1), F.greatest("depth", F.lit(1))), "/").alias("dir"))
    near = (ups.join(speak, "dir").groupBy("from").agg(F.min(F.struct("distance", F.col("b.l").alias("l"), F.col("b.p").alias("p"))).alias("n")))
    got = d.join(near, F.array_join(folder, "/") == F.col("from"), "left")
    has = F.col("own_license").isNotNull()
    return got.select("path", "own_license", "own_score", F.when(has, F.col("own_license")).otherwise(F.col("n.l")).alias("license"),
                      F.when(has, F.col("path")).otherwise(F.col("n.p")).alias("license_from"), F.when(has, 0).otherwise(F.col("n.distance")).alias("distance"))
