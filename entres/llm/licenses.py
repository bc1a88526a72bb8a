"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance down directories.

Compared with the templates are every line of a file, every run of words as long as a long template (a notice that
goes over several lines), and the whole of a licence file.  A word weighs (1 + ln of its count) times its inverse document frequency
over all scanned texts, whether a template has it or not; vectors are sparse and scaled to unit length.

What cannot reach ``THRESHOLD`` is pruned exactly.  Of a line: the heaviest words of each short template whose removal leaves less than
the squared threshold of its mass are anchors, and a line without an anchor is out, as is one that
stays below the threshold where every word of no template weighs 1, the least there is.  Of a run: a cosine is at most the root of the template's mass that
the run's words cover, and of neighbouring runs the one that covers most is taken.  The few that are left are told apart by
their words and counts and joined with the document frequencies of those words, which are counted over all texts.

A file without a licence of its own takes that of the nearest ancestor directory with a recognised licence file.
Directories, not files, are joined with their ancestors' paths, so a directory that holds a third of
all files counts once; files then look up their own directory.

Defined cases: null and empty texts have no licence of their own; null path is the root directory; of several
licence files in a directory the best score wins, then the smallest id; ties between templates go to
the first by name; repeated rows are reported each; a text of any length is scanned whole; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import U64, Words, drop_scratch, slices, span_hash, table, write_scratch

THRESHOLD = 0.7
_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."


def _gnu(name: str, version: str) -> str:
    """The notice that the GNU licences ask to be put at the start of a file."""
    it = "This library" if name.startswith("GNU Lesser") else "This program"
    noun = it.split()[1]
    return f"{it} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this {noun}. If not, see <https://www.gnu.org/licenses/>."


def _gnu_title(name: str, version: str, date: str) -> str:
    """The head of the licence text itself."""
    return f"{name.upper()} Version {version}, {date} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


#: The texts of licences, the notices by which they are declared in files, and common one-line statements, by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", _gnu("GNU Affero General Public License", "3"), _gnu_title("GNU Affero General Public License", "3", "19 November 2007")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", f"{_BSD_GRANT} {_BSD_WARRANTY}"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Released under the BSD 3-Clause License.",
        f"{_BSD_GRANT} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_WARRANTY}",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Attribution 4.0 International Creative Commons Attribution 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License (\"Public License\")."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Attribution-NonCommercial 4.0 International Creative Commons Attribution-NonCommercial 4.0 International Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License (\"Public License\")."],
    "CC0-1.0": ["This work is dedicated to the public domain under CC0 1.0.", "CC0 1.0 Universal Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _gnu("GNU General Public License", "2"), _gnu_title("GNU General Public License", "2", "June 1991")],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _gnu("GNU General Public License", "3"), _gnu_title("GNU General Public License", "3", "29 June 2007")],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1.", _gnu("GNU Lesser General Public License", "2.1"), _gnu_title("GNU Lesser General Public License", "2.1", "February 1999")],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", _gnu("GNU Lesser General Public License", "3"), _gnu_title("GNU Lesser General Public License", "3", "29 June 2007")],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", f"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
for _name, _texts in TEMPLATES.items():
    _texts.append(f"SPDX-License-Identifier: {_name}")
#: Templates of more words than this are looked for in runs of words, others in lines.
LONG = 24
LICENCE_FILES = ("LICENSE", "LICENCE", "COPYING", "NOTICE")
_EDGE = np.zeros(256, bool)
_EDGE[np.frombuffer(b".,;:!?()[]\"'*#/", np.uint8)] = True


class Lines:
    """Words of a batch without punctuation at their ends, and the line (within its document) of each."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts)
        a, b = w.start.copy(), w.end.copy()
        for _ in range(3):
            a += (a < b) & _EDGE[w.data[np.minimum(a, len(w.data) - 1)]] if len(a) else 0
            b -= (a < b) & _EDGE[w.data[np.maximum(b - 1, 0)]] if len(a) else 0
        keep = a < b
        self.hash, self.doc = span_hash(w.prefix, a[keep], b[keep]), w.doc[keep]
        breaks = np.concatenate(([0], np.cumsum(w.data == 10)))
        self.line = breaks[a[keep]]  # texts end with a break of their own, so lines never join two documents


def counted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes and 1 + ln of their counts."""
    words, n = np.unique(words, return_counts=True)
    return words, 1.0 + np.log(n)


def template_words() -> tuple[list[tuple[str, int, np.ndarray, np.ndarray]], np.ndarray]:
    """(name, number of words, distinct words, their term weights) of every template, and all words of templates."""
    rows = []
    for name, texts in TEMPLATES.items():
        for t in texts:
            h = Lines([t.encode()]).hash
            rows.append((name, len(h), *counted(h)))
    return rows, np.unique(np.concatenate([h for _, _, h, _ in rows]))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in slices(batches):
        x = Lines(texts)
        order = np.lexsort((x.doc, x.hash))
        word, doc = x.hash[order], x.doc[order]
        new = np.append(True, (word[1:] != word[:-1]) | (doc[1:] != doc[:-1]))[: len(word)]
        words, n = np.unique(word[new], return_counts=True)
        yield pa.record_batch({"word": pa.array([None, *words.view(np.int64).tolist()], pa.int64()), "n": pa.array([len(texts), *n.tolist()], pa.int64())})


def frequencies(files: DataFrame) -> DataFrame:
    """Number of texts with each word hash (word, n); the null word counts all texts."""
    counts = files.select("text").mapInArrow(_frequencies, "word long, n long")
    return write_scratch(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-texts")


def idf(counts: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse document frequency of each template word, and the number of texts."""
    _, vocab = template_words()
    words = vocab.view(np.int64).tolist()
    df = {r.word: r.n for r in counts.where(F.col("word").isNull() | F.col("word").isin(words)).collect()}
    n = df.get(None, 0)
    return np.array([math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in words]), n


class Matcher:
    def __init__(self, weights: np.ndarray, n: int):
        rows, self.vocab = template_words()
        self.weights, self.n = weights, n
        self.vectors, self.runs, anchors = [], [], set()
        for name, length, words, tf in rows:
            at = np.searchsorted(self.vocab, words)
            w = tf * weights[at]
            unit = w / np.sqrt((w * w).sum())
            self.vectors.append((name, dict(zip(at.tolist(), unit.tolist(), strict=True))))
            if length > LONG:
                mass = np.zeros(len(self.vocab) + 1)
                mass[at] = unit**2
                self.runs.append((length, mass))
                continue
            order = np.argsort(-unit, kind="stable")
            rest = 1.0 - np.cumsum(unit[order] ** 2)
            anchors.update(at[order[: int(np.searchsorted(-rest, -(THRESHOLD**2) + 1e-9)) + 1]].tolist())
        self.anchor = np.zeros(len(self.vocab) + 1, bool)
        self.anchor[list(anchors)] = True

    def best(self, words: np.ndarray, tf: np.ndarray, df: np.ndarray | None = None) -> tuple[float, str]:
        """The closest template of distinct word hashes and their term weights; without ``df`` (texts with each word) an upper bound of the score."""
        at = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        known = self.vocab[at] == words
        w = tf * np.where(known, self.weights[at], 1.0 if df is None else np.log((1 + self.n) / (1 + df)) + 1)
        norm = float(np.sqrt((w * w).sum()))
        mine = dict(zip(at[known].tolist(), w[known].tolist(), strict=True))
        top = (0.0, "")
        for name, v in self.vectors:
            dot = sum(x * v[i] for i, x in mine.items() if i in v) / norm
            if dot > top[0] + 1e-12:
                top = (dot, name)
        return top

    def likely(self, texts: list[bytes], whole: list[bool]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Words and term weights of the lines, runs and licence files of each text that may reach the threshold."""
        x = Lines(texts)
        if not len(x.hash):
            return [[] for _ in texts]
        at = np.minimum(np.searchsorted(self.vocab, x.hash), len(self.vocab) - 1)
        at = np.where(self.vocab[at] == x.hash, at, len(self.vocab))
        hit = self.anchor[at]
        found: list[list] = [[] for _ in texts]
        lines = np.unique(x.line[hit])
        lo, hi = np.searchsorted(x.line, lines), np.searchsorted(x.line, lines, side="right")
        spans = [(int(x.doc[a]), a, b) for a, b in zip(lo, hi, strict=True)]
        for d in sorted({d for d, _, _ in spans if whole[d]}):
            spans.append((d, int(np.searchsorted(x.doc, d)), int(np.searchsorted(x.doc, d, side="right"))))
        for length, mass in self.runs:
            covered = np.concatenate(([0.0], np.cumsum(mass[at])))
            sums = covered[length:] - covered[:-length]
            able = np.flatnonzero((sums >= THRESHOLD**2 - 1e-9) & (x.doc[: len(sums)] == x.doc[length - 1 : length - 1 + len(sums)])) if len(sums) else []
            for run in np.split(able, np.flatnonzero(np.diff(able) > 1) + 1) if len(able) else []:
                a = int(run[np.argmax(sums[run])])
                spans.append((int(x.doc[a]), a, a + length))
        for d, a, b in spans:
            words, tf = counted(x.hash[a:b])
            if self.best(words, tf)[0] >= THRESHOLD - 1e-9:
                found[d].append((words, tf))
        return found


def own_licences(files: DataFrame) -> DataFrame:
    """``files(doc_id, path, text)`` to one row a file: doc_id, path, own licence or null, and score."""
    counts = frequencies(files)
    model = files.sparkSession.sparkContext.broadcast(idf(counts))  # bounded by the template words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(*model.value)
        kind = pa.list_(pa.struct([("key", pa.int64()), ("words", pa.list_(pa.struct([("word", pa.int64()), ("tf", pa.float64())])))]))
        for part, texts in slices(batches):
            paths = part.column(1).to_pylist()
            found = m.likely(texts, [(p or "").rsplit("/", 1)[-1].split(".")[0].upper() in LICENCE_FILES for p in paths])
            sets = [[{"key": xxhash.xxh64_intdigest(w.tobytes() + tf.tobytes()) - (1 << 63), "words": [{"word": a, "tf": b} for a, b in zip(w.view(np.int64).tolist(), tf.tolist(), strict=True)]} for w, tf in ws] for ws in found]
            yield pa.record_batch({"doc_id": part.column(0), "path": part.column(1), "sets": pa.array(sets, kind)})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(*model.value)
        for b in batches:
            top = []
            for rows in b.column(1).to_pylist():
                rows = sorted((r["word"] % (1 << 64), r["tf"], r["n"]) for r in rows)
                top.append(m.best(np.array([r[0] for r in rows], U64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], np.float64)))
            yield pa.record_batch({"key": b.column(0), "own": pa.array([n for _, n in top], pa.string()), "score": pa.array([s for s, _ in top], pa.float64())})

    rows = files.selectExpr("cast(doc_id as long) doc_id", "path", "text").mapInArrow(run, "doc_id long, path string, sets array<struct<key:long,words:array<struct<word:long,tf:double>>>>")
    rows = write_scratch(rows.withColumn("row", F.monotonically_increasing_id()), "licence-lines")
    sets = rows.select("row", F.posexplode("sets").alias("at", "s")).select("row", "at", "s.key", "s.words")
    words = sets.groupBy("key").agg(F.first("words").alias("words")).select("key", F.explode("words").alias("w")).select("key", "w.word", "w.tf")
    words = words.join(counts, "word").groupBy("key").agg(F.collect_list(F.struct("word", "tf", "n")).alias("rows"))
    scored = words.mapInArrow(score, "key long, own string, score double").where(F.col("score") >= THRESHOLD)
    best = sets.select("row", "at", "key").join(scored, "key").groupBy("row").agg(F.max_by(F.struct("own", "score"), F.struct("score", -F.col("at"))).alias("b"))
    out = rows.select("row", "doc_id", "path").join(best, "row", "left")
    out = write_scratch(out.select("doc_id", "path", F.col("b.own").alias("own"), F.coalesce("b.score", F.lit(0.0)).alias("score")), "own-licences")
    drop_scratch(counts, rows)
    return out


def scan(files: DataFrame) -> DataFrame:
    """``files(doc_id, path, text)`` to one row a file: doc_id, path, license, score, origin and inherited_from."""
    own = own_licences(files)
    name = F.element_at(F.split(F.coalesce("path", F.lit("")), "/"), -1)
    stem = F.upper(F.element_at(F.split(name, r"\."), 1))
    own = own.withColumn("dir", F.regexp_replace(F.coalesce("path", F.lit("")), "/?[^/]*$", "")).withColumn("is_file", stem.isin(*LICENCE_FILES))
    declared = own.where("is_file and own is not null").groupBy("dir").agg(F.max_by(F.struct("own", "path"), F.struct("score", -F.coalesce("doc_id", F.lit(0)))).alias("found"))
    parts = F.split("dir", "/")
    dirs = own.select("dir").distinct().select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
    dirs = dirs.select("dir", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("up"))
    near = dirs.join(declared.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by("found", "depth").alias("found"))
    out = own.join(near, "dir", "left")
    has = F.col("own").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("own", "found.own").alias("license"), "score",
        F.when(has & F.col("is_file"), "file").when(has, "header").when(F.col("found").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("found.path")).alias("inherited_from"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a file tree: source/lang/thousand/hundred/id.txt.

    The table has no paths, so these are the query's own: ids divisible by 8 are licence files of their directory, those
    divisible by 64 of the directory above, and by 512 of the language's, whatever their text.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    top = F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("none")), F.coalesce(F.col("lang").cast("string"), F.lit("none")))
    middle = F.concat_ws("/", top, F.concat(F.lit("t"), F.floor(number / 1000)))
    deep = F.concat_ws("/", middle, F.concat(F.lit("h"), F.floor(number / 100)))
    licence = F.concat(F.lit("/LICENSE."), F.col("doc_id"))
    by = lambda n: F.pmod(F.col("doc_id"), F.lit(n)) == 0
    path = F.when(by(512), F.concat(top, licence)).when(by(64), F.concat(middle, licence)).when(by(8), F.concat(deep, licence))
    return docs.select("doc_id", F.coalesce(path, F.concat(deep, F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt"))).alias("path"), "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(document_paths(table(spark, sf_dir, "documents")))
