"""License scans: TF-IDF cosine of license passages to templates, and inheritance by directory.

A file is a sequence of lines, long ones cut into sentences or short runs of words. Windows of
consecutive ones, and short files as a whole, are compared with templates of notices and of whole
texts, as sparse vectors of hashed terms, weighed by how rare a term is among the lines of all
files. Products with the templates are sums over lines, so all windows of a text are scored in
place from running sums; only those that can reach the threshold get their exact length, and
nothing but passages with a license leaves the scan. A
file's license is that of its best passage. Files that are licences, by
name or because license lines are most of their words, speak for their directory; a file without
a license of its own takes that of the nearest directory above it that has one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import release_memory
from tillroll.scratch import Scratch

_NOTICE = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by"
    " the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)
_AS_IS = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:"
)
_BSD_1_2 = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
    " the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation the'
    " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
    " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and"
    " this permission notice shall be included in all copies or substantial portions of the Software."
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
    " provided that the above copyright notice and this permission notice appear in all copies."
)

# How license headers and short whole texts read, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        _MIT,
    ],
    "GPL-3.0": [
        _NOTICE.format("General Public License", "3"),
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        _NOTICE.format("General Public License", "2"),
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL-2.1": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        _NOTICE.format("Lesser General Public License", "2.1"),
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        _NOTICE.format("Lesser General Public License", "3"),
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        _NOTICE.format("Affero General Public License", "3"),
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license", _BSD_3, _BSD + _BSD_1_2 + _BSD_3 + _AS_IS],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD, _BSD + _BSD_1_2 + _AS_IS],
    "ISC": ["Licensed under the ISC License.", _ISC],
    "CC0-1.0": ["Released under CC0 1.0 Universal, public domain dedication.", "This work is dedicated to the public domain under CC0 1.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. Proprietary and confidential."],
}
# The first is the second and more: a file with passages of both has the first.
INCLUDES = {"BSD-3-Clause": "BSD-2-Clause"}
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)(\.(md|txt|rst))?$"
MIN_COSINE = 0.7
# Share of a file's words in license lines from which it is a licence file.
FILE_SHARE = 0.5

# Lines of more words are cut at sentences, and sentences of more words into runs of so many.
LINE_WORDS, RUN_WORDS = 30, 4
# Sizes of windows, in lines or their pieces; files up to so many words are also compared as a whole.
WINDOWS, WHOLE_WORDS = (1, 2, 3, 4, 6, 12), 600
# Terms are counted in so many buckets, whatever the number of files.
BUCKET_BITS = 18
LOT_UNITS = 1 << 13

_TERM = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+")

JUDGED = T.StructType(
    [
        T.StructField("license", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spoken", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField(
            "passages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("lo", T.IntegerType()),
                        T.StructField("n", T.IntegerType()),
                        T.StructField("license", T.StringType()),
                        T.StructField("score", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def units_of(text: str) -> list[list[str]]:
    """The terms of every line that has any; long lines in sentences, long sentences in runs."""
    out: list[list[str]] = []
    for line in text.lower().split("\n"):
        for piece in _SENTENCE.split(line) if line.count(" ") >= LINE_WORDS else (line,):
            terms = _TERM.findall(piece)
            if len(terms) > LINE_WORDS:
                out += [terms[i : i + RUN_WORDS] for i in range(0, len(terms), RUN_WORDS)]
            elif terms:
                out.append(terms)
    return out


class _Buckets(dict):
    """Bucket of each term, remembered for as many as a worker meets up to a bound."""

    def __missing__(self, term: str) -> int:
        if len(self) > 1 << 19:
            self.clear()
        self[term] = found = zlib.crc32(term.encode()) >> (32 - BUCKET_BITS)
        return found


def _flat(units: list[list[str]], buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all terms, and where each unit's start, with the end last."""
    starts = np.concatenate(([0], np.cumsum([len(u) for u in units], dtype=np.int64)))
    return np.fromiter((buckets[t] for u in units for t in u), np.int64, starts[-1]), starts


def term_rarity(texts: DataFrame) -> np.ndarray:
    """Inverse frequency of each bucket among the units of all texts (one column) and templates."""

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, found, total = _Buckets(), np.zeros((1 << BUCKET_BITS) + 1, np.int64), 0
        for frame in frames:
            units: list[list[str]] = []
            for n, text in enumerate(frame.column(0), 1):
                units += units_of(text.as_py() or "")
                if len(units) >= LOT_UNITS or n == len(frame):
                    total += len(units)
                    flat, starts = _flat(units, buckets)
                    own = np.repeat(np.arange(len(units)), np.diff(starts)) << BUCKET_BITS | flat
                    found += np.bincount(np.unique(own) & (1 << BUCKET_BITS) - 1, minlength=len(found))
                    units = []
        found[-1] = total
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["bucket", "n"])
        release_memory()

    counts = np.zeros((1 << BUCKET_BITS) + 1)
    # At most one row for each bucket.
    rows = texts.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    total, counts = counts[-1], counts[:-1]
    for _, terms in _templates():
        counts[sorted({_Buckets()[t] for t in terms})] += 1
        total += 1
    return np.log((total + 1) / (counts + 1)) + 1


def _templates() -> list[tuple[str, list[str]]]:
    return [(name, _TERM.findall(text.lower())) for name, texts in TEMPLATES.items() for text in texts]


class Templates:
    """Weights of all templates under given rarities of terms, each of length one."""

    def __init__(self, rarity: np.ndarray):
        self.rarity = rarity
        templates = _templates()
        self.names = [name for name, _ in templates]
        buckets = _Buckets()
        known = sorted({buckets[t] for _, terms in templates for t in terms})
        self.row = np.zeros(len(rarity), np.int32)  # of a bucket; 0 is in no template
        self.row[known] = np.arange(1, len(known) + 1)
        self.weights = np.zeros((len(known) + 1, len(templates)))
        for k, (_, terms) in enumerate(templates):
            for term in terms:
                self.weights[self.row[buckets[term]], k] += 1
        self.weights[1:] *= rarity[known][:, None]
        self.weights /= np.sqrt((self.weights**2).sum(0))
        # Ties go to the first by name.
        self.order = np.argsort(np.array(self.names), kind="stable")

    def passages(self, units: list[list[str]], whole: bool, buckets: _Buckets) -> list[tuple[int, int, str, float]]:
        """(lo, n, license, score) of all windows of ``MIN_COSINE`` or more, and of the whole if
        that is asked for."""
        found: dict[tuple[int, int], tuple[int, int, str, float]] = {}
        step = LOT_UNITS - max(WINDOWS)
        for first in range(0, max(1, len(units) - max(WINDOWS)), step):
            for lo, n, name, score in self._stretch(units[first : first + LOT_UNITS], whole and len(units) <= LOT_UNITS, buckets):
                found[first + lo, n] = (first + lo, n, name, score)
        return [found[k] for k in sorted(found)]

    def _stretch(self, units: list[list[str]], whole: bool, buckets: _Buckets) -> Iterator[tuple[int, int, str, float]]:
        flat, starts = _flat(units, buckets)
        if not len(units):
            return
        weight = self.rarity[flat]
        rows = self.row[flat]
        known = np.flatnonzero(rows)
        if not len(known):
            return
        # Products with the templates, and a lower bound of the squared length, summed up to each unit.
        each = self.weights[rows[known]] * weight[known, None]
        sums = np.vstack((np.zeros((1, each.shape[1])), np.cumsum(each, 0)))[np.searchsorted(known, starts)]
        least = np.concatenate(([0.0], np.cumsum(weight * weight)))[starts]
        sizes = sorted({n for n in WINDOWS if n <= len(units)} | ({len(units)} if whole else set()))
        for n in sizes:
            best = (sums[n:] - sums[:-n]).max(1)
            for lo in np.flatnonzero(best >= (MIN_COSINE - 1e-6) * np.sqrt(least[n:] - least[:-n])).tolist():
                own, times = np.unique(flat[starts[lo] : starts[lo + n]], return_counts=True)
                length = np.sqrt(((times * self.rarity[own]) ** 2).sum())
                scores = np.round(np.minimum(1.0, (sums[lo + n] - sums[lo]) / length), 9)[self.order]
                top = int(scores.argmax())
                if scores[top] >= MIN_COSINE:
                    yield lo, n, self.names[self.order[top]], float(scores[top])

    def judge(self, text: str | None, buckets: _Buckets) -> tuple:
        """A row of ``JUDGED``: the license of the best passage, and the words in any passage."""
        text = text or ""
        units, words = units_of(text), len(text.encode().split())
        passages = self.passages(units, words <= WHOLE_WORDS, buckets)
        if not passages:
            return None, None, 0, words, []
        best: dict[str, float] = {}
        for _, _, name, score in passages:
            best[name] = max(score, best.get(name, 0.0))
        for more, less in INCLUDES.items():
            if more in best:
                best.pop(less, None)
        name = min(best, key=lambda x: (-best[x], x))
        covered = {u for lo, n, _, _ in passages for u in range(lo, lo + n)}
        return name, best[name], sum(len(units[u]) for u in covered), words, passages


def judge_files(files: DataFrame, text: str = "text") -> DataFrame:
    """``files`` with ``_judged`` (``JUDGED``): the license of each by its own text. One scan for
    the rarity of terms, and one to score; no text is shuffled or written."""
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(Templates(term_rarity(files.select(F.col(text).cast("string").alias("text")))))

    @F.pandas_udf(JUDGED)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for batch in batches:
            rows = [shared.value.judge(t, buckets) for t in batch]
            frame = pd.DataFrame(rows, columns=[f.name for f in JUDGED.fields])
            frame["passages"] = [[dict(zip(("lo", "n", "license", "score"), p, strict=True)) for p in r[4]] for r in rows]
            yield frame
        release_memory()

    return files.withColumn("_judged", judged.asNondeterministic()(F.col(text).cast("string")))


def scan_licenses(
    files: DataFrame, scratch: Scratch, path: str = "path", text: str = "text", keep_text: bool = True
) -> DataFrame:
    """``files`` with license, score, own (boolean), license_dir and passages, replacing such
    columns; without their texts if these are not to be kept.

    A passage is a window (``WINDOWS``) of consecutive lines or pieces of long ones, or a short file;
    it has a license if its cosine is ``MIN_COSINE`` or more, and the file's is that of its best
    passage (ties by name; one that includes another goes before it). ``passages`` lists all of
    them, by the first line and the number of lines. A licence file speaks for the
    directory it is in: the best score, then the name. Files
    without a license take that of the nearest directory above; ``license_dir`` names it, and
    ``own`` is false. Without any, license is null and score 0. Null texts are empty; a file with
    a null path is in no directory. Repeated rows are files of their own, each judged by its own
    text. Long texts are scored in stretches of bounded size; an empty table gives no rows.
    """
    made = ("license", "score", "own", "license_dir", "passages")
    others = [c for c in files.columns if c not in made and (keep_text or c != text)]
    judged = scratch.cut(judge_files(files, text).select(*others, "_judged"), "judged")

    name = F.element_at(F.split(F.col(path), "/"), -1)
    directory = F.regexp_replace(F.col(path), r"/?[^/]*$", "")
    speaks = name.rlike(LICENSE_FILE) | (F.col("_judged.spoken") >= FILE_SHARE * F.col("_judged.words"))
    own = judged.filter(F.col("_judged.license").isNotNull() & F.col(path).isNotNull() & speaks)
    heads = F.min(F.struct((-F.col("_judged.score")).alias("minus"), F.col("_judged.license").alias("license")))
    directories = own.groupBy(directory.alias("dir")).agg(heads.alias("d"))

    # Path join: each directory that holds files, with all directories above it.
    holding = judged.filter(F.col(path).isNotNull()).select(directory.alias("of")).distinct()
    parts = F.split("of", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))
    nearest = (
        holding.select("of", F.explode(F.array_distinct(above)).alias("a"))
        .select("of", "a.depth", "a.dir")
        .join(directories, "dir")
        .groupBy("of")
        .agg(F.max(F.struct("depth", "dir", "d")).alias("n"))
    )
    nearest = nearest.select(
        F.col("of").alias("_of"), F.col("n.dir").alias("_dir"), F.col("n.d.license").alias("_given"), (-F.col("n.d.minus")).alias("_given_score")
    )
    rows = judged.withColumn("_in", directory).join(nearest, F.col("_in") == F.col("_of"), "left")
    has = F.col("_judged.license").isNotNull()
    return rows.select(
        *others,
        F.coalesce("_judged.license", "_given").alias("license"),
        F.coalesce("_judged.score", "_given_score", F.lit(0.0)).alias("score"),
        has.alias("own"),
        F.when(~has, F.col("_dir")).alias("license_dir"),
        F.col("_judged.passages").alias("passages"),
    )


def license_query(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: a source's are in a directory for each language. Null sources and
    languages are empty names; the result has a row for every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    place = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string"))
    files = docs.select("doc_id", place.alias("path"), "text")
    found = scan_licenses(files, Scratch(spark), keep_text=False)
    return found.select("doc_id", "path", "license", F.round("score", 6).alias("score"), "own", "license_dir")
