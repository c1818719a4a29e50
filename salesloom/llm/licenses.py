"""Licence texts in documents by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import Words, by_size, mix, spread, stream, table

THRESHOLD = 0.8
PLACE = stream(61, 2)
#: Bytes between words: ASCII other than letters and digits.
NO_WORD = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])

# Notices as licence texts state them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
}

_GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, {}."
_LATER = "either version {} of the License, or (at your option) any later version"
for _name, _gnu, _subject in (("GPL-2.0", "General Public License", "This program"), ("GPL-3.0", "General Public License", "This program"), ("LGPL-2.1", "Lesser General Public License", "This library"), ("LGPL-3.0", "Lesser General Public License", "This library"), ("AGPL-3.0", "Affero General Public License", "This program")):
    _version = _name.split("-")[1].removesuffix(".0")
    TEMPLATES[f"{_name}-notice"] = f"This work is licensed under the GNU {_gnu}, version {_version}."
    TEMPLATES[f"{_name}-or-later"] = f"{_subject} is free software: {_GNU.format(_gnu, _LATER.format(_version))}"
    TEMPLATES[f"{_name}-only"] = f"{_subject} is free software: {_GNU.format(_gnu, f'version {_version} of the License')}"
for _name, _kind in (("CC-BY-SA-4.0", "Attribution-ShareAlike 4.0"), ("CC-BY-NC-4.0", "Attribution-NonCommercial 4.0"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives 4.0")):
    TEMPLATES[f"{_name}-notice"] = f"This work is licensed under a Creative Commons {_kind} International License."
TEMPLATES["EPL-2.0"] = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
TEMPLATES["BSD-3-Clause"] = TEMPLATES["BSD-2-Clause"] + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    " IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES["BSD-2-Clause-text"], TEMPLATES["BSD-3-Clause-text"] = TEMPLATES["BSD-2-Clause"] + _BSD_END, TEMPLATES["BSD-3-Clause"] + _BSD_END
TEMPLATES["MIT-text"] = TEMPLATES["MIT"] + (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
    " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
TEMPLATES["ISC-text"] = TEMPLATES["ISC"] + (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
    " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEMPLATES |= {f"{x.stem}-text": x.read_text(encoding="utf-8") for x in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def bigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the rows' adjacent word pairs, words being A-Z lower-cased runs of letters and digits."""
    w = Words(texts, fold=True, blank=NO_WORD)
    pair = mix(w.hashes[:-1] * PLACE[0] + w.hashes[1:] * PLACE[1]) if len(w.hashes) > 1 else np.zeros(0, np.uint64)
    n = np.maximum(np.diff(w.bounds) - 1, 0)
    keep = np.ones(len(pair), bool)
    cut = w.bounds[1:-1] - 1
    keep[cut[(cut >= 0) & (cut < len(pair))]] = False
    return pair[keep], np.concatenate([[0], np.cumsum(n)])


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes a passage may have to reach the threshold against n bigrams: 2 * min / (n + m) >= threshold."""
    return max(1, math.ceil(n * threshold / (2 - threshold) - 1e-9)), math.floor(n * (2 - threshold) / threshold + 1e-9)


def _passages(own: np.ndarray, places: np.ndarray, template: Counter, threshold: float) -> list[tuple[float, int, int]]:
    """(dice, first, size) of the best passages that do not overlap, among those that begin and end with a template's bigram.

    A passage's outer bigrams that the template lacks only lower its score, so no passage is missed. places are
    the positions of the template's bigrams; a start is taken up only if enough of them lie within the size bounds.
    """
    n = sum(template.values())
    least, most = size_bounds(n, threshold)
    inside = np.searchsorted(places, places + most) - np.arange(len(places))
    h = own[places]
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    group, nth = spread(np.diff(np.append(new, len(h))))
    times = np.array([template[int(x)] for x in h[order][new]], np.int64)[group]
    past = np.full(len(h), -1)  # an occurrence counts from starts after this place on, as often as the template has the bigram
    past[order[nth >= times]] = order[np.arange(len(h)) - times][nth >= times]
    found = []
    for k in np.flatnonzero(2 * inside >= threshold * (n + least) - 1e-9):
        to = k + inside[k]
        size = places[k:to] - places[k] + 1
        dice = 2 * np.cumsum(past[k:to] < k) / (n + size)
        best = int(dice.argmax())
        if dice[best] >= threshold:
            found.append((float(dice[best]), int(places[k]), int(size[best])))
    out: list[tuple[float, int, int]] = []
    for x in sorted(found, key=lambda x: (-x[0], x[1])):
        if all(x[1] + x[2] <= y[1] or y[1] + y[2] <= x[1] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1])


def _best(rows: list[tuple], sizes: dict[str, int]) -> list[tuple]:
    """Of a row's overlapping passages (row, name, dice, first word, words) the one with most bigrams matched beyond those not matched."""

    def order(x: tuple) -> tuple:
        both = sizes[x[1]] + x[4] - 1
        return -(1.5 * x[2] - 1) * both, -x[2], x[3], x[1]  # 3 x common - both, common being dice x both / 2

    out: list[tuple] = []
    for x in sorted(rows, key=order):
        if all(x[3] + x[4] <= y[3] or y[3] + y[4] <= x[3] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[3])


def _scan(templates: dict[str, str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for name, text in templates.items():
            own = bigrams(pa.array([text]))[0]
            if len(own):
                known[name] = Counter(own.tolist())
        sizes = {name: sum(c.values()) for name, c in known.items()}
        every = np.array(sorted({h for c in known.values() for h in c}), np.uint64)
        member = {name: np.isin(every, np.array(list(c), np.uint64)) for name, c in known.items()}
        for batch in by_size(batches, "text"):
            pairs, bounds = bigrams(batch.column("text"))
            i = np.minimum(np.searchsorted(every, pairs), max(len(every) - 1, 0))
            hits = np.flatnonzero(every[i] == pairs) if len(every) and len(pairs) else np.zeros(0, np.int64)
            row_of = np.searchsorted(bounds, hits, "right") - 1
            rows = []
            for name, c in known.items():
                mine = member[name][i[hits]]
                at, row = hits[mine], row_of[mine]
                least = size_bounds(sum(c.values()), threshold)[0]
                for r, count in zip(*np.unique(row, return_counts=True)):
                    if 2 * count >= threshold * (sum(c.values()) + least) - 1e-9:
                        for dice, first, size in _passages(pairs, at[row == r], c, threshold):
                            rows.append((int(r), name, dice, first - int(bounds[r]), size + 1))
            rows.sort(key=lambda x: x[0])
            rows = [x for _, of in groupby(rows, key=lambda x: x[0]) for x in _best(list(of), sizes)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], ["doc_id", "license", "dice", "first_word", "n_words"])

    return run


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, first_word, n_words): passages of a document that are a template but for some words.

    Templates and texts are compared as multisets of word bigrams, punctuation and ASCII case left out. Overlapping passages are
    reduced to the best, of one template by the coefficient, of several by the bigrams matched beyond those not matched. Null and empty
    texts, and templates of fewer than two words, give no rows; repeated rows repeat; other columns are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan(dict(templates), threshold), "doc_id long, license string, dice double, first_word long, n_words long")


def op3_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of all `documents`."""
    return find_licenses(table(spark, sf_dir, "documents"))
