"""License scan by an exact set-similarity join with license templates.

A text's words (A-Z lower-cased) are cut into blocks: windows of twice a
template's number of words, starting every such number, so that any passage as long as
the template lies in one block.  A block matches a template if it contains at
least ``threshold`` of the template's distinct words.  A notice of fewer than
``short`` distinct words has to be there with all of them: each word of a short
notice may be the one that tells its license from others.  The join is exact:

* order: the template words by their frequency in the whole corpus, rarest first;
* prefix filter: a matching block has one of a template's first
  |T| - needed + 1 words, so only blocks around these are looked at;
* length filter: a block with fewer template words than needed is skipped;
* positional filter: a common word at places i and j of the two ordered sets
  leaves at most min(|T| - i, |B| - j) common words;
* the overlap of the remaining pairs is counted in full.

The texts are read once: the positions of template words are stored, the
frequencies are a grouped count of them, and the join runs on the stored rows.
The templates (and so the index in each task) are a parameter, not data; their
number of words is checked.

Edge cases: NULL text has no words; labels of texts without a match are the
empty string and the score is the best containment of any block that passed the
filters, else 0; repeated rows are scanned one by one; empty tables give empty
results.  Very long texts are one value in one task; templates of one label match as one, and
ties of the word frequency are broken by the words' order in the templates; further columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Phrases and labels of the base search.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Texts and notices of public licences, by label (a label may have several).
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
            "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                   "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                         "or (at your option) any later version."),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                         "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                         "or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
            "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
            "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
            "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
            "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
            "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
            "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
            "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
            "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
            "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
            "SOFTWARE."),
)
#: Notices with fewer distinct words must be there in full.
SHORT = 45
MOST_WORDS = 20_000
#: Word characters: digits, letters (A-Z become a-z) and everything that isn't ASCII.
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def phrase_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> dict[str, list[int]]:
    """For each label the word numbers at which one of its phrases starts."""
    joined, out = b" " + b" ".join(words) + b" ", defaultdict(list)
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = joined.find(wanted)
        while at >= 0:
            out[label].append(joined.count(b" ", 0, at))
            at = joined.find(wanted, at + 1)
    return out


_TOKENS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
           "places array<int>, tokens array<int>")


def _read(vocabulary: dict[bytes, int], phrases: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            counts, found, places, tokens = [], [], [], []
            for raw in batch.column(1):
                words = words_of(raw.as_buffer().to_pybytes())
                of = np.fromiter((number(w, -1) for w in words), np.int32, len(words))
                at = np.flatnonzero(of >= 0)
                counts.append(len(words))
                found.append(phrase_places(words, phrases))
                places.append(at.astype(np.int32))
                tokens.append(of[at])
            starts = [[p for x in f.values() for p in x] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(map(len, starts), pa.int64()),
                 pa.array([min(s, default=None) for s in starts], pa.int64()), pa.array([max(s, default=None) for s in starts], pa.int64()),
                 pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                 pa.array(places, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "places", "tokens"])
    return run


class TemplateIndex:
    """The templates as ordered sets with an inverted index of their prefixes, by block size."""

    def __init__(self, templates: list[tuple[str, int, list[int]]], rank: np.ndarray, threshold: float, short: int = SHORT):
        """Templates: label, number of words, distinct word numbers; rank: of each word number, rarest first."""
        self.rank = rank
        self.labels = [t[0] for t in templates]
        self.sets = [sorted(int(rank[w]) for w in t[2]) for t in templates]
        self.need = [len(s) if len(s) < short else max(1, math.ceil(threshold * len(s) - 1e-9)) for s in self.sets]
        self.sizes = defaultdict(lambda: defaultdict(list))       # block step -> word -> (template, place)
        for t, (_, n, _) in enumerate(templates):
            for i, w in enumerate(self.sets[t][:len(self.sets[t]) - self.need[t] + 1]):
                self.sizes[n][w].append((t, i))

    def matches(self, places: np.ndarray, tokens: np.ndarray) -> tuple[set[str], float]:
        """The labels of matching templates and the best containment seen."""
        labels, best = set(), 0.0
        ranks = self.rank[tokens]
        for step, index in self.sizes.items():
            near = places[np.isin(ranks, np.fromiter(index, np.int64, len(index)))] // step
            if not len(near):
                continue
            blocks = np.unique(np.concatenate([near, near - 1]))
            blocks = blocks[blocks >= 0]
            low, high = np.searchsorted(places, blocks * step), np.searchsorted(places, (blocks + 2) * step)
            for a, b in zip(low.tolist(), high.tolist()):
                block = np.unique(ranks[a:b]).tolist()
                candidates = set()
                for j, w in enumerate(block):
                    for t, i in index.get(w, ()):
                        if len(block) >= self.need[t] and t not in candidates and \
                                min(len(self.sets[t]) - i, len(block) - j) >= self.need[t]:
                            candidates.add(t)
                for t in candidates:
                    common = len(set(block).intersection(self.sets[t]))
                    best = max(best, common / len(self.sets[t]))
                    if common >= self.need[t]:
                        labels.add(self.labels[t])
        return labels, best


def _join(index: TemplateIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = [], []
            for places, tokens, base in zip(*(batch.column(c) for c in (5, 6, 7))):
                found, score = index.matches(places.values.to_numpy(), tokens.values.to_numpy()) if len(places) else (set(), 0.0)
                labels.append(",".join(sorted(found.union(base.as_py()))))
                scores.append(score)
            base = [",".join(x) for x in batch.column(7).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases: dict[str, str] = PHRASES,
                  threshold: float = 0.8, short: int = SHORT) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels (base and template labels) and score (the best containment of a template)."""
    split = [(label, words_of(text.encode())) for label, text in templates]
    vocabulary: dict[bytes, int] = {}
    numbered = [(label, len(words), sorted({vocabulary.setdefault(w, len(vocabulary)) for w in words})) for label, words in split]
    if len(vocabulary) > MOST_WORDS:
        raise ValueError(f"the templates have {len(vocabulary)} distinct words; the index in each task holds at most {MOST_WORDS}")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    rows = stored(rows.mapInArrow(_read(vocabulary, phrases), _TOKENS), "license-tokens")
    counts = rows.select(F.explode("tokens").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()  # <= vocabulary
    frequency = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        frequency[r["w"]] = r["n"]
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((np.arange(len(vocabulary)), frequency))] = np.arange(len(vocabulary))
    index = TemplateIndex(numbered, rank, threshold, short)
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "places", "tokens", "base_labels").mapInArrow(
        _join(index), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                      "labels string, score double")
