"""Licence scans: MinHash bands over overlapping text windows retrieve templates, containment decides.

Words are lower-cased runs of letters and digits, shingles five words. Windows of W = 8, 16, 32, ... shingles start every
W / 2 shingles; a template of m shingles belongs to the first W with m <= W / 2 + 1, so any run of m shingles lies
inside one of its windows. Such a window has a Jaccard similarity of at least 1 / 8 with the template it holds, and with
``BANDS`` bands of one MinHash value each the two share a value with a probability of at least
1 - (7 / 8) ** 128 > 0.9999999; of a template cut in two by other words the half with a sixteenth does with
0.9997. Values are computed for all windows, a wider window's from its halves'. Of a retrieved template the distinct
shingles in the window and half a window on both sides are compared: ``CONTAINMENT`` of its own must be there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkernel as K
from .shared import only

SHINGLE, BANDS, CONTAINMENT = 5, 128, 0.8
#: Templates go to all workers: their bytes at most.
TEMPLATE_BYTES = 16 << 20
#: Templates of one width up to which each is compared with every window; beyond, a band's sorted values are searched.
FEW = 16

#: The names and wordings that licences themselves prescribe.
TEMPLATES = {
    "MIT-declared": "Released under the MIT License.",
    "Apache-2.0-declared": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-declared": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-declared": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-declared": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-declared": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "GPL-disclaimer": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles, each text's first shingle (n + 1), and every word's start and end.
    A text of fewer words, but not none, has one shingle of them all."""
    low = K.LOWER[data]
    s, e, first = K.words(low, off, K.ALNUM)
    h = K.word_hashes(low, s, e)
    count = np.diff(first)
    m = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    cut = np.concatenate([[0], np.cumsum(m)])
    doc = np.repeat(np.arange(len(m)), m)
    at = first[doc] + np.arange(len(doc)) - cut[doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(1, SHINGLE + 1):
        mine = np.minimum(count, SHINGLE)[doc] == k
        if mine.any():
            out[mine] = K.ngram_hashes(h, k)[at[mine]]
    return out, cut, s, e


class Templates:
    def __init__(self, texts: dict[str, str]):
        data, off = K.text_buffer(pa.array(list(texts.values()), pa.string()))
        g, cut, _, _ = shingles(data, off)
        self.names = list(texts)
        self.sets = [np.unique(g[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
        seeds = K.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)
        self.seeds = [(a, b | np.uint64(1)) for a, b in seeds.T]
        self.values = np.array([[((x ^ a) * b).min() if len(x) else 0 for a, b in self.seeds] for x in self.sets], np.uint64).reshape(len(self.sets), BANDS)
        self.width: dict[int, list[int]] = {}
        for k, n in enumerate(np.diff(cut).tolist()):
            w = 8
            while n > w // 2 + 1:
                w *= 2
            if n:
                self.width.setdefault(w, []).append(k)
        # the band index: of each width and band the templates' values in order, and whose they are
        self.order = {w: np.argsort(self.values[members], axis=0, kind="stable") for w, members in self.width.items()}
        self.sorted = {w: np.take_along_axis(self.values[members], self.order[w], axis=0) for w, members in self.width.items()}

    def _search(self, w: int, band: int, window: np.ndarray) -> np.ndarray:
        """The template's place among its width's and the window, as one number, of every equal value."""
        order, values, found = self.order[w][:, band], self.sorted[w][:, band], [np.zeros(0, np.int64)]
        at = np.searchsorted(values, window)
        here = np.flatnonzero((at < len(values)) & (values[np.minimum(at, len(values) - 1)] == window))
        at = at[here]
        while len(here):  # once for each of the templates that share a value
            found.append(order[at] * len(window) + here)
            at += 1
            more = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] == window[here])
            at, here = at[more], here[more]
        return np.concatenate(found)

    def _retrieve(self, g: np.ndarray) -> dict[int, list[np.ndarray]]:
        """Of each width the windows (numbers along all texts, a new one every half window) and templates that share a band."""
        last = max(self.width, default=8)
        n = -(-len(g) // last) * last
        padded = np.concatenate([g, np.repeat(g[-1:], n - len(g))])  # repeats change no minimum
        hit = {w: np.zeros((len(members), 2 * n // w), bool) for w, members in self.width.items() if len(members) <= FEW}
        pairs: dict[int, np.ndarray] = {w: np.zeros(0, np.int64) for w in self.width if w not in hit}
        for band, (a, b) in enumerate(self.seeds):
            half, w = ((padded ^ a) * b).reshape(-1, 4).min(axis=1), 8
            while w <= last:
                if w in self.width:
                    window = np.minimum(half, np.append(half[1:], half[-1:]))
                    if w in hit:
                        for row, k in enumerate(self.width[w]):
                            hit[w][row] |= window == self.values[k, band]
                    else:
                        pairs[w] = np.union1d(pairs[w], self._search(w, band, window))
                half, w = half.reshape(-1, 2).min(axis=1) if w < last else half, 2 * w
        out = {w: [np.flatnonzero(row) for row in rows] for w, rows in hit.items()}
        for w, own in pairs.items():
            row, window = np.divmod(own, 2 * n // w)
            out[w] = np.split(window, np.searchsorted(row, np.arange(1, len(self.width[w]))))
        return {w: out[w] for w in self.width}

    def scan(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """(text, template, containment, first and last byte of the shared words) of every matching place: retrieved
        windows that overlap are one place."""
        g, cut, s, e = shingles(data, off)
        if not len(g):
            return
        first_word = np.searchsorted(s, off)
        for w, found in self._retrieve(g).items():
            for k, windows in zip(self.width[w], found, strict=True):
                if not len(windows):
                    continue
                # half a window on both sides, joined where they meet, cut where texts end
                lo, hi = np.maximum(windows * (w // 2) - w // 2, 0), np.minimum(windows * (w // 2) + w + w // 2, len(g))
                new = np.concatenate([[True], lo[1:] > hi[:-1]])
                for a, b in zip(lo[new].tolist(), hi[np.append(new[1:], True)].tolist(), strict=True):
                    here = a + np.flatnonzero(np.isin(g[a:b], self.sets[k]))
                    text = np.searchsorted(cut, here, side="right") - 1
                    for t in np.unique(text).tolist():
                        at = here[text == t]
                        share = len(np.unique(g[at])) / len(self.sets[k])
                        if share >= CONTAINMENT:
                            word = first_word[t] + (at - cut[t])
                            last = min(int(word[-1]) + SHINGLE, int(first_word[t + 1])) - 1
                            yield t, k, share, int(s[word[0]] - off[t]), int(e[last] - off[t])


def _send(docs: DataFrame, templates: dict[str, str] | None):
    some = templates or TEMPLATES
    if sum(len(x.encode()) for x in some.values()) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes aren't sent to all workers")
    return docs.sparkSession.sparkContext.broadcast(Templates(some))


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each place of each text that holds a template: doc_id, license, containment, byte_start, byte_end
    (of the shared words in the text's UTF-8).

    A null or empty text has none, nor does an empty table; repeated rows and null ids stay rows of their own; templates
    that hold the same words all match (ties are all told). ``templates``: at most ``TEMPLATE_BYTES`` of text."""
    sent = _send(docs, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            data, off = K.text_buffer(b.column(1))
            rows = []
            for lo, hi in K.chunks(off):
                rows += [(lo + r[0], own.names[r[1]], *r[2:]) for r in own.scan(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])]
            doc, name, share, frm, to = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield pa.record_batch([b.column(0).take(pa.array(doc, pa.int64())), pa.array(name, pa.string()), pa.array(share, pa.float64()), pa.array(frm, pa.int64()), pa.array(to, pa.int64())], names=["doc_id", "license", "containment", "byte_start", "byte_end"])

    src = only(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, license string, containment double, byte_start long, byte_end long")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """Of every row: doc_id, licenses (sorted, comma-joined), n_licenses, containment (the largest; 0 without any).

    A null or empty text has none; repeated rows and null ids stay rows of their own, an empty table gives no rows."""
    sent = _send(docs, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            data, off = K.text_buffer(b.column(1))
            found: list[dict[str, float]] = [{} for _ in range(b.num_rows)]
            for lo, hi in K.chunks(off):
                for text, t, share, _, _ in own.scan(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]):
                    at = found[lo + text]
                    at[own.names[t]] = max(share, at.get(own.names[t], 0.0))
            yield pa.record_batch([b.column(0), pa.array([",".join(sorted(x)) for x in found], pa.string()), pa.array([len(x) for x in found], pa.int64()), pa.array([max(x.values(), default=0.0) for x in found], pa.float64())], names=["doc_id", "licenses", "n_licenses", "containment"])

    src = only(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, licenses string, n_licenses long, containment double")
