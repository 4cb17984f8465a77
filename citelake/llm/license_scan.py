"""License scan by patience alignment (operator 10).

Words are compared in lower case, letters and digits only. A document becomes a candidate for a
template if it holds enough of the template's distinct words close together; that stretch is aligned:
common ends are cut off, words that occur once in both texts become anchors, the longest increasing
subsequence of their places is kept, and the gaps between them are aligned in the same way. Gaps without
such words are settled by their longest common subsequence. ``coverage`` is the share of the template's
words that found a partner. Words that tell licenses apart (name, version, variant) must stand together in
the stretch (``NEEDED``), whatever the coverage. Of templates that fit the same stretch the one with the most
partners counts.

Templates are notices, headers and whole license texts (``licenses/`` holds the longer ones).

Defined results: null or blank texts match nothing; repeated rows are scanned per row; of several
stretches that fit a template the best counts, the first at a tie; an empty table or no templates give
no rows; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from citelake.llm.latent_retrieval import common_length
from citelake.llm.words import Words, byte_spans, chunk_words, chunks

COVERAGE = 0.8
SLACK = 2.0

DISCLAIMER = (
    "IN NO EVENT SHALL THE {holders} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution. {more}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
    'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
) + DISCLAIMER.format(holders="COPYRIGHT HOLDER OR CONTRIBUTORS")
ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization. "
)
ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the Software), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so{condition}. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
    "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted{condition}. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
    "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version."
)
BY = "This work is licensed under a Creative Commons {name} 4.0 International License."

TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Released under the MIT License.",
    "bsd-notice": "Released under the BSD License.",
    "bsd-2-clause-notice": "Licensed under the BSD 2-Clause License.",
    "bsd-3-clause-notice": "Licensed under the BSD 3-Clause License.",
    "isc-notice": "Licensed under the ISC License.",
    "zlib-notice": "Released under the zlib License.",
    "unlicense-notice": "Released under the Unlicense.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "epl-1.0-notice": "Licensed under the Eclipse Public License, Version 1.0.",
    "epl-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "cc-by-4.0-short-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0-notice": BY.format(name="Attribution"),
    "cc-by-sa-4.0": BY.format(name="Attribution-ShareAlike"),
    "cc-by-nd-4.0": BY.format(name="Attribution-NoDerivatives"),
    "cc-by-nc-4.0": BY.format(name="Attribution-NonCommercial"),
    "cc-by-nc-sa-4.0": BY.format(name="Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-nd-4.0": BY.format(name="Attribution-NonCommercial-NoDerivatives"),
    "mit": MIT.format(
        condition=", subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software"
    ),
    "mit-0": MIT.format(condition=""),
    "isc": ISC.format(
        condition=", provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "0bsd": ISC.format(condition=""),
    "bsd": BSD.format(more=""),
    "bsd-3-clause": BSD.format(more="3. " + ENDORSE),
    "bsd-4-clause": BSD.format(more=ADVERTISING + "4. " + ENDORSE),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "
        "AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "gpl-2.0": GNU.format(name="GNU General Public License", version="2"),
    "lgpl-2.1": GNU.format(name="GNU Lesser General Public License", version="2.1"),
    "lgpl-3.0": GNU.format(name="GNU Lesser General Public License", version="3"),
    "agpl-3.0": GNU.format(name="GNU Affero General Public License", version="3"),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "gpl-3.0": GNU.format(name="GNU General Public License", version="3"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at"
    ),
}

# Identifiers of the SPDX list, as tags in files name them.
SPDX = [
    "0BSD", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0",
    "CC0-1.0", "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "ISC", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
]
GNU_NAMES = [("gpl", "", "2"), ("gpl", "", "3"), ("lgpl", "Lesser ", "2.1"), ("lgpl", "Lesser ", "3"),
             ("agpl", "Affero ", "3")]


def other_spellings() -> tuple[dict[str, str], dict[str, tuple[str, ...]]]:
    """Tags, licenses named by their identifier or in short, and versions with their ".0"; each with the
    words that must stand together."""
    texts, together = {}, {}
    for name in SPDX:
        texts[f"{name.lower()}-spdx"] = f"SPDX-License-Identifier: {name}"
        together[f"{name.lower()}-spdx"] = (f"SPDX-License-Identifier: {name}",)
        if name.startswith("CC-"):  # others are words of their own or written as notices
            texts[f"{name.lower()}-id-notice"] = f"Licensed under {name}."
            together[f"{name.lower()}-id-notice"] = (f"under {name}",)
    for short, which, version in GNU_NAMES:
        for form in (f"{short.upper()} v{version}", f"{short.upper()}v{version}"):
            name = f"{short}-{version if '.' in version else version + '.0'}-{'short' if ' ' in form else 'joined'}-notice"
            texts[name] = f"Licensed under the {form}."
            together[name] = (f"under the {form}",)
        if "." not in version:
            name = f"{short}-{version}.0-full-notice"
            texts[name] = f"GNU {which}General Public License, version {version}.0."
            together[name] = (f"GNU {which}General Public License", f"version {version}.0")
    return texts, together


_texts, _together = other_spellings()
TEMPLATES.update(_texts)

# What must stand together in a stretch.
NEEDED = {
    **_together,
    "all-rights-reserved": ("all rights reserved",),
    "mit-notice": ("MIT License",),
    "bsd-notice": ("BSD License",),
    "bsd-2-clause-notice": ("BSD 2-Clause",),
    "bsd-3-clause-notice": ("BSD 3-Clause",),
    "isc-notice": ("ISC License",),
    "zlib-notice": ("zlib License",),
    "unlicense-notice": ("under the Unlicense",),
    "apache-2.0-notice": ("Apache License", "2.0"),
    "mpl-2.0-notice": ("Mozilla Public License", "2.0"),
    "epl-1.0-notice": ("Eclipse Public License", "1.0"),
    "epl-2.0-notice": ("Eclipse Public License", "2.0"),
    "cc0-1.0-notice": ("CC0 1.0",),
    "cc-by-4.0-short-notice": ("CC BY 4.0",),
    **{f"cc-by-{x}-4.0-notice": (f"CC BY-{x} 4.0",) for x in ("sa", "nd", "nc", "nc-sa", "nc-nd")},
    "cc-by-4.0-notice": ("Creative Commons Attribution 4.0",),
    "cc-by-sa-4.0": ("Attribution-ShareAlike 4.0",),
    "cc-by-nd-4.0": ("Attribution-NoDerivatives 4.0",),
    "cc-by-nc-4.0": ("Attribution-NonCommercial 4.0",),
    "cc-by-nc-sa-4.0": ("Attribution-NonCommercial-ShareAlike 4.0",),
    "cc-by-nc-nd-4.0": ("Attribution-NonCommercial-NoDerivatives 4.0",),
    **{
        f"{x}-{version}.0{y}".replace("2.1.0", "2.1"): (f"GNU {name}General Public License", f"version {version}")
        for x, name, version in GNU_NAMES
        for y in ("", "-notice")
    },
    "mit": ("permission notice shall be included",),
    "isc": ("appear in all copies",),
    "bsd-3-clause": ("endorse or promote",),
    "bsd-4-clause": ("advertising materials", "endorse or promote"),
    "apache-2.0": ("Apache License", "2.0"),
    "mpl-2.0": ("Mozilla Public License", "2.0"),
    "apache-2.0-text": ("Apache License Version 2.0",),
    "cc0-1.0-text": ("CC0 1.0 Universal",),
    "gpl-2.0-text": ("GNU General Public License Version 2",),
    "gpl-3.0-text": ("GNU General Public License Version 3",),
    "lgpl-2.1-text": ("GNU Lesser General Public License Version 2.1",),
    "lgpl-3.0-text": ("GNU Lesser General Public License Version 3",),
    "mpl-2.0-text": ("Mozilla Public License Version 2.0",),
}


def whole_texts() -> dict[str, str]:
    """The license texts beside this module; read by the driver."""
    found = {}
    for path in (Path(__file__).parent / "licenses").glob("*.txt"):
        name = path.stem.lower()
        found[f"{name}{'' if '.' in name else '.0'}-text"] = path.read_text(encoding="utf-8")
    return found


_kept = np.zeros(256, dtype=bool)
_kept[[32, *range(9, 14), *range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def plain_words(body: np.ndarray, places: np.ndarray) -> Words:
    """Words of letters and digits; what is between blanks and has none is no word."""
    kept = _kept[body]
    before = np.concatenate([[0], np.cumsum(kept)])
    return chunk_words(body[kept], before[places])


def align(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """How many words of ``a`` find a partner in ``b``, in order, and the part of ``b`` they lie in."""
    matched, work = 0, [(0, len(a), 0, len(b))]
    low, high = len(b), 0
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            low, high = min(low, b0), max(high, b0 + 1)
            a0, b0, matched = a0 + 1, b0 + 1, matched + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            low, high = min(low, b1 - 1), max(high, b1)
            a1, b1, matched = a1 - 1, b1 - 1, matched + 1
        if a0 == a1 or b0 == b1:
            continue
        anchors = anchor_chain(a, b, a0, a1, b0, b1)
        if not anchors:
            more = common_length(a[a0:a1], b[b0:b1])
            if more:
                matched, low, high = matched + more, min(low, b0), max(high, b1)
            continue
        at_a, at_b = a0, b0
        for i, j in anchors:
            work.append((at_a, i, at_b, j))
            at_a, at_b, matched = i + 1, j + 1, matched + 1
        low, high = min(low, anchors[0][1]), max(high, anchors[-1][1] + 1)
        work.append((at_a, a1, at_b, b1))
    return matched, min(low, high), high


def anchor_chain(a, b, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Words once in both stretches, of which the longest run with rising places in both."""
    once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    place = {w: j for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
    pairs = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in place]
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[pile], piles[pile] = j, n
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def stretches(at: np.ndarray, word: np.ndarray, length: int, wanted: int) -> list[tuple[int, int]]:
    """Spans of at most SLACK times the template around its words, each with ``wanted`` distinct ones."""
    found, reach, left = [], int(SLACK * length) + 4, 0
    held: Counter = Counter()
    for right in range(len(at)):
        held[word[right]] += 1
        while at[right] - at[left] >= reach:
            held[word[left]] -= 1
            if not held[word[left]]:
                del held[word[left]]
            left += 1
        if len(held) >= wanted:
            span = (int(at[left]), int(at[right]) + 1)
            if found and found[-1][0] == span[0]:
                found[-1] = span
            else:
                found.append(span)
    return found


def fewest(times: np.ndarray, coverage: float) -> int:
    """Distinct words that a stretch of this coverage holds at least, by how often the template has each."""
    spare = int(times.sum()) - int(np.ceil(coverage * times.sum() - 1e-9))
    return max(1, len(times) - int(np.searchsorted(np.cumsum(np.sort(times)), spare, side="right")))


def holds(words: list[int], phrase: list[int]) -> bool:
    n = len(phrase)
    return any(words[i : i + n] == phrase for i, w in enumerate(words) if w == phrase[0])


def best_apart(fits: list[tuple]) -> list[tuple]:
    """Of (template, share, matched, start, end), those that no better one shares half a stretch with."""
    kept: list[tuple] = []
    for fit in sorted(fits, key=lambda x: (-x[2], -x[1], x[3], x[0])):
        _, _, _, start, end = fit
        if all(2 * (min(end, b) - max(start, a)) < min(end - start, b - a) for _, _, _, a, b in kept):
            kept.append(fit)
    first: dict[int, tuple] = {}
    for fit in kept:
        first.setdefault(fit[0], fit)
    return [first[j] for j in sorted(first)]


def scan_licenses(
    documents: DataFrame,
    templates: dict[str, str] | None = None,
    key: str = "doc_id",
    text: str = "text",
    coverage: float = COVERAGE,
    needed: dict[str, tuple[str, ...]] = NEEDED,
) -> DataFrame:
    """``key``, ``license``, ``coverage``, ``matched``, ``start``, ``end`` (in words of letters and digits)
    for each document and template that it covers."""
    templates = {**TEMPLATES, **whole_texts()} if templates is None else templates
    names = sorted(templates)
    body, places = byte_spans(pa.array([templates[n] for n in names], pa.string()))
    found = plain_words(body, places)
    wanted = [found.of(i) for i in range(len(names))]
    vocabulary = np.unique(found.hashes)
    member = np.zeros((len(vocabulary), len(names)), dtype=np.int32)
    for i, words in enumerate(wanted):
        member[np.searchsorted(vocabulary, words), i] = 1
    least = np.array(
        [fewest(np.unique(words, return_counts=True)[1], coverage) for words in wanted], dtype=np.int64
    )
    phrases = []
    for name in names:
        parts = plain_words(*byte_spans(pa.array(list(needed.get(name, ())), pa.string())))
        phrases.append([parts.of(i).tolist() for i in range(len(needed.get(name, ())))])
    lists = [w.tolist() for w in wanted]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            body, places = byte_spans(batch.column(1))
            for first, last in chunks(places) if len(vocabulary) else ():
                at = places[first]
                words = plain_words(body[at : places[last]], places[first : last + 1] - at)
                where = np.searchsorted(vocabulary, words.hashes)
                where[where == len(vocabulary)] = 0
                hit = np.flatnonzero(vocabulary[where] == words.hashes)
                owner = np.searchsorted(words.places, hit, side="right") - 1
                known = where[hit]
                pair = np.unique(owner * len(vocabulary) + known)
                counts = np.zeros((last - first, len(names)), dtype=np.int64)
                np.add.at(counts, pair // len(vocabulary), member[pair % len(vocabulary)])
                fits: dict[int, list[tuple]] = {}
                for document, j in zip(*np.nonzero(counts >= least), strict=True):
                    own = words.of(document).tolist()
                    if not all(holds(own, phrase) for phrase in phrases[j]):
                        continue
                    a, b = np.searchsorted(owner, [document, document + 1])
                    use = member[known[a:b], j] == 1
                    spots = hit[a:b][use] - words.places[document]
                    n = len(lists[j])
                    left = stretches(spots, known[a:b][use], n, int(least[j]))
                    while left:
                        low, high = left.pop()
                        if high - low < coverage * n:
                            continue
                        matched, begin, end = align(lists[j], own[low:high])
                        if matched < coverage * n:
                            continue
                        begin, end = low + begin, low + end
                        if all(holds(own[begin:end], phrase) for phrase in phrases[j]):
                            fits.setdefault(int(document), []).append((int(j), matched / n, matched, begin, end))
                        left += [(low, begin), (end, high)]  # another copy may stand beside this one
                for document, own_fits in sorted(fits.items()):
                    for j, *fit in best_apart(own_fits):
                        rows.append((first + document, names[j], *fit))
            column = list(zip(*rows, strict=True)) if rows else [[] for _ in range(6)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(column, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(arrays[0]), *arrays[1:]],
                names=[key, "license", "coverage", "matched", "start", "end"],
            )

    fields = [
        documents.schema[key],
        T.StructField("license", T.StringType()),
        T.StructField("coverage", T.DoubleType()),
        *[T.StructField(n, T.LongType()) for n in ("matched", "start", "end")],
    ]
    return documents.select(key, text).mapInArrow(scan, T.StructType(fields))
