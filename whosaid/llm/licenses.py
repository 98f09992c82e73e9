"""Operator 6: license scans by winnowed fingerprints and banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices, the openings of grants and short licenses whole, as
# their licenses give them; one for each license, version and variant.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "Apache-2.0 title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "Apache-1.1 notice": "Licensed under the Apache License, Version 1.1.",
    "Apache notice": "Licensed under the Apache License.",
    "MIT notice": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction"
    ),
    "NCSA grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal with the Software "
        "without restriction"
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD notice": "Released under the BSD License.",
    "BSD-2-Clause notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause notice": "Released under the BSD 3-Clause License.",
    "BSD grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "ISC notice": "Released under the ISC License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 "
    "International License.",
    "CC0-1.0 notice": "Released under CC0 1.0.",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at"
    ),
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "MPL-1.1 notice": "Licensed under the Mozilla Public License, Version 1.1.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved.",
}
_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_TWO_CLAUSES = (
    f"{TEMPLATES['BSD grant']}: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
TEMPLATES |= {
    "MIT text": (
        f"{TEMPLATES['MIT grant']}, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause text": _TWO_CLAUSES + _AS_IS,
    "BSD-3-Clause text": (
        f"{_TWO_CLAUSES}3. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without specific prior "
        f"written permission. {_AS_IS}"
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}

#: What tells a template from the others: of each of its marks, one spelling has
#: to stand at the match, word by word.
MARKS: dict[str, tuple[tuple[str, ...], ...]] = {
    "MIT notice": (("MIT",),),
    "MIT grant": (("deal in",),),
    "MIT text": (("deal in",),),
    "NCSA grant": (("deal with",),),
    "Apache notice": (("Apache",),),
    "BSD notice": (("BSD",),),
    "BSD-3-Clause text": (("neither the name",),),
    "ISC notice": (("ISC",),),
    "CC0-1.0 notice": (("CC0 1.0", "CC0 v1.0"),),
    "All rights reserved": (("all rights reserved",),),
}


def _versions(name: str, version: str) -> tuple[str, ...]:
    """Spellings of a license's name with its version."""
    return tuple(f"{name}{between}{version}" for between in (" ", " version ", " v", " v. "))


for _n in ("2", "3"):
    MARKS[f"BSD-{_n}-Clause notice"] = ((f"BSD {_n} clause", f"{_n} clause BSD"),)
for _id, _name in (("Apache", "Apache License"), ("MPL", "Mozilla Public License")):
    for _t in TEMPLATES:
        if _t.startswith(f"{_id}-"):
            _v = _t.split(" ")[0].removeprefix(f"{_id}-")
            MARKS[_t] = (_versions(_name, _v) + _versions(_id, _v),)

_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the {} as published by the Free Software Foundation"
)
_GNU = {
    "GPL": ("General", {"1": "February 1989", "2": "June 1991", "3": "29 June 2007"}),
    "LGPL": ("Lesser General", {"2.1": "February 1999", "3": "29 June 2007"}),
    "Library GPL": ("Library General", {"2": "June 1991"}),
    "AGPL": ("Affero General", {"3": "19 November 2007"}),
}
for _id, (_kind, _dates) in _GNU.items():
    _name = f"GNU {_kind} Public License"
    _named = (_name, f"the {_kind} Public License")
    TEMPLATES[f"{_id} notice"] = f"This work is licensed under the {_name}."
    TEMPLATES[f"{_id} header"] = _HEADER.format(_name)
    MARKS[f"{_id} notice"] = MARKS[f"{_id} header"] = (_named,)
    for _v, _date in _dates.items():
        _full = f"{_id}-{_v if '.' in _v else _v + '.0'}"
        _version = (f"version {_v}", f"v{_v}", f"v {_v}", f"License {_v}")
        TEMPLATES[f"{_full} notice"] = f"This work is licensed under the {_name}, version {_v}."
        TEMPLATES[f"{_full}-only header"] = f"{_HEADER.format(_name)}, version {_v} of the License"
        TEMPLATES[f"{_full} header"] = (
            f"{_HEADER.format(_name)}, either version {_v} of the License, or (at your option) any "
            "later version"
        )
        TEMPLATES[f"{_full} title"] = f"{_name} Version {_v}, {_date} Copyright (C)"
        MARKS[f"{_full} notice"] = MARKS[f"{_full}-only header"] = (_named, _version)
        MARKS[f"{_full} header"] = (_named, _version, ("later version",))
        MARKS[f"{_full} title"] = (_named, _version, (_date,))

_CC = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    _long = "-".join(_CC[_k] for _k in _kind.split("-"))
    _apart = _long.replace("NonC", "Non-C").replace("ShareA", "Share-A").replace("NoD", "No-D")
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _port = {"4.0": " International", "3.0": " Unported"}.get(_v, " Generic")
        _short = f"Licensed under CC {_kind} {_v}."
        _spelled_out = (
            f"This work is licensed under a Creative Commons {_long} {_v}{_port} License."
        )
        _full = f"CC-{_kind}-{_v}"
        for _text, _more in ((_short, "short"), (_spelled_out, "long")):
            if _text not in TEMPLATES.values():
                _free = f"{_full} notice" not in TEMPLATES
                TEMPLATES[f"{_full} notice" if _free else f"{_full} {_more} notice"] = _text
        for _t, _text in TEMPLATES.items():
            if _text in (_short, _spelled_out):
                MARKS[_t] = (
                    _versions(f"CC {_kind}", _v)
                    + _versions(f"Commons {_long}", _v)
                    + _versions(f"Commons {_apart}", _v),
                )

#: Words of a gram and grams of a winnowing window: a shared run of
#: GRAM + WINDOW - 1 words is found whatever surrounds it.
GRAM, WINDOW = 3, 2
#: The share of a template's words that a match has at least.
COVERAGE = 0.8

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Index:
    """Templates as word numbers, and the inverted index of their winnowed
    grams: gram to (template, position)."""

    names: tuple[str, ...]
    numbers: dict[str, int]
    templates: tuple[tuple[int, ...], ...]
    grams: np.ndarray
    postings: dict[int, list[tuple[int, int]]]
    marks: tuple[tuple[tuple[tuple[str, ...], ...], ...], ...]


def _gram_keys(words: np.ndarray, base: int) -> np.ndarray:
    """A number for each run of GRAM known words; -1 where a word is unknown."""
    n = max(0, len(words) - GRAM + 1)
    keys, known = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(GRAM):
        part = words[i : i + n]
        keys = keys * base + part
        known &= part > 0
    return np.where(known, keys, -1)


def build_index(
    templates: dict[str, str], marks: dict[str, tuple[tuple[str, ...], ...]] | None = None
) -> Index:
    """The index of the templates and their marks; it is as small as they are.

    Of each window of grams the one with the smallest hash is kept, the last of
    equals. Templates with fewer words than a gram are refused.
    """
    listed = {name: words_of(text) for name, text in templates.items()}
    if any(len(w) < GRAM for w in listed.values()):
        raise ValueError(f"a template has fewer than {GRAM} words")
    vocabulary = sorted({w for words in listed.values() for w in words})
    numbers = {w: i for i, w in enumerate(vocabulary, start=1)}
    base = len(vocabulary) + 1
    postings: dict[int, list[tuple[int, int]]] = {}
    coded = []
    for t, words in enumerate(listed.values()):
        code = np.array([numbers[w] for w in words], np.int64)
        coded.append(tuple(code.tolist()))
        keys = _gram_keys(code, base)
        order = (keys * 0x9E3779B1) & 0xFFFFFFFF
        kept = set()
        for start in range(max(1, len(keys) - WINDOW + 1)):
            window = order[start : start + WINDOW]
            kept.add(start + len(window) - 1 - int(np.argmin(window[::-1])))
        for at in sorted(kept):
            postings.setdefault(int(keys[at]), []).append((t, at))
    marked = tuple(
        tuple(tuple(tuple(words_of(m)) for m in mark) for mark in (marks or {}).get(name, ()))
        for name in listed
    )
    return Index(
        tuple(listed), numbers, tuple(coded), np.array(sorted(postings), np.int64), postings, marked
    )


def aligned(template: Sequence[int], words: Sequence[int], band: int) -> list[tuple[int, int]]:
    """The pairs (template, document word) of a best alignment in a band.

    ``words`` starts ``band`` words before the template's place. The alignment
    has the most equal words of those that stay within ``band`` words of the
    diagonal; of equals, the one that ends first and takes words late.
    """
    m, width = len(template), 2 * band + 1
    rows = [[0] * width]
    for i in range(m):
        above, row = rows[-1], [0] * width
        for k in range(width):
            j = i + k
            best = row[k - 1] if k else 0
            if k + 1 < width and above[k + 1] > best:
                best = above[k + 1]
            if j < len(words) and words[j] == template[i] and above[k] + 1 > best:
                best = above[k] + 1
            row[k] = best
        rows.append(row)
    # rows[i + 1][k]: the most equal words of template[: i + 1] and words[: i + k + 1].
    best = max(rows[m])
    k, i, pairs = rows[m].index(best), m - 1, []
    while i >= 0 and k >= 0:
        here = rows[i + 1][k]
        if here == 0:
            break
        j = i + k
        if k and rows[i + 1][k - 1] == here:
            k -= 1
        elif k + 1 < width and rows[i][k + 1] == here:
            i, k = i - 1, k + 1
        elif j < len(words) and words[j] == template[i]:
            pairs.append((i, j))
            i -= 1
        else:
            i -= 1
    return pairs[::-1]


def _marked(
    marks: Sequence[Sequence[tuple[str, ...]]],
    found: Sequence[str],
    spans: Sequence[tuple[int, int]],
    text: str,
    start: int,
    end: int,
) -> set[int] | None:
    """Where the marks stand in the match from word ``start`` to ``end``, or up
    to two words before or after it; None if a mark is missing."""

    def whole(at: int, mark: tuple[str, ...]) -> bool:
        """A number at the mark's end is not the start of a longer one."""
        after = at + len(mark)
        if not mark[-1][-1].isdigit() or after == len(found):
            return True
        more = found[after].isdigit() and int(found[after]) > 0
        return not more or text[spans[after - 1][1] : spans[after][0]] != "."

    first, last, out = max(0, start - 2), end + 2, set()
    for mark in marks:
        places = [
            (at, at + len(m) - 1)
            for m in mark
            for at in range(first, min(last + 1, len(found)) - len(m) + 1)
            if tuple(found[at : at + len(m)]) == m and whole(at, m)
        ]
        if not places:
            return None
        near = min(places, key=lambda p: (max(start - p[0], 0) + max(p[1] - end, 0), p))
        out |= set(range(near[0], near[1] + 1))
    return out


def find_licenses(text: str, index: Index, coverage: float) -> list[tuple[str, float, int, int]]:
    """The matches (name, coverage, start, end) in a whole text, by place.

    Hits of the index in one template are candidates by their diagonal, merged
    within the band, and each is aligned once. A match has all marks of its
    template. Of matches that overlap, whatever their templates, the one with the
    most aligned and marking words stays (a whole text, not the notice in it),
    then the one with the highest coverage, then the first. Start and end are
    code points around the first and last of these words.
    """
    lowered = text.lower()
    found = _WORD.findall(lowered)
    get = index.numbers.get
    words = np.fromiter((get(w, 0) for w in found), np.int64, len(found))
    keys = _gram_keys(words, len(index.numbers) + 1)
    at = np.flatnonzero(np.isin(keys, index.grams)) if (keys >= 0).any() else ()
    if not len(at):
        return []
    diagonals: dict[int, set[int]] = {}
    for place in at.tolist():
        for template, offset in index.postings[int(keys[place])]:
            diagonals.setdefault(template, set()).add(place - offset)
    if len(lowered) == len(text):
        spans = [m.span() for m in _WORD.finditer(lowered)]
    else:  # lower-casing changed the length of some character
        spans = _spans(text, found)
    matches = []
    for template, places in diagonals.items():
        code = index.templates[template]
        band = max(2, len(code) // 4)
        last = None
        for place in sorted(places):
            if last is not None and place - last <= band // 2:
                continue
            last = place
            first = place - band
            part = [0] * max(0, -first) + words[max(0, first) : place + len(code) + band].tolist()
            pairs = aligned(code, part, band)
            share = len(pairs) / len(code)
            if share >= coverage:
                start, end = pairs[0][1] + first, pairs[-1][1] + first
                marks = _marked(index.marks[template], found, spans, text, start, end)
                if marks is not None:
                    own = marks | {first + j for _, j in pairs}
                    ends = spans[min(own)][0], spans[max(own)][1]
                    matches.append((-len(own), -share, *ends, index.names[template]))
    kept: list[tuple[str, float, int, int]] = []
    for _, share, start, end, name in sorted(matches):
        if all(end <= k[2] or start >= k[3] for k in kept):
            kept.append((name, -share, start, end))
    return sorted(kept, key=lambda m: (m[2], m[3], m[0]))


def _spans(text: str, found: list[str]) -> list[tuple[int, int]]:
    """Places of lower-cased words in the text as it is."""
    lowered = [c.lower() for c in text]
    place = [i for i, c in enumerate(lowered) for _ in c]
    joined = "".join(lowered)
    spans = [(place[m.start()], place[m.end() - 1] + 1) for m in _WORD.finditer(joined)]
    return spans if len(spans) == len(found) else spans + [(len(text), len(text))] * (
        len(found) - len(spans)
    )


def license_matches(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and (license, coverage, start, end): a row for each
    match of a template in a row's whole text.

    A null text has no match, and a document without one no row; repeated rows
    have theirs each. The index of the templates goes to the tasks; documents
    stay where they are.
    """
    index = build_index(TEMPLATES, MARKS) if templates is None else build_index(templates)
    given = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    schema = given.drop("_text").schema
    for name, kind in (("license", "string"), ("coverage", "double"), ("start", "long"), ("end", "long")):
        schema = schema.add(name, kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, *match)
                for i, text in enumerate(batch.column("_text").to_pylist())
                for match in find_licenses(text, index, coverage)
            ]
            at, *values = zip(*rows) if rows else ((),) * 5
            kept = batch.select(list(keep)).take(pa.array(at, pa.int64()))
            types = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(v, t) for v, t in zip(values, types))],
                [*keep, "license", "coverage", "start", "end"],
            )

    return given.mapInArrow(scan, schema)
