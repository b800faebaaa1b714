"""License scans: winnowed fingerprints of templates in an inverted index, banded alignment of the candidates."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import table
from .lm_score import mixed
from .textbytes import text_runs

#: Notices by which well-known licenses are granted, and texts of short ones, in their public wording.
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."
    ),
    "BSD/redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0/short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0/short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-2.0/short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL/notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC/permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "MIT/full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT/short": "Released under the MIT License.",
    "MIT/permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "MPL-2.0/short": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
GRAM, WINNOW = 3, 2
#: Words that an alignment may drift from its diagonal, at least; more where a place may lack or have put in more words.
BAND = 8

#: Bytes to lower case; what is no ASCII letter or digit nor part of another letter becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: No-break space, angle quotes, and the block of general punctuation with its dashes, spaces and quotes.
_MARKS = re.compile(rb"\xc2[\xa0\xab\xbb]|\xe2[\x80\x81][\x80-\xbf]")


def folded(text: bytes) -> bytes:
    """The text in lower case with spaces for all that is no word, of the same length."""
    flat = text.translate(_FOLD)
    return flat if text.isascii() else _MARKS.sub(lambda m: b" " * len(m.group()), flat)


def words_of(text: bytes) -> list[bytes]:
    return folded(text).split()


def gram_hashes(tokens: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A hash for each width tokens in a row."""
    n = max(len(tokens) - width + 1, 0)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + tokens[k : k + n])
    return out


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of each WINNOW in a row, so that GRAM + WINNOW - 1 equal words share one."""
    n = len(hashes) - WINNOW + 1
    if n <= 0:
        return np.arange(len(hashes))
    runs = np.lib.stride_tricks.sliding_window_view(hashes, WINNOW)
    return np.unique(runs.argmin(axis=1) + np.arange(n))


def _digests(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 5) for w in words], np.uint64)


@dataclass
class TemplateIndex:
    """Fingerprints of all templates, sorted, each with its template and place; widths are the numbers of words of a fingerprint that occur."""

    names: list[str]
    tokens: list[np.ndarray]
    keys: np.ndarray
    template: np.ndarray
    place: np.ndarray
    widths: list[int]


def build_index(templates: dict[str, str], least: float = 0.8) -> TemplateIndex:
    """Templates enter winnowed fingerprints of GRAM words, where a place that keeps least of the words has GRAM + WINNOW - 1 of them in a row.

    Where it may have fewer in a row, all fingerprints enter, and of as few words as are in a row for certain.
    """
    names = sorted(templates)
    tokens = [_digests(words_of(templates[n].encode())) for n in names]
    keys, owner, place, widths = [], [], [], set()
    for t, own in enumerate(tokens):
        spare = len(own) - math.ceil(least * len(own) - 1e-9)
        run = -(-(len(own) - spare) // (spare + 1))
        width = min(GRAM, max(run, 1))
        hashes = gram_hashes(own, width)
        at = winnowed(hashes) if run >= GRAM + WINNOW - 1 else np.arange(len(hashes))
        keys.append(hashes[at])
        owner.append(np.full(len(at), t))
        place.append(at)
        widths.add(width)
    flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    join = lambda x: np.concatenate(x)[order] if x else np.zeros(0, int)
    return TemplateIndex(names, tokens, flat[order], join(owner), join(place), sorted(widths))


def band_of(template: np.ndarray, least: float) -> int:
    """The drift that a place can have: as many words left out or put in as it may lack."""
    return max(BAND, len(template) - math.ceil(least * len(template) - 1e-9))


def banded_alignment(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first word, after last word) of the best alignment of the template within band of text[i + diagonal].

    A match earns 1, a word that is missing, put in or replaced costs 1/4; the text's ends are free. A row of the table is filled at once: words put
    in are a running maximum along it.
    """
    m, width, gap = len(template), 2 * band + 1, 0.25
    trace = np.zeros((m + 1, width), np.int8)
    slope, score = np.arange(width) * gap, np.zeros(width)
    cell = np.arange(width) + diagonal - band  # plus i: words of the text before this cell
    best: tuple[float, int, int] = (0.0, 0, band)
    for i in range(1, m + 1):
        at = cell + i
        inside = (at >= 0) & (at <= len(text))
        some = inside & (at > 0)
        equal = np.zeros(width, bool)
        equal[some] = text[at[some] - 1] == template[i - 1]
        moved = np.where(some, score + np.where(equal, 1.0, -gap), -np.inf)
        missing = np.append(score[1:] - gap, -np.inf)  # a template word is missing
        new, kind = np.zeros(width), np.zeros(width, np.int8)
        for value, name in ((moved, np.where(equal, 1, 2)), (missing, 3)):
            more = value > new
            new, kind = np.where(more, value, new), np.where(more, name, kind)
        new = np.where(inside, new, -np.inf)
        put_in = np.maximum.accumulate(new + slope) - slope
        more = inside & (put_in > new + 1e-9)
        new, kind = np.where(more, put_in, new), np.where(more, 4, kind)
        trace[i], score = kind, new
        top = int(new.argmax())
        if new[top] > best[0] + 1e-9:
            best = (float(new[top]), i, top)
    _, i, b = best
    matched, end, start = 0, cell[b] + i, cell[b] + i
    while i > 0 and trace[i, b] > 0:
        kind = trace[i, b]
        if kind == 1:
            matched += 1
            start = cell[b] + i - 1
        if kind in (1, 2):
            i -= 1
        elif kind == 3:
            i, b = i - 1, b + 1
        else:
            b -= 1
    return matched, int(start), int(end)


def align_candidates(tokens: np.ndarray, hits: list[tuple[int, int, int]], index: TemplateIndex, least: float) -> list[tuple[int, float, int, int, int]]:
    """(template, coverage, matched, start, end) in words: hits are (template, its place, text's place); of spans that meet, the one that matches most stays.

    A hit is skipped only where an accepted span of its template covers it; else it is aligned from its own diagonal between such spans, until it is covered or nothing is found.
    """
    tried, found = set(), []
    taken: dict[int, tuple[list[int], list[int]]] = {}  # starts and ends of a template's accepted spans, in order; they do not meet
    for t, i, j in sorted(hits, key=lambda x: (x[0], x[2], x[1])):
        own, (starts, ends) = index.tokens[t], taken.setdefault(t, ([], []))
        band = band_of(own, least)
        while True:
            k = bisect_right(starts, j)
            if k and j < ends[k - 1]:
                break
            # what accepted spans of the template leave around the hit
            lo = max(0, j - i - band, ends[k - 1] if k else 0)
            hi = min(len(tokens), j - i + len(own) + band, starts[k] if k < len(starts) else len(tokens))
            if (t, j - i, lo, hi) in tried:
                break
            tried.add((t, j - i, lo, hi))
            if lo <= j - i and j - i + len(own) <= hi and np.array_equal(tokens[j - i : j - i + len(own)], own):
                matched, start, end = len(own), j - i - lo, j - i - lo + len(own)  # word for word: nothing to align
            elif np.isin(own, tokens[lo:hi]).sum() < least * len(own) - 1e-9:
                break
            else:
                matched, start, end = banded_alignment(own, tokens[lo:hi], j - i - lo, band)
            if matched < least * len(own) - 1e-9:
                break
            at = bisect_right(starts, lo + start)
            starts.insert(at, lo + start)
            ends.insert(at, lo + end)
            found.append((t, matched / len(own), matched, lo + start, lo + end))
    kept: list[tuple[int, float, int, int, int]] = []
    starts = []
    for one in sorted(set(found), key=lambda x: (-x[2], -x[1], x[3], x[0])):
        at = bisect_right(starts, one[3])
        if (not at or kept[at - 1][4] <= one[3]) and (at == len(kept) or one[4] <= kept[at][3]):
            kept.insert(at, one)
            starts.insert(at, one[3])
    return kept


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, in code points."""
    flat = np.frombuffer(folded(text), np.uint8)
    edge = np.flatnonzero(np.diff((flat != 32).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return points[edge[::2]], points[edge[1::2]]


_MATCH = "array<struct<license:string,coverage:double,matched:long,start:long,end:long>>"
_FIELDS = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_texts(texts: pa.Array, index: TemplateIndex, least: float) -> list[list[dict]]:
    """The places of each text: license, coverage, matched, start, end."""
    out: list[list[dict]] = []
    for i, j, data, offsets in text_runs(texts):
        out += [[] for _ in range(i, j)]
        whole, cuts = data.tobytes(), offsets.tolist()
        parts = [words_of(whole[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        tokens = _digests([w for p in parts for w in p])
        by_doc: dict[int, list[tuple[int, int, int]]] = {}
        for width in index.widths:
            hashes = gram_hashes(tokens, width)  # the index is winnowed where it may be; the text is looked up whole
            low, high = np.searchsorted(index.keys, hashes, "left"), np.searchsorted(index.keys, hashes, "right")
            at = np.flatnonzero(high > low)
            doc = np.searchsorted(first, at, side="right") - 1
            inside = at + width <= first[doc + 1]
            for p, k in zip(at[inside], doc[inside].tolist(), strict=True):
                hits = by_doc.setdefault(k, [])
                hits.extend((int(index.template[x]), int(index.place[x]), int(p - first[k])) for x in range(low[p], high[p]))
        for k, hits in by_doc.items():
            got = align_candidates(tokens[first[k] : first[k + 1]], hits, index, least)
            if got:
                starts, ends = word_places(whole[cuts[k] : cuts[k + 1]])
                out[i + k] = [{"license": index.names[t], "coverage": c, "matched": n, "start": int(starts[s]), "end": int(ends[e - 1])} for t, c, n, s, e in got]
    return out


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each place where a template is matched: id, license, coverage, matched, span_start, span_end.

    coverage is the share of the template's words that the alignment matches, least at least; the
    span is in code points, end exclusive, from the first matched word to the last. A place that keeps least of the template's words, whether the others are replaced or left
    out or as many are put in, always has a fingerprint of it in the index, and its alignment stays in the band; where several of these come together, it may have none. The
    alignment that earns most is taken, and it may end before a last few words that stand beyond more changed ones: of places at the very limit a few in a hundred are lost so. Templates without words are never found. Places that meet are given once, for the template with
    most matched words (ties: larger coverage, then the name). The index is of the templates, which
    the caller names, and goes to the tasks; texts stay where they are. A null or empty text has no
    rows, nor has a document without a match; rows that repeat give their rows each. Other
    columns of the input are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(build_index(TEMPLATES if templates is None else templates, least))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(scan_texts(texts, shared.value, least), _FIELDS)

    found = F.arrow_udf(run, _MATCH).asNondeterministic()  # the size test that explode() adds, pushed below, would run it twice
    rows = docs.select(F.col(id_col).alias("_id"), found(F.col(text_col).cast("string")).alias("_found"))
    each = rows.select("_id", F.explode("_found").alias("_m"))
    return each.select(
        F.col("_id").alias(id_col), F.col("_m.license").alias("license"), F.col("_m.coverage").alias("coverage"), F.col("_m.matched").alias("matched"),
        F.col("_m.start").alias("span_start"), F.col("_m.end").alias("span_end"),
    )


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
