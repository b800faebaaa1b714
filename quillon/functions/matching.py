"""Fuzzy search of spoken callsigns in a transcript, and their repair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import expand_callsign, normalize, present_tails, spoken_realizations

MATCH = 0.85
SNAP_BELOW = 0.98

_SCHEMA = "tail string, score double, matched boolean, text string, snapped boolean"


def common_length(masks: dict[str, int], full: int, window: str) -> int:
    """Length of the longest common subsequence with the string whose characters' places are the masks' bits."""
    row = full
    for ch in window:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return (full & ~row).bit_count()


class Slid:
    """A text that other strings are slid over: its letters as places in a table of the different ones."""

    def __init__(self, text: str):
        self.text, self.letters = text, list(dict.fromkeys(text))
        place = {ch: i for i, ch in enumerate(self.letters)}
        self.places = np.array([place[ch] for ch in text], np.intp)

    def windows(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, lengths) of what a string of m letters covers, from its last letter on the first to its first on the last."""
        end = np.arange(1, len(self.text) + m)
        a, b = np.maximum(end - m, 0), np.minimum(end, len(self.text))
        return a, b, b - a

    def common(self, needle: str) -> np.ndarray:
        """Length of the longest common subsequence of needle with each window: all windows take their next letter together, a bit a place of needle."""
        m, masks = len(needle), {}
        for i, ch in enumerate(needle):
            masks[ch] = masks.get(ch, 0) | 1 << i
        if m > 63:  # more places than a machine word has bits
            a, b, _ = self.windows(m)
            return np.array([common_length(masks, (1 << m) - 1, self.text[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)])
        n = len(self.text)
        padded = np.zeros(n + 2 * (m - 1), np.uint64)  # beyond the ends no letter is in common
        padded[m - 1 : m - 1 + n] = np.array([masks.get(ch, 0) for ch in self.letters], np.uint64)[self.places]
        width, full = n + m - 1, np.uint64((1 << m) - 1)
        row, hit, more = np.full(width, full), np.empty(width, np.uint64), np.empty(width, np.uint64)
        for k in range(m):
            np.bitwise_and(row, padded[k : k + width], out=hit)
            np.add(row, hit, out=more)
            np.subtract(row, hit, out=row)
            np.bitwise_or(row, more, out=row)
        return np.bitwise_count(~row & full)


def partial_ratio(needle: str, hay: str | Slid, floor: float = 0.0) -> tuple[float, int, int]:
    """(best similarity, start, end in hay): needle slides over hay, over both ends too; the first best window counts.

    The similarity of two strings is 2 * common subsequence / both lengths. If needle is the longer, hay slides over it and
    the span is the whole hay. Of two strings of one length both are slid. What is not over floor is given as floor or less.
    """
    slid = hay if isinstance(hay, Slid) else None
    hay = slid.text if slid else hay
    if not needle or not hay:
        return (1.0 if needle == hay else 0.0), 0, len(hay)
    if len(needle) > len(hay):
        return partial_ratio(hay, needle, floor)[0], 0, len(hay)
    m, n = len(needle), len(hay)
    at = hay.find(needle)
    if at >= 0:
        return 1.0, at, at + m
    slid = slid or Slid(hay)
    a, b, length = slid.windows(m)
    scores = 2 * slid.common(needle) / (m + length)
    k = int(np.argmax(scores))
    best = (float(scores[k]), int(a[k]), int(b[k])) if scores[k] > floor else (floor, 0, m)
    if m == n:
        _, _, length = slid.windows(m)
        other = float(np.max(np.where(length < m, 2 * Slid(needle).common(hay) / (m + length), 0.0)))
        best = (other, 0, n) if other > best[0] else best
    return best


def word_span(needle: str, hay: str) -> tuple[int, int]:
    """The run of as many words as needle has that is most like it; the first of equals."""
    words, n = hay.split(" "), len(needle.split(" "))
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    full, masks = (1 << len(needle)) - 1, {}
    for i, ch in enumerate(needle):
        masks[ch] = masks.get(ch, 0) | 1 << i
    spans = [(starts[k], starts[min(k + n, len(words))] - 1) for k in range(max(len(words) - n, 0) + 1)]
    return max(spans, key=lambda s: 2 * common_length(masks, full, hay[s[0] : s[1]]) / (len(needle) + s[1] - s[0]))


def find_callsign(text: str, spoken: list[list[str]], tails: list[str], canonical: list[str], whole_words: bool) -> tuple:
    best: tuple[float, int, str, int, int] = (0.0, -1, "", 0, 0)
    slid = Slid(text)
    for k, forms in enumerate(spoken):
        for form in forms:
            score, a, b = partial_ratio(form, slid, best[0])
            if score > best[0]:
                best = (score, k, form, a, b)
    score, k, form, a, b = best
    if k < 0:
        return None, 0.0, False, text, False
    matched = score >= MATCH
    if not matched or score >= SNAP_BELOW or not canonical[k]:
        return tails[k], score, matched, text, False
    if whole_words:
        a, b = word_span(form, text)
    return tails[k], score, matched, " ".join((text[:a] + canonical[k] + text[b:]).split()), True


def _finder(whole_words: bool):
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [find_callsign(t or "", s, n, c, whole_words) for t, s, n, c in zip(*(x.to_pylist() for x in batch), strict=True)]
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.string(), pa.bool_())
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(cols, names=[f.split()[0] for f in _SCHEMA.split(", ")])

    return run


def match_callsign(text: Column, tails: Column, airlines: dict[str, str] | None = None, whole_words: bool = False) -> Column:
    """struct<tail, score, matched, text, snapped> for a transcript and the array of tails that were near.

    Every tail is tried in order, as its whole spoken form and as what begins with its first digit;
    a later one must score more. From MATCH on it is a match; a match under SNAP_BELOW is spliced out for
    the whole spoken form (with whole_words, the run of words most like it is spliced out). tail is the best one even where it
    is no match, and null where all scores are 0. No tails: no match. Null tails and texts are blank.
    """
    near = present_tails(tails)
    spoken = F.transform(near, lambda t: spoken_realizations(t, airlines))
    canonical = F.transform(near, lambda t: F.coalesce(normalize(expand_callsign(t, airlines)), F.lit("")))
    return F.arrow_udf(_finder(whole_words), _SCHEMA)(normalize(F.coalesce(text, F.lit(""))), spoken, near, canonical)
