"""Locating text by edit distance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def best_match(needle: Column, haystack: Column, floor: float = 0.7) -> Column:
    """0-based position of the window of the needle's length with the smallest distance, the first of equals, if its
    similarity exceeds the floor. For short windows: every window is compared."""
    at = F.sequence(F.lit(1), F.length(haystack) - F.length(needle) + 1)
    scored = F.transform(at, lambda i: F.struct(F.levenshtein(needle, F.substr(haystack, i, F.length(needle))).alias("d"), (i - 1).alias("pos")))
    best = F.array_min(scored)
    usable = (F.length(needle) > 0) & (F.length(haystack) >= F.length(needle))
    return F.when(usable, F.when(1 - best["d"] / F.length(needle) > floor, best["pos"]))


def window_distances(needle: str, haystack: str) -> np.ndarray:
    """Edit distance of the needle to every window of its length: one dynamic programme, all windows at once."""
    n, m = len(needle), len(haystack) - len(needle) + 1
    if m <= 0:
        return np.zeros(0, np.int32)
    hay = np.frombuffer(haystack.encode("utf-32-le", "surrogatepass"), np.uint32)
    pin = np.frombuffer(needle.encode("utf-32-le", "surrogatepass"), np.uint32)
    windows = np.lib.stride_tricks.sliding_window_view(hay, n)
    row = np.tile(np.arange(n + 1, dtype=np.int32), (m, 1)).T.copy()  # over window prefixes
    for i in range(1, n + 1):
        above = row
        row = np.empty_like(above)
        row[0] = i
        for j in range(1, n + 1):
            row[j] = np.minimum(np.minimum(above[j] + 1, row[j - 1] + 1), above[j - 1] + (windows[:, j - 1] != pin[i - 1]))
    return row[n]


def locate(needle: str, haystack: str, floor: float = 0.7, block: int = 4096) -> int | None:
    """Position of the best window, or None. An exact occurrence has distance 0 and is looked for first."""
    if not needle or not haystack or len(haystack) < len(needle):
        return None
    at = haystack.find(needle)
    if at >= 0:
        return at
    best, where, n = None, None, len(needle)
    for lo in range(0, len(haystack) - n + 1, block):
        d = window_distances(needle, haystack[lo:lo + block + n - 1])
        if len(d) and (best is None or d.min() < best):
            best, where = int(d.min()), lo + int(d.argmin())
    return where if best is not None and 1 - best / n > floor else None


def located(needle: Column, haystack: Column, floor: float = 0.7) -> Column:
    """:func:`locate` as a column; null where either is null or nothing is similar enough."""
    @F.arrow_udf("int")
    def at(needle: pa.Array, haystack: pa.Array) -> pa.Array:
        return pa.array([locate(n, h, floor) for n, h in zip(needle.to_pylist(), haystack.to_pylist(), strict=True)], pa.int32())

    return at(needle, haystack)


#: A text that is to follow a cut starts at most so many characters behind it, and is looked for in so many more than its own length.
_FOLLOWS_WITHIN, _LOOK_AHEAD = 50, 100


def cut_position_of(before: Column, after: Column, text: Column) -> Column:
    """Where a text is cut: behind the place most like ``before``, null without such a place. Where ``after`` follows closely, the cut
    also leaves the blanks and tabs between to the first part.

    Only the two searches run in Python; each is a column of its own, the rest are built-in expressions.
    """
    cut = located(before, text) + F.length(before)
    window = F.substr(text, cut + 1, F.length(after) + _LOOK_AHEAD)
    blanks = F.length(F.regexp_extract(F.substr(text, cut + 1), r"^[ \t]*", 0))
    return cut + F.when(located(after, window) <= _FOLLOWS_WITHIN, blanks).otherwise(0)
