"""Kondrak n-gram similarity, batched with numpy, and Dice over character bigrams.

The distance is the one of Kondrak, "N-gram similarity and distance" (SPIRE 2005):
an edit distance over the n-grams ending at each character, where insertions and
deletions cost 1 and replacing a gram costs the share of its positions that differ.
Positions both strings fill with front padding are left out of that share.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from math import lcm

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from twinfold.functions.text import _col

SLACK = 1e-6
_CELLS = 32_000
_FIRST_BAND = 16
_CHECKED = 32


def _codes(texts: Sequence[str], before: int, height: int, fill: int) -> np.ndarray:
    """One column of code points per text: 0 in ``before`` rows and one more, the text, ``fill`` up to ``height``."""
    out = np.full((len(texts), height), fill, dtype=np.int32)
    out[:, : before + 1] = 0
    for row, text in enumerate(texts):
        out[row, before + 1 : before + 1 + len(text)] = np.frombuffer(
            text.encode("utf-32-le", "surrogatepass"), dtype=np.int32
        )
    return out.T


def _narrow(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same codes as bytes, where they are few: only their equality counts."""
    known = np.union1d(a, b)
    if len(known) > 256:
        return a, b
    return np.searchsorted(known, a).astype(np.uint8), np.searchsorted(known, b).astype(np.uint8)


def _banded(short: list[str], long: list[str], n: int, e: int, limit: np.ndarray) -> np.ndarray:
    """Distances along alignments that leave the corner diagonals by up to ``e`` places; infinite for pairs that pass
    their ``limit``.

    Costs are whole numbers in units of ``1 / lcm(1..n)``. The table is filled by diagonals of places ``i + j = s``,
    each from the two before; row ``i + 1`` stands for place ``i`` of the shorter strings, a column for a pair.
    """
    unit = lcm(*range(1, n + 1))
    la = np.array([len(s) for s in short])
    lb = np.array([len(s) for s in long])
    rows, cols, gap = int(la.max()), int(lb.max()), int((lb - la).max())
    kind, far = (np.int16, 32_000) if (cols + n) * unit < 31_000 else (np.int32, 1 << 28)
    a, b = _narrow(_codes(short, n, n + rows + 2, -1), _codes(long, n, n + cols + 2, -2))
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b[::-1])
    out = np.full(len(short), np.inf)
    where, ends = np.arange(len(short)), la + lb
    cap = np.floor(limit * unit + SLACK).astype(np.int64)
    bounded = bool((cap < lb * unit).any())
    older, old, new = (np.full((rows + 3, len(short)), far, dtype=kind) for _ in range(3))
    old[1] = 0
    finish = {int(s): np.flatnonzero(ends == s) for s in np.unique(ends)}
    for s in range(1, int(ends.max()) + 1):
        lo = max(0, s - cols, -((gap + e - s) // 2))
        hi = min(rows, s, (s + e) // 2)
        # place j of the longer strings stands in row n + j, counted from the end once reversed
        at, back, size = n + lo, cols + 1 - s + lo, hi - lo + 1
        total = (a[at : at + size] != b[back : back + size]).view(np.uint8)
        for t in range(1, n):
            total += (a[at - t : at - t + size] != b[back + t : back + t + size]).view(np.uint8)
        if s <= 2 * (n - 1):
            i = np.arange(lo, hi + 1)
            cost = total * (unit // np.clip(np.maximum(i, s - i), 1, n)).astype(kind)[:, None]
        else:
            cost = np.multiply(total, unit // n, dtype=kind)
        cost += older[lo : hi + 1]
        gaps = np.minimum(old[lo : hi + 1], old[lo + 1 : hi + 2])
        gaps += unit
        np.minimum(cost, gaps, out=new[lo + 1 : hi + 2])
        new[lo] = far
        new[hi + 2] = far
        older, old, new = old, new, older
        done = finish.get(s)
        if done is not None:
            out[where[done]] = old[la[done] + 1, done] / unit
        if s % _CHECKED == 0:
            alive = ends > s
            if bounded:
                # every alignment crosses one of two diagonals in a row, so their minimum bounds the distance
                alive &= np.minimum(old[lo + 1 : hi + 2].min(axis=0), older[max(lo, 1) : hi + 2].min(axis=0)) <= cap
            if not alive.any():
                break
            if alive.sum() <= 0.7 * len(alive):
                a, b, older, old, new = (np.ascontiguousarray(x[:, alive]) for x in (a, b, older, old, new))
                la, ends, where, cap = la[alive], ends[alive], where[alive], cap[alive]
                finish = {int(x): np.flatnonzero(ends == x) for x in np.unique(ends)}
    return out


def _first_band(x: str, y: str, low: float, settle: bool = False) -> int:
    """A narrow band, or at once the one that settles the pair if lengths differ so much that none is narrow, or if
    that is wanted."""
    gap = len(y) - len(x)
    if not settle and gap // 2 + _FIRST_BAND < len(x) // 3:
        return min(_FIRST_BAND, len(y))
    return min(max(_FIRST_BAND, math.ceil(((1 - max(low, 0.0)) * len(y) - gap) / 2) + 1), len(y))


def _alike(band: int, x: str, y: str) -> tuple[int, int, int]:
    """Pairs that share a table: of about the same band and lengths."""
    return int(math.log2(band)), int(math.log2(len(y))), int(math.log2(len(x)))


def _grams(text: str, n: int) -> set:
    return {text[i : i + n] for i in range(len(text) - n + 1)}


def _too_few_shared(x: str, y: str, n: int, floor: float) -> bool:
    """True when so many grams of one string are missing from the other that the
    similarity is under ``floor``: each lost gram costs at least 1/n."""
    if floor <= 1 - 1 / n:
        return False
    pad = "\x01" * (n - 1)
    gx, gy = _grams(pad + x, n), _grams(pad + y, n)
    return max(len(gx - gy), len(gy - gx)) > n * (1 - floor) * len(y) + SLACK


def _chunks(groups: Iterable[list]) -> Iterator[list]:
    """Groups cut into parts whose diagonals fit the cell budget."""
    for group in groups:
        band, x, y, _ = group[0]
        size = max(1, _CELLS // min(len(x) + 1, (len(y) - len(x)) // 2 + band + 1))
        yield from (group[at : at + size] for at in range(0, len(group), size))


def ngram_similarity(
    left: Sequence[str], right: Sequence[str], n: int = 3, floor: float | Sequence[float] = 0.0, unlike: bool = False
) -> np.ndarray:
    """Similarities in [0, 1]. Values under ``floor`` (one, or one per pair) are reported
    as 0, which lets most pairs stop at a length test, a narrow band or a shared-gram test.
    ``unlike``: most are expected to be under it, which a narrow band does not tell."""
    out = np.zeros(len(left))
    floors = np.broadcast_to(np.asarray(floor, dtype=float), len(left))
    work: dict[tuple[str, str], list[int]] = {}
    for at, (x, y) in enumerate(zip(left, right)):
        if x == y:
            out[at] = 1.0
        elif x and y and floors[at] < 1.0 - SLACK:
            work.setdefault((x, y) if (len(x), x) <= (len(y), y) else (y, x), []).append(at)
    todo = []
    for (x, y), rows in work.items():
        low = floors[rows].min()
        if len(x) < n:
            sim = sum(p == q for p, q in zip(x, y)) / len(y)
            if sim >= low - SLACK:
                out[rows] = sim
        elif len(x) / len(y) >= low - SLACK:
            todo.append((x, y, low))
    todo = [(_first_band(x, y, low, unlike), x, y, low) for x, y, low in todo]
    while todo:
        groups: dict[tuple[int, int, int], list] = {}
        for p in todo:
            groups.setdefault(_alike(*p[:3]), []).append(p)
        again = []
        for chunk in _chunks(groups.values()):
            e = max(p[0] for p in chunk)
            short = [p[1] for p in chunk]
            long = [p[2] for p in chunk]
            limits = np.array([(1 - low) * len(y) + SLACK for _, _, y, low in chunk])
            for (_, x, y, low), limit, d in zip(chunk, limits, _banded(short, long, n, e, limits)):
                # an alignment that leaves the band needs this many gaps
                outside = 2 * (e + 1) + len(y) - len(x)
                if d <= outside or outside > limit or e >= len(y):
                    if d <= limit:
                        out[work[(x, y)]] = 1 - d / len(y)
                elif not _too_few_shared(x, y, n, low):
                    # no alignment that is better than the one found, or good enough, leaves this band
                    need = math.ceil((min(d, limit) - (len(y) - len(x))) / 2)
                    again.append((min(max(need, e + 1), len(y)), x, y, low))
        todo = again
    out[out < floors - SLACK] = 0.0
    return out


def ngram_similarity_col(a: Column | str, b: Column | str, n: int = 3, floor: float = 0.0) -> Column:
    @F.pandas_udf("double")
    def similarity(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(ngram_similarity(x.fillna("").tolist(), y.fillna("").tolist(), n, floor))

    return similarity(_col(a), _col(b))


def _bigrams(text: str) -> np.ndarray:
    """The distinct bigrams of a text, as sorted numbers."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.int32).astype(np.int64)
    return np.unique((codes[:-1] << 21) | codes[1:])


def dice_of_texts(left: Sequence[str | None], right: Sequence[str | None]) -> np.ndarray:
    """Dice over sets of character bigrams, 0 for two texts without any; equal texts score 1, nulls 0."""
    out = np.zeros(len(left))
    last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.int64))
    for at, (x, y) in enumerate(zip(left, right)):
        if x is None or y is None:
            continue
        if x == y:
            out[at] = 1.0
            continue
        # many pairs in a row may have the same first text
        if x != last[0]:
            last = x, _bigrams(x)
        one, two = last[1], _bigrams(y)
        if len(one) + len(two):
            both = len(one) + len(two) - len(np.union1d(one, two))
            out[at] = 2.0 * both / (len(one) + len(two))
    return out


def dice(a: Column | str, b: Column | str) -> Column:
    """Dice over sets of character bigrams; equal strings score 1."""

    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(dice_of_texts(x.where(x.notna(), None).tolist(), y.where(y.notna(), None).tolist()))

    return score(_col(a), _col(b))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
