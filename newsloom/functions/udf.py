"""The few functions that have no native expression, as Arrow UDFs: NFKC, HTML entities, fuzzy ratios."""

from __future__ import annotations

import html
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: html.unescape(t) if "&" in t else t, na_action="ignore")


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel over a Python int."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """2 * LCS / (|a| + |b|); 0 if either is empty."""
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_set_ratio(a: str, b: str) -> float:
    """Ratio over the shared words and each side's own; 1 if one word set holds the other and they share a word."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 1.0
    left, right = (" ".join(p for p in (both, own) if p) for own in (only_x, only_y))
    found = [ratio(left, right)]
    if both:
        found += [ratio(both, left), ratio(both, right)]
    return max(found)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against a window of its length, or a cut one at either end, of the longer."""
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_window(short, long)
    return max(best, _best_window(long, short)) if len(a) == len(b) and best < 1 else best


def _best_window(short: str, long: str) -> float:
    """Windows by falling bound (letters in common, and the subsequence of the whole text); exact, since bounds only skip."""
    m, n = len(short), len(long)
    left = Counter(short)
    most, common, bounds = lcs_length(short, long), 0, []
    for end in range(1, n + m):  # the window is long[max(0, end - m) : min(end, n)]; left: letters of short less the window's
        if end <= n:
            c = long[end - 1]
            if left[c] > 0:
                common += 1
            left[c] -= 1
        if end > m:
            c = long[end - m - 1]
            left[c] += 1
            if left[c] > 0:
                common -= 1
        size = min(end, n) - max(0, end - m)
        bounds.append((2 * min(common, most) / (m + size), end))
    best = 0.0
    for bound, end in sorted(bounds, key=lambda x: (-x[0], x[1])):
        if bound <= best:
            break
        best = max(best, ratio(short, long[max(0, end - m) : end]))
    return best


def _difflib(a: str, b: str) -> float:
    return 1.0 if a and a == b else SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def fuzzy3(backend: str = "indel"):
    """UDF (title_a, title_b, compact_a, compact_b) -> struct<token_set, partial, direct>, each the better of both spellings.

    backend 'difflib' uses one plain sequence ratio for all three.
    """
    kinds = (token_set_ratio, partial_ratio, ratio) if backend == "indel" else (_difflib,) * 3

    @F.pandas_udf("token_set double, partial double, direct double")
    def fuzzy(ta: pd.Series, tb: pd.Series, ca: pd.Series, cb: pd.Series) -> pd.DataFrame:
        seen: dict[tuple, tuple] = {}
        rows = []
        for key in zip(ta, tb, ca, cb):
            if key not in seen:
                seen[key] = tuple(max(f(key[0], key[1]), f(key[2], key[3])) for f in kinds)
            rows.append(seen[key])
        return pd.DataFrame(rows, columns=["token_set", "partial", "direct"], dtype=float)

    return fuzzy
