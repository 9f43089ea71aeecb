"""String similarity that Spark lacks, as Arrow-batched functions, and vector similarity as expressions.

Each function compares the distinct pairs of a batch once.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over one machine integer of any width."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """200 * LCS / (length of both); 100 for two empty strings."""
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best of shared words against each side and of the sides with the shared words before the rest; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    with_left, with_right = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = indel_ratio(with_left, with_right)
    return max(best, indel_ratio(both, with_left), indel_ratio(both, with_right)) if both else best


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    other = [c for c, t in zip(b, taken, strict=True) if t]
    turned = sum(x != y for x, y in zip(mine, other, strict=True)) // 2
    m = len(mine)
    jaro = (m / len(a) + m / len(b) + (m - turned) / m) / 3
    head = 0
    while head < min(4, len(a), len(b)) and a[head] == b[head]:
        head += 1
    return jaro + head * weight * (1 - jaro) if jaro > 0.7 else jaro


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance."""
    last: dict[str, int] = {}
    most = len(a) + len(b)
    grid = [[most] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        grid[i + 1][1] = i
    for j in range(len(b) + 1):
        grid[1][j + 1] = j
    for i, c in enumerate(a, 1):
        back = 0
        for j, d in enumerate(b, 1):
            k, match = last.get(d, 0), back
            same = c == d
            if same:
                back = j
            grid[i + 1][j + 1] = min(grid[i][j] + (not same), grid[i + 1][j] + 1, grid[i][j + 1] + 1, grid[k][match] + (i - k - 1) + 1 + (j - match - 1))
        last[c] = i
    return grid[-1][-1]


def damerau_similarity(a: str, b: str) -> float:
    return 1 - damerau(a, b) / max(len(a), len(b)) if a or b else 1.0


def sequence_ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp; the order of the arguments matters."""
    return SequenceMatcher(None, a, b).ratio()


def _column(function):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple, float | None] = {}
        out = []
        for pair in zip(a, b, strict=True):
            if pair not in known:
                known[pair] = None if pair[0] is None or pair[1] is None else function(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run


token_sort_ratio = _column(token_sort)
token_set_ratio = _column(token_set)
jaro_winkler_similarity = _column(jaro_winkler)
damerau_levenshtein_similarity = _column(damerau_similarity)
difflib_ratio = _column(sequence_ratio)


@F.pandas_udf(T.DoubleType())
def difflib_ratio_from(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """As difflib_ratio, but 0 where the letters in common, repeats counted, already say that it is below `least`."""
    may = lambda x, y, low: 2 * sum(min(x.count(c), y.count(c)) for c in set(x)) >= (low - 1e-9) * (len(x) + len(y))
    return pd.Series([sequence_ratio(x, y) if may(x, y, low) else 0.0 for x, y, low in zip(a, b, least)], dtype="float64")


def neighbourhoods_agree(a: Column, b: Column, least: float = 75.0) -> Column:
    """True if either is missing or both agree by sorted words."""
    from siteweave.functions.text import MISSING

    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return F.when(x.isin(*MISSING) | y.isin(*MISSING), True).when(F.upper(x) == F.upper(y), True).otherwise(token_sort_ratio(F.upper(x), F.upper(y)) >= least)


def cosine(a: Column, b: Column) -> Column:
    """Dot product over the norms, kept from zero as the matcher does."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / ((F.sqrt(dot(a, a)) + 1e-9) * (F.sqrt(dot(b, b)) + 1e-9))
