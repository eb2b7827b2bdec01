"""Similarity of strings, and one Arrow function that gives all scores of a pair at once.

Scores are on 0..100 (Jaro-Winkler on 0..1). The edit score is the share of characters in a longest common subsequence;
its length comes from bit-parallel steps over Python integers, a word of any length at a time.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

SCORES = ("ratio", "partial", "token_sort", "token_set", "jaro_winkler")
#: Distinct pairs remembered in a worker.
REMEMBERED = 100_000


def common(a: str, b: str) -> int:
    """Length of a longest common subsequence."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    mask = (1 << len(a)) - 1
    row = mask
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * common(a, b) / total if total else 100.0


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string to a stretch of the longer that is no longer than it, edges included."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    best = max(ratio(short, long[max(0, k) : k + n]) for k in range(1 - n, len(long)))
    return max(best, ratio(long, short)) if len(a) == len(b) else best


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = " ".join(sorted(left & right))
    first, second = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if both and not (first and second):
        return 100.0
    x, y = (f"{both} {z}".strip() for z in (first, second))
    return max(ratio(x, y), *((ratio(both, x), ratio(both, y)) if both else (0.0,)))


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, drawn to 1 by a common beginning of up to four characters if it exceeds 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, left = [False] * len(b), []
    for k, c in enumerate(a):
        for j in range(max(0, k - reach), min(len(b), k + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, u in zip(b, used) if u]
    m, moved = len(left), sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


_BY_NAME = dict(zip(SCORES, (ratio, partial, token_sort, token_set, jaro_winkler)))


@lru_cache(maxsize=REMEMBERED)
def wanted_scores(which: tuple[str, ...], a: str, b: str) -> tuple[float, ...]:
    return tuple(_BY_NAME[s](a, b) for s in which)


def scores(a: Column, b: Column, which: tuple[str, ...] = SCORES) -> Column:
    """A struct of the wanted scores of each pair, no others being computed; null if either is null."""

    @F.pandas_udf(StructType([StructField(s, DoubleType()) for s in which]))
    def each(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        none = (None,) * len(which)
        rows = [none if x is None or y is None else wanted_scores(which, x, y) for x, y in zip(a, b)]
        return pd.DataFrame(rows, columns=list(which), dtype=float)

    return each(a, b)


def with_scores(pairs: DataFrame, a: str, b: str, prefix: str, which: tuple[str, ...], guarded: bool = False) -> DataFrame:
    """``pairs`` with columns prefix_score, computed once for each distinct pair of strings.

    ``guarded`` scores are null unless both strings are non-empty.
    """
    left, right = F.col(a), F.col(b)
    if guarded:
        both = (left != "") & (right != "")
        left, right = F.when(both, left), F.when(both, right)
    distinct = pairs.select(a, b).distinct().withColumn("_s", scores(left, right, which))
    named = distinct.select(F.col(a).alias("_a"), F.col(b).alias("_b"), *[F.nanvl(F.col(f"_s.{s}"), F.lit(None).cast("double")).alias(f"{prefix}_{s}") for s in which])
    return pairs.join(named, F.col(a).eqNullSafe(F.col("_a")) & F.col(b).eqNullSafe(F.col("_b")), "left").drop("_a", "_b")
