"""Exact quantiles of a distributed column and the outlier filter built on them."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
SMALL = 20_000


def _histogram(values: DataFrame, low: float, high: float) -> list:
    """Row count and extremes of each occupied bin of [low, high]; at most BINS rows."""
    width = high / BINS - low / BINS
    position = F.floor((F.col("v") - F.lit(low)) / F.lit(max(width, 5e-324)))
    slot = F.least(F.greatest(position, F.lit(0)), F.lit(BINS - 1))
    return (
        values.where(F.col("v").between(low, high))
        .groupBy(slot.alias("slot"))
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy("slot")
        .collect()
    )


def _values_at(values: DataFrame, ranks: Sequence[int], n: int, low: float, high: float) -> dict:
    """The values at 0-based ``ranks`` of the sorted column, by narrowing histograms.

    Every round counts an interval into at most ``BINS`` bins (a map-side
    aggregate; no rows are shuffled or sorted) and keeps the bins that hold a
    rank, together with their own extremes.  A bin is finished when it holds one
    distinct value, however often it repeats, or so few rows that they can be
    sorted directly.
    """
    found: dict[int, float] = {}
    small: list[tuple[float, float, int, list[int]]] = []
    pending = [(low, high, 0, n, sorted(set(ranks)))]
    while pending:
        lo, hi, below, count, wanted = pending.pop()
        if lo == hi:
            found.update({r: lo for r in wanted})
        elif count <= SMALL:
            small.append((lo, hi, below, wanted))
        else:
            start = below
            for b in _histogram(values, lo, hi):
                here = [r for r in wanted if start <= r < start + b["n"]]
                if here:
                    pending.append((b["lo"], b["hi"], start, b["n"], here))
                start += b["n"]
    if small:
        inside = reduce(or_, [F.col("v").between(lo, hi) for lo, hi, _, _ in small])
        few = sorted(r["v"] for r in values.where(inside).collect())
        for lo, _, below, wanted in small:
            first = bisect_left(few, lo)
            found.update({r: few[first + r - below] for r in wanted})
    return found


def exact_quantiles(df: DataFrame, column: str, fractions: Sequence[float]) -> list[float | None]:
    """Linear-interpolated quantiles over the non-null values of ``column``."""
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    infinite = F.lit(math.inf)
    finite = F.abs("v") < infinite
    n, under, over, low, high = values.agg(
        F.count("*"), F.count_if(F.col("v") == -infinite), F.count_if(F.col("v") == infinite),
        F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v"))),
    ).first()
    if n == 0:
        return [None for _ in fractions]
    places = [(n - 1) * q for q in fractions]
    left = [math.floor(p) for p in places]
    right = [min(i + 1, n - 1) for i in left]
    # infinities are placed by rank; only finite values are searched by narrowing
    at = {r: -math.inf if r < under else math.inf for r in left + right}
    inner = [r - under for r in at if under <= r < n - over]
    if inner:
        found = _values_at(values.where(finite), inner, n - under - over, low, high)
        at.update({r + under: v for r, v in found.items()})
    return [at[i] if p == i or at[i] == at[j] else at[i] + (at[j] - at[i]) * (p - i) for p, i, j in zip(places, left, right)]


def iqr_bounds(df: DataFrame, column: str, factor: float = 1.5) -> tuple[float, float] | None:
    q1, q3 = exact_quantiles(df, column, [0.25, 0.75])
    if q1 is None:
        return None
    spread = q3 - q1
    return q1 - factor * spread, q3 + factor * spread


def remove_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Keep rows inside the inter-quartile fences, one column after the other.

    Later columns see the rows the earlier ones left.  The fences are plain
    numbers by the time the filter is built, so it reaches the parquet scan.
    """
    for column in columns:
        bounds = iqr_bounds(df, column, factor)
        if bounds is None:
            return df.where(F.lit(False))
        low, high = bounds
        if isinstance(df.schema[column].dataType, T.IntegralType):
            # Whole numbers keep the comparison free of casts, so it can be pushed down.
            low, high = math.ceil(low), math.floor(high)
        df = df.where(F.col(column).between(low, high))
    return df
