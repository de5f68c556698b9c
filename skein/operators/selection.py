"""Exact order statistics without a sort of all values or a buffer that grows with them.

A first pass counts values by sign and binary exponent, which orders them; each further pass cuts
the bucket that holds the wanted rank into ``BUCKETS`` equal parts. Buckets are ordered and
tasks hold a counter for each, so a pass is one small aggregate. As soon as a bucket
holds ``FEW`` rows or one value, its distinct values are fetched. An exponent's values differ in 52
bits and a pass tells twelve apart, so six passes are enough for any doubles; two are usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, FEW = 4096, 10_000


def _exponent(v: Column) -> Column:
    """A bucket that grows with v: below 0 for negative values, 0 for zero."""
    size = F.floor(F.log2(F.abs(v))) + 1100
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("int")


def order_statistics(values: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """The values of given ranks, from 0, in ascending order; nulls and values that are not numbers do not count.

    values are read some three times: hand in a table.
    """
    kept = values.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    found: dict[int, float] = {}
    wanted = sorted(set(ranks))
    # an interval of values, how many values are below it, and the ranks that lie within
    open_ = [(None, None, 0, wanted)] if wanted else []
    while open_:
        low, high, below, inside = open_.pop()
        within = kept if low is None else kept.where((F.col("v") >= low) & (F.col("v") <= high))
        if low is None:
            bucket = _exponent(F.col("v"))
        else:  # halves, as the difference of two doubles need not be one
            span = high / 2 - low / 2
            bucket = F.least(F.floor((F.col("v") / 2 - low / 2) / span * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
        rows = within.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        for r in sorted(rows, key=lambda r: r["b"]):
            here = [k for k in inside if below <= k < below + r["n"]]
            if here and r["low"] == r["high"]:
                found |= dict.fromkeys(here, r["low"])
            elif here and r["n"] <= FEW:
                some = kept.where((F.col("v") >= r["low"]) & (F.col("v") <= r["high"]))
                at = below
                for x in sorted(some.groupBy("v").agg(F.count("*").alias("n")).collect(), key=lambda x: x["v"]):
                    found |= {k: x["v"] for k in here if at <= k < at + x["n"]}
                    at += x["n"]
            elif here:
                open_.append((r["low"], r["high"], below, here))
            below += r["n"]
    return found


def quantiles(values: DataFrame, column: str, fractions: list[float], n: int | None = None) -> list[float | None]:
    """Exact quantiles, between two values by their distances; None without values. n: how many values there are, if known."""
    if n is None:
        n = values.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return [None] * len(fractions)
    places = [f * (n - 1) for f in fractions]
    at = order_statistics(values, column, [k for p in places for k in {int(p), min(int(p) + 1, n - 1)}])
    return [at[int(p)] + (at[min(int(p) + 1, n - 1)] - at[int(p)]) * (p - int(p)) for p in places]
