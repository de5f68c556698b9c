"""Joins (J): paired files, anti and semi joins on names, positional zips, side-by-side statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.dedup import top_per_group


def paired(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    return left.join(right, key)


def unmatched(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """Keys on one side only, with side: one full outer join."""
    both = left.select(key, F.lit(True).alias("l")).distinct().join(right.select(key, F.lit(True).alias("r")).distinct(), key, "full_outer")
    return both.where("l is null or r is null").select(key, F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"))


def unmatched_summary(keys: DataFrame, key: str = "key", first: int = 5) -> DataFrame:
    """For each side the number of unmatched keys and the first few of them."""
    shown = top_per_group(keys, ["side"], [key], first).groupBy("side").agg(F.array_sort(F.collect_list(key)).alias("examples"))
    return keys.groupBy("side").agg(F.count("*").alias("n")).join(shown, "side")


def without(rows: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not among names."""
    return rows.join(names.select(*on).distinct(), on, "left_anti")


def only(rows: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among names."""
    return rows.join(names.select(*on).distinct(), on, "left_semi")


def zip_short(a: Column, b: Column, names: tuple[str, str] = ("clean", "messy")) -> Column:
    """Two arrays item by item, as long as the shorter."""
    n = F.least(F.size(a), F.size(b))
    zipped = F.arrays_zip(F.slice(a, 1, n).alias(names[0]), F.slice(b, 1, n).alias(names[1]))
    return zipped


def side_by_side(a: DataFrame, b: DataFrame, key: str, value: str, names: tuple[str, str]) -> DataFrame:
    """Counts of two runs, 0 where one has none."""
    both = a.select(key, F.col(value).alias(names[0])).join(b.select(key, F.col(value).alias(names[1])), key, "full_outer")
    return both.select(key, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
