"""Dedup, order, split and sampling (WIN), and sets of rows (SET).

Orders come from a digest of keys and a seed, so they do not depend on how the
data are partitioned. A split of exact sizes needs places in one global order;
see ``digest_places``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import dedup_key
from skein.sources.shared import stored


def first_occurrences(pairs: DataFrame, order: list[str], text: str = "input") -> DataFrame:
    """Of rows with one normalised text the first in order (ties: any one of equal rows)."""
    keyed = pairs.withColumn("__key", F.sha2(dedup_key(F.coalesce(F.col(text), F.lit(""))), 256))
    w = Window.partitionBy("__key").orderBy(*order)
    return keyed.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__key")


def duplicate_count(pairs: DataFrame, text: str = "input") -> DataFrame:
    """One row: n, n_distinct, n_duplicates."""
    key = F.sha2(dedup_key(F.coalesce(F.col(text), F.lit(""))), 256)
    counted = pairs.groupBy(key.alias("k")).agg(F.count("*").alias("c"))
    return counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("n_distinct")).select("n", "n_distinct", (F.col("n") - F.col("n_distinct")).alias("n_duplicates"))


def shuffle_key(seed: int, *columns: str) -> Column:
    """A digest that orders rows at random, alike in every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]).cast("binary"))


def digest_places(rows: DataFrame, digest: str, key: list[str], name: str = "place", digits: int = 4, group: str | None = None, total: str | None = None) -> DataFrame:
    """rows with their place from 0 in the order of a hexadecimal digest (ties by key), in all or in each group.

    Rows are numbered within buckets of the digest's first digits, and the
    buckets before each are counted: no task sees all rows of a group. There are
    at most 16 ** digits buckets (of a group); their counts are broadcast if
    there is one group, else Spark joins them as their size has it.
    """
    by = [group] if group else []
    bucketed = rows.withColumn("__bucket", F.left(F.col(digest), F.lit(digits)))
    counts = bucketed.groupBy(*by, "__bucket").agg(F.count("*").alias("__n"))
    all_ = Window.partitionBy(*by)
    before = counts.select(*by, "__bucket", (F.sum("__n").over(all_.orderBy("__bucket")) - F.col("__n")).alias("__before"), F.sum("__n").over(all_).alias("__total"))
    within = F.row_number().over(Window.partitionBy(*by, "__bucket").orderBy(digest, *key))
    numbered = bucketed.withColumn("__within", within)
    if group:  # a null group is one as well
        same = numbered[group].eqNullSafe(before[group]) & (numbered["__bucket"] == before["__bucket"])
        placed = numbered.join(before, same).drop(before[group]).drop(before["__bucket"])
    else:
        placed = numbered.join(F.broadcast(before), "__bucket")
    if total:
        placed = placed.withColumn(total, F.col("__total"))
    return placed.withColumn(name, F.col("__before") + F.col("__within") - 1).drop("__bucket", "__within", "__before", "__total")


def exact_split(rows: DataFrame, key: list[str], seed: int = 42, train: float = 0.90, valid: float = 0.05) -> DataFrame:
    """rows with split: floor(n * train) train, floor(n * valid) valid, the rest test."""
    n = rows.count()
    n_train, n_valid = int(n * train), int(n * valid)
    placed = digest_places(rows.withColumn("__order", shuffle_key(seed, *key)), "__order", key, "__place")
    split = F.when(F.col("__place") < n_train, "train").when(F.col("__place") < n_train + n_valid, "valid").otherwise("test")
    return placed.withColumn("split", split).drop("__order", "__place")


def sample_per_group(rows: DataFrame, group: str, key: list[str], rate: float, seed: int = 42) -> DataFrame:
    """ceil(n * rate) rows of each group, chosen by digest; a sampling operator. A large group is numbered by buckets of the digest."""
    placed = digest_places(rows.withColumn("__order", shuffle_key(seed, *key)), "__order", key, "__place", 2, group, "__n")
    return placed.where(F.col("__place") < F.ceil(F.col("__n") * F.lit(rate))).select(*rows.columns)


def sample_at_most(rows: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """n rows by digest, or all if there are fewer."""
    return rows.withColumn("__order", shuffle_key(seed, *key)).orderBy("__order", *key).limit(n).drop("__order")


def top_per_group(rows: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group; Spark cuts groups before and after the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


#: Counts (a row for each file and group) up to which they are broadcast.
FEW_COUNTS = 1_000_000


def ordered_places(rows: DataFrame, order: list[str], name: str = "place", group: str | None = None, total: str | None = None) -> DataFrame:
    """rows with their place from 0 in the order of columns, in all or in each group; total: a column for the rows of the group.

    Rows are dealt by ranges of group and order and written, so each file holds one
    stretch of the order however large a group is. A place is the rows of the group in the files before
    and the place in its own file: only the counts, a row for each file and group, are shuffled. Rows alike in group and
    order stand in any order, which the table fixes.
    """
    by = [group] if group else []
    table = stored(rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order), "ordered")
    lined = table.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = lined.groupBy(*by, "__file").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"), F.min(F.struct(*order)).alias("__low"))
    all_ = Window.partitionBy(*by)  # over the counts
    before = counts.select(*by, "__file", "__first", (F.sum("__n").over(all_.orderBy("__low")) - F.col("__n")).alias("__before"), F.sum("__n").over(all_).alias("__total"))
    before = F.broadcast(before) if before.count() <= FEW_COUNTS else before
    if group:  # a null group is one as well
        placed = lined.join(before, (lined["__file"] == before["__file"]) & lined[group].eqNullSafe(before[group])).drop(before["__file"]).drop(before[group])
    else:
        placed = lined.join(before, "__file")
    if total:
        placed = placed.withColumn(total, F.col("__total"))
    return placed.withColumn(name, F.col("__before") + F.col("__row") - F.col("__first")).drop("__file", "__row", "__first", "__before", "__total")


def batches(rows: DataFrame, group: str, order: list[str], size: int = 25) -> DataFrame:
    """rows with batch, their number in fixed-size batches of a group."""
    return ordered_places(rows, order, "batch", group).withColumn("batch", F.floor(F.col("batch") / size).cast("int"))


def still_needed(rows: DataFrame, plan: DataFrame, order: list[str]) -> DataFrame:
    """Of each category's rows the first plan.remaining."""
    asked = rows.join(plan.where("remaining > 0").select("category", "remaining"), "category")
    return ordered_places(asked, order, "__place", "category").where("__place < remaining").drop("__place", "remaining")


def union_sources(*ranked: DataFrame) -> DataFrame:
    """All rows, with src_rank by argument order; columns that one lacks are null."""
    out = None
    for rank, rows in enumerate(ranked):
        rows = rows.withColumn("src_rank", F.lit(rank))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
