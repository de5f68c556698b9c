"""Aggregates over pairs and texts (AGG)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import compression, correction_count, filler_density, words
from skein.operators.dedup import top_per_group


def length_stats(pairs: DataFrame, source: str = "input", output: str = "output") -> DataFrame:
    """One row: count, and mean, least and greatest length of inputs and outputs."""
    fields = [F.count("*").alias("n")]
    for c in (source, output):
        fields += [F.avg(F.length(c)).alias(f"avg_{c}"), F.min(F.length(c)).alias(f"min_{c}"), F.max(F.length(c)).alias(f"max_{c}")]
    return pairs.agg(*fields)


def counts_by(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key, the most frequent first."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def total_if_known(rows: DataFrame, value: str) -> DataFrame:
    """One row: the sum, null if any value is unknown."""
    return rows.agg(F.when(F.count(value) == F.count("*"), F.sum(value)).alias("total"))


def vocabulary(pairs: DataFrame, group: list[str], order: list, n: int = 100, text: str = "input") -> DataFrame:
    """Distinct words over words in the first n rows of each group (a sampling operator)."""
    some = top_per_group(pairs, group, order, n)
    each = some.select(*group, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))).alias("w"))
    per_word = each.groupBy(*group, "w").agg(F.count("*").alias("c"))
    return per_word.groupBy(*group).agg((F.count("*") / F.sum("c")).alias("vocab_diversity"))


def profile(pairs: DataFrame, group: list[str], source: str = "input", output: str = "output") -> DataFrame:
    """Of each group: sizes, spread, compression, filler density and self-corrections."""
    each = pairs.select(
        *group,
        F.length(source).alias("ic"),
        F.size(words(F.col(source))).alias("iw"),
        F.length(output).alias("oc"),
        F.size(words(F.col(output))).alias("ow"),
        compression(F.col(source), F.col(output)).alias("cr"),
        filler_density(F.col(source)).alias("fd"),
        correction_count(F.col(source)).alias("sc"),
    )
    sd = F.coalesce(F.stddev_samp("iw"), F.lit(0.0))
    mean = lambda c, d: F.bround(F.avg(c), d)
    return each.groupBy(*group).agg(
        F.count("*").alias("count"),
        mean("ic", 1).alias("avg_input_chars"),
        mean("iw", 1).alias("avg_input_words"),
        mean("oc", 1).alias("avg_output_chars"),
        mean("ow", 1).alias("avg_output_words"),
        mean("cr", 3).alias("avg_compression"),
        mean("fd", 2).alias("avg_filler_density"),
        mean("sc", 2).alias("avg_corrections"),
        F.bround(F.coalesce(F.try_divide(sd, F.avg("iw")), F.lit(0.0)), 3).alias("input_length_cv"),
        F.min("iw").alias("input_word_min"),
        F.max("iw").alias("input_word_max"),
        F.bround(sd, 1).alias("input_word_std"),
    )


def mean_of_means(rows: DataFrame, group: str, value: str) -> DataFrame:
    """One row: the unweighted mean of the groups' means."""
    return rows.groupBy(group).agg(F.avg(value).alias("m")).agg(F.avg("m").alias("mean_of_means"))


def with_total(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """Sums by key and a TOTAL row."""
    return rows.rollup(key).agg(*[F.sum(v).alias(v) for v in values]).withColumn(key, F.coalesce(key, F.lit("TOTAL")))


def directory_size(listing: DataFrame) -> DataFrame:
    """One row: MB of a binaryFile listing's files."""
    return listing.agg((F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("mb"))
