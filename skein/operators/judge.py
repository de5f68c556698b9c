"""Judging a sample and what follows from it: rates, decisions, pruning (AGG-06 to 09, GAT, WIN-06)."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import lexicons as L
from skein.functions.jsonx import parse_verdicts
from skein.operators.dedup import sample_per_group, top_per_group
from skein.operators.synth import Model, call_model

KEY = ["category", "line_no"]


def _passed(criterion: str) -> Column:
    """A verdict's criterion; an unparsed verdict fails it."""
    return F.coalesce(F.col(criterion), F.lit(False))


def all_pass() -> Column:
    return reduce(and_, [_passed(c) for c in L.CRITERIA])


def judge_sample(pairs: DataFrame, rate: float, seed: int = 42) -> DataFrame:
    return sample_per_group(pairs, "category", KEY, rate, seed)


def judge_pairs(sample: DataFrame, model: Model, prompt: Column) -> DataFrame:
    """sample with the criteria of the model's verdicts and parse_error."""
    said = parse_verdicts(call_model(sample.withColumn("prompt", prompt), model))
    return said.select("*", *[F.col("verdict")[c].alias(c) for c in L.CRITERIA]).drop("verdict", "prompt", "raw")


def criterion_rates(verdicts: DataFrame) -> DataFrame:
    """Per category: sampled, judged, errors, the pass rate of each criterion and of all four."""
    rate = lambda c: F.bround(F.avg(c.cast("int")), 4)
    return verdicts.groupBy("category").agg(
        F.count("*").alias("sampled"),
        F.count_if(~F.col("parse_error")).alias("judged"),
        F.count_if("parse_error").alias("parse_errors"),
        *[rate(_passed(c)).alias(f"{c}_rate") for c in L.CRITERIA],
        rate(all_pass()).alias("pass_rate"),
    )


def decide(rates: DataFrame, pass_at: float = 0.85, reject_below: float = 0.70) -> DataFrame:
    """rates with decision: pass, warn, reject, or skip where nothing was sampled. The rounded rate counts."""
    rate = F.col("pass_rate")
    return rates.withColumn(
        "decision", F.when(F.col("sampled") == 0, "skip").when(rate >= pass_at, "pass").when(rate >= reject_below, "warn").otherwise("reject")
    )


def with_empty(rates: DataFrame, categories: DataFrame) -> DataFrame:
    """rates with a row for each category, of which nothing may have been sampled."""
    out = categories.select("category").distinct().join(rates, "category", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("sampled", "judged", "parse_errors")})


def decision_counts(decisions: DataFrame) -> DataFrame:
    kinds = ("pass", "warn", "reject", "skip")
    return decisions.agg(*[F.count_if(F.col("decision") == k).alias(k) for k in kinds], F.count("*").alias("total"))


def critical_lines(verdicts: DataFrame) -> DataFrame:
    """Keys of judged lines that fail a critical criterion."""
    return verdicts.where(~F.col("parse_error") & reduce(or_, [~_passed(c) for c in L.CRITICAL])).select(*KEY)


def prune(pairs: DataFrame, critical: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs of categories that are not rejected, less critical lines."""
    rejected = decisions.where("decision = 'reject'").select("category")
    return pairs.join(critical.distinct(), KEY, "left_anti").join(rejected, "category", "left_anti")


def failures(verdicts: DataFrame) -> DataFrame:
    """(category, line_no, criterion, rest of the columns): a row for each failed criterion of a parsed verdict."""
    failed = F.array(*[F.when(~_passed(c), F.lit(c)) for c in L.CRITERIA])
    return verdicts.where(~F.col("parse_error")).withColumn("criterion", F.explode(F.filter(failed, lambda c: c.isNotNull())))


def failure_examples(verdicts: DataFrame, n: int = 5) -> DataFrame:
    """The first n failures of each criterion in each category."""
    return top_per_group(failures(verdicts), ["category", "criterion"], ["line_no"], n)


def rates_ascending(rates: DataFrame) -> DataFrame:
    """(category, criteria): criteria with their rates, the lowest first."""
    items = F.array(*[F.struct(F.col(f"{c}_rate").alias("rate"), F.lit(i).alias("ord"), F.lit(c).alias("criterion")) for i, c in enumerate(L.CRITERIA)])
    return rates.select("category", F.transform(F.array_sort(items), lambda x: F.struct(x["criterion"].alias("criterion"), x["rate"].alias("rate"))).alias("criteria"))


def suggestions(rates: DataFrame, spark: SparkSession, below: float = 0.90) -> DataFrame:
    """(category, criterion, rate, suggestion) for criteria that often fail."""
    each = rates_ascending(rates).select("category", F.explode("criteria").alias("c")).select("category", "c.criterion", "c.rate")
    known = spark.createDataFrame(list(L.SUGGESTIONS.items()), "criterion string, suggestion string")
    return each.where(F.col("rate") < below).join(known, "criterion")


def batch_summary(verdicts: DataFrame) -> DataFrame:
    """One row: total, passed, failed, and the criterion that fails most (the first on ties)."""
    counts = [F.count_if(~_passed(c)) for c in L.CRITERIA]
    worst = F.array_max(F.array(*[F.struct(n.alias("n"), F.lit(-i).alias("ord"), F.lit(c).alias("c")) for i, (n, c) in enumerate(zip(counts, L.CRITERIA, strict=True))]))
    return verdicts.agg(
        F.count("*").alias("total"), F.count_if(all_pass()).alias("passed"), F.count_if(~all_pass()).alias("failed"), F.when(worst["n"] > 0, worst["c"]).alias("most_common_failure")
    )


def unexpected(categories: DataFrame, configured: list[str], spark: SparkSession) -> DataFrame:
    """Categories found that are not configured."""
    return categories.select("category").distinct().join(spark.createDataFrame([(c,) for c in configured], "category string"), "category", "left_anti")
