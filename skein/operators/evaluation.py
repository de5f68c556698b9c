"""Scores of generated rows and their summary (AGG-10 to 13, WIN-07, MET-12 to 15)."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import metrics as M
from skein.functions.text import had_think, round_even, strip_think, words
from skein.operators.selection import quantiles
from skein.sources.shared import scratch


def score(rows: DataFrame) -> DataFrame:
    """Rows (index, input, expected, raw_generated, generation_seconds, generated_token_count) with all metrics."""
    made = rows.withColumn("generated", strip_think(F.col("raw_generated"))).withColumn("had_think", had_think(F.col("raw_generated")))
    g, e = F.col("generated"), F.col("expected")
    checks = M.format_checks(F.col("input"), e, g)
    scored = made.withColumns({"exact": M.exact_match(g, e), "cer": M.cer(g, e), "parts": M.bleu_parts(g, e), **checks})
    return scored.withColumns({"sentence_bleu": M.sentence_bleu(F.col("parts")), "format_accuracy": M.format_accuracy([F.col(c) for c in M.CHECKS])})


def summary(scored: DataFrame) -> DataFrame:
    """One row of aggregates over scored rows; counts of checks are nullable where none applies.

    The figures are written once as a narrow table, which the aggregates and the exact median are read from.
    """
    r4 = lambda c: F.bround(c, 4)
    fields = [
        F.count("*").alias("n"),
        F.count_if("exact").alias("exact_count"),
        r4(F.avg(F.col("exact").cast("int"))).alias("exact_rate"),
        r4(F.avg("cer")).alias("cer_mean"),
        r4(F.min("cer")).alias("cer_min"),
        r4(F.max("cer")).alias("cer_max"),
        r4(F.avg("sentence_bleu")).alias("sentence_bleu_mean"),
        r4(F.avg("format_accuracy")).alias("format_accuracy_mean"),
        F.count("format_accuracy").alias("format_applicable"),
        F.count_if("had_think").alias("think_count"),
    ]
    for c in M.CHECKS:
        fields += [F.count(c).alias(f"{c}_applicable"), F.count_if(F.col(c)).alias(f"{c}_passed")]
    with scratch(scored.select("exact", "cer", "sentence_bleu", "format_accuracy", "had_think", *M.CHECKS), "scores") as figures:
        found = figures.agg(*fields)
        row, (median,) = found.collect(), quantiles(figures, "cer", [0.5])
        made = scored.sparkSession.createDataFrame(row, found.schema)
    names = [c for c in found.columns if c != "cer_min"]
    at = names.index("cer_mean") + 1
    return made.withColumn("cer_median", r4(F.lit(median).cast("double"))).select(*names[:at], "cer_median", "cer_min", *names[at:])


def check_rates(scored: DataFrame) -> DataFrame:
    """(check, applicable, passed, rate) of checks that apply to any row."""
    each = scored.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("ok")) for c in M.CHECKS])).alias("c")).select("c.*")
    return each.where("ok is not null").groupBy("check").agg(F.count("*").alias("applicable"), F.count_if("ok").alias("passed"), round_even(F.avg(F.col("ok").cast("int")), 4).alias("rate"))


def latency(scored: DataFrame) -> DataFrame:
    """One row: tokens, seconds, tokens a second, seconds a sample."""
    s, t = F.sum("generation_seconds"), F.sum("generated_token_count")
    return scored.agg(
        t.alias("total_tokens"), F.bround(s, 2).alias("total_seconds"), F.bround(t / F.greatest(s, F.lit(1e-6)), 2).alias("tokens_per_second"), F.bround(F.avg("generation_seconds"), 3).alias("seconds_per_sample")
    )


def best(scored: DataFrame, k: int = 20) -> DataFrame:
    """The k rows of least error rate: a top-k report."""
    return scored.orderBy(F.asc("cer"), F.desc("exact"), F.desc("sentence_bleu"), F.asc("index")).limit(k)


def worst(scored: DataFrame, k: int = 20) -> DataFrame:
    """The k rows of greatest error rate: a top-k report."""
    return scored.orderBy(F.desc("cer"), F.asc("exact"), F.asc("sentence_bleu"), F.desc("index")).limit(k)


def sanity(outputs: DataFrame, text: str = "generated") -> DataFrame:
    """outputs with problems: empty text, raw chat markers."""
    found = F.array(
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit("empty")),
        F.when(F.contains(F.col(text), F.lit("<|im_start|>")) | F.contains(F.col(text), F.lit("<|im_end|>")), F.lit("chat_markers")),
    )
    return outputs.withColumn("problems", F.filter(found, lambda x: x.isNotNull()))


def compare_precisions(full: DataFrame, small: DataFrame) -> DataFrame:
    """Outputs (idx, text) of two precisions: identical, length ratio, and whether the small one is off."""
    both = full.select("idx", F.col("text").alias("full")).join(small.select("idx", F.col("text").alias("small")), "idx")
    ratio = F.try_divide(F.length("small").cast("double"), F.length("full"))
    return both.select(
        "idx",
        (F.col("full") == F.col("small")).alias("identical"),
        ratio.alias("length_ratio"),
        F.coalesce((ratio < 0.3) | (ratio > 3.0), F.lit(False)).alias("length_off"),
        ((F.trim("full") != "") & (F.trim("small") == "")).alias("emptied"),
    )


#: Shares of the counts 0, 1, 2 ... of a Poisson distribution of mean 1, added up.
POISSON = [sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(8)]


def replicate_weight(seed: int, replicate: Column, key: Column) -> Column:
    """How often a row is drawn in a replicate: Poisson of mean 1 by a digest, alike in every engine and partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), replicate.cast("string"), key.cast("string")).cast("binary"))
    share = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") / F.lit(float(1 << 32))
    return reduce(add, [(share >= F.lit(p)).cast("int") for p in POISSON])


def ab_compare(rows: DataFrame, replicates: int = 200, seed: int = 42, inside: float = 0.95) -> DataFrame:
    """One row for rows (index, expected, a, b): word error rates of two outputs, which is better how often, and an interval of their difference.

    The interval is that of a bootstrap: every replicate weighs each row by a digest, so all replicates are
    sums that tasks add up before anything is shuffled, a row for each replicate and task.
    Rows without an expected text or one of the outputs do not count.
    """
    rate = lambda c: M.word_rate(words(F.col(c)), words(F.col("expected")))
    rated = rows.select("index", rate("a").alias("a"), rate("b").alias("b")).where("a is not null and b is not null")
    with scratch(rated, "ab") as pairs:
        means = [F.count("*").alias("n"), F.avg("a").alias("wer_a"), F.avg("b").alias("wer_b"), F.avg(F.col("a") - F.col("b")).alias("difference")]
        wins = [F.count_if(F.col("a") < F.col("b")).alias("a_better"), F.count_if(F.col("a") > F.col("b")).alias("b_better"), F.count_if(F.col("a") == F.col("b")).alias("ties")]
        whole = pairs.agg(*means, *wins)
        drawn = pairs.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("w", replicate_weight(seed, F.col("r"), F.col("index")))
        sums = drawn.groupBy("r").agg(F.sum(F.col("w") * (F.col("a") - F.col("b"))).alias("d"), F.sum("w").alias("w")).where("w > 0")
        found, row = sorted(r["d"] / r["w"] for r in sums.collect()), whole.collect()
        made = rows.sparkSession.createDataFrame(row, whole.schema)
    low, high = (found[math.floor((1 - inside) / 2 * (len(found) - 1))], found[math.ceil((1 + inside) / 2 * (len(found) - 1))]) if found else (None, None)
    r6 = lambda c: F.bround(c, 6)
    ends = made.withColumn("low", F.lit(low).cast("double")).withColumn("high", F.lit(high).cast("double"))
    return ends.select("n", *[r6(c).alias(c) for c in ("wer_a", "wer_b", "difference", "low", "high")], "a_better", "b_better", "ties")
