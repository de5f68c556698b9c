"""Reports as lines (SNK-10, 12, 15, 17): tables of (ord, line) that are printed or written in order.

Only counts, sums and the few rows of a top-k report come here, never rows of a corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import fixed, truncate
from skein.operators.compare import verdict_counts
from skein.operators.stats import counts_by, length_stats
from skein.sources.writers import fixed_width


def _numbered(*parts: DataFrame) -> DataFrame:
    """Parts (line, and what orders them within) one after another."""
    named = [p.select(F.lit(i).alias("part"), F.col("ord").cast("string").alias("ord"), "line") for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, named)


def stats_lines(pairs: DataFrame, label: str, source: str = "input", output: str = "output") -> DataFrame:
    """(part, ord, line): samples and mean lengths, and the rows of each source, the most frequent first."""
    one = length_stats(pairs, source, output)
    head = one.select(F.lit(0).alias("ord"), F.format_string(label + ": %d samples, avg input: %.0f chars, avg output: %.0f chars", "n", F.bround(f"avg_{source}", 0), F.bround(f"avg_{output}", 0)).alias("line"))
    counted = counts_by(pairs, "source")
    sources = counted.select(F.format_string("%019d %s", F.lit((1 << 62)) - F.col("n"), "source").alias("ord"), F.format_string("  %s: %d", "source", "n").alias("line"))
    return _numbered(head, sources)


def sample_blocks(rows: DataFrame, order: list[Column], k: int = 20, width: int = 200) -> DataFrame:
    """(rank, line): a block of each of the first k scored rows: its scores and the beginnings of its texts. A top-k report."""
    shown = rows.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # over the k rows
    accuracy = F.when(F.col("format_accuracy").isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f", "format_accuracy"))
    mark = F.when(F.col("exact"), F.lit("yes")).otherwise(F.lit("no"))
    cut = lambda c: F.left(F.col(c), F.lit(width))
    lines = [
        F.format_string("#%d  (CER: %s | BLEU: %s | Exact: %s | Format: %s)", F.col("rank"), fixed(F.col("cer"), 4), fixed(F.col("sentence_bleu"), 4), mark, accuracy),
        F.concat(F.lit("INPUT:     "), cut("input")),
        F.concat(F.lit("EXPECTED:  "), cut("expected")),
        F.concat(F.lit("GENERATED: "), cut("generated")),
    ]
    return shown.select("rank", F.array_join(F.array(*lines), "\n").alias("line"))


def comparison_lines(winners: DataFrame, verdicts: DataFrame, profiles: DataFrame, side: str = "dataset") -> DataFrame:
    """(part, ord, line): each category's metrics with their winners, verdicts, their tally, and each side's means over categories."""
    number = lambda c: F.format_string("%.2f", F.col(c))
    table = winners.select("category", "metric", number("a").alias("a"), number("b").alias("b"), "winner")
    widths = {"category": 28, "metric": 20, "a": 10, "b": 10, "winner": 6}
    metrics = fixed_width(table, widths).select(F.col("line").alias("ord"), "line")
    each = fixed_width(verdicts.select("category", "verdict", F.concat_ws(":", "score_a", "score_b").alias("score")), {"category": 28, "verdict": 12, "score": 6})
    tally = verdict_counts(verdicts).select("verdict", F.format_string("%s: %d", "verdict", "n").alias("line"))
    means = profiles.groupBy(side).agg(F.avg("avg_input_words").alias("w"), F.avg("avg_filler_density").alias("d"), F.sum("count").alias("n"))
    means = means.select(F.col(side).alias("ord"), F.format_string("%s: avg input words %.1f, avg filler density %.1f%%, %d samples", side, F.bround("w", 1), F.bround("d", 1), "n").alias("line"))
    return _numbered(metrics, each.select(F.col("line").alias("ord"), "line"), tally.select(F.col("verdict").alias("ord"), "line"), means)


def training_summary(log: DataFrame, model: str, train_rows: int, valid_rows: int) -> DataFrame:
    """One row: what a run of a parsed log came to."""
    first = F.min(F.when(F.col("val_loss").isNotNull(), F.struct("iter", "val_loss")))["val_loss"]
    last = F.max(F.when(F.col("val_loss").isNotNull(), F.struct("iter", "val_loss")))["val_loss"]
    final = F.max(F.when(F.col("train_loss").isNotNull(), F.struct("iter", "train_loss")))["train_loss"]
    return log.agg(
        F.lit("completed").alias("status"),
        F.lit(model).alias("model"),
        F.lit(train_rows).cast("long").alias("train_samples"),
        F.lit(valid_rows).cast("long").alias("valid_samples"),
        first.alias("initial_eval_loss"),
        final.alias("final_train_loss"),
        last.alias("final_eval_loss"),
        F.min("val_loss").alias("best_eval_loss"),
        F.max("iter").alias("total_steps"),
    )


def headline(summary: DataFrame) -> DataFrame:
    """(part, ord, line): the headline metrics of an evaluation's summary with corpus_bleu."""
    lines = [
        F.format_string("Exact Match:     %d/%d (%s%%)", "exact_count", "n", fixed(F.col("exact_rate") * 100, 1)),
        F.format_string("CER (mean):      %.4f (median: %.4f, range: %.4f-%.4f)", "cer_mean", "cer_median", "cer_min", "cer_max"),
        F.format_string("BLEU (corpus):   %.4f", "corpus_bleu"),
        F.format_string("BLEU (sent avg): %.4f", "sentence_bleu_mean"),
    ]
    return _numbered(summary.select(F.posexplode(F.array(*lines)).alias("ord", "line")))


def first_lines(lines: DataFrame, n: int = 55, width: int = 120) -> list[str]:
    """The first lines of a report, cut, for a driver's log."""
    return [r["line"] for r in lines.orderBy("part", "ord").limit(n).select(truncate(F.col("line"), width).alias("line")).collect()]
