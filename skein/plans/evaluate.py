"""Evaluation: generated rows to scores, a summary, best and worst rows, and reports (SNK-09 to 12)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.metrics import corpus_bleu
from skein.functions.text import fixed, pretty_label
from skein.operators import evaluation as E
from skein.sources.shared import stored


@dataclass
class Evaluated:
    scored: DataFrame
    summary: DataFrame
    best: DataFrame
    worst: DataFrame


def evaluate(rows: DataFrame, k: int = 20) -> Evaluated:
    scored = stored(E.score(rows), "scored")
    summary = E.summary(scored).crossJoin(corpus_bleu(scored)).crossJoin(E.latency(scored))  # one row each
    return Evaluated(scored, summary, E.best(scored, k), E.worst(scored, k))


def check_lines(rates: DataFrame) -> DataFrame:
    """Report lines such as 'Filler Removal: 126/126 (100.0%)'."""
    return rates.select(F.format_string("%s: %d/%d (%s%%)", pretty_label(F.col("check")), "passed", "applicable", fixed(F.col("rate") * 100, 1)).alias("line"))


def acceptance(summary: DataFrame, cer_below: float = 0.10, fillers_above: float = 0.95) -> DataFrame:
    """Whether the targets are met."""
    fillers = F.try_divide(F.col("filler_removal_ok_passed").cast("double"), F.col("filler_removal_ok_applicable"))
    return summary.select((F.col("cer_mean") < cer_below).alias("cer_ok"), F.coalesce(fillers > fillers_above, F.lit(False)).alias("fillers_ok"))


def card(name: str, base: str, metrics: dict | None) -> str:
    """A model card; metric rows only if there are metrics."""
    lines = [f"# {name}", "", f"Fine-tuned from {base}."]
    if metrics:
        lines += ["", "| Metric | Value |", "|---|---|", *(f"| {k} | {v} |" for k, v in metrics.items() if v is not None)]
    return "\n".join(lines) + "\n"
