"""The judge gate: sample, judge, decide, report, then prune (the reports come before anything is removed)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators import judge
from skein.operators.dedup import top_per_group
from skein.operators.synth import Model, ask, replay, with_retries
from skein.functions.jsonx import parse_verdicts, strict_strings
from skein.functions import lexicons as L
from skein.sources.shared import stored
from skein.sources.versions import Versions
from skein.sources.writers import report_json


def verdicts_once(pairs: DataFrame, path: str, rate: float, prompt: Column, model: Model, seed: int = 42) -> DataFrame:
    """Verdicts of a sample, written as a table: no later action calls the model again."""
    sample = judge.judge_sample(pairs, rate, seed)
    judge.judge_pairs(sample, with_retries(model), prompt).write.mode("overwrite").parquet(path)
    return pairs.sparkSession.read.parquet(path)


def replayed_verdicts(sample: DataFrame, responses: DataFrame, prompt: Column) -> DataFrame:
    """As judge_pairs, with recorded responses (prompt_hash, raw) instead of a model."""
    said = parse_verdicts(replay(sample.withColumn("prompt", prompt), responses))
    return said.select("*", *[F.col("verdict")[c].alias(c) for c in L.CRITERIA]).drop("verdict", "prompt", "raw")


def report(verdicts: DataFrame, categories: DataFrame, pass_at: float = 0.85, reject_below: float = 0.70, first: int = 20) -> DataFrame:
    """Per category: rates, decision, the first failures of each criterion, how many critical lines there are and the first of them."""
    decided = judge.decide(judge.with_empty(judge.criterion_rates(verdicts), categories), pass_at, reject_below)
    examples = judge.failure_examples(verdicts).groupBy("category", "criterion").agg(F.sort_array(F.collect_list("line_no")).alias("lines"))
    examples = examples.groupBy("category").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("criterion", "lines")))).alias("failures"))
    critical = judge.critical_lines(verdicts)
    shown = top_per_group(critical, ["category"], ["line_no"], first).groupBy("category").agg(F.sort_array(F.collect_list("line_no")).alias("critical"))
    counted = critical.groupBy("category").agg(F.count("*").alias("n_critical"))
    full = decided.join(examples, "category", "left").join(counted, "category", "left").join(shown, "category", "left")
    return full.withColumn("n_critical", F.coalesce("n_critical", F.lit(0)))


def gate(pairs: DataFrame, verdicts: DataFrame, pass_at: float = 0.85, reject_below: float = 0.70) -> tuple[DataFrame, DataFrame]:
    """(decisions, pairs that stay)."""
    decisions = judge.decide(judge.with_empty(judge.criterion_rates(verdicts), pairs), pass_at, reject_below)
    return decisions, judge.prune(pairs, judge.critical_lines(verdicts), decisions)


def run_gate(table: Versions, model: Model, prompt: Column, record: str, rate: float = 0.12, pass_at: float = 0.85, reject_below: float = 0.70, seed: int = 42) -> int:
    """Judge a sample of the last version's pairs, write the report, then make the next version; its number.

    ``prompt`` may use input, output and category. Answers are recorded in the folder ``record``. Lines that are no pair, or have a
    blank side, are not judged. Critical lines go from categories that pass or warn; rejected categories are
    quarantined whole. A run that fails on the way leaves the last version as it is; run again, it asks no prompt twice.
    """
    base = table.current()
    lines = table.read(base)
    pairs = lines.withColumn("p", strict_strings(F.col("value"), ["input", "output"])).where("trim(p.input) <> '' and trim(p.output) <> ''").select("category", "line_no", "p.*")
    sample = stored(judge.judge_sample(pairs, rate, seed).withColumn("prompt", prompt), "sample")
    said = parse_verdicts(ask(sample, with_retries(model), record))
    verdicts = stored(said.select("category", "line_no", "parse_error", *[F.col("verdict")[c].alias(c) for c in L.CRITERIA]), "verdicts")
    full = stored(report(verdicts, lines, pass_at, reject_below), "report")
    place = f"reports/v{base + 1:08d}-{uuid.uuid4().hex}"
    report_json(full).write.text(f"{table.root}/{place}")
    decided = {r["category"]: r["decision"] for r in full.select("category", "decision").collect()}  # configured categories
    rejected = sorted(c for c, d in decided.items() if d == "reject")
    return table.rewrite(base, judge.critical_lines(verdicts), rejected, place)
