"""Drivers of model work (STM-01, UDF-07 to 11): quotas filled with resume, inference, the batch judge.

A model is a function from prompts to answers. What it says is written as a table before it
is used, so no later action, and no executor lost, calls it again for what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.jsonx import array_pairs, lenient_verdict
from skein.functions.text import chat_messages, chatml
from skein.operators import judge, synth
from skein.operators.dedup import top_per_group
from skein.operators.quality import first_reason
from skein.sources.readers import given_pairs
from skein.sources.shared import stored
from skein.sources.writers import append_pairs

PAIRS = "input string, output string, category string"


def existing(spark: SparkSession, path: str) -> DataFrame:
    """Valid pairs of earlier runs; none where there is no folder."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(PAIRS).json(path)
    except AnalysisException:
        return spark.createDataFrame([], PAIRS)
    return rows.where(first_reason(F.col("input"), F.col("output")).isNull())


def fill_quotas(spark: SparkSession, path: str, total: int, model: synth.Model, prompt: Column, batch: int = 25, give_up: int = 5, weights: dict[str, float] | None = None) -> DataFrame:
    """Ask for batches of every category that lacks pairs, all categories side by side, until quotas are full.

    Each round asks for what is still needed by what is there, so a run that was
    broken off goes on. ``prompt`` may use category, batch and size. A category without a pair in
    ``give_up`` rounds in a row is left. Returns run totals by category.
    """
    tallies, barren = [], {}
    while True:
        plan = synth.quota_plan(spark, existing(spark, path), total, batch, weights).where("remaining > 0")
        open_ = plan.where(~F.col("category").isin([c for c, n in barren.items() if n >= give_up]))
        asked = open_.select("category", "remaining", F.explode(F.sequence(F.lit(1).cast("long"), "num_batches")).alias("batch"))
        asked = asked.withColumn("size", F.least(F.lit(batch).cast("long"), F.col("remaining") - (F.col("batch") - 1) * batch)).withColumn("prompt", prompt)
        if asked.isEmpty():
            break
        answers = stored(synth.call_model(asked, model).withColumn("round", F.lit(len(tallies))), "answers")
        pairs = synth.generated_pairs(answers)
        good = pairs.where("reason is null").select("category", "remaining", F.col("transcript").alias("input"), "output")
        order = ["k", "input", "output"]
        kept = stored(top_per_group(good.withColumn("k", F.xxhash64("input", "output")), ["category"], order, total), "pairs")
        ranked = kept.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(*order)))  # of at most total rows
        append_pairs(ranked.where("place <= remaining").select("category", "input", "output"), path)
        failed = answers.select("category", F.coalesce(F.size(array_pairs(F.col("raw"))), F.lit(0)).alias("n_pairs"))
        tallies.append(synth.run_totals(pairs.select("category", "reason"), failed))
        got = {r["category"] for r in kept.select("category").distinct().collect()}
        for r in open_.select("category").collect():
            barren[r["category"]] = 0 if r["category"] in got else barren.get(r["category"], 0) + 1
    if not tallies:
        return spark.createDataFrame([], "category string, generated long, rejected long, failed long")
    out = tallies[0]
    for more in tallies[1:]:
        out = out.unionByName(more)
    return out.groupBy("category").agg(*[F.sum(c).alias(c) for c in ("generated", "rejected", "failed")])


def clean_to_messy(spark: SparkSession, pattern: str, path: str, record: str, model: synth.Model, template: str, wanted: int, text: str = "text", size: int = 25) -> DataFrame:
    """Pairs made of clean texts: a bounded scan, batches to a model, valid pairs appended to their category's folder.

    A run again finds the same texts, asks what has no recorded answer, and appends the pairs that
    are not there: a run that broke off goes on. Returns run totals by category.
    """
    texts = synth.clean_texts(spark, pattern, wanted, text)
    made = stored(synth.messify(texts, model, ["place"], template, size, record), "messy")
    good = made.where("reason is null").select(F.col("transcript").alias("input"), "output", "category")
    append_pairs(good.dropDuplicates().join(existing(spark, path).select("category", "input", "output"), ["category", "input", "output"], "left_anti").select("input", "output", "category"), path)
    return synth.run_totals(made.select("category", "reason"))


def infer(rows: DataFrame, model: synth.Model, system: str, source: str = "input") -> DataFrame:
    """rows with raw_generated, generation_seconds and generated_token_count; prompts are ChatML with an open assistant turn.

    Tokens are counted as the model's words; a model that counts its own gives them in a table.
    """
    import time

    def timed(prompts: list[str]) -> list[str | None]:
        began = time.perf_counter()
        said = model(prompts)
        each = (time.perf_counter() - began) / max(1, len(prompts))
        return [f"{each:.6f}\n{x or ''}" for x in said]

    asked = rows.withColumn("prompt", chatml(chat_messages(system, F.col(source)), generate=True))
    answered = stored(synth.call_model(asked, timed, answer="said").drop("prompt"), "generated")
    text = F.expr("substring(said, instr(said, '\\n') + 1)")
    seconds = F.substring_index("said", "\n", 1).cast("double")
    return answered.withColumns({"raw_generated": text, "generation_seconds": seconds, "generated_token_count": F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("long")}).drop("said")


def judge_batch(lines: DataFrame, model: synth.Model, prompt: Column, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(evaluations, summary) of numbered lines that are pairs; an answer that is none fails every criterion.

    ``prompt`` may use input and output.
    """
    asked = given_pairs(lines).withColumn("prompt", prompt)
    said = stored(synth.call_model(asked, synth.with_retries(model)), "judged")
    found = said.withColumn("v", lenient_verdict(F.col("raw"), compat)).select("pair_index", "v.*").withColumn("parse_error", F.lit(False))
    return found.withColumn("passed", judge.all_pass()), judge.batch_summary(found)
