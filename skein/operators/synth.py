"""Synthesis: keyword categories (CLS), quotas and costs (PLN, AGG-19), and model calls (UDF).

A model is a function from a list of prompts to a list of answers (or None). It runs in
``mapInPandas`` on the executors; ``replay`` answers from a table of recorded responses.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import lexicons as L
from skein.functions.jsonx import array_pairs
from skein.functions.text import first_paragraph, numbered_list
from skein.operators.dedup import batches
from skein.operators.joins import zip_short
from skein.operators.quality import first_reason
from skein.sources.readers import file_name, listing
from skein.sources.shared import stored

Model = Callable[[list[str]], list[str | None]]


def keyword_scores(text: Column) -> Column:
    """array<struct<score, rank, category>>: distinct keywords of each category in the text."""
    low = F.lower(text)
    scores = [
        F.struct(
            reduce(add, [F.contains(low, F.lit(k.lower())).cast("int") for k in keywords]).alias("score"),
            F.lit(-rank).alias("rank"),
            F.lit(category).alias("category"),
        )
        for rank, (category, keywords) in enumerate(L.CATEGORY_KEYWORDS.items())
    ]
    return F.array(*scores)


def category(text: Column, least: int = 2) -> Column:
    """The category with most keywords, the earlier on ties, null below ``least``."""
    best = F.array_max(keyword_scores(text))
    return F.when(best["score"] >= least, best["category"])


def eligible(rows: DataFrame) -> DataFrame:
    """Rows of the categories that clean texts may be turned into messy ones for."""
    return rows.where(F.col("category").isin(L.CLEAN_TO_MESSY))


def category_types(categories: DataFrame) -> DataFrame:
    """categories with type: core or domain_specific."""
    return categories.withColumn("type", F.when(F.col("category").isin(L.CORE_CATEGORIES), "core").otherwise("domain_specific"))


def queue(counts: DataFrame, target: int, at_once: int = 4) -> DataFrame:
    """counts (category, n) with state (complete or pending) and wave, the number of the group of ``at_once`` that a pending one runs in.

    Categories are configured, so the window over them has a few rows.
    """
    state = counts.withColumn("state", F.when(F.col("n") >= target, "complete").otherwise("pending"))
    place = F.row_number().over(Window.partitionBy("state").orderBy("category")) - 1
    return state.withColumn("wave", F.when(F.col("state") == "pending", F.floor(place / at_once).cast("int")))


def run_totals(generated: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Per category and in TOTAL: generated and rejected pairs (by reason), and failed answers.

    generated has category and reason; asked has category and n_pairs of each answer, 0 for a failed one.
    """
    made = generated.select("category", F.col("reason").isNull().cast("long").alias("g"), F.col("reason").isNotNull().cast("long").alias("r"), F.lit(0).cast("long").alias("f"))
    if asked is not None:
        none = F.lit(0).cast("long")
        made = made.unionByName(asked.select("category", none.alias("g"), none.alias("r"), (F.col("n_pairs") == 0).cast("long").alias("f")))
    sums = made.rollup("category").agg(F.sum("g").alias("generated"), F.sum("r").alias("rejected"), F.sum("f").alias("failed"), F.grouping("category").alias("all"))
    return sums.where("all = 1 or category is not null").select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("category")).alias("category"), "generated", "rejected", "failed")


def clean_texts(spark: SparkSession, pattern: str, wanted: int, text: str = "text", scan_factor: int = 20) -> DataFrame:
    """Up to ``wanted`` (place, text, category) of first fitting paragraphs of eligible categories, from a bounded scan of Parquet files.

    Files are read in the order of their paths, as many again as before in each step, until
    enough texts are found or ``scan_factor`` times as many rows were seen; files behind are
    not opened. place is that of the row in all files, so the same texts are found however files are
    split. Both numbers are the feature's limits.
    """
    files = [r["path"] for r in listing(spark, pattern).orderBy("path").collect()]
    seen, at, step, most = 0, 0, 1, scan_factor * wanted
    found = spark.createDataFrame([], "place long, text string, category string")
    have = 0
    while at < len(files) and seen < most and have < wanted:
        some = files[at : at + step]
        rows = spark.read.parquet(*some).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"), first_paragraph(F.col(text)).alias("text"))
        firsts = []
        for path in some:  # counts come from the footers
            firsts.append((file_name(path), seen))
            seen += spark.read.parquet(path).count()
        placed = rows.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(spark.createDataFrame(firsts, "file string, first long")), "file")
        placed = placed.withColumn("place", F.col("first") + F.col("row")).where(F.col("place") < most)
        fitting = placed.where("text is not null").withColumn("category", category(F.col("text"))).where(F.col("category").isin(L.CLEAN_TO_MESSY))
        found = found.unionByName(stored(fitting.orderBy("place").limit(wanted - have).select("place", "text", "category"), "clean"))
        have = found.count()
        at, step = at + len(some), 2 * step
    return found


def quota_plan(spark: SparkSession, existing: DataFrame, total: int, batch_size: int = 25, weights: dict[str, float] | None = None) -> DataFrame:
    """Per category: target (half to even), existing, remaining and batches; targets of 0 are left out."""
    rows = [(c, i, w) for i, (c, w) in enumerate((weights or L.CATEGORY_WEIGHTS).items())]
    plan = spark.createDataFrame(rows, "category string, ord int, proportion double")
    plan = plan.withColumn("target", F.bround(F.lit(float(total)) * F.col("proportion"), 0).cast("long")).where("target > 0")
    have = existing.groupBy("category").agg(F.count("*").alias("existing"))
    joined = plan.join(have, "category", "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    remaining = F.greatest(F.col("target") - F.col("existing"), F.lit(0))
    return joined.withColumn("remaining", remaining).withColumn("num_batches", F.ceil(F.col("remaining") / batch_size).cast("long"))


def generation_cost(samples: Column, batch_size: int = 25, tokens: tuple[int, int] = (1500, 2000), price: tuple[float, float] = (3.0, 15.0)) -> Column:
    """struct<batches, input_tokens, output_tokens, usd>; prices for a million tokens."""
    n = F.ceil(samples / batch_size).cast("long")
    usd = n * tokens[0] / 1e6 * price[0] + n * tokens[1] / 1e6 * price[1]
    return F.struct(n.alias("batches"), (n * tokens[0]).alias("input_tokens"), (n * tokens[1]).alias("output_tokens"), F.bround(usd, 2).alias("usd"))


def judging_cost(counts: DataFrame, rate: float, tokens: tuple[int, int] = (800, 50), price: tuple[float, float] = (3.0, 15.0)) -> DataFrame:
    """One row for counts (category, n): calls, tokens and dollars."""
    calls = counts.agg(F.sum(F.ceil(F.col("n") * F.lit(rate)).cast("long")).alias("calls"))
    usd = F.col("calls") * tokens[0] / 1e6 * price[0] + F.col("calls") * tokens[1] / 1e6 * price[1]
    return calls.select("calls", (F.col("calls") * tokens[0]).alias("input_tokens"), (F.col("calls") * tokens[1]).alias("output_tokens"), F.bround(usd, 4).alias("usd"))


def with_retries(model: Model, tries: int = 3, wait: float = 2.0) -> Model:
    """The model, called again after an error, each time after twice the wait; after the last its prompts have no answers."""

    def call(prompts: list[str]) -> list[str | None]:
        for k in range(tries):
            try:
                return model(prompts)
            except Exception as e:
                if k == tries - 1:
                    print(f"{len(prompts)} prompts have no answer: {e!r}", file=sys.stderr)
                else:
                    time.sleep(wait * 2**k)
        return [None] * len(prompts)

    return call


def call_model(rows: DataFrame, model: Model, prompt: str = "prompt", answer: str = "raw", batch: int = 25, at_once: int = 1) -> DataFrame:
    """rows with the model's answers, null where it gives none; a task has ``at_once`` calls of ``batch`` prompts under way.

    Write the result as a table before using it twice, or the model is called again.
    """
    schema = rows.withColumn(answer, F.lit(None).cast("string")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(at_once) as pool:
            for frame in frames:
                prompts = frame[prompt].tolist()
                said = [x for part in pool.map(model, [prompts[a : a + batch] for a in range(0, len(prompts), batch)]) for x in part]
                yield frame.assign(**{answer: pd.Series(said, index=frame.index, dtype=object)})

    return rows.mapInPandas(run, schema)


RESPONSES = "prompt_hash string, raw string"


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """Responses (``RESPONSES``) recorded in a folder, one for each prompt; none where there is no folder."""
    try:
        rows = spark.read.schema(RESPONSES).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], RESPONSES)
    return rows.groupBy("prompt_hash").agg(F.min("raw").alias("raw"))


def ask(rows: DataFrame, model: Model, path: str, prompt: str = "prompt", batch: int = 25, at_once: int = 4) -> DataFrame:
    """rows with raw, the answers to their prompts; equal prompts are asked once, those recorded in the folder not at all.

    New answers are appended to the record before anything uses them, so a run that was
    broken off, or a later one, asks for the rest only. Prompts without an answer (null) are not recorded:
    a later run asks them again.
    """
    spark = rows.sparkSession
    hashed = rows.withColumn("prompt_hash", F.sha2(F.col(prompt), 256))
    open_ = hashed.where(F.col(prompt).isNotNull()).groupBy("prompt_hash").agg(F.first(prompt).alias("__prompt"))
    open_ = open_.join(recorded(spark, path).select("prompt_hash"), "prompt_hash", "left_anti")
    said = call_model(open_, model, "__prompt", "raw", batch, at_once).where("raw is not null")
    said.select("prompt_hash", "raw").write.mode("append").parquet(path)
    return hashed.join(recorded(spark, path), "prompt_hash", "left").drop("prompt_hash")


def replay(rows: DataFrame, responses: DataFrame, prompt: str = "prompt") -> DataFrame:
    """rows with raw from recorded responses (prompt_hash, raw): a model that needs no network."""
    return rows.withColumn("prompt_hash", F.sha2(prompt, 256)).join(responses.select("prompt_hash", "raw"), "prompt_hash", "left").drop("prompt_hash")


def split_system(messages: Column) -> Column:
    """struct<system, messages>: system contents joined, and the other messages."""
    system = F.transform(F.filter(messages, lambda m: m["role"] == "system"), lambda m: m["content"])
    return F.struct(F.array_join(system, "\n\n").alias("system"), F.filter(messages, lambda m: m["role"] != "system").alias("messages"))


def answer_or_reasoning(content: Column, reasoning: Column) -> Column:
    return F.coalesce(content, reasoning)


def generated_pairs(answers: DataFrame, raw: str = "raw") -> DataFrame:
    """A row for each pair of each answer with reason (null: valid); an unparsed answer gives none."""
    each = answers.withColumn("pair", F.explode(array_pairs(F.col(raw)))).select("*", "pair.transcript", "pair.output").drop("pair", raw)
    return each.withColumn("reason", first_reason(F.col("transcript"), F.col("output")))


def messify(texts: DataFrame, model: Model, order: list[str], template: str, size: int = 25, record: str | None = None) -> DataFrame:
    """Clean texts in numbered batches to a model; its items zipped with the texts as far as both go.

    With a folder ``record`` answers are kept there, and what is recorded is not asked again.
    """
    grouped = batches(texts, "category", order, size)
    lists = grouped.groupBy("category", "batch").agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, "text"))), lambda x: x["text"]).alias("clean"))
    asked = lists.withColumn("prompt", F.replace(F.lit(template), F.lit("{texts}"), numbered_list(F.col("clean"))))
    answered = ask(asked, model, record) if record else call_model(asked, model)
    messy = F.transform(F.filter(array_pairs(F.col("raw")), lambda p: p["transcript"].isNotNull()), lambda p: p["transcript"])
    zipped = answered.select("category", "batch", F.explode(zip_short(F.col("clean"), messy)).alias("z"))
    pairs = zipped.select("category", "batch", F.col("z.messy").alias("transcript"), F.col("z.clean").alias("output"))
    return pairs.withColumn("reason", first_reason(F.col("transcript"), F.col("output")))


def fill_loop(plan: list[tuple[str, int]], produce: Callable[[str, int], int], batch: int = 25, give_up: int = 5) -> dict[str, int]:
    """Ask for batches until each category has its remaining pairs or fails ``give_up`` times in a row."""
    made = {}
    for name, remaining in plan:
        got = failures = 0
        while got < remaining and failures < give_up:
            new = produce(name, min(batch, remaining - got))
            got, failures = got + min(new, remaining - got), 0 if new else failures + 1
        made[name] = got
    return made
