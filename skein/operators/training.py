"""The tabular side of training and publishing (JSN-08, J-09, WIN-12, WIN-13, MOD)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.jsonx import log_record


def parse_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """A row of numbers for each line with an iteration."""
    return lines.withColumn("r", log_record(F.col(line))).where("r is not null").select(*[c for c in lines.columns if c != line], "r.*")


def best_iteration(log: DataFrame) -> DataFrame:
    """One row: the iteration of least validation loss (the earliest on ties), that loss, and the last training loss."""
    return log.agg(
        F.min(F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "iter")))["iter"].alias("best_iter"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("train_loss", F.when(F.col("train_loss").isNotNull(), F.col("iter"))).alias("last_train_loss"),
    )


def best_checkpoint(log: DataFrame, files: DataFrame) -> DataFrame:
    """The file of the best iteration: zero-padded name, plain name, then any name that holds the number."""
    best = best_iteration(log).where("best_iter is not null")
    name = F.element_at(F.split("path", "/"), -1)
    n = F.col("best_iter").cast("string")
    rank = (
        F.when(name == F.concat(F.lit("adapters-"), F.lpad(n, 9, "0"), F.lit(".safetensors")), 0)
        .when(name == F.concat(F.lit("adapters-"), n, F.lit(".safetensors")), 1)
        .when(F.startswith(name, F.lit("adapters")) & F.contains(name, n), 2)
    )
    ranked = files.crossJoin(F.broadcast(best)).withColumn("rank", rank)  # one row of best
    return ranked.where("rank is not null").groupBy("best_iter").agg(F.min(F.struct("rank", "path"))["path"].alias("path"))


def latest_checkpoint(files: DataFrame, pattern: str = r"-(\d+)") -> DataFrame:
    """One row: the path with the greatest number."""
    n = F.regexp_extract("path", pattern, 1).try_cast("long")
    return files.agg(F.max_by("path", n).alias("path"))


def missing_files(listing: DataFrame, expected: list[str]) -> DataFrame:
    """Per directory: expected names that are not there."""
    have = listing.groupBy("dir").agg(F.collect_set("name").alias("names"))
    return have.select("dir", F.array_sort(F.array_except(F.array(*[F.lit(x) for x in expected]), "names")).alias("missing"))


def any_of(listing: DataFrame, pattern: str) -> DataFrame:
    """Per directory: whether some name fits (weights, tokenizer files)."""
    return listing.groupBy("dir").agg(F.coalesce(F.bool_or(F.col("name").rlike(pattern)), F.lit(False)).alias("found"))


def normalized_summary(rows: DataFrame, train: list[str], valid: list[str], compat: bool = False) -> DataFrame:
    """final_train_loss and best_val_loss from the first of several columns; compat passes over zeros."""
    pick = lambda cs: F.coalesce(*[F.nullif(F.col(c), F.lit(0.0)) if compat else F.col(c) for c in cs])
    return rows.withColumns({"final_train_loss": pick(train), "best_val_loss": pick(valid)})


def compression_ratio(before_mb: Column, after_mb: Column) -> Column:
    return F.bround(F.try_divide(before_mb, after_mb), 2)


def base_name(path: Column) -> Column:
    """The last part of a path, for what is published."""
    return F.element_at(F.split(path, "/"), -1)


def first_existing(*candidates: tuple[Column, str]) -> Column:
    """The name of the first candidate that exists."""
    return F.coalesce(*[F.when(there, F.lit(name)) for there, name in candidates])


def template_problems(rendered: Column) -> Column:
    """What a rendered chat lacks: markers, roles, or that think blocks be empty."""
    rules = {
        "no_markers": ~(F.contains(rendered, F.lit("<|im_start|>")) & F.contains(rendered, F.lit("<|im_end|>"))),
        "missing_role": ~(rendered.rlike("<\\|im_start\\|>system") & rendered.rlike("<\\|im_start\\|>user") & rendered.rlike("<\\|im_start\\|>assistant")),
        "think_content": rendered.rlike(r"(?s)<think>(?!\s*</think>).*?</think>"),
    }
    return F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]), lambda x: x.isNotNull())
