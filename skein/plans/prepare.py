"""The flagship plan: pairs of all sources to validated, distinct, split chat records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import chat_messages
from skein.operators.dedup import exact_split, first_occurrences, union_sources
from skein.operators.quality import passing, severity, validate
from skein.operators.stats import counts_by, length_stats
from skein.sources.shared import stored

SYSTEM = "Clean up the transcript. Keep its meaning and words, remove fillers, apply corrections."
ORDER = ["src_rank", "file", "line_no"]


@dataclass
class Prepared:
    validated: DataFrame
    accepted: DataFrame
    split: DataFrame

    def chat(self, system: str = SYSTEM) -> DataFrame:
        """messages of each pair, with split, source and category."""
        return self.split.select("split", "source", "category", chat_messages(system, F.col("input"), F.col("output")).alias("messages"))

    def stats(self) -> tuple[DataFrame, DataFrame]:
        return length_stats(self.split), counts_by(self.split, "source")


def prepare(*sources: DataFrame, seed: int = 42, train: float = 0.90, valid: float = 0.05) -> Prepared:
    """Sources in order of rank; a rejected first copy lets a later one stand, as rules come before dedup."""
    pairs = union_sources(*sources)
    if pairs.isEmpty():
        raise ValueError("no pairs")
    validated = severity(validate(pairs))
    accepted = stored(first_occurrences(passing(pairs), ORDER), "accepted")
    split = exact_split(accepted, ORDER, seed, train, valid)
    return Prepared(validated, accepted, split)


def write_prepared(done: Prepared, path: str, force: bool = False, system: str = SYSTEM) -> dict[str, int]:
    """train, valid and test as JSON lines; existing outputs are kept unless forced."""
    from pyspark.errors import AnalysisException

    from skein.sources.writers import write_jsonl

    chat = done.chat(system).persist()
    try:
        return {s: write_jsonl(chat.where(F.col("split") == s), f"{path}/{s}.jsonl", ["messages"], "overwrite" if force else "errorifexists") for s in ("train", "valid", "test")}
    except AnalysisException as e:
        raise FileExistsError(f"outputs exist in {path}; use force") from e
    finally:
        chat.unpersist()
