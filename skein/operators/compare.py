"""Two corpora side by side (STR-15 to 17, AGG-21, AGG-22)."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import lexicons as L
from skein.functions.text import correction_count, has_multi_step, matches, output_fillers, pair_features
from skein.operators.dedup import shuffle_key, top_per_group
from skein.operators.quality import validate

#: Metrics of which the greater value wins; the others are not judged, but for the density.
GREATER_WINS = ("count", "input_length_cv", "avg_corrections", "vocab_diversity", "input_word_max", "input_word_std")
IDEAL_DENSITY = 5.5


def sample_features(samples: DataFrame, group: list[str]) -> DataFrame:
    """Of each group: sums and means of the samples' features that verdicts look at."""
    each = samples.select(*group, *pair_features(F.col("input"), F.col("output")))
    return each.groupBy(*group).agg(
        F.sum("positions.mid_phrase").alias("mid_phrase"),
        F.sum("positions.boundary").alias("boundary"),
        F.avg("smell.caps_start_pct").alias("caps_pct"),
        F.sum(F.size("fillers_left")).alias("fillers_left"),
        F.avg("preservation").alias("preservation"),
    )


def _points(a: Column, b: Column) -> list[Column]:
    """For each criterion 1 if side a is better, -1 if side b is, else 0. a and b are structs of one side's figures."""

    def better(x: Column, y: Column) -> Column:
        return F.when(x, F.lit(1)).when(y, F.lit(-1)).otherwise(F.lit(0))

    def more(field: str, margin: float) -> Column:
        x, y = F.coalesce(a[field], F.lit(0.0)), F.coalesce(b[field], F.lit(0.0))
        return better(x > y + margin, y > x + margin)

    def less(field: str, margin: float) -> Column:
        x, y = F.coalesce(a[field], F.lit(0.0)), F.coalesce(b[field], F.lit(0.0))
        return better(x < y - margin, y < x - margin)

    def times(field: str, factor: float) -> Column:
        x, y = F.coalesce(a[field], F.lit(0)), F.coalesce(b[field], F.lit(0))
        return better(x > y * factor, y > x * factor)

    natural = lambda s: F.coalesce(F.try_divide(s["mid_phrase"].cast("double"), s["mid_phrase"] + s["boundary"]), F.lit(0.0))
    off = lambda s: F.abs(F.coalesce(s["avg_filler_density"], F.lit(0.0)) - IDEAL_DENSITY)
    return [
        better(natural(a) > natural(b) + 0.1, natural(b) > natural(a) + 0.1),
        more("avg_corrections", 0.3),
        less("caps_pct", 10),
        less("fillers_left", 0),
        more("preservation", 0.05),
        more("input_length_cv", 0.1),
        more("vocab_diversity", 0.02),
        better(off(a) < off(b) - 1, off(b) < off(a) - 1),
        times("count", 2),
        times("avg_input_words", 1.5),
    ]


def verdicts(figures: DataFrame, side: str, a: str, b: str, key: str = "category") -> DataFrame:
    """(key, score_a, score_b, verdict): ten criteria; a side that leads by more than one is better."""
    wide = figures.groupBy(key).agg(*[F.max(F.when(F.col(side) == s, F.struct(*[c for c in figures.columns if c not in (key, side)]))).alias(n) for s, n in ((a, "a"), (b, "b"))])
    points = F.array(*_points(F.col("a"), F.col("b")))
    count = lambda v: F.size(F.filter("points", lambda p: p == v))
    scored = wide.select(key, points.alias("points")).select(key, count(1).alias("score_a"), count(-1).alias("score_b"))
    lead = F.col("score_a") - F.col("score_b")
    return scored.withColumn("verdict", F.when(lead > 1, "A_BETTER").when(lead < -1, "B_BETTER").otherwise("TIE"))


def verdict_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("verdict").agg(F.count("*").alias("n"))


def metric_winners(profiles: DataFrame, side: str, a: str, b: str, metrics: list[str], key: str = "category") -> DataFrame:
    """(key, metric, a, b, winner): the greater value, the density nearer to the ideal by 0.5, or '~'."""
    long = profiles.select(key, side, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m")).select(key, side, "m.*")
    wide = long.groupBy(key, "metric").agg(F.max(F.when(F.col(side) == a, F.col("value"))).alias("a"), F.max(F.when(F.col(side) == b, F.col("value"))).alias("b"))
    off_a, off_b = F.abs(F.col("a") - IDEAL_DENSITY), F.abs(F.col("b") - IDEAL_DENSITY)
    density = F.when(off_a < off_b - 0.5, "a").when(off_b < off_a - 0.5, "b")
    greater = F.when(F.col("a") > F.col("b"), "a").when(F.col("b") > F.col("a"), "b")
    winner = F.when(F.col("metric") == "avg_filler_density", density).when(F.col("metric").isin(*GREATER_WINS), greater)
    return wide.withColumn("winner", F.coalesce(winner, F.lit("~")))


def deep_checks(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Tallies of what single categories are looked at for, for every group."""
    i, o = F.col("input"), F.col("output")
    spoken = reduce(add, [matches(F.lower(i), [p]) for p in L.SPOKEN_NUMBERS]) > 0
    bullet, numbered, header = (o.rlike("(?U)" + p) for p in (L.BULLET, L.NUMBERED, L.HEADER))
    underscore = F.contains(F.lower(i), F.lit("underscore"))
    tallies = {
        "multi_step": has_multi_step(i),
        "bulleted": bullet,
        "numbered": numbered,
        "backtick": F.contains(o, F.lit("`")),
        "underscore_spoken": underscore,
        "underscore_written": underscore & F.contains(o, F.lit("_")),
        "code_block": F.contains(o, F.lit("```")),
        "spoken_numbers": spoken,
        "formatted_numbers": o.rlike(r"\$[\d,.]+|\d+%"),
        "headers": header,
        "action_items": F.lower(o).rlike(r"(?U)action\s*item|decision|attendee|agenda"),
        "prose_only": ~o.rlike("[-•*#]"),
    }
    return pairs.groupBy(*group).agg(
        F.count("*").alias("n"), F.sum(correction_count(i)).alias("corrections"), *[F.count_if(c).alias(k) for k, c in tallies.items()]
    ).withColumn("flat", F.col("n") - F.col("bulleted") - F.col("numbered"))


def first_example(pairs: DataFrame, group: list[str], order: Column, wanted: Column) -> DataFrame:
    """Of each group the first input that fulfils a condition."""
    return pairs.where(wanted).groupBy(*group).agg(F.min_by("input", order).alias("example"))


def repeated_openings(pairs: DataFrame, group: list[str], n_words: int = 3, least: int = 2) -> DataFrame:
    """Openings of n words that several inputs of a group share."""
    opening = F.array_join(F.slice(F.split(F.lower("input"), r"(?U)\s+"), 1, n_words), " ")
    return pairs.groupBy(*group, opening.alias("opening")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def size_imbalance(pairs: DataFrame, group: str) -> DataFrame:
    """One row: the largest and smallest group, and their ratio."""
    sizes = pairs.groupBy(group).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio"))


def inventory(pairs: DataFrame, group: str, expected: list[str], small: float = 0.25) -> DataFrame:
    """(group, n, bytes, state) of all groups, expected ones with no pair included.

    state: missing, small (fewer than a share of the mean), unexpected or ok.
    """
    size = F.octet_length("input") + F.octet_length("output")
    found = pairs.groupBy(group).agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("bytes"))
    wanted = pairs.sparkSession.createDataFrame([(x,) for x in expected], f"{group} string").distinct().withColumn("wanted", F.lit(True))
    both = found.join(wanted, group, "full").withColumns({"n": F.coalesce("n", F.lit(0)), "bytes": F.coalesce("bytes", F.lit(0))})
    mean = F.try_divide(F.sum("n").over(Window.partitionBy()), F.count_if(F.col("n") > 0).over(Window.partitionBy()))  # over the groups
    state = F.when(F.col("n") == 0, "missing").when(F.col("n") < mean * small, "small").when(F.col("wanted").isNull(), "unexpected").otherwise("ok")
    return both.select(group, "n", "bytes", state.alias("state"))


def review_sample(pairs: DataFrame, group: str, key: list[str], n: int = 5, seed: int = 42) -> DataFrame:
    """n pairs of each group, by digest, with the problems that rules find and the number of fillers left in the output."""
    some = top_per_group(pairs.withColumn("__order", shuffle_key(seed, group, *key)), [group], ["__order", *key], n)
    return validate(some).select(group, *key, F.array_join("reasons", ",").alias("problems"), F.size(output_fillers(F.col("output"))).alias("fillers_left"))


#: Names, as words with a capital after a word or a comma, and numbers.
NAMES, NUMBERS = r"[\p{Ll},;] (\p{Lu}\p{L}+)", r"[0-9]+(?:[.,][0-9]+)*"
#: The most terms that the sketch follows.
TRACKED = 1_000_000


def shared_terms(pairs: DataFrame, group: str, share: float = 0.01, least: int = 2, text: str = "output") -> DataFrame:
    """(term, n, n_groups): names and numbers that at least a share of all pairs hold, in ``least`` groups or more.

    A mergeable sketch of bounded size finds the terms that can be so frequent: with t terms followed, none that makes up 4 / t of all
    is missed. Those few are then counted exactly. A share too small for the sketch raises.
    """
    terms = pairs.select(group, F.explode(F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(NAMES), F.lit(1)), F.regexp_extract_all(text, F.lit(NUMBERS), F.lit(0))))).alias("term"))
    n, every = pairs.count(), terms.count()
    wanted = max(1, math.ceil(n * share))
    most = every // wanted + 1
    tracked = max(1_000, 4 * most)
    if tracked > TRACKED:
        raise ValueError(f"a share of {share} needs a sketch of {tracked} terms")
    found = terms.agg(F.expr(f"approx_top_k(term, {most}, {tracked})").alias("top")).select(F.explode("top.item").alias("term"))
    counted = terms.join(F.broadcast(found), "term").groupBy("term", group).agg(F.count("*").alias("n")).groupBy("term").agg(F.sum("n").alias("n"), F.count("*").alias("n_groups"))
    return counted.where((F.col("n") >= wanted) & (F.col("n_groups") >= least))
