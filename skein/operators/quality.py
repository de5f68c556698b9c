"""Quality rules for pairs (FLT): reasons to reject, warnings, first-reason validation."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import lexicons as L
from skein.functions.text import has_any, merged_codes, strip, words


def unquoted_fillers(text: Column) -> Column:
    """Fillers outside double quotes, sorted, each once."""
    found = F.regexp_extract_all(F.regexp_replace(text, L.QUOTED, ""), F.lit(L.VALIDATOR_FILLERS), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, F.lower)))


def novel_words(source: Column, output: Column) -> Column:
    """How many output words, repeats included, the input does not have; words are told apart by 63-bit hashes."""
    # an input word comes just before its equals of the output
    step = lambda s, e: F.struct(
        F.when(e.bitwiseAND(1) == 0, e.bitwiseOR(1)).otherwise(s["known"]).alias("known"),
        (s["n"] + ((e.bitwiseAND(1) == 1) & (e != s["known"])).cast("int")).alias("n"),
    )
    start = F.struct(F.lit(0).cast("long").alias("known"), F.lit(0).alias("n"))
    return F.aggregate(merged_codes(words(F.lower(source)), words(F.lower(output))), start, step, lambda s: s["n"])


def rule_checks(source: Column, output: Column) -> dict[str, Column]:
    """Code of each rule and whether the pair breaks it."""
    i, o = strip(source), strip(output)
    null_byte = lambda t: F.contains(t, F.lit("\x00"))
    mojibake = lambda t: has_any(t, "�", "Ã", "â") & t.rlike(L.MOJIBAKE)
    return {
        "length": (i != "") & (o != "") & (F.length(o) > 2 * F.length(i)),
        "empty_output": (o == "") & (i != "") & (F.length(strip(F.regexp_replace(i, L.VALIDATOR_FILLERS, ""))) > 10),
        "input_null_byte": null_byte(source),
        "input_mojibake": mojibake(source),
        "output_null_byte": null_byte(output),
        "output_mojibake": mojibake(output),
        "fillers": (o != "") & F.regexp_replace(o, L.QUOTED, "").rlike(L.VALIDATOR_FILLERS),
        "think_tag": has_any(F.lower(o), "think>") & o.rlike(L.THINK_TAG),
    }


def adds_content(source: Column, output: Column, limit: float = 0.20) -> Column:
    n = F.size(words(output))
    return (strip(source) != "") & (n > 0) & (novel_words(source, output) / n > limit)


def detail(code: str, source: Column, output: Column) -> Column:
    """Words for a broken rule; codes stay fit for counting."""
    if code == "length":
        return F.format_string("output (%d chars) > 2x input (%d chars)", F.length(strip(output)), F.length(strip(source)))
    if code == "fillers":
        return F.concat(F.lit("fillers in output: "), F.array_join(unquoted_fillers(strip(output)), ", "))
    return F.lit(code.replace("_", " "))


def validate(pairs: DataFrame, source: str = "input", output: str = "output") -> DataFrame:
    """pairs with reasons (all broken rules' codes), details and warnings. Null texts count as empty."""
    s, o = (F.coalesce(F.col(c), F.lit("")) for c in (source, output))
    some = lambda items: F.filter(F.array(*items), lambda x: x.isNotNull())
    checks = rule_checks(s, o)
    return pairs.withColumns(
        {
            "reasons": some([F.when(c, F.lit(k)) for k, c in checks.items()]),
            "details": some([F.when(c, detail(k, s, o)) for k, c in checks.items()]),
            "warnings": some([F.when(adds_content(s, o), F.lit("added_content"))]),
        }
    )


def passing(pairs: DataFrame, source: str = "input", output: str = "output") -> DataFrame:
    """Pairs that break no rule; warnings, which never reject, are not worked out."""
    s, o = (F.coalesce(F.col(c), F.lit("")) for c in (source, output))
    return pairs.where(~reduce(or_, rule_checks(s, o).values()))


def severity(validated: DataFrame) -> DataFrame:
    """reject if there is a reason, warn if only a warning, else accept."""
    return validated.withColumn("severity", F.when(F.size("reasons") > 0, "reject").when(F.size("warnings") > 0, "warn").otherwise("accept"))


def first_reason(transcript: Column, output: Column) -> Column:
    """The first broken rule of a generated pair, null for a valid one."""
    t, o = F.coalesce(transcript, F.lit("")), F.coalesce(output, F.lit(""))
    return F.coalesce(
        F.when(strip(t) == "", F.lit("empty_transcript")),
        F.when(strip(o) == "", F.lit("empty_output")),
        F.when(F.contains(t, F.lit("\x00")) | F.contains(o, F.lit("\x00")), F.lit("null_byte")),
        F.when(F.length(strip(o)) > 2.0 * F.length(strip(t)), F.lit("too_long")),
        F.when(o.rlike(L.GENERATION_FILLERS), F.lit("fillers")),
    )


def complete_pairs(pairs: DataFrame, source: str = "input", output: str = "output") -> DataFrame:
    """Pairs of which neither text is blank."""
    return pairs.where((strip(F.coalesce(F.col(source), F.lit(""))) != "") & (strip(F.coalesce(F.col(output), F.lit(""))) != ""))


def reason_counts(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def rejection_log(validated: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first n rejected pairs with their reasons: a log with a limit."""
    return validated.where(F.size("reasons") > 0).select(*order, "reasons", "details").orderBy(*order).limit(n)


def severity_counts(validated: DataFrame) -> DataFrame:
    """One row: accepted (with or without warning), rejected, warned, total."""
    return severity(validated).agg(
        F.count_if(F.col("severity") != "reject").alias("accepted"),
        F.count_if(F.col("severity") == "reject").alias("rejected"),
        F.count_if(F.col("severity") == "warn").alias("warned"),
        F.count("*").alias("total"),
    )
