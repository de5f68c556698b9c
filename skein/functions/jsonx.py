"""JSON columns with strict types (JSN), and log lines. Built-ins, and one Arrow function for what no pattern can find."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions import lexicons as L
from skein.functions.text import strip


def _type(value: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def strict_strings(line: Column, required: list[str], optional: list[str] = ()) -> Column:
    """struct of string fields if the line is an object with those required as strings, else null.

    Of a repeated key the last value counts. Numbers and the like are no strings.
    """
    fields = [*required, *optional]
    parsed = F.from_json(line, ", ".join(f"`{f}` string" for f in fields))
    variant = F.try_parse_json(line)
    is_string = lambda f: F.coalesce(_type(variant, f"$.{f}") == "STRING", F.lit(False))
    # repeated keys are no variant; their types are told from the text of the last value
    raw = F.from_json(line, "map<string,string>")
    loose = F.lit(True)
    typed = F.lit(True)
    for f in required:
        typed &= is_string(f)
        loose &= F.element_at(F.regexp_extract_all(line, F.lit(rf'"{f}"\s*:\s*(.)'), F.lit(1)), -1) == '"'
    have = F.lit(True)
    for f in required:
        have &= parsed[f].isNotNull()
    good = have & F.when(variant.isNotNull(), typed).otherwise(loose & raw.isNotNull() & strip(line).rlike(r"^\{(?s).*\}\z"))
    own = F.struct(*[F.when(is_string(f) | variant.isNull(), parsed[f]).alias(f) if f in optional else parsed[f].alias(f) for f in fields])
    return F.when(good, own)


def to_json_line(*columns: Column) -> Column:
    """A JSON object of the columns; other than ASCII characters stay as they are, nulls are written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _unfenced(raw: Column) -> Column:
    """A code fence around the whole text removed."""
    text = strip(raw)
    inner = F.regexp_replace(F.regexp_replace(text, r"^```[a-zA-Z]*\s*\n?", ""), r"\n?```\s*\z", "")
    return F.when(F.startswith(text, F.lit("```")), strip(inner)).otherwise(text)


def parse_array(raw: Column) -> Column:
    """A model's answer as a variant array: as it is, else from the first '[' to the last ']'; else null."""
    text = _unfenced(raw)
    whole = F.try_parse_json(text)
    part = F.try_parse_json(F.regexp_substr(text, F.lit(r"(?s)\[.*\]")))
    found = F.coalesce(whole, part)
    return F.when(F.startswith(F.schema_of_variant(found), F.lit("ARRAY")), found)


def array_pairs(raw: Column) -> Column:
    """array<struct<transcript, output>> of an answer; other items are null, no array is null."""
    items = F.try_variant_get(parse_array(raw), "$", "array<variant>")
    text = lambda v, f: F.when(_type(v, f"$.{f}") == "STRING", F.try_variant_get(v, f"$.{f}", "string"))
    return F.transform(items, lambda v: F.struct(text(v, "transcript").alias("transcript"), text(v, "output").alias("output")))


#: What matters outside and inside strings when braces are counted.
_MARKS = re.compile(r'\\.|["{}]', re.DOTALL)


def balanced_object(text: str | None) -> str | None:
    """The first balanced {...} of a text that is JSON; after one that is not, the search goes on behind it."""
    start, depth, quoted = -1, 0, False
    for m in _MARKS.finditer(text or "", max(0, (text or "").find("{"))):
        mark = m[0]
        if mark == '"':
            quoted = not quoted
        elif mark == "{" and not quoted:
            start, depth = (m.start() if depth == 0 else start), depth + 1
        elif mark == "}" and not quoted and depth:
            depth -= 1
            if depth == 0:
                try:
                    json.loads(found := text[start : m.end()])
                    return found
                except ValueError:
                    continue
    return None


@F.pandas_udf(T.StringType())
def first_object(texts: pd.Series) -> pd.Series:
    return texts.map(balanced_object)


def judge_text(raw: Column) -> Column:
    """A judge's answer without think blocks, and only what a code fence holds if there is one."""
    text = strip(F.regexp_replace(strip(raw), L.THINK_BLOCK, ""))
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```", 1)
    return F.when(text.rlike(r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```"), strip(fenced)).otherwise(text)


def verdict(json_text: Column) -> Column:
    """struct of the criteria as booleans, or null if one is missing or neither a boolean nor 'true' or 'false'."""
    value = F.try_parse_json(json_text)
    flag = lambda c: F.when(F.lower(F.try_variant_get(value, f"$.{c}", "string")).isin("true", "false") & _type(value, f"$.{c}").isin("BOOLEAN", "STRING"), F.lower(F.try_variant_get(value, f"$.{c}", "string")) == "true")
    flags = {c: flag(c) for c in L.CRITERIA}
    whole = F.lit(True)
    for f in flags.values():
        whole &= f.isNotNull()
    return F.when(whole, F.struct(*[f.alias(c) for c, f in flags.items()]))


def parse_verdicts(rows, raw: str = "raw"):
    """rows with verdict and parse_error. The Arrow function sees only answers that are not JSON as they stand."""
    text = rows.withColumn("__text", judge_text(F.col(raw)))
    object_ = F.when(F.try_parse_json("__text").isNull(), first_object(F.when(F.try_parse_json("__text").isNull(), F.col("__text")))).otherwise(F.col("__text"))
    done = text.withColumn("__json", object_).withColumn("verdict", verdict(F.col("__json")))
    return done.withColumn("parse_error", F.col("verdict").isNull()).drop("__text", "__json")


def lenient_verdict(raw: Column, compat: bool = False) -> Column:
    """struct of the criteria for the batch judge; what is missing fails, no JSON fails all.

    compat: any non-empty string passes, even "false".
    """
    text = strip(raw)
    text = F.when(F.startswith(text, F.lit("```")), F.regexp_replace(text, r"^[^\n]*\n?", "")).otherwise(text)
    text = F.when(F.endswith(text, F.lit("```")), F.regexp_replace(text, r"\n?[^\n]*\z", "")).otherwise(text)
    value = F.try_parse_json(strip(text))

    def flag(c: str) -> Column:
        kind, said = _type(value, f"$.{c}"), F.try_variant_get(value, f"$.{c}", "string")
        true = F.when(kind == "BOOLEAN", said == "true")
        return F.coalesce(true.when(kind == "STRING", (said != "") if compat else F.lower(said) == "true").when(kind.isNotNull(), ~said.isin("0", "0.0", "[]", "{}")), F.lit(False))

    return F.struct(*[flag(c).alias(c) for c in L.CRITERIA])


def log_record(line: Column) -> Column:
    """struct of a training log line's numbers, null for a line without an iteration."""
    number = lambda p: F.regexp_extract(line, p, 1).try_cast("double")
    found = F.struct(
        F.regexp_extract(line, r"Iter\s+(\d+)", 1).try_cast("int").alias("iter"),
        number(r"Train loss\s+([\d.]+)").alias("train_loss"),
        number(r"Val loss\s+([\d.]+)").alias("val_loss"),
        number(r"Learning Rate\s+([\d.eE+-]+)").alias("learning_rate"),
        number(r"It/sec\s+([\d.]+)").alias("it_per_sec"),
        number(r"Tokens/sec\s+([\d.]+)").alias("tokens_per_sec"),
    )
    return F.when(line.rlike(r"Iter\s+\d+"), found)


def has_keys(json_text: Column, *keys: str) -> Column:
    """Whether a metadata object has any of the keys."""
    value = F.try_parse_json(json_text)
    out = F.lit(False)
    for k in keys:
        out |= F.coalesce(F.try_variant_get(value, f"$.{k}", "variant").isNotNull(), F.lit(False))
    return out
