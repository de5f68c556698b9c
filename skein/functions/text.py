"""Text columns: normalisers (PRJ) and lexical features (STR). Column in, Column out, built-ins only."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions import lexicons as L


def matches(text: Column, patterns: list[str]) -> Column:
    """How often any of the patterns occurs, each counted by itself."""
    return reduce(add, [F.regexp_count(text, F.lit("(?U)" + p)) for p in patterns])


#: The characters with the property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """text without white space at its ends, which alone are looked at."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def has_any(text: Column, *needles: str) -> Column:
    """Whether text holds any of the strings: a cheap test before a pattern that needs one of them."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in needles])


def words(text: Column) -> Column:
    """Tokens between white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


# --- normalisers


def normalize_text(text: Column) -> Column:
    """Line ends as line feeds, white space at the ends gone, null as empty."""
    unix = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return strip(unix)


def slug(name: Column) -> Column:
    """The last part of a path, other characters than letters and digits as one underscore, lower case."""
    last = F.element_at(F.split(name, "/"), -1)
    return F.lower(F.regexp_replace(F.regexp_replace(last, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def dedup_key(text: Column) -> Column:
    return F.regexp_replace(strip(F.lower(text)), r"(?U)\s+", " ")


def strip_think(text: Column) -> Column:
    """Think blocks removed; only a text that has one is stripped."""
    return F.when(F.contains(text, F.lit("<think>")), strip(F.regexp_replace(text, L.THINK_BLOCK, ""))).otherwise(text)


def had_think(text: Column) -> Column:
    return F.contains(text, F.lit("<think>"))


def first_paragraph(text: Column, shortest: int = 100, longest: int = 2000) -> Column:
    """The first paragraph with a length in the window, else null."""
    paragraphs = F.transform(F.split(text, "\n\n"), strip)
    return F.try_element_at(F.filter(paragraphs, lambda p: F.length(p).between(shortest, longest)), F.lit(1))


def truncate(text: Column, n: int = 120) -> Column:
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.left(text, F.lit(n)), F.lit("...")))


def numbered_list(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), t)), "\n")


def fill(template: str, **values: Column) -> Column:
    """A template with {name} places filled."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def pretty_label(name: Column) -> Column:
    return F.initcap(F.replace(F.regexp_replace(name, "_ok$", ""), F.lit("_"), F.lit(" ")))


def round_even(number: Column, places: int) -> Column:
    """A double rounded by its product with a power of ten, half to even, as DuckDB does; bround goes by the shortest decimal, and differs at ties."""
    return F.rint(number * float(10**places)) / float(10**places)


def fixed(number: Column, places: int) -> Column:
    """A double with so many decimals by its exact binary value, as printf in C; Java's rounds its shortest decimal half up (25.65 is less than it looks)."""
    return F.call_function("format_number", number, F.lit("0." + "0" * places))


def duration(seconds: Column) -> Column:
    """As 12.3s, 4m 5s or 1h 2m 3s."""
    minutes = F.floor(seconds / 60).cast("long")
    rest = F.format_string("%.0f", F.bround(seconds % 60, 0))
    return (
        F.when(seconds < 60, F.format_string("%.1fs", F.bround(seconds, 1)))
        .when(minutes < 60, F.format_string("%dm %ss", minutes, rest))
        .otherwise(F.format_string("%dh %dm %ss", F.floor(minutes / 60).cast("long"), minutes % 60, rest))
    )


def chat_messages(system: str, user: Column, assistant: Column | None = None) -> Column:
    """array<struct<role, content>>: system, user and, if given, assistant."""
    turns = [("system", F.lit(system)), ("user", user)] + ([("assistant", assistant)] if assistant is not None else [])
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def chatml(messages: Column, generate: bool = False) -> Column:
    """ChatML text of messages, with an open assistant turn if one is to be generated."""
    turns = F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n")))
    return F.concat(F.array_join(turns, ""), F.lit("<|im_start|>assistant\n" if generate else ""))


def last_content(messages: Column, role: str) -> Column:
    """The content of the last message of a role, else null."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"]


# --- lexical features


def filler_count(text: Column, fix_case: bool = False) -> Column:
    """Fillers in lower-cased text; fix_case lets the patterns with a capital I match."""
    return matches(F.lower(text), [p.replace("I", "i") for p in L.COMPARE_FILLERS] if fix_case else L.COMPARE_FILLERS)


def output_fillers(text: Column) -> Column:
    """The fillers left in an output, with repeats, pattern by pattern."""
    low = F.lower(text)
    return F.flatten(F.array(*[F.regexp_extract_all(low, F.lit("(?U)" + p), F.lit(0)) for p in L.OUTPUT_FILLERS]))


def filler_positions(text: Column) -> Column:
    """struct<boundary, mid_phrase>: fillers near a sentence's ends, and others."""
    sentences = F.transform(F.split(text, "[.!?]+"), lambda s: words(F.lower(s)))
    places = F.flatten(
        F.transform(
            F.filter(sentences, lambda ws: F.size(ws) >= 2),
            lambda ws: F.filter(
                F.transform(ws, lambda w, i: F.when(w.isin(L.POSITION_FILLERS), ((i <= 1) | (i >= F.size(ws) - 1)).cast("int"))),
                lambda x: x.isNotNull(),
            ),
        )
    )
    edge = F.size(F.filter(places, lambda x: x == 1))
    return F.struct(edge.alias("boundary"), (F.size(places) - edge).alias("mid_phrase"))


def correction_count(text: Column, fix_case: bool = False) -> Column:
    return matches(F.lower(text), [p.replace("I", "i") for p in L.CORRECTION_MARKERS] if fix_case else L.CORRECTION_MARKERS)


def has_multi_step(text: Column) -> Column:
    return F.lower(text).rlike("(?U)" + L.MULTI_STEP)


def has_false_start(text: Column) -> Column:
    return text.rlike("(?U)" + L.FALSE_STARTS)


def share(part: Column, whole: Column, digits: int) -> Column:
    """Percent of whole, 0 where there is none."""
    return F.bround(F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0)), digits)


def written_smell(text: Column) -> Column:
    """Signs of written language: sentences that begin with a capital, bullets, numbers, headers, lines that end with a period."""
    sentences = F.filter(F.transform(F.split(text, "[.!?]+"), strip), lambda s: s != "")
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda s: s != "")
    capitals = F.size(F.filter(sentences, lambda s: s.rlike(r"^\p{Lu}")))
    return F.struct(
        share(capitals, F.size(sentences), 1).alias("caps_start_pct"),
        text.rlike("(?U)" + L.BULLET).alias("has_bullets"),
        text.rlike("(?U)" + L.NUMBERED).alias("has_numbered"),
        text.rlike("(?U)" + L.HEADER).alias("has_headers"),
        share(F.size(F.filter(lines, lambda s: F.endswith(s, F.lit(".")))), F.size(lines), 1).alias("period_end_pct"),
    )


def _letters(text: Column, least: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)\b[a-z]{{{least},}}\b"), F.lit(0)))


def _literals(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in dict.fromkeys(items)])


def preservation(source: Column, output: Column) -> Column:
    """Share of an input's content words that the output has; 1 if there are none."""
    wanted = F.array_except(_letters(source, 4), _literals(L.PRESERVATION_STOPWORDS))
    kept = F.array_intersect(wanted, _letters(output, 4))
    return F.when(F.size(wanted) == 0, F.lit(1.0)).otherwise(F.size(kept) / F.size(wanted))


def merged_codes(a: Column, b: Column) -> Column:
    """The items of two arrays of strings as sorted longs: 63 bits of a hash, then 0 for an item of a and 1 for one of b.

    A fold over them meets equal items side by side, so that work on repeats costs a sort and not the product of the lengths.
    """
    code = lambda items, side: F.transform(items, lambda x: F.shiftleft(F.xxhash64(x), 1).bitwiseOR(F.lit(side).cast("long")))
    return F.sort_array(F.concat(code(a, 0), code(b, 1)))


def place_among(item: Column, ordered: Column) -> Column:
    """The place from 0 at which a sorted array has the item, -1 if it has not, by halving the range where it can be."""

    def halve(s: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        below = F.get(ordered, mid) < item
        return F.struct(F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(mid).alias("hi"))

    # each step leaves at most half of the range; one that is empty stays as it is
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ordered) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(ordered).alias("hi"))
    found = F.aggregate(steps, start, lambda s, _: F.when(s["lo"] < s["hi"], halve(s)).otherwise(s), lambda s: s["lo"])
    return F.transform(F.array(found), lambda i: F.when(F.get(ordered, i) == item, i).otherwise(F.lit(-1)))[0]


def is_among(item: Column, ordered: Column) -> Column:
    """Whether a sorted array has the item."""
    return place_among(item, ordered) >= 0


def made_up_words(source: Column, output: Column) -> Column:
    """Words of five letters and more that the input has in no near form, in order of appearance.

    A form that adds an ending is looked for as the input's words without it; only
    forms that lose letters at the end are looked up word by word.
    """
    without = lambda ks, end: F.transform(F.filter(ks, lambda k: F.endswith(k, F.lit(end))), lambda k: F.left(k, F.length(k) - len(end)))
    near = lambda ks: F.concat(ks, *[without(ks, end) for end in ("s", "ed", "ing")])
    news = F.array_except(_letters(output, 5), _literals(L.HALLUCINATION_COMMON))
    rest = lambda ks: F.filter(F.array_except(news, near(ks)), lambda w: ~reduce(lambda a, b: a | b, [is_among(F.rtrim(w, F.lit(end)), ks) for end in ("s", "ed", "ing")]))
    # the input's words are sorted and bound once for each text
    return F.transform(F.array(F.array_sort(_letters(source, 3))), rest)[0]


def number_conversion(source: Column, output: Column) -> Column:
    return F.struct(
        matches(F.lower(source), L.SPOKEN_NUMBERS).alias("spoken_in_input"),
        output.rlike("(?U)" + L.FORMATTED_NUMBER).alias("formatted_in_output"),
        matches(F.lower(output), L.SPOKEN_NUMBERS).alias("spoken_in_output"),
    )


def format_flags(text: Column) -> Column:
    return F.struct(
        text.rlike(r"^\p{Lu}").alias("starts_capital"),
        strip(text).rlike(r"[.!?]\z").alias("ends_punctuation"),
        text.rlike("(?U)" + L.BULLET).alias("has_bullets"),
        F.contains(text, F.lit("\n\n")).alias("has_paragraphs"),
        text.rlike("(?U)" + L.HEADER).alias("has_headers"),
        F.contains(text, F.lit("`")).alias("has_code"),
    )


def filler_density(text: Column) -> Column:
    """Fillers per 100 words, 0 without words."""
    return F.coalesce(F.try_divide(filler_count(text) * F.lit(100.0), F.size(words(text))), F.lit(0.0))


def compression(source: Column, output: Column) -> Column:
    """Characters of the output for each of the input, 0 for an empty input."""
    return F.coalesce(F.try_divide(F.length(output).cast("double"), F.length(source)), F.lit(0.0))


def pair_features(source: Column, output: Column) -> list[Column]:
    """The lexical features of a pair, as columns of one projection."""
    return [
        F.size(words(source)).alias("input_words"),
        F.size(words(output)).alias("output_words"),
        filler_count(source).alias("filler_count"),
        filler_positions(source).alias("positions"),
        correction_count(source).alias("corrections"),
        has_multi_step(source).alias("multi_step"),
        written_smell(source).alias("smell"),
        output_fillers(output).alias("fillers_left"),
        F.bround(preservation(source, output), 3).alias("preservation"),
        F.slice(made_up_words(source, output), 1, 5).alias("made_up"),
        number_conversion(source, output).alias("numbers"),
        format_flags(output).alias("format"),
        has_false_start(source).alias("false_start"),
    ]
