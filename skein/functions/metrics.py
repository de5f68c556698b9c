"""Metrics of generated text against what was expected (MET). Built-ins only."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import lexicons as L
from skein.functions.text import merged_codes, place_among, strip, words


def exact_match(generated: Column, expected: Column) -> Column:
    return strip(generated) == strip(expected)


def _shared_start(a: Column, b: Column) -> Column:
    """Characters that a and b begin with alike, by halving the range where they part."""

    def halve(s: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"] + 1, 1)
        same = F.left(a, mid) == F.left(b, mid)
        return F.struct(F.when(same, mid).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(mid - 1).alias("hi"))

    n = F.least(F.length(a), F.length(b))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), lambda s, _: halve(s), lambda s: s["lo"])


#: Items of the shorter side up to which the built-in distance is asked; it takes time with the product of the lengths.
SHORT = 1_000


def _run(a: Column, b: Column, i: Column, j: Column) -> Column:
    """How many items from i in a equal those from j in b: blocks are doubled while they are equal, then halved."""
    most = F.greatest(F.least(F.size(a) - i, F.size(b) - j), F.lit(0))
    doublings = F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int"))

    def block(s: Column, t: Column) -> Column:
        size = F.pow(F.lit(2.0), t).cast("int")
        same = F.slice(a, i + s["n"] + 1, size) == F.slice(b, j + s["n"] + 1, size)
        grown = F.struct((s["n"] + size).alias("n"), s["stop"].alias("stop"))
        return F.when((t < s["stop"]) & (s["n"] + size <= most) & same, grown)

    up = lambda s, t: F.coalesce(block(s, t), F.struct(s["n"].alias("n"), F.least(s["stop"], t).alias("stop")))
    start = F.struct(F.lit(0).alias("n"), F.lit(31).alias("stop")).cast("struct<n:int,stop:int>")
    doubled = F.aggregate(doublings, start, lambda s, t: F.when(t < s["stop"], up(s, t)).otherwise(s))
    full = F.aggregate(F.reverse(doublings), doubled, lambda s, t: F.coalesce(block(s, t), s), lambda s: s["n"])
    return F.when(F.get(a, i) == F.get(b, j), full).otherwise(F.lit(0))


def _by_diagonals(a: Column, b: Column) -> Column:
    """Edit distance of two arrays of any items: on each diagonal how far so many edits reach, one edit more at a time.

    Costs the square of the distance and the items that are passed over; holds a number for each diagonal reached.
    """
    n, m = F.size(a), F.size(b)
    slide = lambda i, j: i + _run(a, b, i, j)

    def further(s: Column) -> Column:
        """One edit more: a diagonal is reached from itself and from both beside it."""
        d = s["d"] + 1

        def reach(x: Column) -> Column:
            k = x - d
            start = F.greatest(F.get(s["f"], x - 1) + 1, F.get(s["f"], x - 2), F.get(s["f"], x) + 1)
            bound = F.least(start, n, m - k)  # before 0 or beyond the end there is nothing
            return F.transform(F.array(bound), lambda i: F.when((i >= 0) & (i + k >= 0), slide(i, i + k)).otherwise(i))[0]

        return F.struct(d.alias("d"), F.transform(F.sequence(F.lit(0), 2 * d), reach).alias("f")).cast("struct<d:int,f:array<int>>")

    done = lambda s: F.coalesce(F.get(s["f"], m - n + s["d"]) >= n, F.lit(False))
    start = F.struct(F.lit(0).alias("d"), F.array(slide(F.lit(0), F.lit(0))).alias("f")).cast("struct<d:int,f:array<int>>")
    return F.aggregate(F.sequence(F.lit(0), F.greatest(n, m)), start, lambda s, _: F.when(done(s), s).otherwise(further(s)), lambda s: s["d"])


def edit_distance(a: Column, b: Column, short: int = SHORT) -> Column:
    """Levenshtein distance. What texts have alike at either end adds nothing; what is left costs its length and the square of the distance."""
    bind = lambda x, y, f: F.transform(F.array(F.struct(x.alias("a"), y.alias("b"))), f)[0]
    rest = lambda t, n: F.substring(t, n + 1, F.length(t))
    letters = lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "", -1))

    def different(p: Column) -> Column:
        few = F.least(F.length(p["a"]), F.length(p["b"])) <= short
        return F.when(few, F.levenshtein(p["a"], p["b"])).otherwise(bind(letters(p["a"]), letters(p["b"]), lambda q: _by_diagonals(q["a"], q["b"])))

    def between(p: Column) -> Column:
        """Of reversed texts without their common start."""
        return F.transform(F.array(_shared_start(p["a"], p["b"])), lambda n: bind(rest(p["a"], n), rest(p["b"], n), different))[0]

    def turned(p: Column) -> Column:
        return F.transform(F.array(_shared_start(p["a"], p["b"])), lambda n: bind(F.reverse(rest(p["a"], n)), F.reverse(rest(p["b"], n)), between))[0]

    return F.when(a == b, F.lit(0)).otherwise(bind(a, b, turned))


def cer(generated: Column, expected: Column) -> Column:
    """Edit distance for each expected character; of an empty one 0 or 1."""
    return F.when(F.length(expected) == 0, (F.length(generated) > 0).cast("double")).otherwise(
        edit_distance(generated, expected) / F.length(expected)
    )


def _item_codes(items: Column, common: Column, alone: int) -> Column:
    """A character for each item: of a common one by its place in the sorted common items, of any other ``alone``."""
    code = lambda w: F.transform(F.array(place_among(w, common)), lambda i: F.when(i < 0, F.lit(alone)).otherwise(i + 0x40))[0]
    return F.decode(F.unhex(F.array_join(F.transform(items, lambda w: F.lpad(F.hex(code(w)), 8, "0")), "")), "UTF-32")


def word_distance(generated: Column, expected: Column, short: int = SHORT) -> Column:
    """Edit distance of two arrays of words, of any number.

    Words of a short side become characters, those that only one side has one character for
    each side, as they match nothing; longer arrays are compared as they are.
    """
    both = F.struct(generated.alias("g"), expected.alias("e"))

    def coded(t: Column) -> Column:
        common = F.array(F.array_sort(F.array_intersect(t["g"], t["e"])))
        texts = lambda c: F.struct(_item_codes(t["g"], c, 0x20).alias("g"), _item_codes(t["e"], c, 0x21).alias("e"))
        return F.transform(F.transform(common, texts), lambda c: F.levenshtein(c["g"], c["e"]))[0]

    few = lambda t: F.least(F.size(t["g"]), F.size(t["e"])) <= short
    return F.transform(F.array(both), lambda t: F.when(few(t), coded(t)).otherwise(_by_diagonals(t["g"], t["e"])))[0]


def word_rate(generated: Column, expected: Column) -> Column:
    """Edit distance of two arrays of words for each expected one; of none expected 0 or 1."""

    def rate(t: Column) -> Column:
        n = F.size(t["e"])
        return F.when(t["g"].isNull() | t["e"].isNull(), F.lit(None)).when(n == 0, (F.size(t["g"]) > 0).cast("double")).otherwise(word_distance(t["g"], t["e"]) / n)

    return F.transform(F.array(F.struct(generated.alias("g"), expected.alias("e"))), rate)[0]


def wer(generated: Column, expected: Column) -> Column:
    """As cer over words."""
    return word_rate(words(generated), words(expected))


def _grams(tokens: Column, n: int) -> Column:
    """All n-grams in order, as strings; none if there are fewer tokens."""
    last = F.size(tokens) - n + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), "\u0001"))


def _clipped(hyp: Column, ref: Column) -> Column:
    """Common n-grams, each as often as in the side that has fewer; n-grams are told apart by 63-bit hashes."""
    more = lambda s: s["total"] + F.least(s["h"], s["r"])

    def step(s: Column, e: Column) -> Column:
        gram, of_ref = F.shiftright(e, 1), e.bitwiseAND(1).cast("int")
        same = gram == s["gram"]
        so_far = lambda name: F.when(same, s[name]).otherwise(F.lit(0))
        return F.struct(gram.alias("gram"), (so_far("h") + 1 - of_ref).alias("h"), (so_far("r") + of_ref).alias("r"), F.when(same, s["total"]).otherwise(more(s)).alias("total"))

    none = F.lit((1 << 63) - 1).cast("long").alias("gram")
    return F.aggregate(merged_codes(hyp, ref), F.struct(none, F.lit(0).alias("h"), F.lit(0).alias("r"), F.lit(0).alias("total")), step, more)


def bleu_parts(generated: Column, expected: Column) -> Column:
    """struct<n1..n4, d1..d4, hyp, ref>: clipped matches, n-grams and lengths."""
    tokens = F.struct(words(generated).alias("h"), words(expected).alias("r"))

    def parts(t: Column) -> Column:
        fields = [_clipped(_grams(t["h"], n), _grams(t["r"], n)).alias(f"n{n}") for n in range(1, 5)]
        fields += [F.greatest(F.size(t["h"]) - n + 1, F.lit(0)).alias(f"d{n}") for n in range(1, 5)]
        return F.struct(*fields, F.size(t["h"]).alias("hyp"), F.size(t["r"]).alias("ref"))

    return F.transform(F.array(tokens), parts)[0]  # tokens are made once


def sentence_bleu(parts: Column) -> Column:
    """BLEU of up to four words, 0.1 in place of no match; an empty reference gives 1 or 0."""
    logs = [F.log(F.when(parts[f"n{n}"] == 0, F.lit(0.1)).otherwise(parts[f"n{n}"].cast("double")) / F.greatest(parts[f"d{n}"], F.lit(1))) for n in range(1, 5)]
    brief = F.when(parts["hyp"] > parts["ref"], F.lit(1.0)).otherwise(F.exp(1 - parts["ref"] / parts["hyp"]))
    return (
        F.when(parts["ref"] == 0, (parts["hyp"] == 0).cast("double"))
        .when((parts["hyp"] == 0) | (parts["n1"] == 0), F.lit(0.0))
        .otherwise(brief * F.exp(reduce(add, logs) / 4))
    )


def corpus_bleu(rows: DataFrame, parts: str = "parts") -> DataFrame:
    """One row: corpus_bleu over all rows, without smoothing (0 where an order has no match)."""
    sums = rows.agg(
        *[F.sum(f"{parts}.n{n}").alias(f"n{n}") for n in range(1, 5)],
        *[F.sum(F.greatest(F.col(f"{parts}.d{n}"), F.lit(1))).alias(f"d{n}") for n in range(1, 5)],
        F.sum(f"{parts}.hyp").alias("hyp"),
        F.sum(f"{parts}.ref").alias("ref"),
    )
    none = reduce(lambda a, b: a | b, [F.col(f"n{n}") == 0 for n in range(1, 5)])
    brief = F.when(F.col("hyp") > F.col("ref"), F.lit(1.0)).otherwise(F.exp(1 - F.col("ref") / F.col("hyp")))
    score = brief * F.exp(reduce(add, [F.log(F.col(f"n{n}") / F.col(f"d{n}")) for n in range(1, 5)]) / 4)
    return sums.select(F.when(none | (F.col("hyp") == 0), F.lit(0.0)).otherwise(score).alias("corpus_bleu"))


CHECKS = ["number_format_ok", "filler_removal_ok", "self_correction_ok", "punctuation_ok", "emoji_ok"]


def format_checks(source: Column, expected: Column, generated: Column) -> dict[str, Column]:
    """Five three-valued checks; null where a check does not apply."""
    number = F.lit(rf"(?iU)\b(?:{'|'.join(L.NUMBER_WORDS)})\b")
    spoken = lambda t: F.transform(F.regexp_extract_all(t, number, F.lit(0)), F.lower)
    fillers = lambda t: F.regexp_count(t, F.lit(L.STRONG_FILLERS))
    ends = lambda t: strip(t).rlike(r"[.!?]\z")
    return {
        "number_format_ok": F.when(expected.rlike(r"(?U)\d"), F.size(F.array_except(spoken(generated), spoken(expected))) == 0),
        "filler_removal_ok": F.when(source.rlike(L.STRONG_FILLERS), fillers(generated) <= fillers(expected)).when(
            (fillers(generated) > 0) & (fillers(expected) == 0), F.lit(False)
        ),
        "self_correction_ok": F.when(source.rlike(L.EVALUATION_CORRECTIONS), ~generated.rlike(L.EVALUATION_CORRECTIONS)),
        "punctuation_ok": F.when(ends(expected), ends(generated)),
        "emoji_ok": F.when(expected.rlike(L.EMOJI), generated.rlike(L.EMOJI)),
    }


def format_accuracy(checks: list[Column]) -> Column:
    """Mean of the checks that apply, null if none does."""
    known = F.filter(F.array(*[c.cast("int") for c in checks]), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0), lambda a, x: a + x).cast("double"), F.size(known))
