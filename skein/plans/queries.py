"""Queries over the library's operators, each with the SQL that DuckDB answers it by.

The SQL is a second formulation, not a rendering of the plan: word boundaries,
for one, are marks (chr 1 before a word, chr 2 after it) since its regular
expressions know ASCII boundaries only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.functions import lexicons as L
from skein.functions import metrics as M
from skein.functions import text as T
from skein.operators import compare, dedup, evaluation, joins, judge, quality, stats, synth, training
from skein.plans import control
from skein.plans import fixtures as X
from skein.plans.prepare import SYSTEM
from skein.sources.shared import stored

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

P, E, V, LOG = (X.duck(s) for s in (X.PAIRS, X.EVALUATION, X.VERDICTS, X.LOG))


def query(name: str, view: str | None, sql: str | None = None):
    """Register a function of a view as a query, and its SQL."""

    def add(f):
        _QUERIES[name] = (lambda spark, d: f(X.view(spark, d, view))) if view else f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- pieces of SQL


def marked(x: str) -> str:
    return f"regexp_replace({x}, '([\\p{{L}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(2), 'g')"


def n_matches(x: str, *patterns: str) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all({x}, '{p}'))" for p in patterns) + ")"


def word(*ws: str) -> str:
    return r"\x01(?:" + "|".join(ws) + r")\x02"


def phrase(text: str) -> str:
    return " ".join(rf"\x01{w}\x02" for w in text.split())


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"


def key(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, '\\s+', ' ', 'g')"


def fillers(x: str) -> str:
    return n_matches(
        marked(f"lower({x})"), word("um", "uh", "like", "basically", "actually", "literally", "honestly"), phrase("you know"), r"\x01so\x02\s+\x01(?:um|uh|like|the|we|it|he|she|they)"
    )


def corrections(x: str) -> str:
    return n_matches(
        marked(f"lower({x})"),
        phrase("wait no"),
        word("actually"),
        word("sorry"),
        phrase("scratch that"),
        phrase("let me rephrase"),
        phrase("no wait"),
        r"\x01no\x02\s+\x01(?:it|that)(?:\x02''\x01s|s)\x02",
        r"\x01wait\x02[^\n]*\x01no\x02",
    )


MULTI = r"(?:wait\s+no|no\s+wait|actually|sorry)"
SPOKEN = [
    word("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"),
    word("eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty"),
    word("thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion"),
    r"\x01point\x02\s+\x01",
]


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


# --- pairs, sources, sets

_QUERIES["pairs_from_turns"] = lambda s, d: X.view(s, d, X.TURNS).where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("input"), F.col("next_text").alias("output"))
_SQL["pairs_from_turns"] = f"SELECT conv_id, turn, text AS input, next_text AS output FROM {X.duck(X.TURNS)} WHERE role = 'user' AND next_role = 'assistant'"


@query("normalized_pairs", X.PAIRS, f"SELECT line_no, md5({strip(f'''replace(replace(output, chr(13) || chr(10), chr(10)), chr(13), chr(10))''')}) AS norm, regexp_replace(lower(regexp_replace(regexp_replace(category, '^.*/', ''), '[^A-Za-z0-9]+', '_', 'g')), '^_+|_+$', '', 'g') AS slug FROM {P}")
def _(p):
    return p.select("line_no", F.md5(T.normalize_text(F.col("output")).cast("binary")).alias("norm"), T.slug(F.col("category")).alias("slug"))


@query("dedup_first_occurrence", X.PAIRS, f"SELECT line_no FROM (SELECT line_no, row_number() OVER (PARTITION BY {key('input')} ORDER BY line_no) AS rn FROM {P}) WHERE rn = 1")
def _(p):
    return dedup.first_occurrences(p, ["line_no"]).select("line_no")


@query("dedup_counts", X.PAIRS, f"SELECT count(*) AS n, count(DISTINCT k) AS n_distinct, count(*) - count(DISTINCT k) AS n_duplicates FROM (SELECT {key('input')} AS k FROM {P})")
def _(p):
    return dedup.duplicate_count(p)


@query("union_sources", X.PAIRS, f"SELECT src_rank, CAST(count(*) AS BIGINT) AS n FROM (SELECT 0 AS src_rank FROM {P} WHERE lang = 'en' UNION ALL SELECT 1 FROM {P} WHERE lang = 'fr' UNION ALL SELECT 2 FROM {P} WHERE lang NOT IN ('en', 'fr')) GROUP BY 1")
def _(p):
    return dedup.union_sources(p.where("lang = 'en'"), p.where("lang = 'fr'"), p.where("lang not in ('en', 'fr')")).groupBy("src_rank").agg(F.count("*").alias("n"))


@query("key_intersect", X.PAIRS, f"SELECT key FROM (SELECT {key('input')} AS key FROM {P}) INTERSECT SELECT {key('output')} FROM {P}")
def _(p):
    return p.select(T.dedup_key(F.col("input")).alias("key")).intersect(p.select(T.dedup_key(F.col("output")).alias("key")))


@query("key_except", X.PAIRS, f"SELECT key FROM (SELECT {key('input')} AS key FROM {P}) EXCEPT SELECT {key('output')} FROM {P}")
def _(p):
    return p.select(T.dedup_key(F.col("input")).alias("key")).subtract(p.select(T.dedup_key(F.col("output")).alias("key")))


# --- quality rules

_REASONS = {
    "length": "i <> '' AND o <> '' AND length(o) > 2 * length(i)",
    "empty_output": f"o = '' AND i <> '' AND length({strip(f'''replace(replace(regexp_replace({marked('i')}, '(?i){word('um', 'uh', 'uhh', 'umm')}', '', 'g'), chr(1), ''), chr(2), '')''')}) > 10",
    "input_mojibake": "regexp_matches(input, '\\x{FFFD}|Ã[\\x{80}-\\x{BF}]|â\\x{80}|Ã©|Ã¨|Ã¢|Ã®')",
    "output_mojibake": "regexp_matches(output, '\\x{FFFD}|Ã[\\x{80}-\\x{BF}]|â\\x{80}|Ã©|Ã¨|Ã¢|Ã®')",
    "fillers": has(marked("regexp_replace(o, '\"[^\"]*\"', '', 'g')"), "(?i)" + word("um", "uh", "uhh", "umm")),
    "think_tag": has("o", "(?i)</?think>"),
}
_REASONED = f"""SELECT *, list_filter([{", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _REASONS.items())}], lambda x: x IS NOT NULL) AS reasons
  FROM (SELECT *, {strip('input')} AS i, {strip('output')} AS o FROM {P})"""
_NOVEL = f"""SELECT o.line_no, count(*) AS n_out, count(*) FILTER (WHERE i.w IS NULL) AS n_new FROM (SELECT line_no, unnest({tokens('lower(output)')}) AS w FROM {P}) o
  LEFT JOIN (SELECT DISTINCT line_no, unnest({tokens('lower(input)')}) AS w FROM {P}) i ON o.line_no = i.line_no AND o.w = i.w GROUP BY o.line_no"""
_CHECKED = f"SELECT r.*, coalesce(n_out, 0) AS n_out, coalesce(n_new, 0) AS n_new FROM ({_REASONED}) r LEFT JOIN ({_NOVEL}) v ON r.line_no = v.line_no"
_WARNED = "i <> '' AND n_out > 0 AND n_new::DOUBLE / n_out > 0.2::DOUBLE"


@query("quality_reasons", X.PAIRS, f"SELECT line_no, array_to_string(reasons, ',') AS reasons, {_WARNED} AS warned FROM ({_CHECKED})")
def _(p):
    return quality.validate(p).select("line_no", F.array_join("reasons", ",").alias("reasons"), (F.size("warnings") > 0).alias("warned"))


@query("quality_reason_hist", X.PAIRS, f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({_REASONED})) GROUP BY 1")
def _(p):
    return quality.reason_counts(quality.validate(p))


@query(
    "quality_counts",
    X.PAIRS,
    f"SELECT count(*) FILTER (WHERE len(reasons) = 0) AS accepted, count(*) FILTER (WHERE len(reasons) > 0) AS rejected, count(*) FILTER (WHERE len(reasons) = 0 AND {_WARNED}) AS warned, count(*) AS total FROM ({_CHECKED})",
)
def _(p):
    return quality.severity_counts(quality.validate(p))


@query("novel_words", X.PAIRS, f"SELECT line_no, CAST(n_new AS BIGINT) AS novel, CAST(n_out AS BIGINT) AS total FROM ({_CHECKED})")
def _(p):
    return p.select("line_no", quality.novel_words(F.col("input"), F.col("output")).cast("long").alias("novel"), F.size(T.words(F.col("output"))).cast("long").alias("total"))


@query(
    "generation_first_reason",
    X.PAIRS,
    f"""SELECT line_no, CASE WHEN i = '' THEN 'empty_transcript' WHEN o = '' THEN 'empty_output' WHEN length(o) > 2 * length(i) THEN 'too_long'
    WHEN {has(marked('output'), "(?i)(?:" + word("um", "uh") + "|" + phrase("you know") + "|" + phrase("i mean") + "|" + phrase("like basically") + ")")} THEN 'fillers' END AS reason
    FROM (SELECT *, {strip('input')} AS i, {strip('output')} AS o FROM {P})""",
)
def _(p):
    return p.select("line_no", quality.first_reason(F.col("input"), F.col("output")).alias("reason"))


# --- order, split, chat

_PLACED = f"SELECT *, row_number() OVER (ORDER BY md5(concat('42|', line_no)), line_no) - 1 AS place, count(*) OVER () AS n FROM {P}"
_SPLIT = f"SELECT *, CASE WHEN place < floor(n * 0.9::DOUBLE) THEN 'train' WHEN place < floor(n * 0.9::DOUBLE) + floor(n * 0.05::DOUBLE) THEN 'valid' ELSE 'test' END AS split FROM ({_PLACED})"


@query("split_assign", X.PAIRS, f"SELECT line_no, split FROM ({_SPLIT})")
def _(p):
    return dedup.exact_split(p, ["line_no"]).select("line_no", "split")


@query("split_sizes", X.PAIRS, f"SELECT split, count(*) AS n FROM ({_SPLIT}) GROUP BY 1")
def _(p):
    return dedup.exact_split(p, ["line_no"]).groupBy("split").agg(F.count("*").alias("n"))


_GOOD = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key('input')} ORDER BY line_no) AS rn FROM ({_REASONED}) WHERE len(reasons) = 0) WHERE rn = 1"
_CHAT = f"""WITH good AS ({_GOOD}), placed AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', line_no)), line_no) - 1 AS place, count(*) OVER () AS n FROM good)
SELECT line_no, CASE WHEN place < floor(n * 0.9::DOUBLE) THEN 'train' WHEN place < floor(n * 0.9::DOUBLE) + floor(n * 0.05::DOUBLE) THEN 'valid' ELSE 'test' END AS split, m.pos, m.role, m.content
FROM placed, LATERAL (VALUES (0, 'system', '{SYSTEM}'), (1, 'user', input), (2, 'assistant', output)) m(pos, role, content)"""


@query("chat_records", X.PAIRS, _CHAT)
def _(p):
    """The flagship: rules, dedup, exact split, chat messages."""
    good = dedup.first_occurrences(quality.passing(p), ["line_no"]).select("line_no", "input", "output")
    split = dedup.exact_split(stored(good, "accepted"), ["line_no"])
    return split.select("line_no", "split", F.posexplode(T.chat_messages(SYSTEM, F.col("input"), F.col("output"))).alias("pos", "m")).select("line_no", "split", "pos", "m.role", "m.content")


@query("chatml_render", X.PAIRS, f"SELECT line_no, md5(concat('<|im_start|>system', chr(10), 's<|im_end|>', chr(10), '<|im_start|>user', chr(10), input, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10))) AS rendered FROM {P}")
def _(p):
    return p.select("line_no", F.md5(T.chatml(T.chat_messages("s", F.col("input")), True).cast("binary")).alias("rendered"))


@query("judge_sample", X.PAIRS, f"SELECT category, line_no FROM (SELECT category, line_no, row_number() OVER (PARTITION BY category ORDER BY md5(concat('42|', category, '|', line_no)), category, line_no) AS rn, count(*) OVER (PARTITION BY category) AS n FROM {P}) WHERE rn <= ceil(n * 0.12::DOUBLE)")
def _(p):
    return judge.judge_sample(p, 0.12).select("category", "line_no")


@query("batch_sizes", X.PAIRS, f"SELECT category, CAST(b AS INT) AS batch, count(*) AS n FROM (SELECT category, (row_number() OVER (PARTITION BY category ORDER BY line_no) - 1) // 25 AS b FROM {P}) GROUP BY ALL")
def _(p):
    return dedup.batches(p, "category", ["line_no"]).groupBy("category", "batch").agg(F.count("*").alias("n"))


# --- aggregates

@query("length_stats", X.PAIRS, f"SELECT count(*) AS n, avg(length(input)) AS avg_input, CAST(min(length(input)) AS INT) AS min_input, CAST(max(length(input)) AS INT) AS max_input, avg(length(output)) AS avg_output, CAST(min(length(output)) AS INT) AS min_output, CAST(max(length(output)) AS INT) AS max_output FROM {P}")
def _(p):
    return stats.length_stats(p)


@query("source_stats", X.PAIRS, f"SELECT category, count(*) AS n FROM {P} GROUP BY 1")
def _(p):
    return stats.counts_by(p, "category")


@query("totals_rollup", X.PAIRS, f"SELECT coalesce(lang, 'TOTAL') AS lang, CAST(sum(length(input)) AS BIGINT) AS chars FROM {P} GROUP BY ROLLUP (lang)")
def _(p):
    return stats.with_total(p.select("lang", F.length("input").alias("chars")), "lang", "chars")


@query("mean_of_means", X.PAIRS, f"SELECT round_even(avg(m), 6) AS mean_of_means FROM (SELECT category, avg(length(input)) AS m FROM {P} GROUP BY 1)")
def _(p):
    return stats.mean_of_means(p.withColumn("n", F.length("input")), "category", "n").select(F.bround("mean_of_means", 6).alias("mean_of_means"))


@query("total_if_known", X.PAIRS, f"SELECT CAST(CASE WHEN count(v) = count(*) THEN sum(v) END AS BIGINT) AS total FROM (SELECT CASE WHEN output <> '' THEN length(output) END AS v FROM {P})")
def _(p):
    return stats.total_if_known(p.select(F.when(F.col("output") != "", F.length(F.col("output"))).alias("v")), "v")


# --- joins

def _stems(p, k, name):
    """All rows, of which every k-th has a key of its own side."""
    folder = F.when(F.col("line_no") % k == 0, F.lit(f"{name}/")).otherwise(F.lit("d/"))
    return p.select(F.concat(folder, F.col("line_no").cast("string")).alias("key"), F.length(name).alias(name))


_L, _R = (f"(SELECT concat(CASE WHEN line_no % {k} = 0 THEN '{c}/' ELSE 'd/' END, line_no) AS key, length({c}) AS {c} FROM {P})" for k, c in ((3, "input"), (5, "output")))


@query("stem_inner", X.PAIRS, f"SELECT key, CAST(input AS INT) AS input, CAST(output AS INT) AS output FROM {_L} JOIN {_R} USING (key)")
def _(p):
    return joins.paired(_stems(p, 3, "input"), _stems(p, 5, "output"))


_UNMATCHED = f"SELECT coalesce(l.key, r.key) AS key, CASE WHEN r.key IS NULL THEN 'left' ELSE 'right' END AS side FROM {_L} l FULL JOIN {_R} r ON l.key = r.key WHERE l.key IS NULL OR r.key IS NULL"


@query("stem_unmatched", X.PAIRS, _UNMATCHED)
def _(p):
    return joins.unmatched(_stems(p, 3, "input"), _stems(p, 5, "output"))


@query("stem_unmatched_summary", X.PAIRS, f"SELECT side, count(*) AS n, array_to_string(list_slice(list_sort(list(key)), 1, 5), ',') AS examples FROM ({_UNMATCHED}) GROUP BY 1")
def _(p):
    return joins.unmatched_summary(joins.unmatched(_stems(p, 3, "input"), _stems(p, 5, "output"))).withColumn("examples", F.array_join("examples", ","))


@query("rejected_anti", X.PAIRS, f"SELECT line_no FROM {P} WHERE category NOT IN ('src1', 'src2')")
def _(p):
    return joins.without(p, p.sparkSession.createDataFrame([("src1",), ("src2",)], "category string"), ["category"]).select("line_no")


@query("category_semi", X.PAIRS, f"SELECT line_no FROM {P} WHERE category IN ('src1', 'src2')")
def _(p):
    return joins.only(p, p.sparkSession.createDataFrame([("src1",), ("src2",)], "category string"), ["category"]).select("line_no")


@query("category_unexpected", X.PAIRS, f"SELECT DISTINCT category FROM {P} WHERE category NOT IN ('src1', 'src2')")
def _(p):
    return judge.unexpected(p, ["src1", "src2"], p.sparkSession)


@query("zip_positional", X.PAIRS, f"SELECT line_no, unnest(range(1, least(len(a), len(b)) + 1)) - 1 AS pos, a[unnest(range(1, least(len(a), len(b)) + 1))] AS clean, b[unnest(range(1, least(len(a), len(b)) + 1))] AS messy FROM (SELECT line_no, {tokens('input')} AS a, {tokens('output')} AS b FROM {P})")
def _(p):
    z = p.select("line_no", F.posexplode(joins.zip_short(T.words(F.col("input")), T.words(F.col("output")))).alias("pos", "z"))
    return z.select("line_no", F.col("pos").cast("long").alias("pos"), "z.clean", "z.messy")


@query("stats_full_outer", X.PAIRS, f"SELECT coalesce(a.category, b.category) AS category, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b FROM (SELECT category, count(*) AS n FROM {P} WHERE lang = 'en' GROUP BY 1) a FULL JOIN (SELECT category, count(*) AS n FROM {P} WHERE lang <> 'en' GROUP BY 1) b ON a.category = b.category")
def _(p):
    count = lambda rows: stats.counts_by(rows, "category")
    return joins.side_by_side(count(p.where("lang = 'en'")), count(p.where("lang <> 'en'")), "category", "n", ("a", "b"))


# --- categories, paragraphs, quotas

_SCORES = ", ".join(f"{' + '.join(f'''contains(lower(input), '{k.lower()}')::INT''' for k in ks)} AS s{i}" for i, ks in enumerate(L.CATEGORY_KEYWORDS.values()))
_BEST = " ".join(f"WHEN s{i} = best THEN '{c}'" for i, c in enumerate(L.CATEGORY_KEYWORDS))
_CATEGORY = f"SELECT line_no, CASE WHEN best < 2 THEN NULL {_BEST} END AS keyword_category FROM (SELECT *, greatest({', '.join(f's{i}' for i in range(len(L.CATEGORY_KEYWORDS)))}) AS best FROM (SELECT line_no, {_SCORES} FROM {P}))"


@query("keyword_category", X.PAIRS, _CATEGORY)
def _(p):
    return p.select("line_no", synth.category(F.col("input")).alias("keyword_category"))


@query("keyword_category_counts", X.PAIRS, f"SELECT keyword_category, count(*) AS n FROM ({_CATEGORY}) GROUP BY 1")
def _(p):
    return p.groupBy(synth.category(F.col("input")).alias("keyword_category")).agg(F.count("*").alias("n"))


@query("paragraph_first_fit", X.PAIRS, f"SELECT line_no, list_filter(list_transform(string_split(output, chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: length(x) BETWEEN 100 AND 2000)[1] AS paragraph FROM {P}")
def _(p):
    return p.select("line_no", T.first_paragraph(F.col("output")).alias("paragraph"))


_PLAN = "(VALUES {}) w(category, ord, proportion)".format(", ".join(f"('{c}', {i}, {w}::DOUBLE)" for i, (c, w) in enumerate(L.CATEGORY_WEIGHTS.items())))
_HAVE = f"(SELECT c AS category, count(*) AS existing FROM (SELECT CASE line_no % 3 WHEN 0 THEN 'meeting_notes' WHEN 1 THEN 'shopping_lists' ELSE 'other' END AS c FROM {P}) GROUP BY 1)"


@query(
    "quota_plan",
    X.PAIRS,
    f"""SELECT category, ord, proportion, target, existing, remaining, CAST(ceil(remaining / 25.0::DOUBLE) AS BIGINT) AS num_batches FROM (
    SELECT category, ord, proportion, target, coalesce(existing, 0) AS existing, greatest(target - coalesce(existing, 0), 0) AS remaining
    FROM (SELECT *, CAST(round_even(5000 * proportion, 0) AS BIGINT) AS target FROM {_PLAN}) t LEFT JOIN {_HAVE} h USING (category))""",
)
def _(p):
    have = p.select(F.when(F.col("line_no") % 3 == 0, "meeting_notes").when(F.col("line_no") % 3 == 1, "shopping_lists").otherwise("other").alias("category"))
    return synth.quota_plan(p.sparkSession, have, 5000)


@query(
    "cost_estimate",
    X.PAIRS,
    f"SELECT batches, batches * 1500 AS input_tokens, batches * 2000 AS output_tokens, round_even(batches * 1500 / 1e6 * 3 + batches * 2000 / 1e6 * 15, 2) AS usd FROM (SELECT CAST(ceil(count(*) / 25.0::DOUBLE) AS BIGINT) AS batches FROM {P})",
)
def _(p):
    return p.agg(synth.generation_cost(F.count("*")).alias("c")).select("c.*")


@query(
    "judging_cost",
    X.PAIRS,
    f"SELECT calls, calls * 800 AS input_tokens, calls * 50 AS output_tokens, round_even(calls * 800 / 1e6 * 3 + calls * 50 / 1e6 * 15, 4) AS usd FROM (SELECT CAST(sum(CAST(ceil(n * 0.12::DOUBLE) AS BIGINT)) AS BIGINT) AS calls FROM (SELECT count(*) AS n FROM {P} GROUP BY category))",
)
def _(p):
    return synth.judging_cost(stats.counts_by(p, "category"), 0.12)


# --- lexical features

@query("filler_count", X.PAIRS, f"SELECT line_no, CAST({fillers('input')} AS INT) AS n FROM {P}")
def _(p):
    return p.select("line_no", T.filler_count(F.col("input")).alias("n"))


@query("output_fillers", X.PAIRS, f"SELECT line_no, CAST({n_matches(marked('lower(output)'), word('um', 'uh', 'basically', 'literally'), phrase('you know'))} AS INT) AS n FROM {P}")
def _(p):
    return p.select("line_no", F.size(T.output_fillers(F.col("output"))).alias("n"))


_PLACES = f"""flatten(list_transform(list_filter(list_transform(string_split_regex(lower(input), '[.!?]+'), lambda s: {tokens('s')}), lambda ws: len(ws) >= 2),
  lambda ws: list_filter(list_transform(ws, lambda w, i: CASE WHEN w IN ('um', 'uh', 'like', 'basically', 'honestly') THEN CASE WHEN i <= 2 OR i >= len(ws) THEN 1 ELSE 0 END END), lambda x: x IS NOT NULL)))"""


@query("filler_positions", X.PAIRS, f"SELECT line_no, CAST(len(list_filter(x, lambda v: v = 1)) AS INT) AS boundary, CAST(len(list_filter(x, lambda v: v = 0)) AS INT) AS mid_phrase FROM (SELECT line_no, {_PLACES} AS x FROM {P})")
def _(p):
    return p.select("line_no", T.filler_positions(F.col("input")).alias("f")).select("line_no", "f.*")


@query("self_corrections", X.PAIRS, f"SELECT line_no, CAST({corrections('input')} AS INT) AS n FROM {P}")
def _(p):
    return p.select("line_no", T.correction_count(F.col("input")).alias("n"))


@query("multi_step", X.PAIRS, f"SELECT line_no, {has('lower(input)', MULTI + '[^\\n]*' + MULTI)} AS multi_step FROM {P}")
def _(p):
    return p.select("line_no", T.has_multi_step(F.col("input")).alias("multi_step"))


@query("false_starts", X.PAIRS, f"SELECT line_no, {has('input', '\\.\\.\\.|—|[\\p{L}\\p{N}_]+\\s*--\\s*')} AS false_start FROM {P}")
def _(p):
    return p.select("line_no", T.has_false_start(F.col("input")).alias("false_start"))


_BULLET, _NUMBERED, _HEADER = (f"(?m)^{x}" for x in (r"\s*[-•*]\s", r"\s*\d+[.)]\s", r"#+\s"))


@query(
    "written_smell",
    X.PAIRS,
    f"""SELECT line_no, round_even(coalesce(len(list_filter(s, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) * 100.0::DOUBLE / nullif(len(s), 0), 0), 1) AS caps_start_pct,
    {has('output', _BULLET)} AS has_bullets, {has('output', _NUMBERED)} AS has_numbered, {has('output', _HEADER)} AS has_headers,
    round_even(coalesce(len(list_filter(n, lambda x: ends_with(x, '.'))) * 100.0::DOUBLE / nullif(len(n), 0), 0), 1) AS period_end_pct
    FROM (SELECT *, list_filter(list_transform(string_split_regex(output, '[.!?]+'), lambda x: {strip('x')}), lambda x: x <> '') AS s,
      list_filter(list_transform(string_split(output, chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS n FROM {P})""",
)
def _(p):
    return p.select("line_no", T.written_smell(F.col("output")).alias("w")).select("line_no", "w.*")


@query(
    "number_conversion",
    X.PAIRS,
    f"SELECT line_no, CAST({n_matches(marked('lower(input)'), *SPOKEN)} AS INT) AS spoken_in_input, {has('output', '\\$[\\d,.]+|\\d+%|\\d{1,3}(?:,\\d{3})+|\\d+\\.\\d+')} AS formatted_in_output, CAST({n_matches(marked('lower(output)'), *SPOKEN)} AS INT) AS spoken_in_output FROM {P}",
)
def _(p):
    return p.select("line_no", T.number_conversion(F.col("input"), F.col("output")).alias("n")).select("line_no", "n.*")


@query(
    "format_flags",
    X.PAIRS,
    f"SELECT line_no, {has('output', '^\\p{Lu}')} AS starts_capital, {has(strip('output'), '[.!?]$')} AS ends_punctuation, {has('output', _BULLET)} AS has_bullets, contains(output, chr(10) || chr(10)) AS has_paragraphs, {has('output', _HEADER)} AS has_headers, contains(output, '`') AS has_code FROM {P}",
)
def _(p):
    return p.select("line_no", T.format_flags(F.col("output")).alias("f")).select("line_no", "f.*")


def _letters(x: str, least: int) -> str:
    return f"list_distinct(regexp_extract_all({marked(f'lower({x})')}, '\\x01([a-z]{{{least},}})\\x02', 1))"


def _list(ws: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(ws)) + "]"


_PRESERVED = (
    f"SELECT line_no, CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / len(a) END AS preservation FROM (SELECT line_no, list_filter({_letters('input', 4)}, lambda w: NOT list_contains({_list(L.PRESERVATION_STOPWORDS)}, w)) AS a, {_letters('output', 4)} AS b FROM {P})")


@query("preservation", X.PAIRS, _PRESERVED)
def _(p):
    return p.select("line_no", T.preservation(F.col("input"), F.col("output")).alias("preservation"))


@query(
    "made_up_words",
    X.PAIRS,
    f"""SELECT line_no, array_to_string(list_sort(list_filter(o, lambda w: NOT (list_contains(i, w) OR list_contains(i, w || 's') OR list_contains(i, rtrim(w, 's')) OR list_contains(i, w || 'ed')
    OR list_contains(i, w || 'ing') OR list_contains(i, rtrim(w, 'ed')) OR list_contains(i, rtrim(w, 'ing'))))), ',') AS made_up
    FROM (SELECT line_no, {_letters('input', 3)} AS i, list_filter({_letters('output', 5)}, lambda w: NOT list_contains({_list(L.HALLUCINATION_COMMON)}, w)) AS o FROM {P})""",
)
def _(p):
    return p.select("line_no", F.array_join(F.array_sort(T.made_up_words(F.col("input"), F.col("output"))), ",").alias("made_up"))


# --- comparison of two corpora: English rows against all others

def _sided(p):
    return p.withColumn("dataset", F.when(F.col("lang") == "en", "script").otherwise("prompt"))


_SIDED = f"SELECT *, CASE WHEN lang = 'en' THEN 'script' ELSE 'prompt' END AS dataset FROM {P}"
_PROFILE = f"""SELECT category, dataset, count(*) AS count, round_even(avg(length(input)), 1) AS avg_input_chars, round_even(avg(iw), 1) AS avg_input_words, round_even(avg(length(output)), 1) AS avg_output_chars, round_even(avg(ow), 1) AS avg_output_words,
  round_even(avg(CASE WHEN length(input) > 0 THEN length(output)::DOUBLE / length(input) ELSE 0 END), 3) AS avg_compression,
  round_even(avg(CASE WHEN iw > 0 THEN fc * 100.0::DOUBLE / iw ELSE 0 END), 2) AS avg_filler_density, round_even(avg(sc), 2) AS avg_corrections,
  round_even(CASE WHEN avg(iw) > 0 THEN coalesce(stddev_samp(iw), 0) / avg(iw) ELSE 0 END, 3) AS input_length_cv, CAST(min(iw) AS INT) AS input_word_min, CAST(max(iw) AS INT) AS input_word_max, round_even(coalesce(stddev_samp(iw), 0), 1) AS input_word_std
  FROM (SELECT *, len({tokens('input')}) AS iw, len({tokens('output')}) AS ow, {fillers('input')} AS fc, {corrections('input')} AS sc FROM ({_SIDED})) GROUP BY category, dataset"""


@query("category_profile", X.PAIRS, _PROFILE)
def _(p):
    return stats.profile(_sided(p), ["category", "dataset"])


_VOCABULARY = (
    f"SELECT category, dataset, count(DISTINCT w)::DOUBLE / count(*) AS vocab_diversity FROM (SELECT category, dataset, unnest(regexp_extract_all(lower(input), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM (SELECT *, row_number() OVER (PARTITION BY category, dataset ORDER BY line_no) AS rn FROM ({_SIDED})) WHERE rn <= 100) GROUP BY ALL")


@query("vocab_diversity", X.PAIRS, _VOCABULARY)
def _(p):
    return stats.vocabulary(_sided(p), ["category", "dataset"], ["line_no"])


_METRICS = ["count", "avg_filler_density", "avg_corrections", "input_length_cv", "input_word_max", "avg_compression"]


@query(
    "metric_winner",
    X.PAIRS,
    f"""WITH prof AS ({_PROFILE}), long AS ({" UNION ALL ".join(f"SELECT category, dataset, '{m}' AS metric, {m}::DOUBLE AS value FROM prof" for m in _METRICS)}),
    wide AS (SELECT category, metric, max(value) FILTER (WHERE dataset = 'script') AS a, max(value) FILTER (WHERE dataset = 'prompt') AS b FROM long GROUP BY ALL)
    SELECT *, coalesce(CASE WHEN metric = 'avg_filler_density' THEN CASE WHEN abs(a - 5.5) < abs(b - 5.5) - 0.5 THEN 'a' WHEN abs(b - 5.5) < abs(a - 5.5) - 0.5 THEN 'b' END
      WHEN metric <> 'avg_compression' THEN CASE WHEN a > b THEN 'a' WHEN b > a THEN 'b' END END, '~') AS winner FROM wide""",
)
def _(p):
    return compare.metric_winners(stats.profile(_sided(p), ["category", "dataset"]), "dataset", "script", "prompt", _METRICS)


def _more(x: str, y: str, margin: float) -> str:
    return f"CASE WHEN {x} > {y} + {margin}::DOUBLE THEN 1 WHEN {y} > {x} + {margin}::DOUBLE THEN -1 ELSE 0 END"


def _both(c: str) -> tuple[str, str]:
    return f"coalesce(a.{c}, 0)", f"coalesce(b.{c}, 0)"


_POINTS = [
    _more(*(f"coalesce({t}.mid::DOUBLE / nullif({t}.mid + {t}.boundary, 0), 0)" for t in "ab"), 0.1),
    _more(*_both("avg_corrections"), 0.3),
    _more(*_both("caps")[::-1], 10),
    _more(*_both("left_over")[::-1], 0),
    _more(*_both("kept"), 0.05),
    _more(*_both("input_length_cv"), 0.1),
    _more(*_both("vocab_diversity"), 0.02),
    _more(*(f"abs(coalesce({t}.avg_filler_density, 0) - 5.5::DOUBLE)" for t in "ba"), 1),
    *(f"CASE WHEN {x} > {y} * {k}::DOUBLE THEN 1 WHEN {y} > {x} * {k}::DOUBLE THEN -1 ELSE 0 END" for k, (x, y) in ((2, _both("count")), (1.5, _both("avg_input_words")))),
]


_VERDICTS = f"""WITH places AS (SELECT line_no, len(list_filter(x, lambda v: v = 1)) AS boundary, len(list_filter(x, lambda v: v = 0)) AS mid FROM (SELECT line_no, {_PLACES} AS x FROM {P})),
    smell AS (SELECT line_no, round_even(coalesce(len(list_filter(s, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) * 100.0::DOUBLE / nullif(len(s), 0), 0), 1) AS caps
      FROM (SELECT line_no, list_filter(list_transform(string_split_regex(input, '[.!?]+'), lambda x: {strip('x')}), lambda x: x <> '') AS s FROM {P})),
    rest AS (SELECT line_no, {n_matches(marked('lower(output)'), word('um', 'uh', 'basically', 'literally'), phrase('you know'))} AS n FROM {P}),
    kept AS (SELECT line_no, round_even(preservation, 3) AS kept FROM ({_PRESERVED})),
    sample AS (SELECT category, dataset, sum(mid) AS mid, sum(boundary) AS boundary, avg(caps) AS caps, sum(n) AS left_over, avg(kept) AS kept
      FROM ({_SIDED}) JOIN places USING (line_no) JOIN smell USING (line_no) JOIN rest USING (line_no) JOIN kept USING (line_no) GROUP BY category, dataset),
    figures AS (SELECT * FROM ({_PROFILE}) JOIN sample USING (category, dataset) JOIN ({_VOCABULARY}) USING (category, dataset)),
    points AS (SELECT coalesce(a.category, b.category) AS category, [{", ".join(_POINTS)}] AS p
      FROM (SELECT * FROM figures WHERE dataset = 'script') a FULL JOIN (SELECT * FROM figures WHERE dataset = 'prompt') b ON a.category = b.category),
    scored AS (SELECT category, CAST(len(list_filter(p, lambda x: x = 1)) AS INT) AS score_a, CAST(len(list_filter(p, lambda x: x = -1)) AS INT) AS score_b FROM points)
    SELECT *, CASE WHEN score_a - score_b > 1 THEN 'A_BETTER' WHEN score_a - score_b < -1 THEN 'B_BETTER' ELSE 'TIE' END AS verdict FROM scored"""


@query("verdicts", X.PAIRS, _VERDICTS)
def _verdicts(p):
    s = _sided(p)
    by = ["category", "dataset"]
    figures = stats.profile(s, by).join(compare.sample_features(s, by), by).join(stats.vocabulary(s, by, ["line_no"]), by)
    return compare.verdicts(figures, "dataset", "script", "prompt")


@query(
    "deep_checks",
    X.PAIRS,
    f"""SELECT category, count(*) AS n, CAST(sum({corrections('input')}) AS BIGINT) AS corrections, count(*) FILTER (WHERE {has('lower(input)', MULTI + '[^\\n]*' + MULTI)}) AS multi_step,
    count(*) FILTER (WHERE {has('output', _BULLET)}) AS bulleted, count(*) FILTER (WHERE {has('output', _NUMBERED)}) AS numbered, count(*) FILTER (WHERE contains(output, '`')) AS backtick,
    count(*) FILTER (WHERE contains(lower(input), 'underscore')) AS underscore_spoken, count(*) FILTER (WHERE contains(lower(input), 'underscore') AND contains(output, '_')) AS underscore_written,
    count(*) FILTER (WHERE contains(output, '```')) AS code_block, count(*) FILTER (WHERE {n_matches(marked('lower(input)'), *SPOKEN)} > 0) AS spoken_numbers,
    count(*) FILTER (WHERE {has('output', '\\$[\\d,.]+|\\d+%')}) AS formatted_numbers, count(*) FILTER (WHERE {has('output', _HEADER)}) AS headers,
    count(*) FILTER (WHERE {has('lower(output)', 'action\\s*item|decision|attendee|agenda')}) AS action_items, count(*) FILTER (WHERE NOT {has('output', '[-•*#]')}) AS prose_only,
    count(*) - count(*) FILTER (WHERE {has('output', _BULLET)}) - count(*) FILTER (WHERE {has('output', _NUMBERED)}) AS flat FROM {P} GROUP BY 1""",
)
def _(p):
    return compare.deep_checks(p, ["category"])


@query("first_example", X.PAIRS, f"SELECT category, arg_min(input, line_no) AS example FROM {P} WHERE contains(output, '`') GROUP BY 1")
def _(p):
    return compare.first_example(p, ["category"], F.col("line_no"), F.contains(F.col("output"), F.lit("`")))


@query("repeated_openings", X.PAIRS, f"SELECT category, array_to_string(list_slice(string_split_regex(lower(input), '\\s+'), 1, 3), ' ') AS opening, count(*) AS n FROM {P} GROUP BY ALL HAVING count(*) >= 2")
def _(p):
    return compare.repeated_openings(p, ["category"])


@query("size_imbalance", X.PAIRS, f"SELECT max(n) AS largest, min(n) AS smallest, max(n)::DOUBLE / min(n) AS ratio FROM (SELECT count(*) AS n FROM {P} GROUP BY category)")
def _(p):
    return compare.size_imbalance(p, "category")


# --- evaluation

_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü☺"
#: Edit distance counts bytes there, so letters beyond ASCII become control characters one for one.
_ASCII = "translate({}, '" + _LETTERS + "', concat(" + ", ".join(f"chr({i})" for i in [*range(1, 9), *range(14, 28)]) + "))"
_GEN = "CASE WHEN contains(raw_generated, '<think>') THEN {} ELSE raw_generated END".format(strip("regexp_replace(raw_generated, '(?s)<think>.*?</think>', '', 'g')"))
_ROWS = f"(SELECT *, {_GEN} AS generated FROM {E})"
_CER = f"CASE WHEN length(expected) = 0 THEN (length(generated) > 0)::INT::DOUBLE ELSE levenshtein({_ASCII.format('generated')}, {_ASCII.format('expected')})::DOUBLE / length(expected) END"
_BLEU = f"""toks AS (SELECT index, generated, expected, {tokens('generated')} AS h, {tokens('expected')} AS r FROM {_ROWS}),
  ns AS (SELECT unnest([1, 2, 3, 4]) AS n),
  hg AS (SELECT index, n, g, count(*) AS c FROM (SELECT index, n, array_to_string(list_slice(h, i, i + n - 1), chr(1)) AS g FROM (SELECT index, n, h, unnest(range(1, len(h) - n + 2)) AS i FROM toks, ns)) GROUP BY ALL),
  rg AS (SELECT index, n, g, count(*) AS c FROM (SELECT index, n, array_to_string(list_slice(r, i, i + n - 1), chr(1)) AS g FROM (SELECT index, n, r, unnest(range(1, len(r) - n + 2)) AS i FROM toks, ns)) GROUP BY ALL),
  hits AS (SELECT index, n, sum(least(hg.c, rg.c)) AS m FROM hg JOIN rg USING (index, n, g) GROUP BY ALL),
  parts AS (SELECT t.index, len(h) AS hl, len(r) AS rl, n, coalesce(m, 0) AS m, greatest(len(h) - n + 1, 1) AS d FROM toks t CROSS JOIN ns LEFT JOIN hits USING (index, n)),
  bleu AS (SELECT index, CASE WHEN any_value(rl) = 0 THEN (any_value(hl) = 0)::INT::DOUBLE WHEN any_value(hl) = 0 OR max(m) FILTER (WHERE n = 1) = 0 THEN 0::DOUBLE
    ELSE (CASE WHEN any_value(hl) > any_value(rl) THEN 1::DOUBLE ELSE exp(1 - any_value(rl)::DOUBLE / any_value(hl)) END) * exp(sum(ln((CASE WHEN m = 0 THEN 0.1::DOUBLE ELSE m::DOUBLE END) / d)) / 4) END AS sentence_bleu FROM parts GROUP BY index)"""
_NUMBERS = word(*L.NUMBER_WORDS)
_STRONG = "(?i)" + word("um", "uh", "umm", "uhh", "hmm", "hm", "er", "erm")
_FIX = r"(?i)(?:\x01wait\x02\s+\x01no\x02|\x01scratch\x02\s+\x01that\x02|\x01no\x02\s+\x01wait\x02|\x01i\x02\s+\x01meant?\x02)"
_EMOJI = "[\\x{1F600}-\\x{1F64F}\\x{1F300}-\\x{1F5FF}\\x{1F680}-\\x{1F6FF}\\x{1F1E0}-\\x{1F1FF}\\x{2600}-\\x{26FF}\\x{2700}-\\x{27BF}]"


def _spoken(x: str) -> str:
    return f"regexp_extract_all({marked(f'lower({x})')}, '{_NUMBERS}')"


_CHECKS = f"""SELECT index,
  CASE WHEN {has('expected', '\\d')} THEN len(list_filter({_spoken('generated')}, lambda w: NOT list_contains({_spoken('expected')}, w))) = 0 END AS number_format_ok,
  CASE WHEN {has(marked('input'), _STRONG)} THEN {n_matches(marked('generated'), _STRONG)} <= {n_matches(marked('expected'), _STRONG)}
    WHEN {n_matches(marked('generated'), _STRONG)} > 0 AND {n_matches(marked('expected'), _STRONG)} = 0 THEN false END AS filler_removal_ok,
  CASE WHEN {has(marked('input'), _FIX)} THEN NOT {has(marked('generated'), _FIX)} END AS self_correction_ok,
  CASE WHEN {has(strip('expected'), '[.!?]$')} THEN {has(strip('generated'), '[.!?]$')} END AS punctuation_ok,
  CASE WHEN {has('expected', _EMOJI)} THEN {has('generated', _EMOJI)} END AS emoji_ok FROM {_ROWS}"""
_ACCURACY = f"SELECT *, CASE WHEN len(l) > 0 THEN list_sum(l)::DOUBLE / len(l) END AS format_accuracy FROM (SELECT *, list_filter([number_format_ok::INT, filler_removal_ok::INT, self_correction_ok::INT, punctuation_ok::INT, emoji_ok::INT], lambda x: x IS NOT NULL) AS l FROM ({_CHECKS}))"
_SCORED = f"WITH {_BLEU}, scored AS (SELECT r.*, {_CER} AS cer, {strip('generated')} = {strip('expected')} AS exact, b.sentence_bleu, a.* EXCLUDE (index, l), contains(raw_generated, '<think>') AS had_think FROM {_ROWS} r JOIN bleu b USING (index) JOIN ({_ACCURACY}) a USING (index))"


@query("exact_match", X.EVALUATION, f"{_SCORED} SELECT index, exact FROM scored")
def _(e):
    return evaluation.score(e).select("index", "exact")


@query("cer", X.EVALUATION, f"SELECT index, round_even({_CER}, 6) AS cer FROM {_ROWS}")
def _(e):
    return evaluation.score(e).select("index", F.bround("cer", 6).alias("cer"))


@query("cer_summary", X.EVALUATION, f"{_SCORED} SELECT round_even(avg(cer), 4) AS mean, round_even(median(cer), 4) AS median, round_even(min(cer), 4) AS least, round_even(max(cer), 4) AS most FROM scored")
def _(e):
    return evaluation.summary(evaluation.score(e)).select(F.col("cer_mean").alias("mean"), F.col("cer_median").alias("median"), F.col("cer_min").alias("least"), F.col("cer_max").alias("most"))


@query("sentence_bleu", X.EVALUATION, f"WITH {_BLEU} SELECT index, round_even(sentence_bleu, 6) AS sentence_bleu FROM bleu")
def _(e):
    return evaluation.score(e).select("index", F.bround("sentence_bleu", 6).alias("sentence_bleu"))


@query(
    "corpus_bleu",
    X.EVALUATION,
    f"""WITH {_BLEU}, s AS (SELECT n, sum(m) AS m, sum(d) AS d, sum(hl) AS hl, sum(rl) AS rl FROM parts GROUP BY n)
    SELECT round_even(CASE WHEN min(m) = 0 THEN 0::DOUBLE ELSE (CASE WHEN max(hl) > max(rl) THEN 1::DOUBLE ELSE exp(1 - max(rl)::DOUBLE / max(hl)) END) * exp(sum(ln(m::DOUBLE / d)) / 4) END, 6) AS corpus_bleu FROM s""",
)
def _(e):
    return M.corpus_bleu(evaluation.score(e)).select(F.bround("corpus_bleu", 6).alias("corpus_bleu"))


@query("format_checks", X.EVALUATION, _CHECKS)
def _(e):
    return evaluation.score(e).select("index", *M.CHECKS)


@query("format_accuracy", X.EVALUATION, f"SELECT index, round_even(format_accuracy, 6) AS format_accuracy FROM ({_ACCURACY})")
def _(e):
    return evaluation.score(e).select("index", F.bround("format_accuracy", 6).alias("format_accuracy"))


@query(
    "check_rates",
    X.EVALUATION,
    "SELECT c AS \"check\", count(*) AS applicable, count(*) FILTER (WHERE ok) AS passed, round_even(avg(ok::INT), 4) AS rate FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS ok FROM ({_CHECKS})" for c in M.CHECKS) + ") WHERE ok IS NOT NULL GROUP BY 1",
)
def _(e):
    return evaluation.check_rates(evaluation.score(e))


@query(
    "eval_summary",
    X.EVALUATION,
    f"""{_SCORED} SELECT count(*) AS n, count(*) FILTER (WHERE exact) AS exact_count, round_even(avg(exact::INT), 4) AS exact_rate, round_even(avg(cer), 4) AS cer_mean, round_even(median(cer), 4) AS cer_median, round_even(min(cer), 4) AS cer_min, round_even(max(cer), 4) AS cer_max,
    round_even(avg(sentence_bleu), 4) AS sentence_bleu_mean, round_even(avg(format_accuracy), 4) AS format_accuracy_mean, count(format_accuracy) AS format_applicable, count(*) FILTER (WHERE had_think) AS think_count,
    {", ".join(f"count({c}) AS {c}_applicable, count(*) FILTER (WHERE {c}) AS {c}_passed" for c in M.CHECKS)} FROM scored""",
)
def _(e):
    return evaluation.summary(evaluation.score(e))


@query("best20", X.EVALUATION, f"{_SCORED} SELECT index, round_even(cer, 6) AS cer FROM scored ORDER BY scored.cer, exact DESC, sentence_bleu DESC, index LIMIT 20")
def _(e):
    return evaluation.best(evaluation.score(e)).select("index", F.bround("cer", 6).alias("cer"))


@query("worst20", X.EVALUATION, f"{_SCORED} SELECT index, round_even(cer, 6) AS cer FROM scored ORDER BY scored.cer DESC, exact, sentence_bleu, index DESC LIMIT 20")
def _(e):
    return evaluation.worst(evaluation.score(e)).select("index", F.bround("cer", 6).alias("cer"))


@query("latency_summary", X.EVALUATION, f"SELECT CAST(sum(generated_token_count) AS BIGINT) AS total_tokens, round_even(sum(generation_seconds), 2) AS total_seconds, round_even(sum(generated_token_count) / greatest(sum(generation_seconds), 1e-6), 2) AS tokens_per_second, round_even(avg(generation_seconds), 3) AS seconds_per_sample FROM {E}")
def _(e):
    return evaluation.latency(e)


@query("precision_compare", X.EVALUATION, f"SELECT index AS idx, expected = raw_generated AS identical, round_even(length(raw_generated)::DOUBLE / nullif(length(expected), 0), 6) AS length_ratio, coalesce(length(raw_generated)::DOUBLE / nullif(length(expected), 0) NOT BETWEEN 0.3 AND 3.0, false) AS length_off, trim(expected) <> '' AND trim(raw_generated) = '' AS emptied FROM {E}")
def _(e):
    found = evaluation.compare_precisions(e.select(F.col("index").alias("idx"), F.col("expected").alias("text")), e.select(F.col("index").alias("idx"), F.col("raw_generated").alias("text")))
    return found.select("idx", "identical", F.bround("length_ratio", 6).alias("length_ratio"), "length_off", "emptied")


# --- the judge gate

_SAMPLED = f"(SELECT * EXCLUDE (rn, n) FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5(concat('42|', category, '|', line_no)), category, line_no) AS rn, count(*) OVER (PARTITION BY category) AS n FROM {V}) WHERE rn <= ceil(n * 0.5::DOUBLE))"
_ALL = " AND ".join(f"coalesce({c}, false)" for c in L.CRITERIA)
_RATES = f"SELECT category, count(*) AS sampled, count(*) FILTER (WHERE NOT parse_error) AS judged, count(*) FILTER (WHERE parse_error) AS parse_errors, {', '.join(f'round_even(avg(coalesce({c}, false)::INT), 4) AS {c}_rate' for c in L.CRITERIA)}, round_even(avg(({_ALL})::INT), 4) AS pass_rate FROM {_SAMPLED} GROUP BY 1"
_DECIDED = f"SELECT *, CASE WHEN pass_rate >= 0.30 THEN 'pass' WHEN pass_rate >= 0.20 THEN 'warn' ELSE 'reject' END AS decision FROM ({_RATES})"
_CRITICAL = f"SELECT category, line_no FROM {_SAMPLED} WHERE NOT parse_error AND NOT (content_preserved AND no_hallucination)"


def _sampled(v):
    return judge.judge_sample(v, 0.5)


def _decided(v):
    return judge.decide(judge.criterion_rates(_sampled(v)), 0.30, 0.20)


@query("criterion_rates", X.VERDICTS, _RATES)
def _(v):
    return judge.criterion_rates(_sampled(v))


@query("gate_decisions", X.VERDICTS, f"SELECT category, pass_rate, decision FROM ({_DECIDED})")
def _(v):
    return _decided(v).select("category", "pass_rate", "decision")


@query("decision_counts", X.VERDICTS, "SELECT " + ", ".join(f"count(*) FILTER (WHERE decision = '{k}') AS {k}" for k in ("pass", "warn", "reject", "skip")) + f", count(*) AS total FROM ({_DECIDED})")
def _(v):
    return judge.decision_counts(_decided(v))


@query("critical_lines", X.VERDICTS, _CRITICAL)
def _(v):
    return judge.critical_lines(_sampled(v))


@query("pruned_pairs", X.VERDICTS, f"SELECT category, line_no FROM {V} x WHERE (category, line_no) NOT IN ({_CRITICAL}) AND category NOT IN (SELECT category FROM ({_DECIDED}) WHERE decision = 'reject')")
def _(v):
    return judge.prune(v, judge.critical_lines(_sampled(v)), _decided(v)).select("category", "line_no")


@query(
    "failure_examples_top5",
    X.VERDICTS,
    "SELECT category, criterion, line_no FROM (SELECT *, row_number() OVER (PARTITION BY category, criterion ORDER BY line_no) AS rn FROM (" + " UNION ALL ".join(f"SELECT category, line_no, '{c}' AS criterion FROM {_SAMPLED} WHERE NOT parse_error AND NOT {c}" for c in L.CRITERIA) + ")) WHERE rn <= 5",
)
def _(v):
    return judge.failure_examples(_sampled(v)).select("category", "criterion", "line_no")


@query(
    "suggestions",
    X.VERDICTS,
    "SELECT category, criterion, rate, suggestion FROM ("
    + " UNION ALL ".join(f"SELECT category, '{c}' AS criterion, {c}_rate AS rate, '{L.SUGGESTIONS[c].replace(chr(39), chr(39) * 2)}' AS suggestion FROM ({_RATES})" for c in L.CRITERIA)
    + ") WHERE rate < 0.9",
)
def _(v):
    return judge.suggestions(judge.criterion_rates(_sampled(v)), v.sparkSession).select("category", "criterion", "rate", "suggestion")


@query(
    "batch_summary",
    X.VERDICTS,
    f"""WITH c AS ({" UNION ALL ".join(f"SELECT {i} AS ord, '{c}' AS c, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS n FROM {V}" for i, c in enumerate(L.CRITERIA))})
    SELECT count(*) AS total, count(*) FILTER (WHERE {_ALL}) AS passed, count(*) FILTER (WHERE NOT ({_ALL})) AS failed, (SELECT c FROM c ORDER BY n DESC, ord LIMIT 1) AS most_common_failure FROM {V}""",
)
def _(v):
    return judge.batch_summary(v)


# --- training logs, steps

_PARSED = f"SELECT ord, CAST(regexp_extract(line, 'Iter\\s+(\\d+)', 1) AS INT) AS iter, {', '.join(f'''TRY_CAST(nullif(regexp_extract(line, '{p}', 1), '') AS DOUBLE) AS {n}''' for n, p in (('train_loss', 'Train loss\\s+([\\d.]+)'), ('val_loss', 'Val loss\\s+([\\d.]+)'), ('learning_rate', 'Learning Rate\\s+([\\d.eE+-]+)'), ('it_per_sec', 'It/sec\\s+([\\d.]+)'), ('tokens_per_sec', 'Tokens/sec\\s+([\\d.]+)')))} FROM {LOG} WHERE regexp_matches(line, 'Iter\\s+\\d+')"


@query("train_log_parse", X.LOG, _PARSED)
def _(log):
    return training.parse_log(log)


@query("best_iteration", X.LOG, f"SELECT (SELECT iter FROM ({_PARSED}) WHERE val_loss IS NOT NULL ORDER BY val_loss, iter LIMIT 1) AS best_iter, (SELECT min(val_loss) FROM ({_PARSED})) AS best_val_loss, (SELECT train_loss FROM ({_PARSED}) WHERE train_loss IS NOT NULL ORDER BY iter DESC LIMIT 1) AS last_train_loss")
def _(log):
    return training.best_iteration(training.parse_log(log))


_STEPS = "(VALUES " + ", ".join(f"('{s}', {i}, {d or '[]::VARCHAR[]'})" for i, (s, _, d, _, _) in enumerate(control.STEPS)) + ") s(step_id, ord, deps)"


@query("dag_missing_deps", None, f"SELECT step_id, dep FROM (SELECT step_id, unnest(deps) AS dep FROM {_STEPS} WHERE step_id IN ('4', '6', '8')) WHERE dep NOT IN ('4', '6', '8', '2')")
def _(spark, d):
    wanted = control.requested(control.steps(spark), ["4", "6", "8"])
    return control.missing_dependencies(wanted, spark.createDataFrame([("2",)], "step_id string"))


@query("dag_resume", None, f"SELECT step_id, CAST(ord AS INT) AS ord FROM {_STEPS} WHERE step_id <> '10' AND step_id NOT IN ('2', '3', '5')")
def _(spark, d):
    state = spark.createDataFrame([("2", "completed"), ("3", "completed"), ("4", "failed")], "step_id string, status string")
    done = control.done_steps(state, spark.createDataFrame([("5",)], "step_id string"))
    return control.to_run(control.requested(control.steps(spark), None), done).select("step_id", "ord")


# --- JSON: answers are made from ids, so what must be read from them is known

_ANSWERS = """
SELECT doc_id, CASE doc_id % 6
  WHEN 0 THEN concat('[{{"transcript": "t', CAST(doc_id AS STRING), '", "output": "o"}}]')
  WHEN 1 THEN concat('```json', chr(10), '[{{"transcript": "t', CAST(doc_id AS STRING), '", "output": "o"}}]', chr(10), '```')
  WHEN 2 THEN concat('Here: [{{"transcript": "t', CAST(doc_id AS STRING), '", "output": "o"}}] done')
  WHEN 3 THEN '{{"transcript": "x"}}'
  WHEN 4 THEN '[{{"transcript": 5, "output": "o"}}]'
  ELSE 'nothing' END AS raw FROM {documents}
"""
_VERDICT_TEXT = """
SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN concat('{{"input_realistic": true, "content_preserved": ', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE '"False"' END, ', "no_hallucination": true, "corrections_applied": false}}')
  WHEN 1 THEN concat('<think>{{"a": 1}}</think>', chr(10), '```json', chr(10), '{{"input_realistic": true, "content_preserved": true, "no_hallucination": true, "corrections_applied": true}}', chr(10), '```')
  WHEN 2 THEN 'I say {{"input_realistic": true, "content_preserved": true, "no_hallucination": false, "corrections_applied": true}} so.'
  WHEN 3 THEN '{{"input_realistic": true}}'
  ELSE 'no verdict' END AS raw FROM {documents}
"""


@query("llm_json_parse", _ANSWERS, "SELECT doc_id, CASE WHEN doc_id % 6 < 3 THEN concat('t', doc_id) END AS transcript, 'o' AS output FROM documents WHERE doc_id % 6 IN (0, 1, 2, 4)")
def _(a):
    return a.select("doc_id", F.explode(J.array_pairs(F.col("raw"))).alias("p")).select("doc_id", "p.transcript", "p.output")


@query(
    "judge_json_parse",
    _VERDICT_TEXT,
    "SELECT doc_id, doc_id % 5 > 2 AS parse_error, CASE WHEN doc_id % 5 <= 2 THEN true END AS input_realistic, CASE doc_id % 5 WHEN 0 THEN doc_id % 2 = 0 WHEN 1 THEN true WHEN 2 THEN true END AS content_preserved, CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS no_hallucination, CASE doc_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true END AS corrections_applied FROM documents",
)
def _(a):
    return J.parse_verdicts(a).select("doc_id", "parse_error", *[F.col("verdict")[c].alias(c) for c in L.CRITERIA])


@query("jsonl_round_trip", X.PAIRS, f"SELECT line_no, md5(input) AS input, md5(output) AS output FROM {P}")
def _(p):
    lines = p.select("line_no", J.to_json_line(F.col("input"), F.col("output")).alias("value"))
    back = lines.select("line_no", J.strict_strings(F.col("value"), ["input", "output"]).alias("p"))
    return back.select("line_no", F.md5(F.col("p.input").cast("binary")).alias("input"), F.md5(F.col("p.output").cast("binary")).alias("output"))


# --- streaming

@query("stream_dedup_available_now", None, f"SELECT count(DISTINCT {key('text')}) AS n_distinct, CAST(sum(length({key('text')})) FILTER (WHERE rn = 1) AS BIGINT) AS chars FROM (SELECT text, row_number() OVER (PARTITION BY {key('text')} ORDER BY doc_id) AS rn FROM documents)")
def _(spark, d):
    import uuid

    from skein.sources.shared import shared_dir
    from skein.streaming.ingest import distinct_stream, run_available

    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    found = spark.readStream.schema(schema).parquet(f"{d}/documents*.parquet")
    work = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run_available(distinct_stream(found.select(F.col("text").alias("input"))), f"{work}/out", f"{work}/checkpoint")
    return spark.read.schema("input string, dedup_key string").parquet(f"{work}/out").agg(F.count("*").alias("n_distinct"), F.sum(F.length(T.dedup_key(F.col("input")))).alias("chars"))


from skein.plans import io_queries  # noqa: E402, F401  registers more queries
