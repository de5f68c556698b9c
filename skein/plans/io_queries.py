"""Queries over sources, sinks, control tables, model calls and streams: what is written is read back."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.functions import lexicons as L
from skein.functions import metrics as M
from skein.functions import text as T
from skein.operators import compare, dedup, evaluation, judge, quality, stats, synth, training
from skein.plans import control, gate, generate, reports
from skein.plans import evaluate as evaluate_plan
from skein.plans import fixtures as X
from skein.plans.queries import _CRITICAL, _DECIDED, _PARSED, _PROFILE, _RATES, _REASONED, _SAMPLED, _SCORED, _VERDICTS, E, P, V, _decided, _sampled, _sided, _verdicts, oracle_sql, query, strip, tokens
from skein.sources import readers, writers
from skein.sources.shared import shared_dir, stored


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/queries-{uuid.uuid4().hex}"


def md5(c: str):
    return F.md5(F.col(c).cast("binary")).alias(c)


# --- sources


@query("raw_pairs_read", X.PAIRS, f"SELECT md5(input) AS input, md5(output) AS output, 'raw/all' AS source FROM {P}")
def _(p):
    """Pairs among lines that are none: an array, broken JSON, a blank line, a number for a text."""
    spark, path = p.sparkSession, folder(p.sparkSession)
    noise = spark.createDataFrame([("[1]",), ("{bad",), ("",), ('{"input":5,"output":"x"}',)], "value string")
    lines = p.select(J.to_json_line(F.col("input"), F.col("output")).alias("value")).unionByName(noise)
    lines.write.text(f"{path}/all.jsonl")
    return readers.raw_pairs(spark, path).select(md5("input"), md5("output"), F.lit("raw/all").alias("source"))


@query("synthetic_pairs_read", X.PAIRS, f"SELECT lang AS category, md5(input) AS input, md5(output) AS output, concat('synthetic/', lang) AS source FROM {P} WHERE lang IN ('en', 'fr')")
def _(p):
    """One file a category, written by ``write_jsonl_file``; one of them is rejected, one is not configured."""
    spark, path = p.sparkSession, folder(p.sparkSession)
    for lang in ("en", "es", "fr", "de"):
        writers.write_jsonl_file(p.where(F.col("lang") == lang), f"{path}/synthetic_{lang}.jsonl", ["input", "output"])
    rejected = spark.createDataFrame([("synthetic_es.jsonl",)], "file string")
    return readers.synthetic_pairs(spark, path, rejected, ["en", "fr", "es"]).select("category", md5("input"), md5("output"), "source")


@query("prepared_pairs_read", X.PAIRS, f"SELECT 'prepared/all' AS source, CAST(row_number() OVER (ORDER BY line_no) AS BIGINT) AS line_no, md5(input) AS input FROM {P}")
def _(p):
    """Numbers of physical lines."""
    path = folder(p.sparkSession)
    writers.write_jsonl_file(p.orderBy("line_no"), f"{path}/all.jsonl", ["input", "output"])
    return readers.prepared_pairs(p.sparkSession, path).select("source", "line_no", md5("input"))


@query("paired_text_files", X.PAIRS, f"SELECT lang AS key, concat(count(*), ' ', min(line_no)) AS clean, concat(count(*), ' ', max(line_no)) AS messy FROM {P} WHERE lang <> 'en' GROUP BY lang")
def _(p):
    """Text files of two folders, paired by their paths; the key of one side is not on the other."""
    spark, path = p.sparkSession, folder(p.sparkSession)
    each = p.groupBy("lang").agg(F.concat_ws(" ", F.count("*"), F.min("line_no")).alias("clean"), F.concat_ws(" ", F.count("*"), F.max("line_no")).alias("messy"))
    sides = {"manual-cleanups": each.where("lang <> 'en'").select("lang", F.col("clean").alias("value")), "whisper-transcripts": each.select("lang", F.col("messy").alias("value"))}
    for name, rows in sides.items():
        rows.coalesce(1).write.partitionBy("lang").text(f"{path}/dataset/data/{name}")
    root = readers.source_root(spark, path)
    read = lambda name, c: readers.text_files(spark, f"{root}/{name}").select(F.regexp_extract("key", r"lang=(\w+)/", 1).alias("key"), F.col("text").alias(c))
    return read("manual-cleanups", "clean").join(read("whisper-transcripts", "messy"), "key")


@query("chat_pairs_read", X.PAIRS, f"SELECT md5(input) AS input, md5(output) AS expected FROM {P} WHERE trim(input) <> '' AND trim(output) <> ''")
def _(p):
    path = folder(p.sparkSession)
    writers.write_jsonl(p.select(T.chat_messages("s", F.col("input"), F.col("output")).alias("messages")), path)
    return readers.chat_pairs(p.sparkSession, path).select(md5("input"), md5("expected"))


def _line():
    """The pair as a line, or one of four lines that are none."""
    whole, number = J.to_json_line(F.col("input"), F.col("output")), J.to_json_line(F.lit(1).alias("input"), F.col("output"))
    kind = F.col("line_no") % 5
    return F.when(kind == 0, whole).when(kind == 1, number).when(kind == 2, F.lit("  ")).when(kind == 3, F.concat(F.lit("["), whole, F.lit("]"))).otherwise(J.to_json_line(F.col("input")))


@query("record_counts", X.PAIRS, f"SELECT category AS file, count(*) AS lines, count(*) FILTER (WHERE line_no % 5 <> 2) AS non_blank, count(*) FILTER (WHERE line_no % 5 < 2) AS with_keys, count(*) FILTER (WHERE line_no % 5 = 0) AS strict FROM {P} GROUP BY 1")
def _(p):
    return readers.record_counts(p.select(F.col("category").alias("file"), _line().alias("value")))


@query("given_pairs", X.PAIRS, f"SELECT CAST(line_no - 1 AS INT) AS pair_index, md5(input) AS input, md5(output) AS output FROM {P} WHERE line_no % 5 = 0")
def _(p):
    return readers.given_pairs(p.select("line_no", _line().alias("value"))).select("pair_index", md5("input"), md5("output"))


@query("split_problems", X.PAIRS, "SELECT * FROM (VALUES ('valid', 'no chat record'), ('test', 'missing')) v(split, problem)")
def _(p):
    chat = T.chat_messages("s", F.col("input"), F.col("output"))
    rows = p.select(F.lit("train").alias("split"), "line_no", J.to_json_line(chat.alias("messages")).alias("value")).unionByName(p.select(F.lit("valid").alias("split"), "line_no", F.col("input").alias("value")))
    return readers.split_problems(rows, ("train", "valid", "test"))


@query("tabular_pairs", X.PAIRS, f"SELECT md5(i) AS input, md5(o) AS output FROM (SELECT {strip('input')} AS i, {strip('output')} AS o FROM {P}) WHERE i <> '' AND o <> ''")
def _(p):
    return readers.tabular_pairs([p.where("lang = 'en'"), p.where("lang <> 'en'")], "input", "output").select(md5("input"), md5("output"))


@query("first_prompts", X.PAIRS, f"SELECT prompt FROM ((SELECT md5(input) AS prompt FROM {P} WHERE output = '' ORDER BY line_no LIMIT 3) UNION ALL (SELECT concat('fallback ', i) FROM range(2) r(i)))")
def _(p):
    few = p.where("output = ''").orderBy("line_no").limit(3).select(F.md5(F.col("input").cast("binary")).alias("prompt"), F.col("line_no").alias("ord"))
    fallback = p.sparkSession.createDataFrame([(f"fallback {i}", i) for i in range(5)], "prompt string, ord long")
    return readers.first_prompts(few, fallback, 5)


@query("compared_sides", X.PAIRS, f"SELECT CASE WHEN lang = 'en' THEN 'script' ELSE 'prompt' END AS dataset, count(*) AS n FROM {P} GROUP BY 1")
def _(p):
    return readers.sides(p.where("lang = 'en'"), p.where("lang <> 'en'")).groupBy("dataset").agg(F.count("*").alias("n"))


# --- sinks


@query("appended_pairs", X.PAIRS, f"SELECT category, 2 * count(*) AS n, md5(min(input)) AS least FROM {P} GROUP BY 1")
def _(p):
    """Two runs append; a later one counts what is there."""
    path = folder(p.sparkSession)
    for _run in range(2):
        writers.append_pairs(p.select("category", "input", "output"), path)
    back = p.sparkSession.read.schema("input string, output string, category string").json(path)
    return back.groupBy("category").agg(F.count("*").alias("n"), F.md5(F.min("input").cast("binary")).alias("least"))


@query("combined_lines", X.PAIRS, f"SELECT md5(input) AS input, md5(output) AS output, CAST(row_number() OVER (ORDER BY list_position(['fr', 'es', 'en', 'de'], lang), line_no) - 1 AS BIGINT) AS place FROM {P} WHERE output <> ''")
def _(p):
    """All pairs as ordered files in the order of their categories, blank lines dropped, read back with their places."""
    path = folder(p.sparkSession)
    line = J.to_json_line(F.col("input"), F.col("output"))
    lines = p.select(F.col("lang").alias("category"), "line_no", F.when(F.col("output") != "", line).otherwise("  ").alias("value"))
    writers.write_ordered(writers.combined(lines, ["fr", "es", "en", "de"]), path)
    back = writers.read_ordered(p.sparkSession, path).withColumn("p", J.strict_strings(F.col("value"), ["input", "output"])).select("place", "p.*")
    return back.select("place", md5("input"), md5("output"))


@query("rewritten_lines", X.VERDICTS, f"SELECT category, line_no FROM {V} WHERE (category, line_no) NOT IN ({_CRITICAL})")
def _(v):
    spark = v.sparkSession
    lines = v.select("category", "line_no", F.lit("x").alias("value"))
    to = writers.rewrite_without(lines, judge.critical_lines(_sampled(v)), folder(spark), 1)
    return spark.read.schema("line_no long, value string, category string").json(to).select("category", "line_no")


@query("quarantined", X.VERDICTS, f"SELECT category, count(*) AS n FROM {V} WHERE category IN (SELECT category FROM ({_DECIDED}) WHERE decision = 'reject') GROUP BY 1")
def _(v):
    spark = v.sparkSession
    to = writers.quarantine(v.select("category", "line_no"), _decided(v), folder(spark), 1)
    return spark.read.schema("line_no long, category string").json(to).groupBy("category").agg(F.count("*").alias("n"))


@query("next_version", X.PAIRS, f"SELECT CAST(max(line_no) + 1 AS BIGINT) AS version FROM {P}")
def _(p):
    names = p.select(F.concat(F.lit("rejected_"), F.col("line_no").cast("string")).alias("name")).unionByName(p.sparkSession.createDataFrame([("rejected_x",), ("v99999999",)], "name string"))
    return p.sparkSession.createDataFrame([(writers.next_version(names, "rejected_"),)], "version long")


@query("report_json", X.VERDICTS, f"SELECT category, decision, CAST(sampled AS BIGINT) AS sampled FROM ({_DECIDED})")
def _(v):
    lines = writers.report_json(_decided(v))
    return lines.select(F.from_json("value", "category string, decision string, sampled long").alias("r")).select("r.*")


@query("fixed_width", X.PAIRS, f"SELECT rpad(category, 12, ' ') || '  ' || lpad(CAST(count(*) AS VARCHAR), 8, ' ') AS line FROM {P} GROUP BY category")
def _(p):
    return writers.fixed_width(stats.counts_by(p, "category"), {"category": 12, "n": 8})


@query("check_lines", X.EVALUATION, f"{_SCORED}, c AS (SELECT " + ", ".join(f"count({c}) AS n{i}, count(*) FILTER (WHERE {c}) AS p{i}" for i, c in enumerate(M.CHECKS)) + " FROM scored) SELECT line FROM (" + " UNION ALL ".join(f"SELECT n{i} AS n, printf('{' '.join(w.capitalize() for w in c.removesuffix('_ok').split('_'))}: %d/%d (%.1f%%)', p{i}, n{i}, round_even(p{i}::DOUBLE / n{i}, 4) * 100) AS line FROM c" for i, c in enumerate(M.CHECKS)) + ") WHERE n > 0")
def _(e):
    return evaluate_plan.check_lines(evaluation.check_rates(evaluation.score(e)))


@query("acceptance", X.EVALUATION, f"{_SCORED} SELECT round_even(avg(cer), 4) < 0.10::DOUBLE AS cer_ok, coalesce(count(*) FILTER (WHERE filler_removal_ok)::DOUBLE / nullif(count(filler_removal_ok), 0) > 0.95::DOUBLE, false) AS fillers_ok FROM scored")
def _(e):
    return evaluate_plan.acceptance(evaluation.summary(evaluation.score(e)))


@query("stats_lines", X.PAIRS, f"SELECT printf('all: %d samples, avg input: %.0f chars, avg output: %.0f chars', count(*), round_even(avg(length(input)), 0), round_even(avg(length(output)), 0)) AS line FROM {P} UNION ALL SELECT printf('  %s: %d', category, count(*)) FROM {P} GROUP BY category")
def _(p):
    return reports.stats_lines(p.withColumn("source", F.col("category")), "all").select("line")


@query("sample_blocks", X.EVALUATION, f"{_SCORED} SELECT CAST(row_number() OVER (ORDER BY cer DESC, exact, sentence_bleu, index DESC) AS INT) AS rank, left(input, 200) AS input, printf('%.4f', cer) AS cer FROM scored ORDER BY rank LIMIT 5")
def _(e):
    worst = [F.desc("cer"), F.asc("exact"), F.asc("sentence_bleu"), F.desc("index")]
    blocks = reports.sample_blocks(evaluation.score(e), worst, 5)
    return blocks.select("rank", F.regexp_extract("line", r"(?s)INPUT:     (.*?)\nEXPECTED", 1).alias("input"), F.regexp_extract("line", r"CER: ([\d.]+)", 1).alias("cer"))


@query("comparison_lines", X.PAIRS, f"SELECT printf('%s: avg input words %.1f, avg filler density %.1f%%, %d samples', dataset, round_even(avg(avg_input_words), 1), round_even(avg(avg_filler_density), 1), CAST(sum(count) AS BIGINT)) AS line FROM ({_PROFILE}) GROUP BY dataset UNION ALL SELECT printf('%s: %d', verdict, count(*)) FROM ({_VERDICTS}) GROUP BY verdict")
def _(p):
    """The last two parts of the report: the tally of verdicts, and each side's means."""
    profiles = stats.profile(_sided(p), ["category", "dataset"])
    winners = compare.metric_winners(profiles, "dataset", "script", "prompt", ["count", "avg_compression"])
    return reports.comparison_lines(winners, _verdicts(p), profiles).where("part >= 2").select("line")


@query("training_summary", X.LOG, f"SELECT 'completed' AS status, 'm' AS model, CAST(9 AS BIGINT) AS train_samples, CAST(1 AS BIGINT) AS valid_samples, arg_min(val_loss, iter) FILTER (WHERE val_loss IS NOT NULL) AS initial_eval_loss, arg_max(train_loss, iter) FILTER (WHERE train_loss IS NOT NULL) AS final_train_loss, arg_max(val_loss, iter) FILTER (WHERE val_loss IS NOT NULL) AS final_eval_loss, min(val_loss) AS best_eval_loss, max(iter) AS total_steps FROM ({_PARSED})")
def _(log):
    return reports.training_summary(training.parse_log(log), "m", 9, 1)


# --- text columns


@query("truncated", X.PAIRS, f"SELECT line_no, CASE WHEN length(input) <= 120 THEN input ELSE left(input, 120) || '...' END AS input FROM {P}")
def _(p):
    return p.select("line_no", T.truncate(F.col("input")).alias("input"))


@query("filled_prompt", X.PAIRS, f"SELECT line_no, concat('Rewrite ', len(w), ' of ', category, ':', chr(10), array_to_string(list_transform(list_slice(w, 1, 5), lambda x, i: concat(i, '. ', x)), chr(10))) AS prompt FROM (SELECT *, {tokens('input')} AS w FROM {P})")
def _(p):
    ws = T.words(F.col("input"))
    return p.select("line_no", T.fill("Rewrite {n} of {category}:\n{texts}", n=F.size(ws).cast("string"), category=F.col("category"), texts=T.numbered_list(F.slice(ws, 1, 5))).alias("prompt"))


@query("file_stems", X.PAIRS, f"SELECT DISTINCT concat('synthetic_', category, '.v1') AS stem, upper(left(lang, 1)) || lower(substr(lang, 2)) || ' Rate' AS label FROM {P}")
def _(p):
    stem = readers.file_stem(F.concat(F.lit("a.b/c/synthetic_"), "category", F.lit(".v1.jsonl")))
    return p.select(stem.alias("stem"), T.pretty_label(F.concat("lang", F.lit("_rate_ok"))).alias("label")).distinct()


@query("durations", X.EVALUATION, f"SELECT index, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %ds', CAST(floor(s / 60) AS BIGINT), CAST(round_even(s - 60 * floor(s / 60), 0) AS BIGINT)) ELSE printf('%dh %dm %ds', CAST(floor(s / 3600) AS BIGINT), CAST(floor(s / 60) AS BIGINT) % 60, CAST(round_even(s - 60 * floor(s / 60), 0) AS BIGINT)) END AS took FROM (SELECT index, generation_seconds * (index % 4000) AS s FROM {E})")
def _(e):
    return e.select("index", T.duration(F.col("generation_seconds") * (F.col("index") % 4000)).alias("took"))


@query("null_bytes", X.PAIRS, f"SELECT line_no, line_no % 7 = 0 AS input, line_no % 5 = 0 AS output FROM {P} WHERE line_no % 7 = 0 OR line_no % 5 = 0")
def _(p):
    marked = p.select("line_no", *[F.when(F.col("line_no") % k == 0, F.concat(c, F.lit("\x00"))).otherwise(F.col(c)).alias(c) for c, k in (("input", 7), ("output", 5))])
    found = quality.validate(marked).select("line_no", F.array_contains("reasons", "input_null_byte").alias("input"), F.array_contains("reasons", "output_null_byte").alias("output"))
    return found.where("input or output")


@query("complete_pairs", X.PAIRS, f"SELECT line_no FROM {P} WHERE {strip('input')} <> '' AND {strip('output')} <> ''")
def _(p):
    return quality.complete_pairs(p).select("line_no")


@query("rejection_log", X.PAIRS, f"SELECT line_no, array_to_string(reasons, ',') AS reasons FROM ({_REASONED}) WHERE len(reasons) > 0 ORDER BY line_no LIMIT 20")
def _(p):
    return quality.rejection_log(quality.validate(p), ["line_no"], 20).select("line_no", F.array_join("reasons", ",").alias("reasons"))


# --- order and limits


@query("sample_at_most", X.PAIRS, f"SELECT line_no FROM {P} ORDER BY md5(concat('42|', line_no)), line_no LIMIT 50")
def _(p):
    return dedup.sample_at_most(p, 50, ["line_no"]).select("line_no")


@query("still_needed", X.PAIRS, f"SELECT category, line_no FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY line_no) AS rn FROM {P}) JOIN (VALUES ('src1', 3), ('src2', 0), ('src3', 1000000)) r(category, remaining) USING (category) WHERE rn <= remaining")
def _(p):
    plan = p.sparkSession.createDataFrame([("src1", 3), ("src2", 0), ("src3", 1000000)], "category string, remaining long")
    return dedup.still_needed(p, plan, ["line_no"]).select("category", "line_no")


@query("rates_ascending", X.VERDICTS, "SELECT category, string_agg(criterion || '=' || printf('%.4f', rate), ',' ORDER BY rate, ord) AS criteria FROM (" + " UNION ALL ".join(f"SELECT category, {i} AS ord, '{c}' AS criterion, {c}_rate AS rate FROM ({_RATES})" for i, c in enumerate(L.CRITERIA)) + ") GROUP BY 1")
def _(v):
    found = judge.rates_ascending(judge.criterion_rates(_sampled(v)))
    return found.select("category", F.array_join(F.transform("criteria", lambda c: F.format_string("%s=%.4f", c["criterion"], c["rate"])), ",").alias("criteria"))


@query(
    "gate_report",
    X.VERDICTS,
    f"""WITH failed AS (SELECT category, criterion, line_no, row_number() OVER (PARTITION BY category, criterion ORDER BY line_no) AS rn FROM ({" UNION ALL ".join(f"SELECT category, line_no, '{c}' AS criterion FROM {_SAMPLED} WHERE NOT parse_error AND NOT {c}" for c in L.CRITERIA)})),
    lists AS (SELECT category, criterion, criterion || ':' || string_agg(CAST(line_no AS VARCHAR), ' ' ORDER BY line_no) AS item FROM failed WHERE rn <= 5 GROUP BY category, criterion),
    examples AS (SELECT category, string_agg(item, ';' ORDER BY criterion) AS failures FROM lists GROUP BY 1),
    critical AS (SELECT category, count(*) AS n FROM ({_CRITICAL}) GROUP BY 1)
    SELECT category, decision, failures, coalesce(n, 0) AS n_critical FROM ({_DECIDED}) LEFT JOIN examples USING (category) LEFT JOIN critical USING (category)""",
)
def _(v):
    found = gate.report(_sampled(v), v, 0.30, 0.20)
    items = F.transform(F.map_entries("failures"), lambda e: F.concat_ws(":", e["key"], F.array_join(F.transform(e["value"], lambda x: x.cast("string")), " ")))
    return found.select("category", "decision", F.array_join(items, ";").alias("failures"), "n_critical")


# --- metrics, figures, corpora


@query("generation_sanity", X.EVALUATION, f"SELECT index, CASE WHEN trim(raw_generated) = '' THEN 'empty' WHEN index % 10 = 0 THEN 'chat_markers' ELSE '' END AS problems FROM {E}")
def _(e):
    shown = e.select("index", F.when(F.col("index") % 10 == 0, F.concat("raw_generated", F.lit("<|im_end|>"))).otherwise(F.col("raw_generated")).alias("generated"))
    return evaluation.sanity(shown).select("index", F.array_join("problems", ",").alias("problems"))


def _word_rate(g: str, e: str, view: str) -> str:
    """index, rate: words that are alike at both ends cut off, the others as numbers in a fold over rows of distances."""
    alike = "coalesce(list_position(list_transform(range(1, least(len(g), len(e)) + 1), lambda i: g[i] <> e[i]), true) - 1, least(len(g), len(e)))"
    rest = f"list_reverse(list_slice(g, {alike} + 1, len(g))) AS g, list_reverse(list_slice(e, {alike} + 1, len(e))) AS e"
    number = lambda ws: f"list_transform({ws}, lambda w: list_position(c, w))::BIGINT[]"
    rows = "list_prepend(range(0, len(b) + 1)::BIGINT[], list_transform(a, lambda x, i: [x, i]::BIGINT[]))"
    above = "list_transform(b, lambda y, j: [least(p[j + 1] + 1, p[j] + (y <> t[1])::INT)]::BIGINT[])"
    row = f"list_reduce(list_prepend([t[2]]::BIGINT[], {above}), lambda done, z: list_append(done, least(list_last(done) + 1, z[1])))"
    return f"""SELECT index, CASE WHEN n = 0 THEN (m > 0)::INT::DOUBLE ELSE list_last(list_reduce({rows}, lambda p, t: {row}))::DOUBLE / n END AS rate FROM
    (SELECT index, n, m, {number('g')} AS a, {number('e')} AS b FROM (SELECT *, list_distinct(list_concat(g, e)) AS c FROM
    (SELECT index, n, m, {rest} FROM (SELECT index, len(e) AS n, len(g) AS m, {rest} FROM (SELECT index, {tokens(g)} AS g, {tokens(e)} AS e FROM {view})))))"""


@query("wer", X.EVALUATION, f"SELECT index, round_even(rate, 6) AS wer FROM ({_word_rate('raw_generated', 'expected', E)})")
def _(e):
    return e.select("index", F.bround(M.wer(F.col("raw_generated"), F.col("expected")), 6).alias("wer"))


_DRAWN = " + ".join(f"CAST(u >= {p!r}::DOUBLE AS INT)" for p in evaluation.POISSON)


@query(
    "ab_compare",
    X.EVALUATION,
    f"""WITH p AS MATERIALIZED (SELECT index, a.rate AS a, b.rate AS b FROM ({_word_rate('raw_generated', 'expected', E)}) a JOIN ({_word_rate('input', 'expected', E)}) b USING (index)),
    u AS (SELECT r, a - b AS d, CAST('0x' || left(md5(concat('42|', r, '|', index)), 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM p, range(200) t(r)),
    s AS (SELECT list_sort(list(m)) AS m FROM (SELECT sum(w * d) / sum(w) AS m FROM (SELECT r, d, {_DRAWN} AS w FROM u) GROUP BY r HAVING sum(w) > 0))
    SELECT n, round_even(wer_a, 6) AS wer_a, round_even(wer_b, 6) AS wer_b, round_even(difference, 6) AS difference, round_even(m[5], 6) AS low, round_even(m[196], 6) AS high, a_better, b_better, ties
    FROM s, (SELECT count(*) AS n, avg(a) AS wer_a, avg(b) AS wer_b, avg(a - b) AS difference, count(*) FILTER (WHERE a < b) AS a_better, count(*) FILTER (WHERE a > b) AS b_better, count(*) FILTER (WHERE a = b) AS ties FROM p)""",
)
def _(e):
    """What the model makes of a text against the text as it was."""
    return evaluation.ab_compare(e.select("index", "expected", F.col("raw_generated").alias("a"), F.col("input").alias("b")))


@query("metadata_report", X.PAIRS, f"SELECT CAST(count(*) AS BIGINT) AS pairs, CAST(min(line_no) AS BIGINT) AS first FROM {P}")
def _(p):
    """A report read back if it is there; one that is not there, and one that is broken, are none."""
    spark, path = p.sparkSession, folder(p.sparkSession)
    writers.write_jsonl_file(p.agg(F.count("*").alias("pairs"), F.min("line_no").alias("first")), f"{path}/report.json")
    spark.createDataFrame([("{broken",)], "value string").write.text(f"{path}/broken.json")
    if readers.optional_json(spark, f"{path}/none.json") is not None or readers.optional_json(spark, f"{path}/broken.json") is not None:
        raise ValueError("a report that cannot be read was read")
    return readers.optional_json(spark, f"{path}/report.json").select("pairs", "first")


@query("listing_megabytes", X.PAIRS, f"SELECT sum(strlen(replace(input, chr(10), ' ')) + 1) / 1048576::DOUBLE AS mb FROM {P}")
def _(p):
    """Sizes of the files of a folder, by a listing alone."""
    path = folder(p.sparkSession)
    p.select(F.translate("input", "\n", " ").alias("value")).write.text(path)
    return stats.directory_size(readers.listing(p.sparkSession, f"{path}/*").withColumnRenamed("size", "length"))


@query("verdict_tally", X.PAIRS, f"SELECT verdict, count(*) AS n FROM ({_VERDICTS}) GROUP BY 1")
def _(p):
    return compare.verdict_counts(_verdicts(p))


@query("eligible_categories", X.PAIRS, "SELECT category, CASE WHEN category IN (" + ", ".join(f"'{c}'" for c in L.CORE_CATEGORIES) + f") THEN 'core' ELSE 'domain_specific' END AS type, count(*) AS n FROM (SELECT ({list(L.CATEGORY_WEIGHTS)!r})[1 + line_no % 12] AS category FROM {P}) WHERE category IN (" + ", ".join(f"'{c}'" for c in L.CLEAN_TO_MESSY) + ") GROUP BY 1")
def _(p):
    names = F.array(*[F.lit(c) for c in L.CATEGORY_WEIGHTS])
    rows = p.select(F.get(names, (F.col("line_no") % 12).cast("int")).alias("category"))
    return synth.category_types(synth.eligible(rows)).groupBy("category", "type").agg(F.count("*").alias("n"))


@query("category_queue", X.PAIRS, f"WITH c AS (SELECT category, count(*) AS n FROM {P} GROUP BY 1), s AS (SELECT *, CASE WHEN n >= (SELECT avg(n) FROM c) THEN 'complete' ELSE 'pending' END AS state FROM c) SELECT category, n, state, CASE WHEN state = 'pending' THEN CAST((row_number() OVER (PARTITION BY state ORDER BY category) - 1) // 4 AS INT) ELSE -1 END AS wave FROM s")
def _(p):
    counts = stats.counts_by(p, "category")
    return synth.queue(counts, counts.agg(F.avg("n")).first()[0]).withColumn("wave", F.coalesce("wave", F.lit(-1)))


# --- model calls: the model is a function, or a table of recorded answers


def _writer(prompts: list[str]) -> list[str | None]:
    """A model that answers a pair by an array of it, or by prose."""
    said = []
    for x in prompts:
        pair = json.loads(x)
        said.append("No." if "<THINK>" in pair["output"] else "Here you are:\n" + json.dumps([{"transcript": pair["input"], "output": pair["output"]}]))
    return said


_WRITTEN = f"SELECT p.line_no, category, md5(input) AS transcript, md5(output) AS output, reason, contains(output, '<THINK>') AS failed FROM {P} p JOIN ({oracle_sql()['generation_first_reason']}) r ON p.line_no = r.line_no"


@query("generated_pairs", X.PAIRS, f"SELECT line_no, transcript, output, reason FROM ({_WRITTEN}) WHERE NOT failed")
def _(p):
    """Pairs of a model's answers, with what is wrong with them."""
    asked = p.select("line_no", J.to_json_line(F.col("input"), F.col("output")).alias("prompt"))
    answered = synth.call_model(asked, synth.with_retries(_writer, wait=0.0))
    return synth.generated_pairs(answered).select("line_no", md5("transcript"), md5("output"), "reason")


@query("run_totals", X.PAIRS, f"SELECT coalesce(category, 'TOTAL') AS category, CAST(count(*) FILTER (WHERE NOT failed AND reason IS NULL) AS BIGINT) AS generated, CAST(count(*) FILTER (WHERE NOT failed AND reason IS NOT NULL) AS BIGINT) AS rejected, CAST(count(*) FILTER (WHERE failed) AS BIGINT) AS failed FROM ({_WRITTEN}) GROUP BY ROLLUP (category)")
def _(p):
    answered = stored(synth.call_model(p.select("category", J.to_json_line(F.col("input"), F.col("output")).alias("prompt")), _writer), "written")
    asked = answered.select("category", F.coalesce(F.size(J.array_pairs(F.col("raw"))), F.lit(0)).alias("n_pairs"))
    return synth.run_totals(synth.generated_pairs(answered), asked)


@query("replayed_verdicts", X.PAIRS, f"SELECT line_no, line_no % 3 = 0 AS parse_error, CASE WHEN line_no % 3 > 0 THEN line_no % 3 = 1 END AS input_realistic FROM {P}")
def _(p):
    prompt = F.concat_ws(" ", F.lit("judge"), F.col("line_no").cast("string"), "input", "output")
    said = {c: "true" for c in L.CRITERIA}
    good, bad = json.dumps({c: True for c in L.CRITERIA}), json.dumps(said | {L.CRITERIA[0]: "False"})
    responses = p.where("line_no % 3 > 0").select(F.sha2(prompt, 256).alias("prompt_hash"), F.when(F.col("line_no") % 3 == 1, good).otherwise(bad).alias("raw"))
    return gate.replayed_verdicts(p.select("line_no", "input", "output"), responses, prompt).select("line_no", "parse_error", "input_realistic")


@query("messified", X.PAIRS, f"SELECT category, CAST((row_number() OVER (PARTITION BY category ORDER BY line_no) - 1) // 25 AS INT) AS batch, md5('um ' || t) AS transcript, md5(t) AS output FROM (SELECT *, replace(input, chr(10), ' ') AS t FROM {P})")
def _(p):
    """Batches of 25 texts; the model's items are zipped with the texts."""

    def model(prompts: list[str]) -> list[str | None]:
        return [json.dumps([{"transcript": "um " + line.split(". ", 1)[1], "output": "-"} for line in x.split("\n")]) for x in prompts]

    texts = p.select("category", "line_no", F.translate("input", "\n", " ").alias("text"))
    return synth.messify(texts, model, ["line_no"], "{texts}").select("category", F.col("batch").cast("int").alias("batch"), md5("transcript"), md5("output"))


@query("quotas_filled", X.PAIRS, "SELECT * FROM (VALUES ('a', 60, 60), ('b', 40, 40), ('c', 0, 0)) v(category, n, n_distinct) WHERE n > 0")
def _(p):
    """A run that is broken off after one category's pairs goes on; the third category's model never answers."""
    spark, path = p.sparkSession, folder(p.sparkSession)

    def model(prompts: list[str]) -> list[str | None]:
        return [None if x.startswith("c") else json.dumps([{"transcript": f"um {x} {k}", "output": f"{x} {k}"} for k in range(int(x.split()[2]))]) for x in prompts]

    prompt = F.concat_ws(" ", "category", F.col("batch").cast("string"), F.col("size").cast("string"))
    weights = {"a": 0.6, "b": 0.4, "c": 0.05}
    writers.append_pairs(spark.createDataFrame([("a", f"um old {k}", f"old {k}") for k in range(30)], "category string, input string, output string"), path)
    generate.fill_quotas(spark, path, 100, model, prompt, 25, 2, weights)
    generate.fill_quotas(spark, path, 100, model, prompt, 25, 2, weights)
    done = generate.existing(spark, path)
    return done.groupBy("category").agg(F.count("*").cast("int").alias("n"), F.countDistinct("input").cast("int").alias("n_distinct"))


@query("inferred", X.PAIRS, f"SELECT line_no, md5(input || ' ok') AS raw_generated, CAST(len({tokens('input')}) + 1 AS BIGINT) AS generated_token_count, true AS timed FROM {P}")
def _(p):
    """A model that repeats the user's turn of its prompt."""

    def model(prompts: list[str]) -> list[str | None]:
        return [x.split("<|im_start|>user\n")[1].split("<|im_end|>")[0] + " ok" for x in prompts]

    found = generate.infer(p.select("line_no", "input"), model, "s")
    return found.select("line_no", md5("raw_generated"), "generated_token_count", (F.col("generation_seconds") >= 0).alias("timed"))


def _judge(prompts: list[str]) -> list[str | None]:
    """A judge that looks at the pair: prose for one kind of text, else four criteria."""
    said = []
    for x in prompts:
        pair = json.loads(x)
        verdict = {
            "input_realistic": not pair["input"].startswith("um "),
            "content_preserved": len(pair["output"]) * 5 > len(pair["input"]),
            "no_hallucination": "\ufffd" not in pair["output"],
            "corrections_applied": not pair["input"].startswith("wait no "),
        }
        said.append("I can't say." if "<THINK>" in pair["output"] else "```json\n" + json.dumps(verdict) + "\n```")
    return said


_PROSE = "contains(output, '<THINK>')"
_SAID = {
    "input_realistic": "NOT starts_with(input, 'um ')",
    "content_preserved": "length(output) * 5 > length(input)",
    "no_hallucination": f"NOT contains(output, '{X.REPLACEMENT}')",
    "corrections_applied": "NOT starts_with(input, 'wait no ')",
}
_JUDGED = f"(SELECT category, line_no, input, output, {_PROSE} AS parse_error, {', '.join(f'CASE WHEN NOT {_PROSE} THEN {rule} END AS {c}' for c, rule in _SAID.items())} FROM {P})"
_ALL_SAID = " AND ".join(f"coalesce({c}, false)" for c in _SAID)


@query(
    "judged_batch",
    X.PAIRS,
    f"""WITH j AS {_JUDGED}, f AS ({" UNION ALL ".join(f"SELECT {i} AS ord, '{c}' AS criterion, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS n FROM j" for i, c in enumerate(_SAID))})
    SELECT count(*) AS total, count(*) FILTER (WHERE {_ALL_SAID}) AS passed, count(*) FILTER (WHERE NOT ({_ALL_SAID})) AS failed, (SELECT criterion FROM f ORDER BY n DESC, ord LIMIT 1) AS most_common_failure FROM j""",
)
def _(p):
    lines = p.select("line_no", J.to_json_line(F.col("input"), F.col("output")).alias("value"))
    return generate.judge_batch(lines, _judge, J.to_json_line(F.col("input"), F.col("output")))[1]


@query("system_hoisted", X.PAIRS, f"SELECT line_no, concat('s', chr(10), chr(10), lang) AS system, 2 AS n_messages FROM {P}")
def _(p):
    messages = F.concat(T.chat_messages("s", F.col("category"), F.col("lang")), F.array(F.struct(F.lit("system").alias("role"), F.col("lang").alias("content"))))
    return p.select("line_no", synth.split_system(messages).alias("m")).select("line_no", "m.system", F.size("m.messages").alias("n_messages"))


@query("lenient_verdicts", X.PAIRS, f"SELECT line_no, line_no % 4 IN (0, 2) AS input_realistic, line_no % 4 = 0 AS content_preserved FROM {P}")
def _(p):
    raw = F.expr("""CASE line_no % 4 WHEN 0 THEN '{"input_realistic": true, "content_preserved": "true"}' WHEN 1 THEN 'no'
      WHEN 2 THEN concat('```json', chr(10), '{"input_realistic": 1, "content_preserved": "false"}', chr(10), '```') ELSE '{"input_realistic": 0}' END""")
    return p.select("line_no", J.lenient_verdict(raw).alias("v")).select("line_no", "v.input_realistic", "v.content_preserved")


@query("metadata_keys", X.PAIRS, f"SELECT line_no, line_no % 3 < 2 AS quantized FROM {P}")
def _(p):
    raw = F.expr("""CASE line_no % 3 WHEN 0 THEN '{"quantization": {"bits": 4}}' WHEN 1 THEN '{"quantization_config": 1}' ELSE '{"other": 1}' END""")
    return p.select("line_no", J.has_keys(raw, "quantization", "quantization_config").alias("quantized"))


@query("judged_pairs", X.PAIRS, f"SELECT line_no, parse_error, {', '.join(_SAID)} FROM {_JUDGED}")
def _(p):
    """Verdicts of a judge that reads the pairs; prose is none."""
    return judge.judge_pairs(p.select("line_no", "input", "output"), _judge, J.to_json_line(F.col("input"), F.col("output"))).select("line_no", "parse_error", *_SAID)


@query("answer_or_reasoning", X.PAIRS, f"SELECT line_no, md5(CASE WHEN output <> '' THEN output ELSE input END) AS answer FROM {P}")
def _(p):
    answer = synth.answer_or_reasoning(F.when(F.col("output") != "", F.col("output")), F.col("input"))
    return p.select("line_no", F.md5(answer.cast("binary")).alias("answer"))


# --- control tables


@query("steps_requested", None, "SELECT step_id, CAST(ord AS INT) AS ord, deps FROM (VALUES ('3b', 2, '3'), ('4', 3, '2,3b'), ('9', 8, '5')) v(step_id, ord, deps)")
def _(spark, d):
    found = control.requested(control.steps(spark, validation=True, base=True), ["9", "4", "3b", "4"])
    return found.select("step_id", "ord", F.array_join("deps", ",").alias("deps"))


@query("steps_dry_run", None, "SELECT * FROM (VALUES ('2', 'skip'), ('4', 'run'), ('6', 'needs 5'), ('8', 'needs 7')) v(step_id, action)")
def _(spark, d):
    done = spark.createDataFrame([("2",)], "step_id string")
    return control.dry_run(control.requested(control.steps(spark), ["2", "4", "6", "8"]), done).select("step_id", "action")


@query("step_state", None, "SELECT * FROM (VALUES ('2', 'completed', 60.0::DOUBLE, NULL), ('3', 'failed', NULL, 'no key'), ('4', 'running', NULL, NULL)) v(step_id, status, duration_seconds, error)")
def _(spark, d):
    """Transitions, saved as one file and loaded again; step 5 is cleared."""
    path = f"{folder(spark)}/state.jsonl"
    at = lambda s: F.lit(f"2024-01-01 00:0{s}:00").cast("timestamp")
    state = control.load_state(spark, path)
    for step, status, minute, error in (("2", "running", 0, None), ("5", "running", 0, None), ("2", "completed", 1, None), ("3", "failed", 2, "no key"), ("4", "completed", 3, None), ("4", "running", 4, None)):
        state = control.mark(state, step, status, at(minute), error)
    control.save_state(control.clear(state, ["5"]), path)
    return control.load_state(spark, path).select("step_id", "status", "duration_seconds", "error")


@query("step_commands", None, "SELECT * FROM (VALUES ('3', '--synthetic-samples 50 --force'), ('6', '--model a --force --resume'), ('10', '--model a --force')) v(step_id, arguments)")
def _(spark, d):
    flags = {"synthetic_samples": 50, "model": "a", "force": True, "resume": True, "base": False, "yes": None}
    return spark.createDataFrame([(s, " ".join(control.command(s, flags))) for s in ("3", "6", "10")], "step_id string, arguments string")


@query("step_artifacts", X.PAIRS, "SELECT step_id FROM (VALUES ('2'), ('4')) v(step_id)")
def _(p):
    root = folder(p.sparkSession)
    for name in ("data/raw/a.jsonl", "data/combined/train.jsonl"):
        writers.write_jsonl_file(p.select("line_no"), f"{root}/{name}")
    writers.write_jsonl_file(p.where("false").select("line_no"), f"{root}/data/synthetic/all_synthetic.jsonl")
    return control.artifacts(p.sparkSession, root)


# --- training tables


@query("checkpoint_file", X.LOG, f"SELECT iter AS best_iter, concat('adapters/', lpad(CAST(iter AS VARCHAR), 9, '0')) AS path FROM ({_PARSED}) WHERE val_loss IS NOT NULL ORDER BY val_loss, iter LIMIT 1")
def _(log):
    parsed = training.parse_log(log)
    padded = parsed.select(F.concat(F.lit("m/adapters-"), F.lpad(F.col("iter").cast("string"), 9, "0"), F.lit(".safetensors")).alias("path"))
    plain = parsed.select(F.concat(F.lit("m/adapters-"), F.col("iter").cast("string"), F.lit(".safetensors")).alias("path"))
    found = training.best_checkpoint(parsed, padded.unionByName(plain))
    return found.select("best_iter", F.regexp_replace(F.regexp_replace("path", "^m/adapters-", "adapters/"), ".safetensors$", "").alias("path"))


@query("latest_checkpoint", X.LOG, f"SELECT concat('run/checkpoint-', max(iter)) AS path FROM ({_PARSED})")
def _(log):
    names = training.parse_log(log).select(F.concat(F.lit("run/checkpoint-"), F.col("iter").cast("string")).alias("path"))
    return training.latest_checkpoint(names.unionByName(log.sparkSession.createDataFrame([("run/final",)], "path string")))


_LISTING = "CASE line_no % 3 WHEN 0 THEN 'config.json' WHEN 1 THEN 'model.safetensors' ELSE 'notes.txt' END"


@query("directory_contents", X.PAIRS, f"SELECT category AS dir, array_to_string(list_filter(['config.json', 'tokenizer.json'], lambda x: NOT list_contains(list(name), x)), ',') AS missing, bool_or(ends_with(name, '.safetensors')) AS weights FROM (SELECT category, {_LISTING} AS name FROM {P}) GROUP BY category")
def _(p):
    listing = p.select(F.col("category").alias("dir"), F.expr(_LISTING).alias("name"))
    missing = training.missing_files(listing, ["config.json", "tokenizer.json"]).select("dir", F.array_join("missing", ",").alias("missing"))
    return missing.join(training.any_of(listing, r"\.safetensors$").withColumnRenamed("found", "weights"), "dir")


@query("normalized_losses", X.LOG, f"SELECT ord, coalesce(train_loss, it_per_sec) AS final_train_loss, coalesce(nullif(val_loss, 0), 9.0::DOUBLE) AS best_val_loss, round_even(train_loss / nullif(it_per_sec, 0), 2) AS ratio, CASE WHEN val_loss IS NOT NULL THEN 'val' WHEN train_loss IS NOT NULL THEN 'train' END AS source FROM ({_PARSED})")
def _(log):
    parsed = training.parse_log(log).withColumn("nine", F.lit(9.0))
    both = training.normalized_summary(parsed, ["train_loss", "it_per_sec"], ["val_loss", "nine"], compat=True)
    source = training.first_existing((F.col("val_loss").isNotNull(), "val"), (F.col("train_loss").isNotNull(), "train"))
    return both.select("ord", "final_train_loss", "best_val_loss", training.compression_ratio(F.col("train_loss"), F.col("it_per_sec")).alias("ratio"), source.alias("source"))


@query("template_problems", X.PAIRS, f"SELECT line_no, CASE WHEN line_no % 4 = 0 THEN 'no_markers,missing_role' WHEN line_no % 4 = 1 THEN 'missing_role' WHEN line_no % 4 = 2 THEN 'think_content' ELSE '' END AS problems FROM {P}")
def _(p):
    whole = T.chatml(T.chat_messages("s", F.col("input"), F.col("output")))
    shown = F.when(F.col("line_no") % 4 == 0, F.col("input")).when(F.col("line_no") % 4 == 1, F.lit("<|im_start|>user\nx<|im_end|>")).when(F.col("line_no") % 4 == 2, F.concat(whole, F.lit("<think>x</think>"))).otherwise(F.concat(whole, F.lit("<think> \n</think>")))
    return p.select("line_no", F.array_join(training.template_problems(shown), ",").alias("problems"))


# --- streams


@query("stream_best_loss", X.LOG, f"SELECT best_val_loss, (SELECT min(iter) FROM ({_PARSED}) WHERE val_loss = best_val_loss) AS least_iter FROM (SELECT min(val_loss) AS best_val_loss FROM ({_PARSED}))")
def _(log):
    """A log tail as a stream; each micro-batch's running row replaces the one before."""
    from skein.streaming.ingest import best_loss_stream, run_complete

    spark, path = log.sparkSession, folder(log.sparkSession)
    log.select("line").write.text(f"{path}/log")
    run_complete(best_loss_stream(spark, f"{path}/log"), f"{path}/out", f"{path}/checkpoint")
    best = spark.read.parquet(f"{path}/out")
    parsed = training.parse_log(log)
    return best.select("best_val_loss").join(parsed, F.col("best_val_loss") == F.col("val_loss")).groupBy("best_val_loss").agg(F.min("iter").alias("least_iter"))


@query("stream_pairs", X.PAIRS, f"SELECT md5(input) AS input, count(*) AS n, count(DISTINCT output) AS outputs FROM {P} GROUP BY 1")
def _(p):
    """New files of pairs as they come, upserted batch by batch into counts."""
    from skein.streaming.ingest import for_each_batch, pair_stream

    spark, path = p.sparkSession, folder(p.sparkSession)
    p.select(J.to_json_line(F.col("input"), F.col("output")).alias("value")).write.text(f"{path}/in")

    def upsert(batch: DataFrame, number: int) -> None:
        batch.groupBy("input", "output").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")

    for_each_batch(pair_stream(spark, f"{path}/in"), upsert, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/counts").groupBy(md5("input")).agg(F.sum("n").alias("n"), F.countDistinct("output").alias("outputs"))


from skein.plans import run_queries  # noqa: E402, F401  registers more queries
