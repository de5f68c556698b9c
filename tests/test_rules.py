"""Golden rows of rules, features, metrics, JSON and logs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skein.functions import jsonx as J
from skein.functions import metrics as M
from skein.functions import text as T
from skein.operators import dedup, judge, quality, stats, synth, training


def pairs(spark, *rows):
    return spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(rows)], "k int, input string, output string")


def test_validator(spark):
    rows = [
        ("abcd", "abcdefgh", ""),
        ("abcd", "abcdefghi", "length"),
        ("um hello there world", "", "empty_output"),
        ("um uh", "", ""),
        ("he said um", 'He said "um".', ""),
        ("he said um", "He said um.", "fillers"),
        ("uh huh ok then", "uh huh ok", "fillers"),
        ("a b", "<THINK>a", "length,think_tag"),
        ("a � b c d e f g", "a b", "input_mojibake"),
        ("a b c d e", "a\x00b", "output_null_byte"),
    ]
    got = quality.validate(pairs(spark, *[(a, b) for a, b, _ in rows])).orderBy("k").collect()
    assert [",".join(r.reasons) for r in got] == [x for _, _, x in rows]
    assert got[6].details == ["fillers in output: uh"]


def test_added_content_is_a_warning(spark):
    got = quality.severity(quality.validate(pairs(spark, ("a b c d", "a b c d e"), ("a b c", "a b c d"), ("", "x"), (None, None)))).orderBy("k").collect()
    assert [r.severity for r in got] == ["accept", "warn", "accept", "accept"]


def test_word_counts_equal_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [a + b for a in ("gard", "tree", "wood", "s", "red", "sing") for b in ("", "s", "ed", "ing", "ss", "deed", "en")]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))), " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for _ in range(60)]
    rows += [("a " * 9000, "b a " * 8000)]  # a long text costs a sort, not a product

    def near(w, known):
        return any(f in known for f in (w, w + "s", w.rstrip("s"), w + "ed", w + "ing", w.rstrip("ed"), w.rstrip("ing")))

    got = pairs(spark, *rows).select("k", quality.novel_words(F.col("input"), F.col("output")).alias("n"), T.made_up_words(F.col("input"), F.col("output")).alias("m"), M.bleu_parts(F.col("output"), F.col("input")).alias("p"))
    for r in got.collect():
        i, o = (x.split() for x in rows[r.k])
        assert r.n == sum(w not in set(i) for w in o)
        known = {w for w in i if len(w) >= 3}
        assert r.m == [w for w in dict.fromkeys(o) if len(w) >= 5 and not near(w, known)]
        grams = lambda ws, n: Counter(zip(*(ws[j:] for j in range(n)), strict=False))
        assert [r.p[f"n{n}"] for n in range(1, 5)] == [sum((grams(i, n) & grams(o, n)).values()) for n in range(1, 5)]


def test_edit_distance_equals_levenshtein(spark):
    rng = random.Random(6)
    rows = [("", ""), ("", "abc"), ("abc", "abc"), ("aaa", "aa"), ("abab", "ab"), ("é🙂x", "é🙂yx"), ("kitten", "sitting"), (None, "a")]
    rows += [("".join(rng.choices("ab", k=rng.randint(0, 9))), "".join(rng.choices("ab", k=rng.randint(0, 9)))) for _ in range(200)]
    got = pairs(spark, *rows).select(M.edit_distance(F.col("input"), F.col("output")).alias("d"), F.levenshtein("input", "output").alias("want"))
    assert all(r.d == r.want for r in got.collect())


def test_first_reason(spark):
    rows = [(None, "x", "empty_transcript"), ("a", "  ", "empty_output"), ("abc", "abcdefg", "too_long"), ("ab cd ef", "you know it", "fillers"), ("abc", "abcdef", None), ("I think so", "I mean it", "fillers")]
    got = pairs(spark, *[(a, b) for a, b, _ in rows]).select("k", quality.first_reason(F.col("input"), F.col("output")).alias("r")).orderBy("k").collect()
    assert [r.r for r in got] == [x for *_, x in rows]


def test_dedup_and_split(spark):
    rows = spark.createDataFrame([("Hello  World", 0, 1), (" hello world ", 0, 2), ("HELLO\nWORLD", 1, 1), ("other", 1, 2)], "input string, src_rank int, line_no int")
    assert sorted(r.input for r in dedup.first_occurrences(rows, ["src_rank", "line_no"]).collect()) == ["Hello  World", "other"]
    assert dedup.duplicate_count(rows).first().n_duplicates == 2
    for n, want in ((10, {"train": 9, "test": 1}), (100, {"train": 90, "valid": 5, "test": 5}), (1, {"test": 1})):
        for parts in (1, 5):
            got = dedup.exact_split(spark.range(n).repartition(parts), ["id"])
            assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == want
    a, b = ({r.id: r.split for r in dedup.exact_split(spark.range(50).repartition(p), ["id"]).collect()} for p in (1, 7))
    assert a == b
    assert dedup.exact_split(spark.range(0), ["id"]).count() == 0


def test_sampling_and_batches(spark):
    rows = spark.range(51).select((F.col("id") % 2).cast("string").alias("category"), F.col("id").alias("line_no"))
    got = {r.category: r["count"] for r in dedup.sample_per_group(rows, "category", ["category", "line_no"], 0.12).groupBy("category").count().collect()}
    assert got == {"0": 4, "1": 3}  # ceil of 26 and of 25
    assert dedup.sample_at_most(rows, 10, ["line_no"]).count() == 10 and dedup.sample_at_most(rows, 99, ["line_no"]).count() == 51
    assert [r["count"] for r in dedup.batches(rows, "category", ["line_no"], 10).groupBy("category", "batch").count().orderBy("category", "batch").collect()] == [10, 10, 6, 10, 10, 5]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("generated", "expected", "cer"), [("sitting", "kitten", 0.5), ("", "", 0.0), ("x", "", 1.0), ("cafe", "café", 0.25)]
)
def test_cer(spark, generated, expected, cer):
    assert one(spark, M.cer(F.lit(generated), F.lit(expected))) == pytest.approx(cer)


def test_bleu(spark):
    bleu = lambda g, e: one(spark, M.sentence_bleu(M.bleu_parts(F.lit(g), F.lit(e))))
    assert bleu("a b c d", "a b c d") == pytest.approx(1.0)
    assert bleu("", "") == 1.0 and bleu("x", "") == 0.0 and bleu("", "x") == 0.0 and bleu("z", "a b") == 0.0
    assert bleu("the the the the", "the cat") == pytest.approx((1 / 4 * 0.1 / 3 * 0.1 / 2 * 0.1 / 1) ** 0.25)
    rows = pairs(spark, ("a b c d e", "a b c d e"), ("f g h i", "f g h j")).select(M.bleu_parts(F.col("input"), F.col("output")).alias("parts"))
    assert M.corpus_bleu(rows).first().corpus_bleu == pytest.approx((8 / 9 * 6 / 7 * 4 / 5 * 2 / 3) ** 0.25)
    assert one(spark, M.wer(F.lit("a x c"), F.lit("a b c d"))) == pytest.approx(0.5)


def checks(spark, source, expected, generated):
    found = M.format_checks(F.lit(source), F.lit(expected), F.lit(generated))
    return spark.range(1).select(*[c.alias(k) for k, c in found.items()], M.format_accuracy(list(found.values())).alias("acc")).first()


def test_format_checks(spark):
    r = checks(spark, "x", "It costs $5.", "It costs five.")
    assert (r.number_format_ok, r.punctuation_ok, r.acc) == (False, True, 0.5)
    r = checks(spark, "x", "five items", "five items")
    assert r.number_format_ok is None and r.punctuation_ok is None and r.acc is None
    assert checks(spark, "wait no tuesday", "Tuesday.", "Wait no, Tuesday.").self_correction_ok is False
    assert checks(spark, "wait no tuesday", "Tuesday.", "Tuesday.").self_correction_ok is True
    assert checks(spark, "um a", "a", "um a").filler_removal_ok is False
    assert checks(spark, "a", "a", "um a").filler_removal_ok is False and checks(spark, "a", "a", "a").filler_removal_ok is None
    assert checks(spark, "a", "ok 😀", "ok").emoji_ok is False


def test_features(spark):
    assert one(spark, T.filler_count(F.lit("So the um thing, you know, like I mean"))) == 4
    assert one(spark, T.filler_count(F.lit("I mean it"), True)) == 1
    p = one(spark, T.filler_positions(F.lit("um a b c like d. uh. a b um c d")))
    assert (p.boundary, p.mid_phrase) == (1, 2)
    assert one(spark, T.correction_count(F.lit("wait no, no it's actually sorry"))) == 5
    assert one(spark, T.has_multi_step(F.lit("Tue, wait no Wed, actually Thu"))) and not one(spark, T.has_multi_step(F.lit("sorry\nactually")))
    assert one(spark, T.preservation(F.lit("the patient walked"), F.lit("patient"))) == 0.5 and one(spark, T.preservation(F.lit("a b"), F.lit(""))) == 1.0
    assert one(spark, T.made_up_words(F.lit("walk cats need"), F.lit("walked needed invented"))) == ["needed", "invented"]
    n = one(spark, T.number_conversion(F.lit("five point five hundred"), F.lit("$5.50 twenty")))
    assert (n.spoken_in_input, n.formatted_in_output, n.spoken_in_output) == (4, True, 1)
    s = one(spark, T.written_smell(F.lit("Hello. there. Yes")))
    assert s.caps_start_pct == 66.7 and s.period_end_pct == 0.0


def test_normalisers(spark):
    assert one(spark, T.normalize_text(F.lit(" \r\na\rb \n"))) == "a\nb"
    assert one(spark, T.slug(F.lit("org/My Data-Set!"))) == "my_data_set"
    assert one(spark, T.strip_think(F.lit(" <think>x\ny</think> ok "))) == "ok" and one(spark, T.strip_think(F.lit(" ok "))) == " ok "
    assert one(spark, T.duration(F.lit(12.34))) == "12.3s" and one(spark, T.duration(F.lit(245.0))) == "4m 5s" and one(spark, T.duration(F.lit(3723.0))) == "1h 2m 3s"
    assert one(spark, T.pretty_label(F.lit("number_format_ok"))) == "Number Format"
    assert one(spark, T.numbered_list(F.array(F.lit("a"), F.lit("b")))) == "1. a\n2. b"
    assert one(spark, T.truncate(F.lit("abcdef"), 3)) == "abc..."
    assert one(spark, T.chatml(T.chat_messages("s", F.lit("u")), True)) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n"


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ('{"input":"a","output":"b"}', ("a", "b")), ('{"input":5,"output":"x"}', None), ("[1]", None), ("{bad", None), ("", None), ('{"input":"","output":"x"}', ("", "x")),
        ('{"input":"a","input":"z","output":"b"}', ("z", "b")), ('{"input":null,"output":"b"}', None), ('{"output":"b"}', None),
    ],
)
def test_strict_json(spark, line, want):
    got = one(spark, J.strict_strings(F.lit(line), ["input", "output"]))
    assert (got and tuple(got)) == want


def test_judge_answers(spark):
    full = '"input_realistic": true, "content_preserved": true, "no_hallucination": true, "corrections_applied": '
    rows = [
        ("<think>x</think>{" + full + "true}", True), ("text ```json\n{" + full + "true}\n``` more", True), ("prose {" + full + '"TRUE"} end', True), ("{" + full + "1}", None),
        ('{"input_realistic": true}', None), ('see {"a": "}"} {' + full + "true}", None), (None, None),
    ]
    frame = spark.createDataFrame(list(enumerate(r for r, _ in rows)), "k int, raw string")
    got = J.parse_verdicts(frame).orderBy("k").collect()
    assert [r.verdict and r.verdict.corrections_applied for r in got] == [w for _, w in rows]
    assert [r.parse_error for r in got] == [w is None for _, w in rows]
    lenient = one(spark, J.lenient_verdict(F.lit('```\n{"input_realistic": "false", "content_preserved": true}\n```')))
    assert tuple(lenient) == (False, True, False, False)
    assert one(spark, J.lenient_verdict(F.lit('{"input_realistic": "false"}'), True)).input_realistic is True
    assert J.balanced_object('x {bad} {"a": {"b": "}"}} y') == '{"a": {"b": "}"}}' and J.balanced_object("{") is None


def test_gate(spark):
    def verdicts(name, good, bad, errors):
        rows = [(name, True, False)] * good + [(name, False, False)] * bad + [(name, None, True)] * errors
        return [(c, i, v, v, v, v, e) for i, (c, v, e) in enumerate(rows)]

    rows = verdicts("a", 9, 0, 1) + verdicts("b", 7, 3, 0) + verdicts("c", 6, 4, 0)
    frame = spark.createDataFrame(rows, "category string, line_no int, input_realistic boolean, content_preserved boolean, no_hallucination boolean, corrections_applied boolean, parse_error boolean")
    categories = spark.createDataFrame([("a",), ("b",), ("c",), ("empty",)], "category string")
    decided = judge.decide(judge.with_empty(judge.criterion_rates(frame), categories))
    assert {r.category: r.decision for r in decided.collect()} == {"a": "pass", "b": "warn", "c": "reject", "empty": "skip"}
    assert judge.critical_lines(frame).count() == 7
    assert {r.category for r in judge.prune(frame, judge.critical_lines(frame), decided).collect()} == {"a", "b"}
    realistic = frame.withColumn("content_preserved", F.lit(True)).withColumn("no_hallucination", F.lit(True))
    assert judge.critical_lines(realistic).count() == 0


@pytest.mark.parametrize(
    ("text", "want"), [("patient diagnosis", "medical_clinical"), ("patient", None), ("patient hospital contract clause", "medical_clinical"), ("cooking stirring", "recipe_cooking")]
)
def test_category(spark, text, want):
    assert one(spark, synth.category(F.lit(text))) == want


def test_quota_and_cost(spark):
    none = spark.createDataFrame([], "category string")
    plan = {r.category: r for r in synth.quota_plan(spark, none, 5000).collect()}
    assert (plan["casual_conversation"].target, plan["shopping_lists"].target, plan["self_corrections_heavy"].target) == (750, 150, 350)
    assert sum(r.target for r in plan.values()) == 5000
    have = spark.createDataFrame([("shopping_lists",)] * 200, "category string")
    row = synth.quota_plan(spark, have, 5000).where("category = 'shopping_lists'").first()
    assert (row.remaining, row.num_batches) == (0, 0)
    assert one(spark, synth.generation_cost(F.lit(5000))).usd == pytest.approx(200 * 1500 / 1e6 * 3 + 200 * 2000 / 1e6 * 15)
    assert synth.fill_loop([("a", 30), ("b", 5)], lambda c, n: n if c == "a" else 0) == {"a": 30, "b": 0}


def test_log_lines(spark):
    lines = ["Iter 10: Train loss 3.456, Learning Rate 1.000e-05, It/sec 2.34", "Iter 100: Val loss 2.789, Val took 1.23s", "note", "Iter 200: Val loss 2.789", "Iter 300: Train loss 3.0"]
    log = training.parse_log(spark.createDataFrame([(x,) for x in lines], "line string"))
    rows = log.orderBy("iter").collect()
    assert (rows[0].train_loss, rows[0].learning_rate, rows[0].it_per_sec, rows[0].val_loss) == (3.456, 1e-05, 2.34, None)
    best = training.best_iteration(log).first()
    assert (best.best_iter, best.best_val_loss, best.last_train_loss) == (100, 2.789, 3.0)
    files = spark.createDataFrame([("x/adapters-100.safetensors",), ("x/adapters-000000100.safetensors",), ("x/adapters-000000200.safetensors",)], "path string")
    assert training.best_checkpoint(log, files).first().path == "x/adapters-000000100.safetensors"
    assert training.latest_checkpoint(files).first().path == "x/adapters-000000200.safetensors"


def test_totals(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "g string, v int")
    assert stats.total_if_known(rows, "v").first().total is None
    assert {r.g: r.v for r in stats.with_total(rows, "g", "v").collect()} == {"a": 1, "b": 3, "TOTAL": 4}
