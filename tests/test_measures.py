"""Exact selection, edit distances of long texts and of words, comparison of two outputs."""

import random
import statistics

import duckdb
import pytest
from pyspark.sql import functions as F

from skein.functions import metrics as M
from skein.operators import evaluation, selection
from skein.plans import evaluate


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def pairs(spark):
    r = random.Random(1)
    some = lambda: "".join(r.choices("abé\U0001f642", k=r.randint(0, 40)))
    texts = [(some(), some()) for _ in range(150)] + [("", ""), ("a", ""), ("", "abc"), ("x" * 90, "y" * 80), ("ab" * 50, "ba" * 50)]
    return texts, spark.createDataFrame(texts, "a string, b string")


@pytest.mark.parametrize("short", [M.SHORT, 3, -1])
def test_edit_distance(pairs, short):
    texts, df = pairs
    items = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    rows = df.select(M.edit_distance(F.col("a"), F.col("b"), short).alias("d"), M.word_distance(items("a"), items("b"), short).alias("w")).collect()
    want = [distance(a, b) for a, b in texts]
    assert [r.d for r in rows] == want and [r.w for r in rows] == want


def test_long_texts_at_a_small_distance(spark):
    r = random.Random(3)
    a = "".join(r.choices("abcdefghij ", k=200_000))
    b = list(a)
    for i in r.sample(range(1000, 199_000), 50):
        b[i] = "#"
    words = [f"w{i}" for i in range(60_000)]
    others = list(words)
    for i in r.sample(range(60_000), 200):
        others[i] = f"other{i}"
    df = spark.createDataFrame([(a, "".join(b), " ".join(words), " ".join(others))], "a string, b string, c string, d string")
    row = df.select(M.edit_distance(F.col("a"), F.col("b")).alias("d"), M.wer(F.col("c"), F.col("d")).alias("w")).first()
    assert row.d == 50 and row.w == pytest.approx(200 / 60_000)


def test_word_rate_of_nulls_and_empty_texts(spark):
    df = spark.createDataFrame([(None, "a b"), ("a", None), ("", ""), ("a", " "), ("", "a b"), ("a  b c", "a c")], "g string, e string")
    assert [r[0] for r in df.select(M.wer(F.col("g"), F.col("e"))).collect()] == [None, None, 0.0, 1.0, 1.0, 0.5]


@pytest.mark.parametrize(
    "values",
    [
        [3.5],
        [1.0, 2.0],
        [0.25] * 30_000 + [0.5] * 30_001,
        [float(i % 977) / 7 for i in range(50_000)],
        [(-1) ** i * 2.0 ** (i % 2000 - 1000) for i in range(30_000)],
        [5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, None, float("nan")],
        [1.0 + i * 2**-52 for i in range(25_000)],
    ],
)
def test_order_statistics_equal_a_sort(spark, tmp_path, monkeypatch, values):
    monkeypatch.setattr(selection, "FEW", 500)
    spark.createDataFrame([(v,) for v in values], "v double").write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v")
    real = sorted(v for v in values if v is not None and v == v)
    ranks = sorted({0, len(real) // 3, len(real) // 2, len(real) - 1})
    assert selection.order_statistics(df, "v", ranks) == {k: real[k] for k in ranks}
    assert selection.quantiles(df, "v", [0.5])[0] == pytest.approx(statistics.median(real))


def test_median_of_a_million_values(spark, tmp_path):
    spark.range(1_000_000).selectExpr("(id * 7919 % 1000003) / 7.0 AS v").write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v")
    assert selection.quantiles(df, "v", [0.5, 0.1]) == pytest.approx(list(df.selectExpr("percentile(v, array(0.5, 0.1))").first()[0]))
    assert selection.quantiles(df.where("false"), "v", [0.5]) == [None]


def test_summary_of_no_rows(spark):
    rows = spark.createDataFrame([], "index long, input string, expected string, raw_generated string, generation_seconds double, generated_token_count long")
    row = evaluation.summary(evaluation.score(rows)).first()
    assert row.n == 0 and row.cer_median is None and row.think_count == 0


def test_ab_compare(spark):
    rows = [(i, "a b c d e", "a b c d e" if i % 4 else "a x c d e", "a b c d") for i in range(80)] + [(90, None, "a", "b"), (91, "a", None, "b")]
    df = spark.createDataFrame(rows, "index long, expected string, a string, b string")
    row = evaluation.ab_compare(df).first()
    assert (row.n, row.a_better, row.b_better, row.ties) == (80, 60, 0, 20)
    assert row.wer_a == 0.05 and row.wer_b == 0.2 and row.low < row.difference == -0.15 < row.high < 0
    none = evaluation.ab_compare(df.where("false")).first()
    assert none.n == 0 and none.low is None


def test_lines_of_rates_as_sql_prints_them(spark):
    """Rates that end in a 5, and those halfway between two: by their exact binary values, as DuckDB rounds and prints them."""
    for passed, of in ((513, 2000), (889, 20_000), (1851, 20_000), (1, 400), (2000, 2000)):
        rows = spark.range(of).select(*[(F.col("id") < passed if c == M.CHECKS[0] else F.lit(None).cast("boolean")).alias(c) for c in M.CHECKS])
        line = evaluate.check_lines(evaluation.check_rates(rows)).first().line
        want = duckdb.connect().execute(f"select printf('%d/%d (%.1f%%)', {passed}, {of}, round_even({passed}::double / {of}, 4) * 100)").fetchone()[0]
        assert line.endswith(f": {want}")
