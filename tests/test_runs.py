"""Places in an order, listings and bounded scans, versions of a pair table, model runs, streams with state."""

import json
import time
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skein.functions import lexicons as L
from skein.operators import compare, dedup, synth
from skein.plans import gate, generate
from skein.sources import readers, writers
from skein.sources.versions import ROWS, ConflictError, Versions
from skein.streaming import ingest, state


def test_places_in_an_order(spark):
    """A group with most rows, a null group, equal keys, an odd order; no window holds a whole group."""
    rows = [("hot", i * 7919 % 5000, f"x{i}") for i in range(5000)] + [("b", 3, "y"), ("b", None, "z"), (None, 2, "n"), (None, 1, "m"), ("c", 1, "p"), ("c", 1, "q")]
    df = spark.createDataFrame(rows, "g string, k int, t string").repartition(7)
    got = dedup.ordered_places(df, ["k", "t"], "place", "g", "n").collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    groups = [sorted((r for r in rows if r[0] == g), key=key) for g in ("hot", "b", None, "c")]
    want = {(*r, i, len(mine)) for mine in groups for i, r in enumerate(mine)}
    assert {(r.g, r.k, r.t, r.place, r.n) for r in got} == want and len(got) == len(rows)
    whole = dedup.ordered_places(df.where("g = 'hot'"), ["k"], "place").collect()
    assert all(r.place == r.k for r in whole) and len(whole) == 5000
    assert dedup.ordered_places(df.where("false"), ["k"], "place", "g").count() == 0
    plan = dedup.batches(df, "g", ["k", "t"])._jdf.queryExecution().toString()
    assert "row_number" not in plan


def test_still_needed(spark):
    df = spark.range(1000).selectExpr("if(id % 10 = 0, 'b', 'a') AS category", "id")
    plan = spark.createDataFrame([("a", 5), ("b", 1000), ("c", 3), ("b2", 0)], "category string, remaining long")
    got = dedup.still_needed(df, plan, ["id"]).orderBy("id").collect()
    assert [r.id for r in got if r.category == "a"] == [1, 2, 3, 4, 5] and sum(r.category == "b" for r in got) == 100
    assert set(got[0].asDict()) == {"category", "id"}


def test_ordered_files(spark, tmp_path):
    lines = spark.range(0, 3000).select((3000 - F.col("id")).alias("k"), F.concat(F.lit("line "), (3000 - F.col("id")).cast("string")).alias("value")).repartition(6)
    manifest = writers.write_ordered(lines.orderBy("k").select("value"), f"{tmp_path}/o")
    back = readers.numbered_lines(spark, f"{tmp_path}/o").count()
    got = writers.read_ordered(spark, f"{tmp_path}/o").orderBy("place").collect()
    assert back == 3000 and [r.place for r in got] == list(range(3000)) and [r.value for r in got] == [f"line {i + 1}" for i in range(3000)]
    assert manifest.agg(F.sum("n")).first()[0] == 3000
    writers.write_ordered(lines.where("false").select("value"), f"{tmp_path}/none")
    assert writers.read_ordered(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="exist"):
        writers.write_ordered(lines.select("value"), f"{tmp_path}/o")


def test_only_chosen_files_are_opened(spark, tmp_path):
    for c in ("a", "b", "c"):
        (tmp_path / f"synthetic_{c}.jsonl").write_text(json.dumps({"input": c, "output": c}) + "\n")
    rejected = spark.createDataFrame([("synthetic_b.jsonl",), ("synthetic_b.jsonl",)], "file string")
    pairs = readers.synthetic_pairs(spark, str(tmp_path), rejected, ["a", "b", "z"])
    assert [readers.file_name(f) for f in pairs.inputFiles()] == ["synthetic_a.jsonl"]
    assert [(r.source, r.category, r.line_no) for r in pairs.collect()] == [("synthetic/a", "a", 1)]
    assert readers.synthetic_pairs(spark, str(tmp_path), None, ["z"]).count() == 0
    assert readers.synthetic_pairs(spark, str(tmp_path)).count() == 3
    sizes = {r.file: r.size for r in readers.listing(spark, f"{tmp_path}/*.jsonl").collect()}
    assert sizes["synthetic_a.jsonl"] == (tmp_path / "synthetic_a.jsonl").stat().st_size


def test_bounded_scan_stops(spark, tmp_path):
    """Later files are broken: opening one would fail. The same texts come however files are split."""
    fit = "The patient came to the hospital with a diagnosis, and the nurse wrote all of it down for the doctor. "
    for i in range(7):
        spark.range(100).selectExpr(f"if(id % 10 = 3, concat('{fit}', {i}, ' ', id), 'short') AS text", "id").coalesce(1).write.parquet(f"{tmp_path}/p{i}")
        next((tmp_path / f"p{i}").glob("part-*")).rename(tmp_path / f"f{i}.parquet")
    for i in range(3, 7):
        (tmp_path / f"f{i}.parquet").write_bytes(b"broken")
    want = [(100 * i + k) for i in range(3) for k in range(3, 100, 10)]
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = synth.clean_texts(spark, f"{tmp_path}/f*.parquet", 25).orderBy("place").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r.place for r in got] == want[:25] and {r.category for r in got} == {"medical_clinical"}
    capped = synth.clean_texts(spark, f"{tmp_path}/f*.parquet", 25, scan_factor=2).collect()
    assert sorted(r.place for r in capped) == want[:5]
    with pytest.raises(Exception, match="(?i)parquet"):
        synth.clean_texts(spark, f"{tmp_path}/f*.parquet", 40).collect()
    assert synth.clean_texts(spark, f"{tmp_path}/none*.parquet", 5).count() == 0


# --- versions and the gate


@pytest.fixture
def table(spark, tmp_path):
    rows = [(c, i, json.dumps({"input": f"{c} text {i}", "output": "" if (c, i % 4) == ("bad", 1) else f"Text {i}."})) for c in ("good", "bad", "poor") for i in range(40)]
    rows += [("good", 100, "no pair"), ("good", 101, json.dumps({"input": " ", "output": "x"}))]
    made = Versions(spark, f"{tmp_path}/t")
    assert made.current() == 0 and made.read().count() == 0
    assert made.create(spark.createDataFrame(rows, ROWS)) == 1
    return made


def judge_by_category(prompts):
    """good passes but for texts that end with 7, bad passes, poor fails half of all."""
    said = []
    for x in prompts:
        pair = json.loads(x)
        poor = pair["input"].startswith("poor") and int(pair["input"].split()[-1]) % 2
        said.append(json.dumps({c: not (poor or c == "no_hallucination" and pair["input"].endswith("7")) for c in L.CRITERIA}))
    return said


def test_gate_writes_the_next_version(spark, table, tmp_path):
    prompt = F.to_json(F.struct("input", "output"))
    before = table.read(1)
    assert gate.run_gate(table, judge_by_category, prompt, f"{tmp_path}/r", 1.0) == 2
    assert {r.category for r in table.rejected(2).collect()} == {"poor"} and table.rejected(2).count() == 40
    now = table.read(2)
    left = {(r.category, r.line_no) for r in now.collect()}
    assert {c for c, _ in left} == {"good", "bad"} and ("good", 7) not in left and ("good", 100) in left and ("bad", 1) in left
    assert before.count() == table.read(1).count() == 122 and table.read(1).where("category = 'poor'").count() == 40
    report = spark.read.json(f"{table.root}/{table.manifest(2)['report']}")
    assert {r.category: r.decision for r in report.collect()} == {"good": "pass", "bad": "pass", "poor": "reject"}
    # judged again, nothing is asked and nothing else goes
    assert gate.run_gate(table, lambda prompts: 1 / 0, prompt, f"{tmp_path}/r", 1.0) == 3
    assert {(r.category, r.line_no) for r in table.read(3).collect()} == left and table.rejected(3).count() == 40
    assert table.manifest(3)["live"] == table.manifest(2)["live"]  # folders of what did not change are named again


def test_a_crash_after_the_report_leaves_the_version(spark, table, tmp_path, monkeypatch):
    prompt = F.to_json(F.struct("input", "output"))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
        m.setattr(Versions, "put", broken)
        gate.run_gate(table, judge_by_category, prompt, f"{tmp_path}/r", 1.0)
    assert table.current() == 1 and table.read().count() == 122
    assert gate.run_gate(table, judge_by_category, prompt, f"{tmp_path}/r", 1.0) == 2


def test_the_second_writer_fails(spark, table):
    other = Versions(spark, table.root)
    gone = spark.createDataFrame([("good", 1), ("good", 1), ("none", 5)], "category string, line_no long")
    with pytest.raises(ValueError, match="report"):
        table.rewrite(1, gone, [], "reports/none")
    assert table.current() == 1
    assert table.rewrite(1, gone, [], None) == 2 and table.read().count() == 121
    with pytest.raises(ConflictError):
        other.rewrite(1, gone, ["bad"], None)
    assert other.current() == 2 and other.rejected().count() == 0
    table.fs.create(table._path("versions/v00000003.json"), False).close()  # a commit that broke off
    assert table.current() == 2
    with pytest.raises(ConflictError):
        table.rewrite(2, gone.where("false"), ["bad"], None)
    assert table.discard_broken() == [3]
    assert table.rewrite(2, gone.where("false"), ["bad", "absent"], None) == 3 and table.rejected().count() == 40
    whole = table.read(3).select("category", "line_no")
    assert table.rewrite(3, whole, [], None) == 4 and table.read(4).count() == 0
    with pytest.raises(ValueError, match="no version"):
        table.read(9)


# --- model runs


def test_prompts_are_asked_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(prompts):
        (calls / uuid.uuid4().hex).write_text("\n".join(prompts))
        return [None if x == "p3" else x.upper() for x in prompts]

    def asked():
        found = sorted(x for f in calls.iterdir() for x in f.read_text().split("\n"))
        for f in calls.iterdir():
            f.unlink()
        return found

    rows = spark.createDataFrame([(i, f"p{i % 5}" if i % 11 else None, "x") for i in range(400)], "id long, prompt string, raw2 string").repartition(6)
    first = synth.ask(rows, model, f"{tmp_path}/r", batch=2).collect()
    assert asked() == ["p0", "p1", "p2", "p3", "p4"] and len(first) == 400
    assert all(r.raw == (None if r.prompt in (None, "p3") else r.prompt.upper()) for r in first)
    more = rows.unionByName(spark.createDataFrame([(1000, "new", "x")], rows.schema))
    assert synth.ask(more, model, f"{tmp_path}/r").count() == 401
    assert asked() == ["new", "p3"]
    assert synth.ask(rows.where("false"), model, f"{tmp_path}/r").count() == 0 and asked() == []


def test_failing_models_leave_nulls(spark, tmp_path):
    def model(prompts):
        if "b" in prompts:
            raise OSError("down")
        return [x * 2 for x in prompts]

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "prompt string").coalesce(1)
    got = synth.ask(rows, synth.with_retries(model, 2, 0), f"{tmp_path}/r", batch=1).collect()
    assert {r.prompt: r.raw for r in got} == {"a": "aa", "b": None, "c": "cc"}


def test_calls_run_at_once(spark):
    def model(prompts):
        import time

        time.sleep(0.4)
        return prompts

    rows = spark.range(16).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    synth.call_model(rows, lambda p: p, batch=1).collect()
    began = time.perf_counter()
    assert sorted(r.raw for r in synth.call_model(rows, model, batch=1, at_once=8).collect()) == sorted(str(i) for i in range(16))
    assert time.perf_counter() - began < 16 * 0.4


# --- streams with state


def test_step_states(spark, tmp_path):
    """Out of order, repeated, null keys; a start clears the end, a long run is stalled by the timer and goes on after it."""
    at = lambda h: f"2024-01-01 {h:02d}:00:00"
    days = lambda d: f"2024-01-{d:02d} 00:00:00"
    batches = [
        [("a", "completed", at(2), 2, None), ("a", "running", at(1), 1, None), ("b", "failed", at(3), 3, "boom"), (None, "running", at(1), 9, None), ("c", "running", at(1), 4, None), ("d", "completed", at(1), 5, None)],
        [("a", "running", at(1), 1, None), ("b", "running", at(4), 6, None), ("x", "running", days(9), 7, None)],
        [("c", "completed", days(10), 8, None), ("x", "failed", days(10), 9, "late"), ("b", "running", at(4), 6, None)],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "step_id string, status string, at string, id long, error string").withColumn("at", F.to_timestamp("at"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        state.run_states(state.step_states(stream), f"{tmp_path}/out", f"{tmp_path}/check")
        if i == 1:
            seen = {r.step_id: r for r in state.last_states(spark, f"{tmp_path}/out").collect()}
            assert seen["c"].stalled and seen["c"].status == "running" and seen["b"].status == "running" and seen["b"].error is None
    seen = {r.step_id: r for r in state.last_states(spark, f"{tmp_path}/out").collect()}
    assert set(seen) == {"a", "b", "c", "d", "x"}
    assert (seen["a"].status, seen["a"].duration_seconds, seen["a"].stalled) == ("completed", 3600.0, False)
    assert (seen["c"].status, seen["c"].stalled, seen["c"].completed_at.day) == ("completed", False, 10)
    assert (seen["d"].started_at, seen["d"].duration_seconds) == (None, None)
    assert (seen["x"].status, seen["x"].error, seen["x"].duration_seconds) == ("failed", "late", 86400.0)


def test_step_states_of_events_without_status_or_user(spark, sf, tmp_path):
    """The last event has no status and comes a day after all others, so that steps that run are stalled; some have no user."""
    c = duckdb.connect()
    c.execute(f"create table events as select event_id, ts, if(user_id % 10 = 3, null, user_id) as user_id, event_type, value, props from '{sf}/events.parquet'")
    c.execute("insert into events select 999999, max(ts) + interval 30 hour, 5, 'signup', 1.0, null from events")
    c.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    want = c.execute(entry.oracle_sql()["stream_step_states"]).fetchall()
    got = [tuple(r) for r in entry.queries()["stream_step_states"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(r[-1] for r in want) and any(r[0] is None for r in want)


def test_keys_are_forgotten_after_the_delay(spark, tmp_path):
    rows = lambda *xs: spark.createDataFrame(xs, "input string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1)
    folder = f"{tmp_path}/in"

    def run():
        stream = spark.readStream.schema("input string, at timestamp").parquet(folder)
        query = ingest.run_available(ingest.distinct_stream(stream, "at", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/check")
        return sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"])

    rows(("A b", "2024-01-01 00:00:00"), ("a  B", "2024-01-01 00:20:00"), ("c", "2024-01-01 00:30:00")).write.mode("append").parquet(folder)
    run()
    rows(("d", "2024-01-01 05:00:00"), ("a b", "2024-01-01 00:40:00")).write.mode("append").parquet(folder)
    removed = run()
    rows(("a b", "2024-01-01 05:10:00"), ("c", "2024-01-01 01:00:00")).write.mode("append").parquet(folder)
    removed += run()
    got = sorted((r.input, r.at.hour) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert [h for _, h in got if _ == "a b"] == [5] and sum(x == "c" for x, _ in got) == 1 and len(got) == 4
    assert removed >= 2


# --- texts to pairs, the last review


def test_clean_to_messy_goes_on(spark, tmp_path):
    fit = "The patient came to the hospital with a diagnosis, and the nurse wrote all of it down for the doctor, visit"
    spark.range(60).selectExpr(f"concat('{fit} ', id, '.') AS text").coalesce(2).write.parquet(f"{tmp_path}/in")

    def model(answered):
        def call(prompts):
            return [json.dumps([{"transcript": "uhm " + line.split(". ", 1)[1]} for line in x.split("\n")]) if answered or "visit 3." in x else None for x in prompts]

        return call

    run = lambda m, n=40: generate.clean_to_messy(spark, f"{tmp_path}/in/*.parquet", f"{tmp_path}/out", f"{tmp_path}/record", m, "{texts}", n, size=10)
    made = lambda: spark.read.schema("input string, output string, category string").json(f"{tmp_path}/out")
    totals = {r.category: r.generated for r in run(model(False)).collect()}
    assert totals == {"medical_clinical": 10, "TOTAL": 10} and made().count() == 10
    run(model(True))
    assert made().count() == made().distinct().count() == 40
    run(lambda prompts: 1 / 0)
    assert made().count() == 40
    assert {r.input[:8] for r in made().collect()} == {"uhm The "}


def test_shared_terms_and_inventory(spark):
    rows = [("a", i, "Then Maria paid 5,000 to them, said Bo" if i % 2 else "said Other" + chr(97 + i % 26), "in") for i in range(200)]
    rows += [("b", 1000 + i, "so Maria came, Bo" if i < 3 else "nothing 42 here", "in") for i in range(30)] + [("c", 2000, None, "in")]
    df = spark.createDataFrame(rows, "category string, line_no long, output string, input string").repartition(5)
    got = {r.term: (r.n, r.n_groups) for r in compare.shared_terms(df, "category", 0.1).collect()}
    assert got == {"Maria": (103, 2), "Bo": (103, 2)}
    assert {r.term for r in compare.shared_terms(df, "category", 0.1, 1).collect()} == {"Maria", "Bo", "5,000", "42"}
    assert compare.shared_terms(df.where("false"), "category").count() == 0
    with pytest.raises(ValueError, match="sketch"):
        compare.shared_terms(df.withColumn("output", F.lit(" ".join(map(str, range(300_000))))).limit(3), "category", 1e-9)
    found = {r.category: (r.n, r.state) for r in compare.inventory(df, "category", ["a", "b", "z"]).collect()}
    assert found == {"a": (200, "ok"), "b": (30, "ok"), "c": (1, "small"), "z": (0, "missing")}
    sample = compare.review_sample(df.fillna(""), "category", ["line_no"]).collect()
    assert sorted(r.category for r in sample) == ["a"] * 5 + ["b"] * 5 + ["c"]
