"""Sources, sinks, plans, control plane, streaming, and the entry module."""

import datetime
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skein.functions.text import chat_messages
from skein.operators import synth
from skein.plans import config, control, gate
from skein.plans import queries as reference
from skein.plans.evaluate import acceptance, card, evaluate
from skein.plans.prepare import prepare, write_prepared
from skein.sources import readers, writers
from skein.streaming import ingest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Queries whose SQL is asked as well; the driver asks all.
CHECKED = ["synthetic_files_opened", "clean_texts_bounded", "gated_version", "model_calls", "stream_deduped_within_watermark", "stream_step_states", "ab_compare", "shared_terms", "review_sample", "generated_pairs", "still_needed", "batch_sizes", "cer_summary", "synthetic_pairs_read", "prepared_pairs_read", "paired_text_files", "combined_lines", "rewritten_lines", "gate_report", "verdicts", "quotas_filled", "messified", "judged_batch", "comparison_lines", "step_state", "steps_dry_run", "step_artifacts", "stream_best_loss", "wer", "chat_records", "dedup_first_occurrence", "quality_reasons", "split_assign", "made_up_words", "filler_positions", "cer", "sentence_bleu", "gate_decisions", "quota_plan", "train_log_parse", "dag_resume", "stream_dedup_available_now"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, duck, name):
    df = reference.queries()[name](spark, sf)
    said = duck.execute(reference.oracle_sql()[name])
    columns = [d[0] for d in said.description]
    assert sorted(columns) == sorted(df.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert got == sorted(repr([plain(v) for v in r]) for r in said.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_sources_to_splits(spark, tmp_path):
    raw, synthetic, prepared = (tmp_path / n for n in ("raw", "synthetic", "prepared"))
    for p in (raw, synthetic, prepared):
        p.mkdir()
    line = lambda i, o: json.dumps({"input": i, "output": o})
    write(raw, "a.jsonl", line("hello world one", "Hello world one."), "", "{bad", line("too", "much " * 9), '{"input":5,"output":"x"}')
    write(synthetic, "synthetic_meeting_notes.jsonl", line("Hello  World One", "Hello world one!"), line("another pair here", "Another pair here."))
    write(synthetic, "synthetic_odd.jsonl", line("not configured", "Not configured."))
    write(prepared, "shopping_lists.jsonl", line("milk and eggs", "Milk and eggs."))
    s = readers.synthetic_pairs(spark, str(synthetic), configured=["meeting_notes"])
    done = prepare(readers.raw_pairs(spark, str(raw)), s, readers.prepared_pairs(spark, str(prepared)))
    assert done.validated.count() == 5
    got = {r.input: (r.source, r.line_no) for r in done.accepted.collect()}
    assert got == {"hello world one": ("raw/a", 1), "another pair here": ("synthetic/meeting_notes", 2), "milk and eggs": ("prepared/shopping_lists", 1)}
    assert sum(write_prepared(done, str(tmp_path / "out")).values()) == 3
    with pytest.raises(FileExistsError):
        write_prepared(done, str(tmp_path / "out"))
    assert sum(write_prepared(done, str(tmp_path / "out"), force=True).values()) == 3
    back = readers.chat_pairs(spark, str(tmp_path / "out" / "*.jsonl" / "*.txt"))
    assert {r.input for r in back.collect()} == set(got)
    rejected = spark.createDataFrame([("synthetic_meeting_notes.jsonl",)], "file string")
    assert readers.synthetic_pairs(spark, str(synthetic), rejected, ["meeting_notes"]).count() == 0
    counts = {r.file: r for r in readers.record_counts(readers.numbered_lines(spark, str(raw / "*.jsonl"))).collect()}["a.jsonl"]
    assert (counts.non_blank, counts.strict) == (4, 2)


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    """Files of many splits, one without a last line feed, one empty; blank lines and carriage returns count."""
    lines = [f"{i} " + "x" * (i % 90) + ("\r" if i % 7 == 0 else "") if i % 5 else "" for i in range(4000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n", newline="")
    (tmp_path / "b.txt").write_text("\n".join(lines[:1500]), newline="")
    (tmp_path / "c.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path / "*.txt"))
        got = {(r.file, r.line_no): r.value for r in rows.collect()}
        assert rows.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {("a.txt", i + 1): x for i, x in enumerate(lines)} | {("b.txt", i + 1): x for i, x in enumerate(lines[:1500])}
    assert got == want


def test_single_files(spark, tmp_path):
    rows = spark.range(5).selectExpr("id", "cast(null as string) AS x")
    path = f"{tmp_path}/d/out.jsonl"
    assert writers.write_jsonl_file(rows, path) == 5 and writers.write_jsonl_file(rows.where("id < 2"), path) == 2
    assert (tmp_path / "d" / "out.jsonl").read_text() == '{"id":0,"x":null}\n{"id":1,"x":null}\n'
    with pytest.raises(Exception, match="boom"):
        writers.write_jsonl_file(rows.selectExpr("raise_error('boom') AS y"), path)
    assert [p.name for p in (tmp_path / "d").iterdir() if not p.name.startswith(".")] == ["out.jsonl"]
    assert writers.write_jsonl_file(rows.where("false"), f"{tmp_path}/none.jsonl") == 0 and (tmp_path / "none.jsonl").read_text() == ""


def test_source_root(spark, tmp_path):
    for name in ("x/y/whisper-transcripts", "x/y/manual-cleanups", "x/whisper-transcripts"):
        (tmp_path / name).mkdir(parents=True)
    assert readers.source_root(spark, str(tmp_path)).endswith("/x/y")
    for name in ("dataset/data/whisper-transcripts", "dataset/data/manual-cleanups"):
        (tmp_path / name).mkdir(parents=True)
    assert readers.source_root(spark, str(tmp_path)) == f"{tmp_path}/dataset/data"
    with pytest.raises(FileNotFoundError):
        readers.source_root(spark, f"{tmp_path}/x/y/manual-cleanups")


def test_state_files(spark, tmp_path):
    path = f"{tmp_path}/state.jsonl"
    assert control.load_state(spark, path).count() == 0
    state = control.mark(control.load_state(spark, path), "2", "running")
    assert control.save_state(state, path) == 1 and control.load_state(spark, path).first().status == "running"
    for i, broken in enumerate(('{"step_id": "2", "status": "odd"}\n', "not json\n")):
        (tmp_path / f"broken{i}.jsonl").write_text(broken)
        assert control.load_state(spark, f"{tmp_path}/broken{i}.jsonl").count() == 0


def test_configuration_text():
    pytest.importorskip("yaml")
    cfg = config.load_yaml("models: [{name: a, base_model: b}]\ndataset: {seed: 7, synthetic: {enabled: false}}\nunknown: 1\n")
    assert cfg.dataset.seed == 7 and cfg.models[0].name == "a" and not cfg.dataset.synthetic.enabled
    for bad in ("- 1", "models: []"):
        with pytest.raises(ValueError):
            config.load_yaml(bad)


def test_command_line(spark, sf, tmp_path, capsys):
    from skein.__main__ import main

    assert main([]) == 0 and "chat_records" in capsys.readouterr().out
    assert main(["nope", "--sf", sf, "--out", str(tmp_path)]) == 2
    assert main(["source_stats", "--sf", sf, "--out", str(tmp_path)]) == 0
    assert main(["source_stats", "--sf", sf, "--out", str(tmp_path)]) == 1  # kept
    assert main(["source_stats", "--sf", f"{tmp_path}/none", "--out", str(tmp_path), "--force"]) == 1
    assert main(["source_stats", "--sf", sf, "--dry-run"]) == 0


def test_paired_files_and_tables(spark, tmp_path):
    for side, names in (("t", ["a/x", "b"]), ("c", ["a/x", "z"])):
        for n in names:
            p = tmp_path / side / f"{n}.txt"
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(f"{side} {n}\r\n")
    t, c = (readers.text_files(spark, str(tmp_path / s)) for s in ("t", "c"))
    assert [(r.key, r.text) for r in t.orderBy("key").collect()] == [("a/x", "t a/x"), ("b", "t b")]
    assert t.join(c, "key").count() == 1
    rows = spark.createDataFrame([("a ", "b"), (" ", "c")], "q string, r string")
    assert [tuple(r) for r in readers.tabular_pairs([rows, rows], "q", "r").distinct().collect()] == [("a", "b")]
    with pytest.raises(ValueError):
        readers.tabular_pairs([rows], "q", "nope")
    assert readers.optional_json(spark, str(tmp_path / "none.json")) is None


def test_sinks(spark, tmp_path):
    pairs = spark.createDataFrame([("a", 1, "é"), ("a", 2, None), ("b", 1, "y")], "category string, line_no int, value string")
    assert writers.write_jsonl(pairs, str(tmp_path / "o")) == 3
    assert '{"category":"a","line_no":2,"value":null}' in [r.value for r in spark.read.text(str(tmp_path / "o")).collect()]
    gone = spark.createDataFrame([("a", 1)], "category string, line_no int")
    assert spark.read.json(writers.rewrite_without(pairs, gone, str(tmp_path / "v"), 2)).count() == 2
    decisions = spark.createDataFrame([("b", "reject")], "category string, decision string")
    assert spark.read.json(writers.quarantine(pairs, decisions, str(tmp_path), 1)).count() == 1
    assert writers.next_version(spark.createDataFrame([("rejected_1",), ("rejected_7",), ("x",)], "name string"), "rejected_") == 8
    assert [r.value for r in writers.combined(pairs, ["b", "a"]).collect()] == ["y", "é"]
    assert writers.fixed_width(pairs.where("category = 'b'"), {"category": 4, "line_no": 3}).first().line == "b" + " " * 7 + "1"


def test_gate_with_replay(spark, tmp_path):
    pairs = spark.createDataFrame([("a", i, f"in {i}") for i in range(20)], "category string, line_no int, input string")
    good = '{"input_realistic": true, "content_preserved": true, "no_hallucination": true, "corrections_applied": true}'
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(prompts):
        import uuid

        (calls / uuid.uuid4().hex).write_text(str(len(prompts)))
        return [None if p.endswith("3") else good.replace("true", "false") if p.endswith("4") else good for p in prompts]

    verdicts = gate.verdicts_once(pairs, str(tmp_path / "v"), 1.0, F.concat(F.lit("judge "), "input"), model)
    n_calls = len(list(calls.iterdir()))
    decisions, kept = gate.gate(pairs, verdicts, 0.75, 0.5)
    assert decisions.first().decision == "pass" and decisions.first().pass_rate == 0.8
    assert kept.count() == 18 and gate.report(verdicts, pairs).count() == 1
    assert len(list(calls.iterdir())) == n_calls
    prompt = F.concat(F.lit("judge "), "input")
    said = pairs.select(F.sha2(prompt, 256).alias("prompt_hash"), F.lit(good).alias("raw")).limit(5)
    assert gate.replayed_verdicts(pairs, said, prompt).where("not parse_error").count() == 5


def test_generation(spark):
    answers = spark.createDataFrame([("x", '[{"transcript": "um hello there", "output": "Hello there."}, {"transcript": "", "output": "x"}, 5]'), ("y", "no")], "category string, raw string")
    assert [r.reason for r in synth.generated_pairs(answers).collect()] == [None, "empty_transcript", "empty_transcript"]
    texts = spark.createDataFrame([("c", i, f"Clean text {i}.") for i in range(5)], "category string, ord int, text string")
    got = synth.messify(texts, lambda ps: ['[{"transcript": "um clean text zero"}, {"transcript": "uh clean text one"}]'] * len(ps), ["ord"], "Make messy:\n{texts}", size=3)
    assert got.count() == 4 and got.where("reason is null").count() == 4
    tries = []

    def flaky(prompts):
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return prompts

    assert synth.with_retries(flaky, wait=0)(["a"]) == ["a"] and len(tries) == 3
    messages = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in (("system", "a"), ("user", "b"), ("system", "c"))])
    row = spark.range(1).select(synth.split_system(messages).alias("x")).first().x
    assert row.system == "a\n\nc" and [m.content for m in row.messages] == ["b"]


def test_evaluation(spark):
    rows = spark.createDataFrame([(0, "um a", "A b c d.", "A b c d.", 1.0, 10), (1, "x", "five", "<think>t</think> six", 1.0, 20)], "index int, input string, expected string, raw_generated string, generation_seconds double, generated_token_count long")
    done = evaluate(rows, 1)
    s = done.summary.first()
    assert (s.n, s.exact_count, s.think_count, s.total_tokens, s.tokens_per_second) == (2, 1, 1, 30, 15.0)
    assert done.best.first()["index"] == 0 and done.worst.first()["index"] == 1
    assert acceptance(done.summary).first().cer_ok is False
    assert "CER" in card("m", "b", {"CER": 0.1, "x": None}) and "Metric" not in card("m", "b", None)


def test_config():
    good = {"models": [{"name": "m", "base_model": "b"}], "unknown": 1, "dataset": {"train_ratio": 0.8, "valid_ratio": 0.1, "test_ratio": 0.1}}
    cfg = config.load(good)
    assert cfg.dataset.train_ratio == 0.8 and config.enabled_models(cfg)[0].name == "m"
    assert config.overridden(cfg, num_samples=7).dataset.synthetic.num_samples == 7
    for bad in (
        {"platform": "dos"}, {"models": []}, {"models": [{"name": "m"}]}, {"dataset": {"train_ratio": 0.5}}, {"dataset": {"synthetic": {"num_samples": 0}}}, {"dataset": {"synthetic": {"categories": {"a": 0.5}}}},
        {"dataset": {"synthetic": {"validation": {"sample_rate": 0}}}}, {"dataset": {"synthetic": {"validation": {"pass_threshold": 0.5}}}}, {"quantization": {"bits": 0}}, {"training": {"lora_rank": 0}},
    ):
        with pytest.raises(ValueError):
            config.load(good | bad)


def test_control(spark):
    defs = control.steps(spark, validation=True)
    assert [r.step_id for r in control.requested(defs, None).collect()] == ["2", "3", "3b", "4", "5", "6", "7", "8", "9"]
    assert [r.step_id for r in control.requested(defs, ["9", "2", "2"]).collect()] == ["2", "9"]
    for wrong in (["77"], ["10", "9"]):
        with pytest.raises(ValueError):
            control.requested(defs, wrong)
    done = spark.createDataFrame([("2",)], "step_id string")
    assert [tuple(r) for r in control.missing_dependencies(control.requested(defs, ["4"]), done).collect()] == [("4", "3b")]
    state = spark.createDataFrame([("2", "failed", None, None, None, "boom")], control.STATE)
    at = F.lit(datetime.datetime(2024, 1, 1))
    running = control.mark(state, "2", "running", at)
    row = control.mark(running, "2", "completed", F.lit(datetime.datetime(2024, 1, 1, 0, 0, 5))).first()
    assert (row.status, row.duration_seconds, row.error) == ("completed", 5.0, None)
    assert control.command("9", {"model": "m", "force": True, "yes": True, "base": False}) == ["--model", "m", "--force"]
    assert control.clear(state, ["2"]).count() == 0


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, "a.jsonl", '{"input":"A b","output":"x"}', '{"input":"a  B","output":"y"}', "{bad", '{"input":1,"output":"y"}')
    pairs = ingest.distinct_stream(ingest.pair_stream(spark, str(folder)))
    ingest.run_available(pairs, str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    write(folder, "b.jsonl", '{"input":" a b ","output":"x"}', '{"input":"new","output":"y"}')
    pairs = ingest.distinct_stream(ingest.pair_stream(spark, str(folder)))
    ingest.run_available(pairs, str(tmp_path / "out"), str(tmp_path / "check"))
    assert sorted(r.input.lower() for r in spark.read.parquet(str(tmp_path / "out")).collect())[-1] == "new"
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_rest_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "skein", tmp_path / "skein", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q))"], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.stdout.split()[1:] == ["False"], said.stderr


def test_messages(spark):
    assert [m.role for m in spark.range(1).select(chat_messages("s", F.lit("u"), F.lit("a")).alias("m")).first().m] == ["system", "user", "assistant"]
