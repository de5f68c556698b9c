"""Control plane: steps, their state, dependencies and resume (DAG, J-10, STM-06, STM-07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.writers import write_jsonl_file

#: (step, name, needs, flags passed on, part of a full run), in running order.
STEPS = [
    ("2", "Pull datasets", [], ["force"], True),
    ("3", "Generate synthetic data", [], ["synthetic_samples", "force"], True),
    ("3b", "Validate synthetic data", ["3"], ["sample_rate", "force", "yes"], True),
    ("4", "Prepare training data", ["2"], ["force"], True),
    ("5", "Download models", [], ["model", "force"], True),
    ("6", "Fine-tune models", ["4", "5"], ["model", "force", "resume"], True),
    ("7", "Fuse and convert models", ["6"], ["model", "force"], True),
    ("8", "Quantize models", ["7"], ["model", "force"], True),
    ("9", "Evaluate models", ["8"], ["model", "force", "base"], True),
    ("10", "Upload", ["9"], ["model", "force"], False),
]
HINTS = {"2": "Check access to the sources.", "3": "Check the provider's key and budget.", "3b": "Look at the validation report.", "4": "Check that steps 2 and 3 wrote pairs.", "9": "Check the model folder."}

STATE = "step_id string, status string, started_at timestamp, completed_at timestamp, duration_seconds double, error string"


def steps(spark: SparkSession, validation: bool = False, synthetic: bool = False, base: bool = False) -> DataFrame:
    """step_id, ord, name, deps, forwards, include_in_all. Step 4 also waits for what feeds it; step 9 on a base model for nothing."""
    rows = [(s, i, n, d, f, a) for i, (s, n, d, f, a) in enumerate(STEPS)]
    out = spark.createDataFrame(rows, "step_id string, ord int, name string, deps array<string>, forwards array<string>, include_in_all boolean")
    more = ["3b"] if validation else ["3"] if synthetic else []
    four = F.concat("deps", F.array(*[F.lit(x) for x in more]).cast("array<string>"))
    nine = F.array(F.lit("5")) if base else F.col("deps")
    return out.withColumn("deps", F.when(F.col("step_id") == "4", four).when(F.col("step_id") == "9", nine).otherwise(F.col("deps")))


def requested(defs: DataFrame, wanted: list[str] | None) -> DataFrame:
    """Definitions of the wanted steps (None: all of a full run), each once, in running order."""
    if wanted is None:
        return defs.where("include_in_all").orderBy("ord")
    known = {r["step_id"] for r in defs.select("step_id").collect()}
    if unknown := [w for w in wanted if w not in known]:
        raise ValueError(f"unknown steps {unknown}; there are {sorted(known)}")
    if "10" in wanted and len(set(wanted)) > 1:
        raise ValueError("step 10 runs alone")
    return defs.where(F.col("step_id").isin(wanted)).orderBy("ord")


def dry_run(wanted: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """(step_id, ord, name, action): what a run would do, with nothing done: run, skip, or wait for needs that are not met."""
    lacks = missing_dependencies(wanted, done).groupBy("step_id").agg(F.array_join(F.array_sort(F.collect_list("dep")), ", ").alias("lacks"))
    known = done.select("step_id", F.lit(True).alias("is_done")).distinct()
    rows = wanted.join(known, "step_id", "left").join(lacks, "step_id", "left")
    skip = F.lit(False) if force else F.coalesce("is_done", F.lit(False))
    action = F.when(skip, "skip").when(F.col("lacks").isNotNull(), F.concat(F.lit("needs "), "lacks")).otherwise("run")
    return rows.select("step_id", "ord", "name", action.alias("action"))


def missing_dependencies(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """(step_id, dep): needs of wanted steps that are neither wanted nor done."""
    met = wanted.select(F.col("step_id").alias("dep")).unionByName(done.select(F.col("step_id").alias("dep"))).distinct()
    return wanted.select("step_id", F.explode("deps").alias("dep")).join(met, "dep", "left_anti").select("step_id", "dep")


def done_steps(state: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Steps completed by state or with artifacts."""
    return state.where("status = 'completed'").select("step_id").unionByName(artifacts.select("step_id")).distinct()


#: What each step leaves behind, below the project's folder: one file with content is enough.
ARTIFACTS = {
    "2": ["data/raw/*.jsonl"],
    "3": ["data/synthetic/all_synthetic.jsonl"],
    "3b": ["data/synthetic/validation_report.json"],
    "4": ["data/combined/train.jsonl"],
    "5": ["models/base/*/config.json"],
    "6": ["models/adapters/*/config.json"],
    "7": ["models/fused/*/config.json", "models/mlx/*/config.json"],
    "8": ["models/quantized/*/config.json"],
    "9": ["eval_results/*/eval_summary.json"],
}


def artifacts(spark: SparkSession, root: str) -> DataFrame:
    """step_id of the steps that left a file with content, in any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda pattern: any(s.isDirectory() or s.getLen() > 0 for s in fs.globStatus(path(f"{root}/{pattern}")) or [])
    found = [(step,) for step, patterns in ARTIFACTS.items() if any(map(there, patterns))]
    return spark.createDataFrame(found, "step_id string")


STATUSES = ("running", "completed", "failed")


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The saved state; none where there is no file, or one whose lines are not steps with a known status."""
    from pyspark.errors import AnalysisException

    none = spark.createDataFrame([], STATE)
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return none
    rows = lines.select(F.from_json("value", STATE, {"mode": "PERMISSIVE"}).alias("s")).select("s.*")
    odd = rows.where("step_id is null").unionByName(rows.where(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))))
    return none if not odd.isEmpty() else rows


def save_state(state: DataFrame, path: str) -> int:
    """The state as one file of JSON lines, there whole or not at all."""
    return write_jsonl_file(state, path)


def to_run(wanted: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    return wanted if force else wanted.join(done.select("step_id"), "step_id", "left_anti").orderBy("ord")


def mark(state: DataFrame, step_id: str, status: str, at: Column | None = None, error: str | None = None) -> DataFrame:
    """state with a step's new status; fields of an older run are cleared."""
    at = F.current_timestamp() if at is None else at
    rest = state.where(F.col("step_id") != step_id)
    old = state.where(F.col("step_id") == step_id)
    start = state.sparkSession.range(1).select(F.lit(step_id).alias("step_id")).join(old.select("step_id", F.col("started_at").alias("began")), "step_id", "left")
    began = at if status == "running" else F.col("began")
    ended = F.lit(None).cast("timestamp") if status == "running" else at
    seconds = ended.cast("double") - began.cast("double")
    new = start.select("step_id", F.lit(status).alias("status"), began.alias("started_at"), ended.alias("completed_at"), seconds.alias("duration_seconds"), F.lit(error).cast("string").alias("error"))
    return rest.select(*new.columns).unionByName(new)


def clear(state: DataFrame, step_ids: list[str]) -> DataFrame:
    return state.where(~F.col("step_id").isin(step_ids))


def command(step_id: str, flags: dict[str, object]) -> list[str]:
    """Arguments of a step: only flags that it takes."""
    takes = next(f for s, _, _, f, _ in STEPS if s == step_id)
    out: list[str] = []
    for name, value in flags.items():
        if name in takes and value not in (None, False):
            out += [f"--{name.replace('_', '-')}"] + ([] if value is True else [str(value)])
    return out


def hint(step_id: str) -> str:
    return HINTS.get(step_id, "See the step's log.")
