"""Sources (SRC): JSONL folders, tables, paired text files, chat records, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.jsonx import strict_strings
from skein.functions.text import last_content, normalize_text, strip

CHAT = "struct<messages: array<struct<role: string, content: string>>>"


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, file, size) of the files that a pattern names, hidden ones left out; no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    rows = [(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in found if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return spark.createDataFrame(rows, "path string, file string, size long")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, stem, line_no, value) of text files; numbers are those of physical lines, from 1.

    Files are split as Spark likes. Each split's lines are counted, and a line's
    number is the lines of the splits before its own and its place there; only
    the counts, a row for each split, are shuffled and sent out.
    """
    each = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    blocks = each.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block")) - F.col("n")
    placed = each.join(F.broadcast(blocks.select("path", "block", "first", before.alias("before"))), ["path", "block"])
    line_no = F.col("before") + F.col("id") - F.col("first") + 1
    return placed.select(F.element_at(F.split("path", "/"), -1).alias("file"), file_stem(F.col("path")).alias("stem"), line_no.cast("long").alias("line_no"), "value")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of splittable text files."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")


def jsonl_pairs(spark: SparkSession, path: str | list[str], rank: int, label: str, prefix: str = "", keep_blank: bool = True) -> DataFrame:
    """Pairs of JSONL files: input, output, source (label/category), category (stem less prefix), src_rank, file, line_no.

    Lines that are no object with both texts as strings are left out.
    keep_blank: whether pairs with a blank text stay.
    """
    parsed = numbered_lines(spark, path).withColumn("p", strict_strings(F.col("value"), ["input", "output"])).where("p is not null")
    pairs = parsed.select(
        "p.input",
        "p.output",
        F.concat(F.lit(f"{label}/"), F.regexp_replace("stem", f"^{prefix}", "")).alias("source"),
        F.regexp_replace("stem", f"^{prefix}", "").alias("category"),
        F.lit(rank).alias("src_rank"),
        "file",
        "line_no",
    )
    return pairs if keep_blank else pairs.where((strip(F.col("input")) != "") & (strip(F.col("output")) != ""))


def raw_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl_pairs(spark, f"{folder}/*.jsonl", 0, "raw").withColumn("category", F.lit(None).cast("string"))


def synthetic_files(spark: SparkSession, folder: str, rejected: DataFrame | None = None, configured: list[str] | None = None) -> DataFrame:
    """The listing of synthetic_*.jsonl less rejected names, of configured categories only."""
    files = listing(spark, f"{folder}/synthetic_*.jsonl")
    if configured is not None:
        names = spark.createDataFrame([(f"synthetic_{c}.jsonl",) for c in configured], "file string")
        files = files.join(names, "file", "left_semi")
    return files.join(rejected.select("file"), "file", "left_anti") if rejected is not None else files


def synthetic_pairs(spark: SparkSession, folder: str, rejected: DataFrame | None = None, configured: list[str] | None = None) -> DataFrame:
    """Pairs of the files of ``synthetic_files``: the others are neither opened nor counted."""
    paths = sorted(r["path"] for r in synthetic_files(spark, folder, rejected, configured).select("path").collect())
    if not paths:
        return spark.createDataFrame([], "input string, output string, source string, category string, src_rank int, file string, line_no long")
    return jsonl_pairs(spark, paths, 1, "synthetic", "synthetic_")


def prepared_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl_pairs(spark, f"{folder}/*.jsonl", 2, "prepared")


def tabular_pairs(splits: list[DataFrame], input_column: str, output_column: str) -> DataFrame:
    """Pairs of all splits of a table, normalised, blank ones left out; missing columns and no rows are errors."""
    out = None
    for rows in splits:
        if missing := {input_column, output_column} - set(rows.columns):
            raise ValueError(f"columns {sorted(missing)} are not among {rows.columns}")
        rows = rows.select(normalize_text(F.col(input_column)).alias("input"), normalize_text(F.col(output_column)).alias("output"))
        out = rows if out is None else out.unionByName(rows)
    out = out.where("input <> '' and output <> ''")
    if out.isEmpty():
        raise ValueError("the table has no pairs")
    return out


def text_files(spark: SparkSession, root: str) -> DataFrame:
    """(key, text) of all text files below a folder; the key is the path below it without suffix."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    base = root.rstrip("/").split("://")[-1].lstrip("/")
    return files.select(F.regexp_replace(F.regexp_replace(path, rf"^.*?\Q{base}\E/", ""), r"\.txt$", "").alias("key"), normalize_text(F.col("value")).alias("text"))


def chat_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, input, expected) of chat records: the last user and assistant messages, blank ones left out."""
    return chat_pairs_of(numbered_lines(spark, path))


def chat_pairs_of(rows: DataFrame) -> DataFrame:
    messages = F.from_json("value", CHAT)["messages"]
    found = rows.withColumn("input", last_content(messages, "user")).withColumn("expected", last_content(messages, "assistant"))
    return found.where("trim(input) <> '' and trim(expected) <> ''").drop("value")


def first_prompts(rows: DataFrame, fallback: DataFrame, k: int = 5) -> DataFrame:
    """k prompts (prompt), the first of rows, topped up from fallback: a feature with a limit."""
    some = rows.select("prompt", F.lit(0).alias("o"), "ord").unionByName(fallback.select("prompt", F.lit(1).alias("o"), "ord"))
    return some.orderBy("o", "ord").limit(k).select("prompt")


#: Folders of the two sides of paired text files (fixed values).
MESSY_FOLDER, CLEAN_FOLDER = "whisper-transcripts", "manual-cleanups"


def source_root(spark: SparkSession, root: str) -> str:
    """The folder that holds both sides' folders: ``data`` or ``dataset/data`` below root, else the first that is found level by level."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    both = lambda f: all(fs.exists(path(f"{f}/{side}")) for side in (MESSY_FOLDER, CLEAN_FOLDER))
    if found := next((f for f in (f"{root}/data", f"{root}/dataset/data") if both(f)), None):
        return found
    level = [root]
    while level:
        if found := next((f for f in level if both(f)), None):
            return found
        level = sorted(s.getPath().toString() for f in level for s in fs.listStatus(path(f)) if s.isDirectory())
    raise FileNotFoundError(f"no folder below {root} holds {MESSY_FOLDER} and {CLEAN_FOLDER}")


def given_pairs(rows: DataFrame) -> DataFrame:
    """Pairs to judge (pair_index from 0, input, output) of numbered lines that are pairs; the judge's input without files."""
    parsed = rows.withColumn("p", strict_strings(F.col("value"), ["input", "output"])).where("p is not null")
    return parsed.select((F.col("line_no") - 1).cast("int").alias("pair_index"), "p.input", "p.output")


def split_problems(rows: DataFrame, wanted: tuple[str, ...] = ("train", "valid")) -> DataFrame:
    """(split, problem): wanted splits of rows (split, line_no, value) that are not there, or whose first line is no chat record."""
    splits = rows.sparkSession.createDataFrame([(s,) for s in wanted], "split string")
    firsts = rows.groupBy("split").agg(F.min_by("value", "line_no").alias("value"))
    found = splits.join(firsts, "split", "left")
    good = F.coalesce(F.size(F.from_json("value", CHAT)["messages"]) > 0, F.lit(False))
    return found.select("split", F.when(F.col("value").isNull(), "missing").when(~good, "no chat record").alias("problem")).where("problem is not null")


def sides(script: DataFrame, prompt: DataFrame, names: tuple[str, str] = ("script", "prompt")) -> DataFrame:
    """Two corpora as one, with dataset."""
    return script.withColumn("dataset", F.lit(names[0])).unionByName(prompt.withColumn("dataset", F.lit(names[1])), allowMissingColumns=True)


def optional_json(spark: SparkSession, path: str) -> DataFrame | None:
    """One JSON file, None where it is absent or broken."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.option("multiLine", "true").json(path)
    except AnalysisException:
        return None
    return None if "_corrupt_record" in found.columns or not found.columns else found


def record_counts(rows: DataFrame) -> DataFrame:
    """Per file the four counts: lines, lines that are not blank, objects with the keys, strict pairs."""
    value = F.col("value")
    keys = F.from_json(value, "map<string,string>")
    return rows.groupBy("file").agg(
        F.count("*").alias("lines"),
        F.count_if(strip(value) != "").alias("non_blank"),
        F.count_if(F.map_contains_key(keys, "input") & F.map_contains_key(keys, "output")).alias("with_keys"),
        F.count_if(strict_strings(value, ["input", "output"]).isNotNull()).alias("strict"),
    )


def require_chat_schema(rows: DataFrame) -> None:
    """Raise unless the first line has messages."""
    first = rows.select(F.from_json("value", CHAT)["messages"].alias("m")).limit(1).collect()
    if not first or not first[0]["m"]:
        raise ValueError("no chat record in the first line")


def paths(root: str) -> dict:
    """Names of raw, synthetic and combined outputs."""
    return {
        "raw": lambda slug: f"{root}/raw/{slug}.jsonl",
        "synthetic": lambda category: f"{root}/synthetic/synthetic_{category}.jsonl",
        "combined": f"{root}/synthetic/synthetic_combined.jsonl",
    }


def system_prompt(text: str, no_think: bool = False) -> str:
    return text.strip() + ("\n/no_think" if no_think else "")
