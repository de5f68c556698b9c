"""Sinks (SNK). Spark's commit makes a folder appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions.jsonx import to_json_line
from skein.sources.readers import numbered_lines


def write_jsonl(rows: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> int:
    """Rows as JSON lines; returns how many were written."""
    seen = Observation()
    line = rows.select(to_json_line(*[F.col(c) for c in columns or rows.columns]).alias("value"))
    line.observe(seen, F.count("*").alias("n")).write.mode(mode).text(path)
    return seen.get["n"]


def write_jsonl_file(rows: DataFrame, path: str, columns: list[str] | None = None) -> int:
    """Rows as the lines of one file, which is there whole or not at all; one task writes it.

    For outputs that have to be a single file, such as a category's. It is
    written beside its place and renamed; what an error leaves is removed.
    """
    spark = rows.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to, beside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}.tmp"))
    fs = to.getFileSystem(conf)
    try:
        n = write_jsonl(rows.coalesce(1), beside.toString(), columns)
        part = next((s.getPath() for s in fs.listStatus(beside) if s.getPath().getName().startswith("part-")), None)
        fs.mkdirs(to.getParent())
        fs.delete(to, False)
        if part is None:
            fs.create(to).close()
        elif not fs.rename(part, to):
            raise OSError(f"could not move lines to {path}")
        return n
    finally:
        fs.delete(beside, True)


def append_pairs(pairs: DataFrame, path: str) -> None:
    """Pairs appended to their category's folder."""
    pairs.write.mode("append").partitionBy("category").json(path)


def combined(pairs: DataFrame, order: list[str]) -> DataFrame:
    """value: the lines of all categories that are not blank, in the order of the categories."""
    rank = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("category"))
    return pairs.where("trim(value) <> ''").orderBy(rank, "line_no").select("value")


def write_ordered(lines: DataFrame, path: str) -> DataFrame:
    """Sorted lines (value) as text files that follow one another, and their manifest (file, n, first), which is returned.

    Tasks write as many files as the sort has ranges; the manifest says how many lines each has
    and the place of its first one, so that no task writes, and no reader counts, all lines. It lies in a folder
    that readers of text skip.
    """
    spark = lines.sparkSession
    lines.write.mode("errorifexists").option("lineSep", "\n").text(path)
    counts = spark.read.option("lineSep", "\n").text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.orderBy("file")) - F.col("n")  # a row for each file, whose names have the order of the ranges
    counts.select("file", "n", first.alias("first")).coalesce(1).write.json(f"{path}/_manifest")
    return spark.read.schema("file string, n long, first long").json(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """(place, value) of what ``write_ordered`` wrote: places from 0 over all files."""
    manifest = spark.read.schema("file string, n long, first long").json(f"{path}/_manifest")
    return numbered_lines(spark, path).join(F.broadcast(manifest), "file").select((F.col("first") + F.col("line_no") - 1).alias("place"), "value")


def rewrite_without(lines: DataFrame, gone: DataFrame, path: str, version: int) -> str:
    """Lines (category, line_no, value) less those of gone, written beside the old version; returns the new folder."""
    to = f"{path}/v{version}"
    lines.join(gone.distinct(), ["category", "line_no"], "left_anti").orderBy("category", "line_no").write.mode("errorifexists").partitionBy("category").json(to)
    return to


def quarantine(pairs: DataFrame, decisions: DataFrame, path: str, version: int) -> str:
    """Pairs of rejected categories in a folder of their own; an old one is never overwritten."""
    to = f"{path}/rejected_{version}"
    rejected = decisions.where("decision = 'reject'").select("category")
    pairs.join(rejected, "category", "left_semi").write.mode("errorifexists").partitionBy("category").json(to)
    return to


def next_version(names: DataFrame, prefix: str) -> int:
    """One more than the greatest number after a prefix among names (name)."""
    n = F.regexp_extract("name", rf"^{prefix}(\d+)$", 1).try_cast("int")
    return (names.agg(F.max(n)).first()[0] or 0) + 1


def report_json(row: DataFrame) -> DataFrame:
    """One JSON value of one row."""
    return row.select(to_json_line(*[F.col(c) for c in row.columns]).alias("value"))


def fixed_width(rows: DataFrame, widths: dict[str, int]) -> DataFrame:
    """line: columns cut or padded to their widths; numbers to the right."""
    kinds = dict(rows.dtypes)
    cells = [(F.rpad if kinds[c] == "string" else F.lpad)(F.coalesce(F.col(c).cast("string"), F.lit("-")), w, " ") for c, w in widths.items()]
    return rows.select(F.concat_ws("  ", *cells).alias("line"))
