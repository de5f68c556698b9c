"""A pair table in numbered versions: rewrites and quarantine with one commit (SNK-05, 06, 14).

A version is a small manifest: of each category the folder that holds its rows, live ones and
rejected ones. A rewrite writes the changed categories only, beside what is there; the next
manifest names them and goes on naming the folders of the others. It becomes visible as a
whole, by a file that is created if it is absent: of two writers that started from one version the second
fails, and what it wrote is named by no version. Readers are bound to a manifest, so a rewrite never
changes what is being read. A commit that names a report demands that the report is complete.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "category string, line_no long, value string"


class ConflictError(RuntimeError):
    """Another writer made the next version first."""


class Versions:
    """Rows (``ROWS``) of categories under a root folder. Categories are configured names: manifests are small."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _manifests(self) -> dict[int, dict | None]:
        """Manifests by number; None for one whose commit broke off while it was written."""
        folder = self._path("versions")
        if not self.fs.exists(folder):
            return {}
        lines = self.spark.read.text(f"{self.root}/versions", wholetext=True).select("_metadata.file_name", "value").collect()
        found = {int(s.getPath().getName()[1:9]): None for s in self.fs.listStatus(folder)}
        for name, value in lines:
            try:
                found[int(name[1:9])] = json.loads(value)
            except ValueError:
                continue
        return found

    def current(self) -> int:
        """The number of the last version, 0 where there is none."""
        return max((n for n, m in self._manifests().items() if m is not None), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{live: {category: folder}, rejected: [[category, folder, version]], report} of a version."""
        all_ = self._manifests()
        version = max((n for n, m in all_.items() if m is not None), default=0) if version is None else version
        if version == 0:
            return {"live": {}, "rejected": [], "report": None}
        if all_.get(version) is None:
            raise ValueError(f"there is no version {version} of {self.root}")
        return all_[version]

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*[f"{self.root}/{f}" for f in sorted(set(folders))])

    def read(self, version: int | None = None) -> DataFrame:
        """The live rows of a version."""
        return self._rows(list(self.manifest(version)["live"].values()))

    def rejected(self, version: int | None = None) -> DataFrame:
        """The rows in quarantine, of all versions up to one."""
        return self._rows([folder for _, folder, _ in self.manifest(version)["rejected"]])

    def put(self, rows: DataFrame) -> dict[str, str]:
        """Write rows beside what is there; the folders of their categories, which no version names yet."""
        name = f"data/{uuid.uuid4().hex}"
        rows.select("category", "line_no", "value", F.col("category").alias("of")).write.partitionBy("of").parquet(f"{self.root}/{name}")
        folders = [s.getPath().getName() for s in self.fs.listStatus(self._path(name)) if s.isDirectory()]
        firsts = {f: self.spark.read.schema(ROWS).parquet(f"{self.root}/{name}/{f}").select("category").first() for f in folders}
        return {row["category"]: f"{name}/{f}" for f, row in firsts.items() if row}

    def commit(self, base: int, live: dict[str, str], rejected: list[list], report: str | None = None) -> int:
        """Make version base + 1 visible; ``ConflictError`` if it is there, ValueError if the report is not complete."""
        if report is not None and not self.fs.exists(self._path(f"{report}/_SUCCESS")):
            raise ValueError("reports come before a rewrite: there is no complete report")
        if self.current() != base:
            raise ConflictError(f"{self.root} is at version {self.current()}, not {base}")
        text = json.dumps({"base": base, "live": live, "rejected": rejected, "report": report})
        self.fs.mkdirs(self._path("versions"))
        try:
            out = self.fs.create(self._path(f"versions/v{base + 1:08d}.json"), False)
        except Py4JJavaError as e:
            raise ConflictError(f"version {base + 1} of {self.root} is being written or was broken off") from e
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return base + 1

    def create(self, rows: DataFrame) -> int:
        """The first version."""
        return self.commit(0, self.put(rows), [])

    def rewrite(self, base: int, gone: DataFrame, rejected: list[str], report: str | None) -> int:
        """The version after base: without the rows of gone (category, line_no), rejected categories in quarantine.

        Categories that lose no row keep their folders; those that lose all have none.
        """
        now = self.manifest(base)
        gone = gone.where(~F.col("category").isin(rejected)) if rejected else gone
        changed = sorted({r["category"] for r in gone.select("category").distinct().collect()} & set(now["live"]))
        live = {c: f for c, f in now["live"].items() if c not in rejected and c not in changed}
        if changed:
            rows = self._rows([now["live"][c] for c in changed])
            live |= self.put(rows.join(gone.distinct(), ["category", "line_no"], "left_anti"))
        quarantine = now["rejected"] + [[c, now["live"][c], base + 1] for c in rejected if c in now["live"]]
        return self.commit(base, live, quarantine, report)

    def discard_broken(self) -> list[int]:
        """Remove manifests whose commit broke off, for use when no writer is at work."""
        broken = [n for n, m in self._manifests().items() if m is None]
        for n in broken:
            self.fs.delete(self._path(f"versions/v{n:08d}.json"), False)
        return broken
