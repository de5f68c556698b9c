"""License scans by canonical digest lookup (built-in functions only).

A text is put into canonical form: lower case, copyright lines dropped, every
ASCII punctuation mark a space, equivalent spellings made one, spaces
collapsed. Two texts that differ only in those respects have one digest, so a
hash join of digests finds every known licence text.

Two units of a document are looked up: its entire text, and each entire line
(a notice such as "Released under the MIT License."). Only lines with the
canonical length of some known text are hashed; others cannot have its digest.

Defined results: null or empty text, and text with nothing but punctuation or
copyright lines, has null digest, null license_id and no notices. Repeated
rows, and rows with a null doc_id, each give a row of their own. Two licence
ids with one canonical text: the smaller id. Extra input columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.license_texts import DIGESTS, KNOWN, SPELLINGS

#: Lines that only name who holds the rights.
RIGHTS_LINE = r"(?m)^[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: ASCII characters other than line feed, digits and lower-case letters.
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
#: British -ise endings; both sides of the join pass through this rule.
ISE = r"([a-z]{2})is(e|ed|es|er|ing|ation|ations)\b"

#: More known texts than this are joined by shuffle instead of by broadcast.
BROADCAST_ROWS = 20_000


def canonical_lines(text: Column) -> Column:
    """The non-empty lines of a text in canonical form, as an array."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), RIGHTS_LINE, "")
    out = F.regexp_replace(out, PUNCTUATION, " ")
    out = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, out)
    out = F.regexp_replace(out, ISE, "$1iz$2")
    lines = F.transform(F.split(out, "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def known_digests(known: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """(digest, license_id, n_chars) of a table of (license_id, text), and of digests (license_id, digest, n_chars) found before."""
    whole = known.select("license_id", F.array_join(canonical_lines(F.col("text")), " ").alias("canonical"))
    each = whole.where("license_id is not null and canonical <> ''").select("license_id", F.sha2("canonical", 256).alias("digest"), F.length("canonical").alias("n_chars"))
    if digests is not None:
        each = each.unionByName(digests)
    return each.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.min("n_chars").alias("n_chars"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: DataFrame | None = None) -> DataFrame:
    """Per row of docs: its id, canonical_sha256, license_id (entire text) and notices.

    ``known`` has license_id and text, ``digests`` those whose texts are not at hand. notices: the sorted, comma-joined ids
    found as entire lines, '' if none; n_notices counts those lines.
    """
    digests = known_digests(known, digests)
    spark = docs.sparkSession
    bound = digests.agg(F.count("*").alias("n"), F.collect_set("n_chars").alias("lengths")).first()
    if bound["n"] <= BROADCAST_ROWS:
        rows = [(r["digest"], r["license_id"]) for r in digests.select("digest", "license_id").collect()]
        digests = F.broadcast(spark.createDataFrame(rows, "digest string, license_id string"))
    lengths = F.array(*[F.lit(n) for n in sorted(bound["lengths"])]).cast("array<int>")

    lines = docs.select(
        F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), canonical_lines(F.col(text_col)).alias("__lines")
    )
    whole = F.array_join("__lines", " ")
    notice_lines = F.filter("__lines", lambda line: F.array_contains(lengths, F.length(line)))
    units = lines.select(
        "__row",
        "__id",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(True).alias("entire"), F.when(whole != "", F.sha2(whole, 256)).alias("digest"))),
                F.transform(notice_lines, lambda line: F.struct(F.lit(False).alias("entire"), F.sha2(line, 256).alias("digest"))),
            )
        ).alias("unit"),
    ).select("__row", "__id", "unit.entire", "unit.digest")
    found = units.join(digests, "digest", "left")
    notice = F.when(~F.col("entire"), F.col("license_id"))
    return (
        found.groupBy("__row")
        .agg(
            F.max("__id").alias(id_col),
            F.max(F.when(F.col("entire"), F.col("digest"))).alias("canonical_sha256"),
            F.max(F.when(F.col("entire"), F.col("license_id"))).alias("license_id"),
            F.count(notice).alias("n_notices"),
            F.array_join(F.array_sort(F.collect_set(notice)), ",").alias("notices"),
        )
        .drop("__row")
    )


def known_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def digest_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIGESTS, "license_id string, digest string, n_chars int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), known_table(spark), digests=digest_table(spark))


def _duck_canonical(text: str) -> str:
    """DuckDB expression for the array of canonical lines."""
    quoted = [r.replace("'", "''") for r in (RIGHTS_LINE, PUNCTUATION, ISE)]
    out = f"regexp_replace(lower(coalesce({text}, '')), '{quoted[0]}', '', 'g')"
    out = f"regexp_replace({out}, '{quoted[1]}', ' ', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    out = f"regexp_replace({out}, '{quoted[2]}', '\\1iz\\2', 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def oracle() -> str:
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in KNOWN)
    digests = ", ".join(f"('{i}', '{d}')" for i, d, _ in DIGESTS)
    return f"""
    WITH given(license_id, text) AS (VALUES {values}),
    known AS (
      SELECT digest, min(license_id) AS license_id FROM (
        SELECT sha256(c) AS digest, license_id FROM (SELECT license_id, array_to_string({_duck_canonical("text")}, ' ') AS c FROM given) WHERE c <> ''
        UNION ALL SELECT d, i FROM (VALUES {digests}) v(i, d)) GROUP BY 1),
    lines AS (SELECT row_number() OVER () AS r, doc_id, {_duck_canonical("text")} AS ls FROM documents),
    whole AS (
      SELECT r, doc_id, CASE WHEN len(ls) > 0 THEN sha256(array_to_string(ls, ' ')) END AS digest FROM lines),
    notice AS (
      SELECT r, k.license_id FROM (SELECT r, unnest(ls) AS l FROM lines) x JOIN known k ON k.digest = sha256(x.l)),
    per AS (
      SELECT r, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids FROM notice GROUP BY r)
    SELECT w.doc_id, w.digest AS canonical_sha256, k.license_id,
           CAST(coalesce(p.n, 0) AS BIGINT) AS n_notices, coalesce(p.ids, '') AS notices
    FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN per p ON p.r = w.r
    """
