"""Fill-in-middle transformation by boolean operations on big integers.

A text is a row of bits, one for each UTF-8 byte, the first byte lowest:
``bytes.translate`` writes the digits of a class of bytes and ``int`` reads
them. A unit (a run of ASCII letters, or one other character) begins where a
byte continues no character and is no letter after a letter, which is one
shift and a few boolean operations on the masks; ``bit_count`` counts units and
halving finds the byte where the unit of a given rank begins. No unit
is ever made a string. A text costs its length, in memory as well.

Ranks and forms come from a digest of the seed and the id, so a document has the
same form wherever and however often it is made. A text that holds one of the
three marks stays plain, hence marks in an output are the transformation's own
and ``restored`` gives every text back exactly.

Defined results: null counts as empty text; an empty text is plain. A null id
is written as an empty string in the digest. Repeated rows are made each, alike. Other columns
stay; one named like a result gives way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.batches import text_pieces
from skein.llm.workspace import unused

SEED = 1
#: Per cent of texts that stay plain, and of the others that are in the order suffix, prefix, middle.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"

LETTERS = bytes([*range(65, 91), *range(97, 123)])
_LETTER = bytes(48 + (b in LETTERS) for b in range(256))
_CONTINUES = bytes(48 + (128 <= b < 192) for b in range(256))
_LEADS = bytes(range(128, 192))


def mask(text: bytes, table: bytes) -> int:
    """Bits of the bytes that the table writes as digit 1, the first byte's lowest."""
    return int(text[::-1].translate(table), 2) if text else 0


def unit_starts(text: bytes) -> int:
    """Bits of the bytes at which a unit begins."""
    letter, continues = mask(text, _LETTER), 0 if text.isascii() else mask(text, _CONTINUES)
    return ((1 << len(text)) - 1) & ~continues & ~(letter & letter << 1)


def ranked(bits: int, rank: int) -> int:
    """The place of the set bit before which there are rank others: the half that holds it is halved again."""
    at, size = 0, bits.bit_length()
    while size > 1:
        half = size >> 1
        low = bits & ((1 << half) - 1)
        below = low.bit_count()
        if rank < below:
            bits, size = low, half
        else:
            bits, size, rank, at = bits >> half, size - half, rank - below, at + half
    return at


def characters(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.translate(None, _LEADS))


def transform(text: bytes, doc_id: int | None, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, characters of the prefix and of the middle, output)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    starts = unit_starts(text)
    n = starts.bit_count()
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    a, b = (ranked(starts, r) if r < n else len(text) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", characters(prefix), characters(middle), b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", characters(prefix), characters(middle), b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """docs with ``RESULTS``: units, form, characters of prefix and middle (null if plain), and the output."""
    names = [x.split()[0] for x in RESULTS.split(", ")]
    keep = [c for c in docs.columns if c.lower() not in names]
    key, text = unused("fim_id", docs), text_col if text_col in keep else unused("fim_text", docs)
    sent = docs.select(*keep, F.col(id_col).cast("long").alias(key), *([] if text in keep else [F.col(text_col).alias(text)]))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), RESULTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_pieces(batches, text):
            raw = data.tobytes()
            ids = rows.column(len(keep)).to_pylist()
            found = [transform(raw[a:b], i, seed, plain_percent, spm_percent) for i, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            n, form, before, within, output = zip(*found, strict=True)
            made = [pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(within, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
            yield pa.record_batch([*rows.columns[: len(keep)], *made], names=[*keep, *names])

    return sent.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, by built-in functions: three parts between marks, put in order."""
    part = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("output")), text_col="output")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


ORACLE = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT *, len(us) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(us) + 1) AS p, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(us) + 1) AS q,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (
  SELECT doc_id, t, n, form, array_to_string(list_slice(us, 1, least(p, q)), '') AS a, array_to_string(list_slice(us, least(p, q) + 1, greatest(p, q)), '') AS m,
    array_to_string(list_slice(us, greatest(p, q) + 1, n), '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', a, '<S>', z, '<M>', m) ELSE concat('<S>', z, '<P>', a, '<M>', m) END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""
