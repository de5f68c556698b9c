"""Views that queries start from, in SQL that Spark and DuckDB read alike.

The tables hold natural prose without spoken fillers, quotes or emoji, so pairs
are made from whole rows by fixed changes that depend on the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPLACEMENT = "�"

PAIRS = f"""
SELECT doc_id AS line_no, source AS category, lang,
  CASE doc_id % 12
    WHEN 0 THEN concat('um ', text)
    WHEN 1 THEN concat('wait no ', text, ' actually sorry')
    WHEN 2 THEN concat('five hundred ', text, ' you know')
    WHEN 3 THEN concat(text, ' so the thing is like basically done')
    WHEN 4 THEN concat('Three point five. ', text, ' -- so um')
    WHEN 5 THEN 'um uh'
    WHEN 6 THEN concat('patient hospital ', text)
    WHEN 7 THEN concat('recipe cooking stirring ', text)
    ELSE text END AS input,
  CASE doc_id % 11
    WHEN 0 THEN concat(text, ' um')
    WHEN 1 THEN concat('"um" ', text)
    WHEN 2 THEN concat('<THINK>x</think>', text)
    WHEN 3 THEN concat(text, '{REPLACEMENT}')
    WHEN 4 THEN concat(text, ' ', text, ' ', text)
    WHEN 5 THEN ''
    WHEN 6 THEN concat('Costs $5.00 and 10%. ', text, '.')
    WHEN 7 THEN concat('- item', chr(10), chr(10), text)
    WHEN 8 THEN concat('# Head', chr(10), text, ' `code`')
    WHEN 9 THEN replace(text, ' the ', ' a ')
    ELSE text END AS output
FROM {{documents}}
"""

TURNS = """
SELECT conv_id, turn, text, role,
  lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
  lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role
FROM {conversations}
"""

EVALUATION = f"""
SELECT conv_id * 1000 + turn AS index,
  CASE conv_id % 3 WHEN 0 THEN concat('um ', text) WHEN 1 THEN concat('wait no ', text) ELSE text END AS input,
  CASE conv_id % 4 WHEN 0 THEN concat(next_text, ' It costs 5.') WHEN 1 THEN concat(next_text, ' ☺') ELSE next_text END AS expected,
  CASE (conv_id + turn) % 9
    WHEN 0 THEN next_text
    WHEN 2 THEN concat('um ', next_text)
    WHEN 3 THEN concat('<think>x</think> ', next_text)
    WHEN 4 THEN concat('five ', replace(next_text, ' the ', ' teh '))
    WHEN 5 THEN concat('wait no ', next_text, ' ☺')
    WHEN 6 THEN substr(next_text, 1, length(next_text) - 1)
    WHEN 7 THEN text
    ELSE next_text END AS raw_generated,
  (conv_id % 7 + 1) / 4.0E0 AS generation_seconds,
  CAST(length(next_text) AS BIGINT) AS generated_token_count
FROM ({TURNS}) t WHERE role = 'user' AND next_role = 'assistant'
"""

VERDICTS = """
SELECT d.source AS category, d.doc_id AS line_no, l.quality IS NULL AS parse_error,
  CASE WHEN l.quality IS NULL THEN NULL ELSE d.doc_id % 7 <> 0 END AS input_realistic,
  l.quality = 1 AS content_preserved, l.toxic = 0 AS no_hallucination,
  CASE WHEN l.quality IS NULL THEN NULL ELSE d.doc_id % 9 <> 0 END AS corrections_applied
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

LOG = """
SELECT event_id AS ord, CASE event_id % 3
  WHEN 0 THEN concat('Iter ', CAST(event_id AS STRING), ': Val loss ', CAST(CAST(floor(abs(value) * 100) AS BIGINT) % 977 AS STRING), '.25, Val took 1.23s')
  WHEN 1 THEN concat('Iter ', CAST(event_id AS STRING), ': Train loss ', CAST(user_id AS STRING), '.5, Learning Rate 1.000e-05, It/sec 2.5, Tokens/sec 100.5')
  ELSE concat('note ', event_type) END AS line
FROM {events}
"""

TABLES = ("documents", "conversations", "labels", "events", "benchmark")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The view of a folder's tables."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def duck(sql: str) -> str:
    """The view's SQL for DuckDB."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return f"({sql})"
