import pytest

LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows, columns with names that operators use themselves."""
    rows = [
        (1, "", "x"),
        (2, None, None),
        (None, "A text without an id.", "x"),
        (None, None, "x"),
        (3, "Twice the same row.\nAnd a line.", "x"),
        (3, "Twice the same row.\nAnd a line.", "x"),
        (4, LONG, "x"),
        (5, "\n\n  \n", "x"),
        (6, "﻿é ∂ 日本語 \U0001f642 <|endoftext|> it's", "x"),
    ]
    names = ["key", "node", "row", "a", "b", "h", "n", "line", "place", "score", "spans", "n_words", "n_lines", "shard", "fingerprint"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, t, *[x] * len(names)) for i, t, x in rows], schema)


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")
