import random

import pytest
from pyspark.sql import types as T

# Names that the operators use inside, or that their results have.
CLASHING = ["body", "label", "n", "salt", "content", "component_id", "text_key", "score", "spans"]

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in ["lang", "source", *CLASHING]]
    + [T.StructField("n_chars", T.LongType())]
)


def rows_of(pairs):
    others = ["en", "src0", *["other"] * len(CLASHING)]
    return [(i, text, *others, None if text is None else len(text)) for i, text in pairs]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from pairs of id and text, with columns of clashing names."""

    def make(pairs):
        return spark.createDataFrame(rows_of(pairs), SCHEMA)

    return make


def prose(seed, words):
    """Words that hardly ever repeat in a row."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeilnorstuü", k=rng.randint(2, 9))) for _ in range(words))


ODD_TEXT = (
    "Licensed under the Apache License, Version 2.0.\nWrite to jane@mail.example.com now.\n"
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"\nlast line here'
)
# Null and empty texts, white space, a very long text, ties, repeated rows, null ids.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, ODD_TEXT),
    (5, ODD_TEXT),
    (5, ODD_TEXT),
    (6, prose(6, 40_000)),
    (7, "a" * 200_000),
    (8, "one two three"),
    (8, "one two four"),
    (None, ODD_TEXT),
    (None, "no id at all"),
    (None, None),
    (9, "1" * 5_000 + " +" * 2_000 + " 1.1" * 2_000 + "@" * 1_000),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD).cache()


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
