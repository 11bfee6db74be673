import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a DataFrame by a DDL schema, dealt over a few partitions."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "Ein Wort",
    "two  spaces and\ttab \n line",
    "漢字かな交じり文 and 🙂 emoji",
    "<|endoftext|> inside <|endoftext|>",
    "no-break space 　wide em \x85next \x1cunit",
    "x" * 5000,
    "word " * 4000,
    "don't can't we'll I'm 123 4567 ... === !!",
    "combining é ​ zero ﻿ mark",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash."""
    rows = [(i, text, "en" if i % 2 else None, "s", i, 0.5, "r") for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, None, None, None, None, None, None), (None, "a text", None, None, None, None, None)]
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.StringType()),
        ]
    )
    return spark.createDataFrame(rows, schema).repartition(3)
