import random

import pytest
from llm_helpers import SCHEMA

from priceloom.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, copies
    that differ in case, near copies, and texts without words or letters."""
    rng = random.Random(5)
    words = ["the", "Of", "tion", "élan", "ñandú", "größe", "ab1", "x,y", "...", "und"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(12)]
    texts = base + [t.upper() for t in base[:4]] + [t + " end" for t in base[:5]]
    texts += [None, "", " \n\t ", "!!! 123", "a", "A", "word " * 4000, "x" * 9000, base[0], base[0]]
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None, "ß"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base[1], "en", "s0", None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(messy):
    """Extra columns under names that operators use inside."""
    names = ("row_key", "bucket", "text_hash", "keep_id", "component_id", "whole_text", "takes", "lang_pred", "size")
    return messy.selectExpr("*", *[f"'extra' as {n}" for n in names])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
