import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        *[T.StructField(n, T.StringType()) for n in ("id", "size", "score", "h", "kept", "label", "n_lines")],
    ]
)


def rows_of(texts, first_id=0):
    return [(first_id + i, t, "en", f"s{i % 3}", None if t is None else len(t), *["x"] * 7) for i, t in enumerate(texts)]


def words(rng, n):
    stems = ["the", "ing", "Ble", "tion", "éa", "ßo", "of", "re", "an", "x1"]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, copies, near copies, shared lines and passages, repeated rows."""
    rng = random.Random(3)
    base = [words(rng, 60) for _ in range(12)]
    shared = words(rng, 40)
    near = base[0].split(" ")
    near[30] = "other"
    texts = [None, "", " \t\n", "one", "\n\n", *base, base[3], base[3] + "  ", " ".join(near)]
    texts += [f"{words(rng, 20)}\n{shared}\n{words(rng, 15)}" for _ in range(5)]
    texts += [shared, shared.upper(), "a" * 3000, "be " * 500, "é" * 400, words(rng, 4000), "x\0y \U0001f600 ▁ z"]
    rows = rows_of(texts)
    rows.append((None, base[5], None, None, None, *["x"] * 7))
    rows.append((None, None, None, None, None, *["x"] * 7))
    rows.append(rows[7])  # a repeated row
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
