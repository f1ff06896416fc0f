import random

import pytest

VOCAB = [f"w{i}" for i in range(400)]


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def edited(text: str, seed: int, n: int) -> str:
    rng, parts = random.Random(seed), text.split()
    for _ in range(n):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


SHARED = "This sentence is found in very many of the documents here."


def rows():
    base = words(1, 120)
    out = [(i, words(100 + i, 80) + "\n" + SHARED + "\nend", "en", "a") for i in range(8)]
    out += [(20 + k, edited(base, k, k % 4), "en", "b") for k in range(10)]
    out += [(40, base, "en", None), (41, base, "en", None), (41, base, "en", None), (None, base, "de", "c")]
    out += [(50, None, "en", "d"), (51, "", "en", "d"), (52, " \t\n", None, "d"), (53, "one two", "en", "d"),
            (54, "One  TWO", "en", "d"), (None, None, None, None)]
    out += [(60, words(7, 30_000), "en", "e"), (61, SHARED.upper() + "\n" + SHARED + "\n" + words(8, 60), "en", "e")]
    return out


SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ["n_lines", "kept", "_id", "_text", "length", "n_words", "_sig", "part", "score", "lang_pred"]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, ties, repeated rows, long texts and columns with the operators' names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]).repartition(3)


@pytest.fixture(scope="session")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)
