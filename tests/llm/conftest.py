import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, seq int, kept string, node string, words string, part int, row string"


def prose(rng, n):
    vocabulary = ["the", "of", "and"] * 20 + [f"w{rng.randrange(400)}x" for _ in range(300)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and very long texts, copies, repeated rows and ids, clashing names."""
    rng = random.Random(5)
    extra = (7, "kept", "node", "words", 1, "row")
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), base.upper(), None, "", " \t\n ", "x", "one two three", "a\n\na\nb a b", "é É ß z", prose(rng, 40_000), "same line\nsame line"]
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, 1, *extra) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, "en", "s1", None, *extra), (None, None, None, None, None, *extra), (3, prose(rng, 80), "de", "s2", 2, *extra)]
    return rows


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(documents):
    return documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
