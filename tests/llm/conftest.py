import random

import pytest
from llm_helpers import SCHEMA

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rnd, n, line=12):
    words = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))


def edited(rnd, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rnd.randrange(len(words))] = "edit%d" % rnd.randrange(10**6)
    return " ".join(words)


def sample_rows():
    """Copies, near copies, shared lines, ties, nulls, empty and long texts, repeated rows."""
    rnd = random.Random(4)
    texts = [prose(rnd, rnd.randint(1, 120)) for _ in range(25)]
    texts += [texts[3], texts[3], texts[5] + "\n" + texts[6], "common line of all\n" + texts[7], "common line of all\n" + texts[8]]
    texts += [edited(rnd, texts[9], k) for k in (1, 1, 2, 3, 6)]
    texts += ["", None, " \t\n ", "one", "one", "a b", "\n\n\n", "é ß 漢字 € x", prose(rnd, 4000), "x" * 3000, "word " * 700, "<|endoftext|> two  spaces\n \n tail "]
    rows = [(i, t, "en", None if i % 9 == 0 else "s%d" % (i % 4), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[10], None, "s1", 0), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The sample with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("kept").alias(c) for c in ("row", "score", "n_lines", "key", "size", "shard", "draws", "component", "facts", "number", "own")])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True, scope="package")
def few_partitions(spark):
    """The small tables here need no more; many rounds of small jobs run faster."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    yield
    spark.conf.set(key, before)
