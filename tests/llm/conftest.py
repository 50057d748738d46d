import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names the operators use themselves.
CLASHES = ("id", "src", "size", "h", "fp", "text_hash", "component_id", "times", "target", "chunk", "kept", "spans", "root", "words")


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from lanecast.llm.common import prepare
    prepare(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in each column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(15_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 3),
            (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 3),
            (3, None, None, None, None), (None, "a null id " * 20, "en", "b", 1), (None, None, None, None, None),
            (4, "", "en", "b", 0), (5, " \t\n\r\x0b\x0c ", "en", "b", 7), (6, long, "en", None, 5),
            (7, "é ü ß 漢字 🙂 \x00 \x85 " * 9, "de", "c", 2), (8, "AAAA " * 400, "en", "a", 2),
            (9, "same text of two ids here it is", "en", "a", 2), (10, "same text of two ids here it is", "en", "c", 2)]
    return rows + rows[:3] + [rows[3]]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
