import pytest
from pyspark.sql import Row

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, h string, kept int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with null and empty texts, null and repeated ids, repeated rows, a copy, a
    long text, and extra columns whose names clash with the operators' own."""
    words = [f"w{i * i % 97}x{i % 13}" for i in range(120)]
    prose = " ".join(words[:60]) + ".\n" + " ".join(words[60:])
    texts = [(1, prose), (2, prose), (2, prose), (3, None), (4, ""), (None, prose + " end"), (5, "one"), (5, "two words"),
             (6, " \t\n "), (7, "the same line here\n" * 5 + "é à ü"), (8, ("long " * 10 + "\n") * 3000), (9, prose.upper()),
             (10, None), (None, None), (11, " ".join(reversed(words)))]
    rows = [Row(i, t, "en", ["a", "b", None][k % 3], 0, "x", 0) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
