import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASH = ("y", "f", "t", "row", "digest", "fp", "n", "key", "label", "word", "size", "ties", "text_hash",
         "part", "rank", "node", "host", "best", "part_id", "held_out", "score", "__id", "__th", "__ties", "__row", "__at", "__source", "__size",
         "__score", "__repeat", "__n", "__part", "__SCORE", "__l", "__s", "__t", "__0", "positions", "a.b")


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "a b c d e", "en", "s1", 9), (2, "a b c d e", "en", "s1", 9), (2, "a b c d e", "en", "s1", 9),
            (3, None, None, None, None), (None, "a b c d e", "en", "s1", 9), (None, None, None, None, None),
            (4, "", "de", "s2", 0), (5, " \t\n ", "de", "s2", 4), (6, long, "en", "s3", len(long)),
            (7, long + " tail", "en", None, 5), (8, "é ü ñ   x y <|endoftext|>", "fr", "s2", 7),
            (9, "one", "en", "s3", 3), (10, "ONE", "en", "s3", 3), (11, "x" * 5000, "en", "s3", 5000)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASH if c.lower() not in [d.lower() for d in CLASH[:CLASH.index(c)]]])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf(spark):
    return lambda name, at="sf0.001": spark.read.parquet(f"/root/testdata/{at}/{name}.parquet")
