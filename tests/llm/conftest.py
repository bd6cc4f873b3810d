import pytest
from pyspark.sql import types as T

#: ``documents`` plus columns named like those that the operators use or add.
CLASHING = ("shard", "slot", "size", "target", "copies", "rank", "row_key", "h", "fp", "root", "words", "digest", "at", "n", "kept", "score", "spans", "ids")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")], T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def rows_of(pairs):
    """(doc_id, text, source) to whole rows."""
    return [(i, t, "en", s, None, *["x"] * len(CLASHING)) for i, t, s in pairs]


LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
PROSE = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(8))
EDGE = [
    (1, PROSE, "a"), (2, PROSE, "a"), (2, PROSE, "a"), (3, None, "a"), (4, "", None), (5, " \n\t ", None), (None, PROSE, "b"),
    (None, "short", "b"), (6, LONG, "b"), (7, LONG + " more", None), (8, "one two", ""), (2**60 + 1, "big id", "a"), (9, "\n\n", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows_of(EDGE), SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    """The whole smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
