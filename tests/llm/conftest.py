import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("row", "size", "target", "score", "t", "i", "h", "clean", "id", "y", "copy", "a.b")]
)
LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))


def rows(*texts):
    return [(k, t, "en", ["s1", None, "", "s2"][k % 4], 0, *(["clash"] * 12)) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, a very long one, ties, a repeated row, null ids and keys, clashing columns."""
    plain = "the quick brown fox jumps over the lazy dog and runs away from all of them today"
    data = rows(None, "", " \n", "a", "A", plain, plain, plain + " again", LONG, "é ß 漢字 mail x@y.example.org")
    data += [data[5], data[1], (None, *data[5][1:]), (None, None, None, None, None, *([None] * 12))]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    """Labels of both kinds, a null label, an unknown id and a repeated id."""
    data = [(k, k % 2, (k + 1) % 2) for k in range(10)] + [(3, None, None), (4, 1, 0), (999, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    data = [(1, "jumps over the lazy dog and runs away from all of"), (2, None), (3, ""), (4, "Fox JUMPS, over!"), (None, "x y")]
    return spark.createDataFrame(data, "item_id long, text string")
