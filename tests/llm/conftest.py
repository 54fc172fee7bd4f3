import pytest
from pyspark.sql import types as T

LONG = "der lange satz geht immer weiter und weiter " * 8000
KINDS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns that other rows have, too, under names the operators use.
        *(T.StructField(n, T.StringType()) for n in ("score", "ids", "ranges", "benchmark_hits", "y", "print", "first")),
    ]
)
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
EDGES = [
    (1, None, "en", None, None),
    (2, "", None, "s", 0),
    (3, "  \n\t ", "de", "s", 5),
    (4, "1234 !! 5678", "en", "s", 12),
    (5, "ein", "de", "s", 3),
    (6, SAME, "en", "s", None),
    (7, SAME, "en", "s", 3),
    (7, SAME, "en", "s", 3),
    (8, LONG, "de", None, len(LONG)),
    (9, "it's 日本語 😀 ñandú▁x <|endoftext|> <s> café", None, "s", 9),
    (None, SAME, "en", "s", 9),
    (None, None, None, None, None),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame([(*row, *"abcdefg") for row in EDGES], KINDS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 10)] + [(None, 1, 1), (3, None, None), (6, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, SAME), (2, None), (None, SAME), (3, ""), (4, "never seen words in this order at all my friend")]
    return spark.createDataFrame(rows, "item_id bigint, text string")
