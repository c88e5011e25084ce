import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()),
    StructField("lang", StringType()), StructField("source", StringType()),
    StructField("n_chars", LongType()),
])


@pytest.fixture
def docs(spark):
    """Documents from texts, or (id, text) pairs."""

    def made(*texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], DOCS
        )

    return made


@pytest.fixture
def rowdy(docs):
    """Nulls, empty texts, repeated rows and ids, ties, a long text, clashing extra columns."""
    from pyspark.sql import functions as F

    long = "\n".join(f"word{i} common words in a line that is long" for i in range(3000))
    df = docs(
        (1, None), (2, ""), (3, "one"), (3, "one"), (3, "another text"), (None, "one"), (None, None),
        (4, " \t\n \n"), (5, long), (6, long), (7, "Grüße aus 北京 😀 x"), (8, "a\nA \n b\n\n"),
    )
    extra = ("row", "k1", "k2", "kept", "key", "count", "pos", "lines", "id", "label", "hit", "g", "t")
    return df.withColumns({c: F.lit(c) for c in extra})
