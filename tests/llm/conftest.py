import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("row", T.LongType()), T.StructField("score", T.StringType()), T.StructField("block", T.StringType()),
    T.StructField("n", T.StringType()), T.StructField("kind", T.StringType())])


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with null and clashing extra columns, over several partitions."""
    def make(*rows, parts=3):
        full = [(i, t, None, "src", None if t is None else len(t), None, "s", "b", "n", "k") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


def odd_texts():
    """Null, empty, blank, very long, repeated and non-ASCII texts."""
    long = " ".join(f"word{i % 977} {'abcdefghij'[i % 10] * (i % 7 + 1)}" for i in range(40_000))
    return [None, "", " ", "\n\t ", "a", "Ä ö é ñ 漢字 🙂", "same text here, twice over", "same text here, twice over",
            "x" * 5000, long, "Tab\tand\r\nline", "<|endoftext|> it's  two  spaces ' s", "ends with space ", "é é́ à"]
