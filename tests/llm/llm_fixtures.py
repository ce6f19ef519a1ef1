import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("fingerprint", T.StringType()),
                       T.StructField("n_lines", T.LongType()), T.StructField("host", T.StringType())])
LINE = "A line that many of the documents share, long enough to count."

TEXTS = [
    None, "", " \n\t ", "one", "one two", "one two three", "  double  spaces \n\n\n and\tfeeds\r\n",
    f"{LINE}\nown line of the first", f"own\n  {LINE.upper()}  \nx", f"{LINE}", f"{LINE}\n{LINE}\nlast", f"q {LINE}\n{LINE}",
    f"{LINE} \n", "ünï çødé Straße ǅ İstanbul ﬁne    wide \x1c sep", "á ́b 가각 한글",
    "<|endoftext|>", "x<|endoftext|>y <|startoftext|> z", " lead", "trail ", "\nfeed", "a \n b\n \nc",
    "it's they're I'll 'tis 123 4567 89 !!! ... ??? #*$%&|<>", "the same words the same words the same words the same words",
    " ".join(f"w{i}" for i in range(60)), " ".join(["again and again"] * 40), "x" * 5000,
    " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000)), "\n".join(f"line {i % 50} of a very long text" for i in range(9_000)),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    rows = [(i, t, None, "clash", 7, "clash") for i, t in enumerate(TEXTS)]
    rows += [(7, TEXTS[7], "en", None, None, None), (None, f"{LINE}\nnobody's", None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
