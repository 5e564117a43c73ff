import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and odd texts, repeated rows and ids, and columns with clashing names."""
    long = "word and another one, " * 4000
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, "a", None, "b", 1),
        (5, long, "en", "b", len(long)),
        (5, long, "en", "b", len(long)),
        (6, "The same text twice, in two rows.", "en", "b", 33),
        (7, "The same text twice, in two rows.", "en", "b", 33),
        (None, "No id has this row.", "de", "b", 19),
        (None, "No id has this row.", "de", "b", 19),
        (8, "日本語 текст émile 😀 <|endoftext|> naïve space  two", "xx", "c", 40),
        (9, "12345 67,89 !!! ???", "en", "c", 19),
        (10, "One id", "en", "c", 6),
        (10, "and two texts", "fr", "c", 13),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clashing = {c: df["doc_id"] for c in ("row", "score", "ids", "key", "_label", "fp", "shard", "part", "run", "stats")}
    return df.withColumns(clashing)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
