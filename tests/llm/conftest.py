import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 10),
        (2, "the cat sat on the mat and looked at the dog", "en", "a", 10),
        (2, "the cat sat on the mat and looked at the dog", "en", "a", 10),
        (3, "", "en", "b", 0),
        (4, None, None, None, None),
        (None, "no id but some text here to read", "en", "b", 3),
        (None, None, None, None, None),
        (5, long_text, "en", "a", 1),
        (6, " leading  and   inner\tspace\n\nlines ▁ and ☃ snow   end  ", "en", "", 4),
        (7, "x" * 50_000, "de", "b", 5),
        (8, "   \t\n ", "de", "b", 5),
        (2, "another text under an id that is used twice already", "en", "c", 7),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge_docs):
    """The same table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["_row", "row_", "_size", "size", "_key", "fp", "score", "text_", "node", "root", "count",
             "rank", "target", "position1", "ids", "label", "a.b"]
    return edge_docs.select("*", *[F.lit(1).alias(n) for n in names])
