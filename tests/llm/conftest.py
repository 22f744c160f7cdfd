import pytest

SF = "/root/testdata/sf0.001"


def documents(spark, rows, extra=True):
    """A table of (doc_id, text) rows with extra columns whose names clash with results."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return frame
    return frame.selectExpr("doc_id", "text", "'x' AS id", "1 AS key", "2.5 AS score",
                            "'y' AS spans", "CAST(NULL AS string) AS bucket")


@pytest.fixture(scope="session")
def frame(spark):
    return lambda rows, extra=True: documents(spark, rows, extra)


#: Missing ids and texts, empty and blank texts, ties and repeated rows, one long text.
ODD_ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (None, "one two three four"), (4, "one two three four"),
    (4, "one two three four"), (4, "other words under this id"), (None, None),
    (5, "é ü 漢字 ▁ \U0001f600 <|endoftext|> a  b \n\n c\t"), (6, "x" * 50_000),
    (7, "word " * 30_000), (8, "a"), (9, "ONE Two three FOUR"),
]


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD_ROWS)


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
