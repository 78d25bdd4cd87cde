import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows as they come: nulls, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    long = "the thing and that " * 4000
    rows = [
        (1, "the cat sat on the mat and the dog sat too", "en", "a"),
        (2, "the cat  sat on\tthe mat and the dog sat too", "en", "a"),
        (2, "the cat  sat on\tthe mat and the dog sat too", "en", "a"),
        (3, None, None, None),
        (4, "", "en", None),
        (5, " \n ", "de", "b"),
        (None, "der Hund und die Katze sind im Haus", "de", "b"),
        (None, None, "de", "b"),
        (6, long, "en", "a"),
        (7, long + "end", None, "c"),
        (8, "der Hund und die Katze sind im Haus", "de", "ü"),
        (9, "12345 !!!", None, "ü"),
        (10, "漢字 😀 ▁x <s> mixed  spaces", None, ""),
    ]
    extra = "size bigint, kept string, row_number int, `a.b` string, text_ string, spans int, shard int, taken string"
    schema = f"doc_id bigint, text string, lang string, source string, {extra}"
    return spark.createDataFrame([(*r, 1, "x", 7, "y", "z", 3, None, "t") for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
