import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, target double, kept boolean, keep_id long, row long, _row long, _text string, label string"
)


def row(doc_id, text, source="a", lang="en"):
    """A document with extra columns named like those the operators use inside or add."""
    return (doc_id, text, lang, source, None, 1, 2.0, False, 3, 4, 5, "x", "y")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long_text = " ".join(f"long{i}" for i in range(20_000))
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, "same text here for all of them"),
        row(5, "same text here for all of them"),
        row(6, "same text here for all of them", source=None, lang=None),
        row(7, long_text),
        row(8, "one"),
        row(9, "zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich"),
        row(9, "zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich"),
        row(None, "nameless text without a key"),
        (10, *[None] * 12),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def marks(spark):
    """Labels with nulls, a repeated row and a key that no document has."""
    rows = [(i, i % 2, (i + 1) % 2, "extra") for i in range(1, 10)] + [(3, 1, 0, "extra"), (None, 1, 1, None), (77, 1, 0, None)]
    rows += [(8, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")
