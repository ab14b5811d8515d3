import pytest

from orderloom.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, id string, fp long, part int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text, lang, source); the last columns have names that operators might use inside."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, s, len(t) if t is not None else None, "x", 7, "y", 8, 9) for i, t, lang, s in rows], SCHEMA
        )

    return make


@pytest.fixture
def edge_docs(make_docs):
    """Null and empty columns, repeated rows and ids, ties, one long text, white space of all kinds."""
    long = " ".join(f"w{i % 977} the{i}" for i in range(30_000))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \t\n ", None, "b"),
        (4, "one two", "xx", "b"),
        (5, "the cat sat on the mat\nthe cat sat on the mat\u00a0end", "en", "a"),
        (5, "the cat sat on the mat\nthe cat sat on the mat\u00a0end", "en", "a"),
        (6, "the cat sat on the mat\nthe cat sat on the mat\u00a0end", "en", "a"),
        (None, "no id here but some words to keep it going", "de", "c"),
        (None, None, None, None),
        (8, long, "en", "a"),
        (9, "éa ß ü \U0001f600 öä " * 30, "de", "é"),
    ]
    return make_docs(rows)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
