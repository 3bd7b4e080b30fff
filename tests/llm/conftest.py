import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, score double, node bigint, _k string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"word{k % 977} and" for k in range(30_000)) + "\n" + "x" * 200_000
    rows = [
        (1, "One short line of plain words here.\nsecond line of the very same text", "en", "a", 5, True, 0.5, 1, "k"),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, False, 0.1, 2, "k"),
        (None, "No id but a text of quite some words in it", "en", "b", 1, True, 0.2, 3, "k"),
        (None, None, "de", None, 1, None, None, None, None),
        (4, long, "en", "a", len(long), True, 0.3, 4, "k"),
        (5, long, "en", "a", len(long), True, 0.3, 4, "k"),
        (6, "One short line of plain words here.\nsecond line of the very same text", "en", "a", 5, True, 0.5, 1, "k"),
        (6, "One short line of plain words here.\nsecond line of the very same text", "en", "a", 5, True, 0.5, 1, "k"),
        (7, " \n\t\n ", "fr", "c", 5, None, 0.0, 1, "k"),
        (8, "ÄÖÜ été \U0001f600 \x00 end", "fr", "c", 5, None, 0.0, 1, "k"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample_dir():
    return "/root/testdata/sf0.001"
