"""The session of the other tests, and small tables with every odd row."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def ready(spark):
    from tickwise.llm.common import prepare
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(ready):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    columns whose names the operators use themselves."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "b", 35), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "", "en", "a", 0),
            (5, long, "en", "a", len(long)), (6, "same text here for you all", "en", "b", 26), (6, "same text here for you all", "en", "b", 26),
            (None, "same text here for you all", "en", None, 26), (7, "\x01 \x02 a@b.cc\x01", "en", "a", 10), (8, " \t\n ", "de", "c", 4),
            (9, "x" * 5000, "de", "c", 5000), (10, "naïve — 日本語 <|endoftext|>   text", "ja", "c", 30)]
    extra = [(*r, i, f"k{i % 3}", float(i), None) for i, r in enumerate(rows)]
    return ready.createDataFrame(extra, DOC_SCHEMA + ", size long, base string, score double, node long")


@pytest.fixture(scope="session")
def no_docs(ready):
    return ready.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(ready):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (5, 0, 0), (5, 1, 1), (6, None, None)]
    return ready.createDataFrame(rows, "doc_id long, quality int, toxic int")
