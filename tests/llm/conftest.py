"""Awkward documents that every operator of the folder has to take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, Score double, digest string"


def rows():
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    texts = [None, "", " \n\t ", "a", "one two", "one two three", "same text", "same text", "Ünïcode 🙂 ß ſ İ", long, "x" * 50_000, "1" * 20_000]
    out = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", None, 1, None, "d") for i, t in enumerate(texts)]
    out.append(out[6])  # a row that repeats whole
    out.append((None, "same text", None, None, 9, None, 0.5, None))
    return out


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
