"""Fixtures of the tests in this folder."""

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: Texts that every operator has to cope with, and one long one.
ODD_TEXTS = ["", None, " ", "\n", "one", "a b c d e", "x" * 5000, "word " * 30000, "Ünïcode ñ 漢字   \x1c z.",
             "same text twice.", "same text twice."]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = [(i, t, 7, "s", 1.0, True) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", 7, "s", 1.0, True), (3, "\n", 7, "s", 1.0, True), (3, "\n", 7, "s", 1.0, True)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, _bucket int, fp string, score double, kept boolean")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
