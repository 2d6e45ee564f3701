import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i}" for i in range(30000))
    base = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn while rain falls softly"
    return [(1, base, "en", "a", len(base)), (1, base, "en", "a", len(base)), (2, base + " again", "en", None, 0), (3, None, None, "b", None),
            (4, "", "en", "b", 0), (None, base, "en", "a", 1), (5, long, "en", "c", len(long)), (6, "   \n\t ", "en", "c", 6),
            (7, "one two", "en", "c", 7), (8, "one two", None, None, 7)]


@pytest.fixture()
def odd(spark, odd_rows):
    from pyspark.sql import functions as F
    extra = {c: F.lit("x") for c in ("score", "spans", "ids", "rep", "size", "__n")}
    return spark.createDataFrame(odd_rows, DOC_SCHEMA).withColumns(extra)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
