import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

#: Columns that share names with what operators make on the way.
SCHEMA = "doc_id long, text string, lang string, source string, size long, node string, `print` string, kept boolean, `a.b` int"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    base = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    long = " ".join(f"word{i % 977} the" for i in range(30000)) + "\n" + "x" * 50_000 + " \n" + " " * 50_000
    rows = [
        (1, base, "en", "a"),
        (2, base.upper() + " \t", "en", "a"),
        (3, base + " seventeen", "en", None),
        (3, base + " seventeen", "en", None),
        (4, None, None, "b"),
        (5, "", "en", "b"),
        (6, " \n\t ", None, "b"),
        (7, long, "en", "c"),
        (8, long + " tail", "en", "c"),
        (None, base, None, "a"),
        (None, None, None, None),
        (9, "der die das und nicht", "de", "a"),
        (9, "ein anderer Text", "de", "a"),
        (10, "12 34 !! 日本語 привет Ελλάδα \x1c \x00", "xx", "z"),
        (11, "İstanbul ﬁ <|startoftext|> don't", "tr", "z"),
    ]
    return [(*r, 1, "n", "p", True, 3) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
