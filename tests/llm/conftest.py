import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in every column, empty and blank texts, ties, a repeated row, a very long text.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one two three", "en", "a", 13),
    (5, "One  two\nthree", "en", "b", 14),
    (6, "the same five words and more of them here " * 3, "en", "b", 1),
    (6, "the same five words and more of them here " * 3, "en", "b", 1),
    (7, "the same five words and more of them here " * 3, "en", None, 1),
    (None, "the same five words and more of them here " * 3, "en", "c", 1),
    (None, None, None, None, None),
    (8, "word " * 40_000, "en", "c", 200_000),
    (9, "x" * 150_000, "en", "c", 150_000),
    (10, "überall größer 漢字 \U0001f600 <|endoftext|> end", "de", "é", 5),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    """Runs SQL over the tables of a folder."""

    def run(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
        with duckdb.connect() as con:
            for name in ("documents", "embeddings", "pages"):
                con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
            found = con.sql(sql)
            return found.columns, found.fetchall()

    return run
