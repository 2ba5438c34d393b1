import sys

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings")


@pytest.fixture(scope="session", autouse=True)
def worker_path(spark):
    """Python workers import this library, too."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [os.environ.get("PYTHONPATH")])])
    sys.path.insert(0, root)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


LONG = " ".join(f"wort{i % 997} und" for i in range(40_000)) + "."
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank. It was a cold day in the north of the country. "

# nulls, empty and blank texts, a very long text, ties and repeated rows, a null id; columns that clash with names the
# operators use, in another case, too
EDGE_COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, Shard string, score string, `n` int, "
                "id int, kept string, size string, `a.b` string, p int, h string")


def edge_rows():
    def row(i, text, lang="en", source="s"):
        return (i, text, lang, source, None if text is None else len(text), "x", "y", 1, 2, "z", "w", "q", 3, "r")
    return [row(1, None), row(2, ""), row(3, " \n\t "), row(4, LONG), row(5, LONG), row(6, PROSE * 3), row(6, PROSE * 3),
            row(7, PROSE * 3, None, None), row(None, PROSE * 2), row(None, None), row(8, "one two"), row(9, "One  TWO"), row(10, "é ü")]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_COLUMNS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_COLUMNS)
