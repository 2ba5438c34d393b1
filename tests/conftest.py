import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from regiolake.session import build_session
    yield build_session("local[4]", app="regiolake-tests", shuffle_partitions=4,
                        extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
