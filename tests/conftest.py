import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flighttables.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="flighttables-tests", shuffle_partitions=4,
                    extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "4"})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (in the given column order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
