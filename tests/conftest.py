import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom.limits import Limits  # noqa: E402
from starloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The plans for large data, run on small data: nothing is small; most keys are hot, or none is.
SALTED = Limits(broadcast_bytes=-1, hot_share=0.05, sketch_items=1024, window_rows=0)
SHUFFLED = Limits(broadcast_bytes=-1, hot_share=0.9, sketch_items=1024, window_rows=0)

BOTH_LIMITS = pytest.mark.parametrize("limits", [Limits(), SALTED], ids=["default", "salted"])
ALL_LIMITS = pytest.mark.parametrize("limits", [Limits(), SALTED, SHUFFLED], ids=["default", "salted", "shuffled"])


def rows(df, *columns):
    """Rows as sorted tuples; NULLs sort first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])
