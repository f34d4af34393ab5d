import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="kestrel-tests", driver_memory="8g",
                            extra={"spark.sql.maxMetadataStringLength": "10000"})
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), in result order."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
