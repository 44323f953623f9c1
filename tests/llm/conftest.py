import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
for folder in (ROOT, HERE):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from llm_fixtures import SF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session

    session = get_session(master="local[*]", shuffle_partitions=8)
    env = session.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    return session


@pytest.fixture(scope="session")
def texts(spark):
    """Whole texts of the smallest documents table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
