import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from innledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(**settings)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as a sorted list of tuples."""

    def collected(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collected
