from __future__ import annotations

import pytest

from kerbflow.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        app="kerbflow-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from kerbflow.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "tables"))


def rows(df, *columns):
    """Sorted row tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
