import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", **{"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted rows of a frame as tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
