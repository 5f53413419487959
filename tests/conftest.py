from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from quantloom.session import local_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="quantloom-warehouse-")
    session = local_session("tests", cores="4", **{"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A new folder; small files are written into it with ``put``."""
    root = Path(scratch_path(spark, "test").removeprefix("file:"))
    root.mkdir(parents=True)

    class Folder:
        path = str(root)

        @staticmethod
        def put(name: str, content: str | bytes) -> str:
            target = root / name
            target.parent.mkdir(parents=True, exist_ok=True)
            if isinstance(content, str):
                content = content.encode()
            target.write_bytes(content)
            return str(target)

    return Folder


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
