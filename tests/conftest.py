import json
import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierlake.session import local_session  # noqa: E402
from tierlake.sources.store import TableStore  # noqa: E402

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def bronze(spark, tmp_path):
    """Bronze rows of records given as dicts or JSON texts, in order of arrival."""
    from tierlake.sources import raw_json

    def build(id_field, *records):
        path = tmp_path / f"{id_field}.jsonl"
        texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path.write_text("\n".join(texts), encoding="utf-8")
        return raw_json.bronze_rows(raw_json.read_lines(spark, str(path)), id_field, NOW)

    return build


def dicts(df, *columns):
    """Rows as dicts, sorted by all values, without audit columns."""
    df = df.select(*columns) if columns else df.drop("processed_at", "ingested_at")
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=str)
