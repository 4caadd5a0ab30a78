from __future__ import annotations

import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture
def docs_of(spark):
    """Documents from texts, ids from 0; or from (id, text) pairs."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)

    return make


@pytest.fixture
def table_dir(spark, tmp_path):
    """A folder like a scale-factor folder, from named frames."""

    def make(**frames):
        for name, frame in frames.items():
            frame.coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
