import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string"


@pytest.fixture
def frame(spark):
    """Documents as a frame of several partitions, with columns whose names clash with the operators' own."""

    def make(rows, parts=3):
        df = spark.createDataFrame([(d, t, "x", 1, True) for d, t in rows], DOCS + ", place string, n int, lent boolean")
        return df.repartition(parts) if rows else df

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """A folder of tables as the registered queries read them."""

    def make(**named):
        for name, df in named.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def rows():
    return rows_of
