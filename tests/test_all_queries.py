"""Every registered query writes its result on sf0.001: those without an oracle
always, the others with QUIRE_ALL_QUERIES=1 (the oracle tool covers them)."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

OWN = [n for n in E.queries() if not n.startswith("op") and n != "pipeline"]
CHOSEN = OWN if os.environ.get("QUIRE_ALL_QUERIES") else [n for n in OWN if n not in E.oracle_sql()]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_writes_its_result(spark, tmp_path, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert len({c.lower() for c in df.columns}) == len(df.columns)
    df.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).columns == df.columns
