"""Driver contract and a DuckDB oracle pass over a selection of queries on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FAST = ["top_terms_by_source", "nation_customer_share", "segment_priority_crosstab", "corpus_summary",
        "top_bigrams", "collocations_en", "kwic_mail", "lexdiv_docs", "mattr_docs", "readability_docs",
        "source_distances", "similarity_to_first_en", "conversation_polarity", "nb_quality_report",
        "skipgram_pmi_en", "wordscores_en", "supplier_win_table", "centroid_similarity", "page_text"]


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "term", "tfidf", "rank"]
    assert df.count() > 0


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    from quire.sources.tables import TABLES
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sdf.columns
    srows = sorted(repr(tuple(_norm(r[c]) for c in sorted(cols))) for r in sdf.collect())
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = sorted(repr(tuple(_norm(r[dcols.index(c)]) for c in sorted(dcols))) for r in res.fetchall())
    assert sorted(cols) == sorted(dcols)
    assert srows == drows
