"""Document-feature tables: counts, trims, weights, grouping."""

import math

import pytest
from pyspark.sql import functions as F

from quire.operators import dfm as D


@pytest.fixture
def small(spark):
    rows = [(1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "c", 3), (3, "a", 1), (3, "b", 1), (3, "d", 1)]
    return spark.createDataFrame(rows, "doc_id long, term string, n long")


def test_trim_bounds_inclusive_and_idempotent(spark, small):
    t = D.dfm_trim(small, n_docs=3, min_docfreq=2 / 3, docfreq_type="prop")
    assert sorted({r.term for r in t.collect()}) == ["a", "b"]
    t2 = D.dfm_trim(t, n_docs=3, min_docfreq=2 / 3, docfreq_type="prop")
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, t2.collect()))
    assert {r.term for r in D.dfm_trim(small, min_termfreq=3).collect()} == {"a", "c"}


def test_tfidf_formula(spark, small):
    w = {(r.doc_id, r.term): r.w for r in D.dfm_tfidf(small, n_docs=3).collect()}
    assert w[(2, "c")] == pytest.approx(3 / 4 * math.log10(3 / 1))
    assert w[(1, "a")] == pytest.approx(0.0)


def test_weight_prop_sums_to_one(spark, small):
    s = D.dfm_weight_prop(small).groupBy("doc_id").agg(F.sum("w").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in s)


def test_group_and_counts(spark, small):
    dv = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "doc_id long, author string")
    g = {(r.author, r.term): r.n for r in D.dfm_group(small, dv, "author").collect()}
    assert g[("x", "a")] == 3 and g[("y", "d")] == 1
    nt = {r.doc_id: (r.ntoken, r.ntype) for r in D.ntoken_ntype(small).collect()}
    assert nt[2] == (4, 2)


def test_top_features_and_vectors(spark, small):
    top = D.topfeatures(small, 2).collect()
    assert [(r.term, r.n) for r in top] == [("a", 4), ("c", 3)]
    vocab = D.vocabulary(small)
    assert [r.idx for r in vocab.orderBy("term").collect()] == [0, 1, 2, 3]
    v = {r.doc_id: r.features for r in D.to_vectors(small, vocab, 4).collect()}
    assert v[2].toArray().tolist() == [1.0, 0.0, 3.0, 0.0]
