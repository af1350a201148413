"""Dictionary lookup with wildcards, polarity, VADER-style rules."""

import math

import pytest

from quire.operators import dfm as D
from quire.operators import lexicon as L
from quire.operators import tokens as T


def _docs(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_lookup_wildcards_count_once_per_category(spark):
    docs = _docs(spark, "happy happiness sad unhappy", "nothing here")
    d = D.dfm(T.unnest_tokens(docs))
    dic = L.dictionary_table(spark, {"negative": ["sad", "unhap*"], "positive": ["happ*", "happy"]})
    w = {r.doc_id: (r.negative, r.positive) for r in L.lookup_wide(docs, d, dic, ["negative", "positive"]).collect()}
    assert w == {1: (2, 2), 2: (0, 0)}


def test_polarity_and_label(spark):
    df = spark.createDataFrame([(3, 1), (0, 0), (0, 2)], "pos long, neg long")
    r = df.select(L.polarity("pos", "neg").alias("p"), L.label_by_sign(df.pos - df.neg).alias("l")).collect()
    assert r[0].p == pytest.approx(math.log(3.5 / 1.5)) and r[0].l == "Positive"
    assert r[1].l is None and r[2].l == "Negative"


def test_dictionary_closure_rolls_up(spark):
    dic = L.dictionary_table(spark, {"strong": ["great"], "positive": ["good"]})
    parents = spark.createDataFrame([("strong", "positive")], "category string, parent string")
    closed = {(r.category, r.pattern) for r in L.dictionary_closure(dic, parents).collect()}
    assert ("positive", "great") in closed and ("strong", "great") in closed


def test_vader_rules(spark):
    lex = {"good": 2.0, "bad": -2.0}
    docs = _docs(spark, "good", "not good", "very good", "GOOD day", "good!!", "plain words")
    v = {r.doc_id: r for r in L.vader(docs, lex, {"very": 1.0}, ["not"]).collect()}
    norm = lambda x: x / math.sqrt(x * x + 15)
    assert v[1].compound == pytest.approx(norm(2.0))
    assert v[2].compound == pytest.approx(norm(2.0 * -0.74))
    assert v[3].compound == pytest.approx(norm(2.0 + 0.293))
    assert v[4].compound == pytest.approx(norm(2.0 + 0.733))
    assert v[5].compound == pytest.approx(norm(2.0 + 2 * 0.292))
    assert v[6].compound == 0.0 and v[6].neu == pytest.approx(1.0)
    assert v[1].pos + v[1].neu + v[1].neg == pytest.approx(1.0)


def test_score_table_safe_output(spark):
    import pandas as pd
    df = spark.createDataFrame([(1, "ok"), (2, "boom"), (3, "fine")], "doc_id long, text string")

    def model(texts):
        if (texts == "boom").any():
            raise RuntimeError("bad input")
        return pd.DataFrame({"score": texts.str.len().astype(float)})
    out = {r.doc_id: r for r in L.score_table(df, model, "text", "score double").collect()}
    assert out[1].score == 2.0 and out[3].score == 4.0
    assert out[2].score is None and "bad input" in out[2].error
