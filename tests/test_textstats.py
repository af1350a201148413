"""Lexical diversity, readability and similarity against brute force."""

import itertools

import numpy as np
import pytest

from quire.operators import dfm as D
from quire.operators import textstats as S
from quire.operators import tokens as T


def _docs(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")


def _mattr_brute(toks, w):
    if len(toks) < w:
        return len(set(toks)) / len(toks)
    vals = [len(set(toks[s:s + w])) / w for s in range(len(toks) - w + 1)]
    return sum(vals) / len(vals)


def test_mattr_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(list("abcdefg"), size=n)) for n in (3, 10, 37, 60)]
    m = {r.doc_id: r.mattr for r in S.mattr(T.unnest_tokens(_docs(spark, *texts)), window=8).collect()}
    for i, t in enumerate(texts, 1):
        assert m[i] == pytest.approx(_mattr_brute(t.split(), 8))


def test_lexdiv(spark):
    d = D.dfm(T.unnest_tokens(_docs(spark, "a a b c")))
    r = S.lexdiv(d).first()
    assert (r.ntoken, r.ntype) == (4, 3) and r.ttr == pytest.approx(0.75) and r.guiraud == pytest.approx(1.5)


def test_readability_counts(spark):
    r = S.readability(_docs(spark, "The cat sat. It was a lovely day!")).first()
    assert (r.n_sent, r.n_words) == (2, 8)
    # vowel groups: the1 cat1 sat1 it1 was1 a1 lovely3 (o, e, y) day1
    assert r.n_syl == 10 and r.n_poly == 1
    assert r.fk_grade == pytest.approx(0.39 * 4 + 11.8 * 10 / 8 - 15.59)


def test_group_distances_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in ["g1", "g2", "g3", "g4"]:
        for t in rng.choice(list("abcdefghij"), size=6, replace=False):
            rows.append((g, str(t), float(rng.integers(1, 5))))
    df = spark.createDataFrame(rows, "g string, term string, w double")
    got = {(r.g_a, r.g_b): r for r in S.group_distances(df, "g").collect()}
    terms = sorted({r[1] for r in rows})
    M = {g: np.array([sum(w for gg, t, w in rows if gg == g and t == x) for x in terms]) for g in ["g1", "g2", "g3", "g4"]}
    for a, b in itertools.product(M, M):
        x, y = M[a], M[b]
        r = got[(a, b)]
        assert r.cosine == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)))
        assert r.euclidean == pytest.approx(np.sqrt(((x - y) ** 2).sum()), abs=1e-9)
        assert r.manhattan == pytest.approx(np.abs(x - y).sum())
        nz = (x != 0) | (y != 0)
        assert r.canberra == pytest.approx((np.abs(x - y)[nz] / (np.abs(x) + np.abs(y))[nz]).sum())
        assert r.jaccard == pytest.approx(((x != 0) & (y != 0)).sum() / nz.sum())


def test_similarity_to_self_and_zero(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 2.0), (2, "b", 4.0), (3, "c", 1.0)]
    d = spark.createDataFrame(rows, "doc_id long, term string, w double")
    s = {r.doc_id: r.cosine for r in S.similarity_to(d, [1]).collect()}
    assert s[1] == pytest.approx(1.0) and s[2] == pytest.approx(1.0) and s[3] == 0.0
    near = S.nearest(S.similarity_to(d, [1]), 1, k=2).collect()
    assert [r.doc_id for r in near] == [2, 3]


def test_word_shares(spark):
    toks = spark.createDataFrame([("D", "x"), ("D", "x"), ("D", "y"), ("R", "x"), ("R", "z")], "party string, term string")
    r = {x.term: x for x in S.group_word_shares(toks, "party", "D", "R").collect()}
    assert set(r) == {"x"} and r["x"].D == pytest.approx(2 / 3) and r["x"].R == pytest.approx(0.5)
    assert r["x"].more == "more D"


def _sw_brute(a, b, match=2.0, mismatch=-1.0, gap=-1.0):
    H = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = match if a[i - 1] == b[j - 1] else mismatch
            H[i][j] = max(0.0, H[i - 1][j - 1] + s, H[i - 1][j] + gap, H[i][j - 1] + gap)
            best = max(best, H[i][j])
    return best


def test_smith_waterman_matches_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a = list(rng.choice(list("abcd"), size=rng.integers(0, 12)))
        b = list(rng.choice(list("abcd"), size=rng.integers(0, 15)))
        assert S.smith_waterman(a, b) == _sw_brute(a, b)


def test_text_reuse_alignment(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    docs = spark.createDataFrame([(10, "intro words then the quick brown fox jumps over the lazy dog and more"),
                                  (11, "nothing shared here at all")], "doc_id long, text string")
    r = S.text_reuse_alignment(items, docs, n=3, min_shared=1).collect()
    assert [(x.item_id, x.doc_id) for x in r] == [(1, 10)]
    assert r[0].aligned == 1.0
