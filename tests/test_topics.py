"""Seeded topics (variational EM) and k-means by hand."""

import numpy as np
import pytest

from quire.operators import topics as P


def test_digamma_values():
    got = P._digamma(np.array([1.0, 0.5, 10.0]))
    assert got == pytest.approx([-0.5772156649, -1.9635100260, 2.2517525891], abs=1e-8)


def test_seeded_topics_follow_keywords(spark):
    rng = np.random.default_rng(0)
    a_words, b_words = [f"a{i}" for i in range(8)], [f"b{i}" for i in range(8)]
    rows = []
    for doc in range(40):
        words = a_words if doc % 2 == 0 else b_words
        for w in rng.choice(words, size=30):
            rows.append((doc, str(w)))
    d = spark.createDataFrame(rows, "doc_id long, term string").groupBy("doc_id", "term").count().withColumnRenamed("count", "n")
    beta, theta = P.seeded_lda(d, {"A": ["a0", "a1"], "B": ["b0", "b1"]}, iters=10, seed_weight=5.0)
    top = {r.label: r for r in beta.groupBy("label").agg(
        __import__("pyspark.sql.functions", fromlist=["x"]).max_by("term", "beta").alias("term")).collect()}
    assert top["A"].term.startswith("a") and top["B"].term.startswith("b")
    g = {(r.doc_id, r.topic): r.gamma for r in theta.collect()}
    assert g[(0, 0)] > 0.8 and g[(1, 1)] > 0.8


def test_kmeans_by_hand_converges(spark):
    pts = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10)])]
    X = spark.createDataFrame(pts, "id long, vec array<double>")
    init = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], "cluster int, vec array<double>")
    cen, a = P.kmeans_by_hand(X, init)
    groups = {}
    for r in a.collect():
        groups.setdefault(r.cluster, set()).add(r.id)
    assert sorted(map(sorted, groups.values())) == [[0, 1, 2], [3, 4, 5]]


def test_stm_prevalence_covariate(spark):
    rng = np.random.default_rng(1)
    rows, cov = [], []
    for doc in range(40):
        g = doc % 2
        words = [f"b{i}" for i in range(6)] if g else [f"a{i}" for i in range(6)]
        for w in rng.choice(words, size=25):
            rows.append((doc, str(w)))
        cov.append((doc, float(g)))
    d = spark.createDataFrame(rows, "doc_id long, term string").groupBy("doc_id", "term").count().withColumnRenamed("count", "n")
    c = spark.createDataFrame(cov, "doc_id long, g double")
    beta, theta, corr, gam = P.stm(d, 2, c, iters=8)
    coef = {(r.covariate, r.topic): r.coef for r in gam.collect()}
    assert abs(coef[("g", 0)]) > 1.0
    sums = theta.groupBy("doc_id").sum("gamma").collect()
    assert all(abs(r[1] - 1) < 1e-9 for r in sums)


def test_seeded_documents_of_a_batch_are_fitted_as_by_themselves():
    import numpy as np
    import pandas as pd
    from quire.operators import topics as P
    rng = np.random.default_rng(2)
    b = rng.random((9, 3)) + 0.1
    js = [np.sort(rng.choice(9, n, replace=False)) for n in (9, 2, 5, 2)]
    docs = pd.DataFrame({"js": js, "cs": [rng.integers(1, 5, len(j)) for j in js]})
    done = 0
    for rows, held, _, c, own in P._padded(docs, np.arange(9), b):
        gamma, expected = P._variational(own, c, 0.1, 20)
        for i, r in enumerate(rows):
            g1, e1 = P._variational(b[js[r]][None], docs["cs"][r][None].astype(float), 0.1, 20)
            assert np.allclose(gamma[i], g1[0]) and np.allclose(expected[i][held[i]], e1[0])
            done += 1
    assert done == 4
