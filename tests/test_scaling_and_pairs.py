"""Wordscores golden values, Wordfish recovery, win coding, matchups,
Bradley–Terry order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import comparisons as N
from quire.operators import scaling as Q


def test_wordscores_wall_example(spark):
    # Republican (+1) uses "wall" 25 times in 1000 words, Democrat (−1) 5 times.
    d = spark.createDataFrame([(1, "wall", 25), (1, "other", 975), (2, "wall", 5), (2, "other", 995),
                               (3, "wall", 200), (3, "other", 800)], "doc_id long, term string, n long")
    ref = spark.createDataFrame([(1, 1.0), (2, -1.0)], "doc_id long, a double")
    ws = {r.term: r.score for r in Q.wordscores_fit(d, ref, smooth=0.0).collect()}
    assert ws["wall"] == pytest.approx(0.025 / 0.03 - 0.005 / 0.03)  # 0.8333 − 0.1667 = 0.6667
    only_wall = Q.wordscores_fit(d, ref).filter(F.col("term") == "wall")
    v = Q.wordscores_predict(d.filter("doc_id = 3"), only_wall).first()
    assert v.score == pytest.approx(0.6667, abs=1e-4)
    p = {r.doc_id: r.score for r in Q.wordscores_predict(d, Q.wordscores_fit(d, ref)).collect()}
    assert p[1] > p[3] > p[2] or p[3] > p[1]  # monotone in the share of "wall"


def test_wordfish_recovers_positions(spark):
    rng = np.random.default_rng(3)
    n_docs, n_words = 40, 60
    omega = np.linspace(-1.5, 1.5, n_docs)
    beta = rng.normal(0, 0.8, n_words)
    psi = rng.normal(1.0, 0.5, n_words)
    alpha = rng.normal(0, 0.2, n_docs)
    y = rng.poisson(np.exp(alpha[:, None] + psi[None, :] + beta[None, :] * omega[:, None]))
    rows = [(int(i), f"w{j}", int(y[i, j])) for i in range(n_docs) for j in range(n_words) if y[i, j] > 0]
    d = spark.createDataFrame(rows, "doc_id long, term string, n long")
    docs, words = Q.wordfish(d, dir=(0, n_docs - 1), max_iter=25)
    est = {r.doc_id: r.omega for r in docs.collect()}
    e = np.array([est[i] for i in range(n_docs)])
    assert np.corrcoef(e, omega)[0, 1] > 0.9
    assert e[0] < e[-1]
    pr = Q.wordfish_predict(docs).first()
    assert pr.lwr < pr.fit < pr.upr


def test_win_coding(spark):
    rows = [("a", "b", "liberal", "a"), ("a", "b", "liberal", "b"), ("a", "b", "conservative", "a"),
            ("a", "b", "conservative", "b"), ("a", "b", "liberal", "Tie"), ("a", "b", "liberal", None)]
    df = spark.createDataFrame(rows, "n1 string, n2 string, direction string, answer string")
    w = [(r.win1, r.win2, r.defective) for r in N.win_table(df, "n1", "n2", "n1", "n2", "answer").collect()]
    assert w == [(0.0, 1.0, False), (1.0, 0.0, False), (1.0, 0.0, False), (0.0, 1.0, False),
                 (0.5, 0.5, False), (None, None, True)]


def test_clean_answer_and_parse(spark):
    import json
    df = spark.createDataFrame([(json.dumps({"choices": [{"message": {"content": " Senator Ann Lee. "}}]}), "Ann Lee", "Bo Di")],
                               "response string, n1 string, n2 string")
    r = df.select(N.parse_response("response")).withColumn("n1", F.lit("Ann Lee")).withColumn("n2", F.lit("Bo Di"))
    assert r.select(N.clean_answer("answer", "n1", "n2").alias("c")).first().c == "Ann Lee"


def test_matchups_cover_every_item(spark):
    items = spark.range(0, 7).withColumnRenamed("id", "item")
    m = N.matchups(items, "item", 2)
    rows = m.collect()
    assert len(rows) == 14 and all(r.item1 != r.item2 for r in rows)
    seen = {}
    for r in rows:
        seen.setdefault(r.item1, set()).add(r.item2)
        seen.setdefault(r.item2, set()).add(r.item1)
    assert all(len(v) >= 2 for v in seen.values()) and len(seen) == 7


def test_bradley_terry_order(spark):
    # transitive: a beats everyone, b beats c and d, c beats d
    order = ["a", "b", "c", "d"]
    rows = []
    for i, x in enumerate(order):
        for y in order[i + 1:]:
            rows += [(x, y, 1.0, 0.0, False)] * 3 + [(x, y, 0.0, 1.0, False)]
    wins = spark.createDataFrame(rows, "item1 string, item2 string, win1 double, win2 double, defective boolean")
    bt = {r.item: r.strength for r in N.bradley_terry(wins, max_iter=60).collect()}
    assert sorted(bt, key=lambda k: -bt[k]) == order


def test_following_scale_recovers_order(spark):
    rng = np.random.default_rng(5)
    theta = rng.uniform(-1.5, 1.5, 150)
    phi = np.linspace(-1.5, 1.5, 8)
    rows = []
    for i, t in enumerate(theta):
        for j, f in enumerate(phi):
            if rng.random() < 1 / (1 + np.exp(-(1.0 - 2.0 * (t - f) ** 2))):
                rows.append((f"u{i}", f"e{j}"))
    edges = spark.createDataFrame(rows, "user string, elite string")
    users, elites = Q.following_scale(edges, iters=25, lr=0.1)
    est = {r.user: r.theta for r in users.collect()}
    common = [i for i in range(len(theta)) if f"u{i}" in est]
    c = np.corrcoef([est[f"u{i}"] for i in common], theta[common])[0, 1]
    assert abs(c) > 0.7


def test_co_occurrences_are_counted_before_they_are_shuffled(spark, monkeypatch):
    import collections
    import random
    import pyarrow as pa
    from quire.operators import embeddings as E
    r = random.Random(4)
    docs = [[r.choice(["a", "b", "é", "Z", None]) for _ in range(r.randrange(0, 40))] for _ in range(60)] + [None, [], ["a"], ["c", "c"]]
    want = collections.Counter()
    for d in docs:
        for i, x in enumerate(d or []):
            for y in (d or [])[i + 1:i + 7]:
                if x is not None and y is not None:
                    want[x, y] += 1
                    want[y, x] += 1
    df = spark.createDataFrame([(i % 3, d) for i, d in enumerate(docs)], "doc_id int, toks array<string>")
    rows = E.fcm(df, 6).collect()
    assert len(rows) == len(want) and {(x.term1, x.term2): x.n for x in rows} == want
    monkeypatch.setattr(E, "SPAN", 7)
    for kept in (1 << 22, 4):  # with few pairs kept, some are given twice, and the sums stay
        monkeypatch.setattr(E, "PAIRS", kept)
        batch = pa.RecordBatch.from_arrays([pa.array(docs, pa.list_(pa.string()))], names=["toks"])
        found = [x for b in E._near([batch, batch.slice(5, 20)], 6) for x in b.to_pylist()]
        half = collections.Counter()
        for x in found:
            half[tuple(sorted((x["x"], x["y"])))] += x["n"]
        assert kept == 4 or len(found) == len(half)  # a row for each different pair, not for each time it is met
        assert half["c", "c"] == 1 and half.total() == sum(want.values()) / 2 + sum(
            1 for d in docs[5:25] for i, x in enumerate(d or []) for y in (d or [])[i + 1:i + 7] if x is not None and y is not None)
