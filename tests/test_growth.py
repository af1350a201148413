"""What has to stay bounded while tables grow: broadcasts, parts, and work that nobody asked for."""

import collections
import contextlib
import io

import pytest
from pyspark.sql import functions as F

from quire.operators import topicquality as TQ
from quire.plans import fixedtopics
from quire.sources.tables import deal, stored_bytes


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("small", [0, 100])
def test_documents_topics_are_never_broadcast(spark, tmp_path, small):
    beta = spark.createDataFrame([(0, "a", 0.75), (0, "b", 0.25), (1, "a", 0.1), (1, "b", 0.9)], "topic int, term string, beta double")
    spark.createDataFrame([(i, t, (0.5, 0.5)[t]) for i in range(20) for t in (0, 1)], "doc_id long, topic int, gamma double").write.parquet(f"{tmp_path}/t")
    theta = spark.read.parquet(f"{tmp_path}/t")  # a small file, as stored tables of documents are
    d = spark.createDataFrame([(i, w, 2) for i in range(20) for w in "ab"], "doc_id long, term string, n long")
    rows = TQ._vectors(beta, theta, d, "doc_id", small=small)
    assert "BroadcastHashJoin [doc_id" not in plan(rows) and "SortMergeJoin [doc_id" in plan(rows)
    assert {(r.term, round(r.q, 9)) for r in rows.collect()} == {("a", 0.425), ("b", 0.575)}
    assert TQ.residual_dispersion(beta, theta, d).first().residual is not None


def test_parts_grow_with_the_files_not_in_size(spark, tmp_path):
    spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    size = stored_bytes(df)
    assert size > 100_000
    dealt = deal(df, "doc_id", part=size // 40)
    assert dealt.rdd.getNumPartitions() >= 40 and dealt.count() == 4000
    slots = spark.sparkContext.defaultParallelism
    assert deal(df, "doc_id").rdd.getNumPartitions() == slots
    assert deal(spark.range(3).select("id"), "id").rdd.getNumPartitions() == slots  # no files


def test_fixed_topics_count_by_hand_and_make_gamma_only_when_asked(spark, tmp_path):
    docs = [(i, ("de", "en", "es", "fr")[i % 4], f"one two{i % 2} both") for i in range(24)]
    docs += [(3, "fr", "one one both"), (3, "en", "both"), (None, "en", "one both"), (90, "xx", "one"), (91, "de", "rare")]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    m = fixedtopics.Model(spark, str(tmp_path))
    found = {(r.topic, r.term): r.beta for r in m.beta.collect()}
    assert "gamma" not in vars(m) and "d" not in vars(m)
    known = [x for x in docs if x[1] in fixedtopics.LANGS]
    cells = collections.Counter((i, w) for i, _, t in known for w in t.split())
    df = collections.Counter(w for _, w in cells)
    kept = {w for w in df if df[w] >= 5}
    counts = collections.Counter()
    for i, lang, _ in known:  # a repeated id counts with each of its rows, a null id with none
        for (j, w), n in cells.items():
            if i is not None and i == j and w in kept:
                counts[fixedtopics.LANGS.index(lang), w] += n
    size = [sum(counts[k, w] for w in kept) + 0.1 * len(kept) for k in range(4)]
    beta = {(k, w): (counts[k, w] + 0.1) / size[k] for k in range(4) for w in kept}
    assert found == pytest.approx(beta)
    total = {w: sum(beta[k, w] for k in range(4)) for w in kept}
    own = {}
    for (i, w), n in cells.items():
        if w in kept:
            own.setdefault(i, []).append((w, n))
    gamma = {(i, k): sum(n * beta[k, w] / total[w] for w, n in ws) / sum(n for _, n in ws) for i, ws in own.items() for k in range(4)}
    assert {(r.doc_id, r.topic): r.gamma for r in m.gamma.collect()} == pytest.approx(gamma, abs=1e-8)
    assert {(r.doc_id, r.term): r.n for r in m.d.collect()} == {x: n for x, n in cells.items() if x[1] in kept}
