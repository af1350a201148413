"""Streaming documents through the batch operators; Porter stemming."""

import os
import tempfile

from quire.functions.stemmer import porter
from quire.operators import tokens as T
from quire.streaming import dictionary_scores_stream, running_term_counts, stream_documents


def test_porter_examples():
    pairs = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "motoring": "motor", "hopping": "hop",
             "relational": "relat", "generalizations": "gener", "happy": "happi", "sky": "sky", "adoption": "adopt"}
    assert {w: porter(w) for w in pairs} == pairs


def test_stem_map_on_vocabulary(spark):
    toks = spark.createDataFrame([(1, 1, "running"), (1, 2, "runs"), (2, 1, "running")], "doc_id long, pos int, term string")
    m = {r.term: r.stem for r in T.stem_map(toks).collect()}
    assert m == {"running": "run", "runs": "run"}
    assert sorted(r.term for r in T.tokens_wordstem(toks).collect()) == ["run", "run", "run"]


def test_streaming_counts_match_batch(spark):
    src = tempfile.mkdtemp(prefix="quire-stream-", dir="/tmp")
    docs = spark.createDataFrame([(1, "The cat sat", "en", "s", 11), (2, "the cat ran", "en", "s", 11),
                                  (3, "ein Hund", "de", "s", 8)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.mode("overwrite").parquet(os.path.join(src, "part1"))
    stream = stream_documents(spark, os.path.join(src, "part1"))
    q = (running_term_counts(stream).writeStream.outputMode("complete").format("memory")
         .queryName("quire_term_counts").option("checkpointLocation", tempfile.mkdtemp(dir="/tmp")).start())
    q.processAllAvailable()
    got = {(r.lang, r.term): r.n for r in spark.table("quire_term_counts").collect()}
    q.stop()
    assert got[("en", "cat")] == 2 and got[("de", "hund")] == 1 and ("en", "the") not in got
    s2 = (dictionary_scores_stream(stream_documents(spark, os.path.join(src, "part1")), ["cat"], ["ran"])
          .writeStream.format("memory").queryName("quire_scores")
          .option("checkpointLocation", tempfile.mkdtemp(dir="/tmp")).start())
    s2.processAllAvailable()
    sc = {r.doc_id: (r.positive, r.negative) for r in spark.table("quire_scores").collect()}
    s2.stop()
    assert sc == {1: (1, 0), 2: (1, 1), 3: (0, 0)}


def test_glove_loss_decreases(spark):
    import numpy as np
    from quire.operators import embeddings as E
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(12)]
    rows = [(a, b, float(rng.integers(1, 30))) for a in words for b in words if a != b and rng.random() < 0.6]
    co = spark.createDataFrame(rows, "term1 string, term2 string, n double")
    V, losses = E.glove(co, rank=4, iters=4)
    assert V.count() == 12 and len(V.first().vec) == 4
    assert losses[-1] <= losses[0]
