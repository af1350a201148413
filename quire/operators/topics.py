"""Clustering and topic models.

k-means by hand (P1) is written as joins against broadcast centroids so it
can serve as an oracle for ML ``KMeans`` (P2); LDA is ML ``LDA`` with its
outputs reshaped to long tables (P5–P12).
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import math as M
from ..session import cut_lineage, ensure_checkpoint_dir


def kmeans_assign(X: DataFrame, centroids: DataFrame, key: str = "id", vec: str = "vec",
                  max_k: int = 10_000) -> DataFrame:
    """P1 assignment: nearest centroid (squared Euclidean, ties → smallest
    cluster id). The centroid table (k rows) is checked, then broadcast as one
    array; the minimum is taken inside the point's row (no shuffle, no copies)."""
    k = centroids.count()
    if k > max_k:
        raise ValueError(f"{k} centroids exceed {max_k}")
    from .embeddings import with_row_of
    cen = centroids.agg(F.collect_list(F.struct("cluster", F.col(vec).alias("v"))).alias("_c"))  # one row
    near = F.array_min(F.transform("_c", lambda c: F.struct(M.euclidean(vec, c["v"]).alias("dist"), c["cluster"].alias("cluster"))))
    best = with_row_of(X.select(key, vec), cen).select(key, near.alias("_b"))
    return best.select(key, "_b.cluster", "_b.dist")


def kmeans_update(X: DataFrame, assign: DataFrame, key: str = "id", vec: str = "vec") -> DataFrame:
    """P1 update: centroid = mean of its points (ML Summarizer aggregate)."""
    from .embeddings import mean_vectors
    j = X.select(key, vec).join(assign.select(key, "cluster"), key)
    return mean_vectors(j, "cluster", vec).select("cluster", vec, "n_vectors")


def kmeans_by_hand(X: DataFrame, init: DataFrame, key: str = "id", vec: str = "vec", max_iter: int = 10):
    """Alternate assignment and update until assignments stop changing or
    ``max_iter`` rounds. Assignments and centroids are written to the
    cluster's checkpoint folder each round (constant plan size)."""
    ensure_checkpoint_dir(X.sparkSession)
    cen = init
    prev = None
    for _ in range(max_iter):
        a = cut_lineage(kmeans_assign(X, cen, key, vec), "km-assign")
        if prev is not None:
            changed = a.join(prev.withColumnRenamed("cluster", "_p"), key).filter(F.col("cluster") != F.col("_p")).count()
            if changed == 0:
                break
        cen = cut_lineage(kmeans_update(X, a, key, vec), "km-centroids")
        prev = a
    return cen, a


def kmeans_ml(X: DataFrame, k: int, seed: int = 1, vec: str = "vec", max_iter: int = 20):
    """ML k-means on array vectors; returns (model, assignments)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    v = X.withColumn("_f", array_to_vector(vec))
    m = KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster", maxIter=max_iter).fit(v)
    return m, m.transform(v).drop("_f")


def cluster_examples(assign: DataFrame, docs: DataFrame, n: int = 5, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Documents with their cluster, ``n`` of each cluster chosen by a seeded hash."""
    from .relational import sample_n
    return sample_n(docs.join(assign.select(key, "cluster"), key), n, key, seed, by="cluster")


def cluster_terms(centers: DataFrame, vocab: DataFrame, n: int = 10, vec: str = "vec") -> DataFrame:
    """Top ``n`` words of each cluster centre (by weight, ties kept),
    collapsed to a label string."""
    ex = centers.select("cluster", F.posexplode(vec).alias("idx", "weight"))
    j = ex.join(vocab.select("idx", "term"), "idx")
    w = Window.partitionBy("cluster").orderBy(F.desc("weight"))
    top = j.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n)
    lab = top.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("top_terms"))
    return lab


def lda(counts: DataFrame, k: int, seed: int = 42, max_iter: int = 20, optimizer: str = "online",
        features: str = "features", passes: float = 5.0):
    """P5: ML LDA (online or EM variational inference; not Gibbs sampling).
    The rounds of the online form draw so large a share of the documents that all of them
    together make ``passes`` passes (at most one pass a round)."""
    from pyspark.ml.clustering import LDA
    rate = min(1.0, max(0.05, passes / max_iter))
    return LDA(k=k, seed=seed, maxIter=max_iter, optimizer=optimizer, featuresCol=features, subsamplingRate=rate).fit(counts)


def tidy_beta(model, vocab: list[str], spark) -> DataFrame:
    """Topic × term β in long form ``(topic, term, beta)`` (β normalised per topic)."""
    from pyspark.ml.functions import vector_to_array
    tt = model.describeTopics(maxTermsPerTopic=len(vocab))
    ex = tt.select("topic", F.arrays_zip("termIndices", "termWeights").alias("z")).select("topic", F.inline("z"))
    v = spark.createDataFrame(list(enumerate(vocab)), "termIndices int, term string")
    del vector_to_array
    return ex.join(v, "termIndices").select(
        "topic", "term", F.col("termWeights").alias("beta"))


def tidy_beta_terms(model, vocab: DataFrame) -> DataFrame:
    """P6 with the vocabulary as a table (idx, term)."""
    tt = model.describeTopics(maxTermsPerTopic=model.vocabSize())
    ex = tt.select("topic", F.arrays_zip("termIndices", "termWeights").alias("z")).select("topic", F.inline("z"))
    return ex.join(vocab.select(F.col("idx").alias("termIndices"), "term"), "termIndices").select(
        "topic", "term", F.col("termWeights").alias("beta"))


def tidy_gamma(model, counts: DataFrame, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Document × topic γ in long form ``(doc_id, topic, gamma)``."""
    from pyspark.ml.functions import vector_to_array
    keys = list(keys)
    t = model.transform(counts).select(*keys, vector_to_array("topicDistribution").alias("_g"))
    return t.select(*keys, F.posexplode("_g").alias("topic", "gamma"))


def top_terms(beta: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` terms per topic (ties kept) and a collapsed label."""
    w = Window.partitionBy("topic").orderBy(F.desc("beta"))
    top = beta.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n)
    return top.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("label"))


def main_topic(gamma: DataFrame, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The most probable topic per document (ties → smallest topic)."""
    keys = list(keys)
    return gamma.groupBy(*keys).agg(F.max_by("topic", F.struct("gamma", -F.col("topic"))).alias("topic"),
                                    F.max("gamma").alias("gamma"))


def top_docs(gamma: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` documents most typical of each topic (ties kept)."""
    w = Window.partitionBy("topic").orderBy(F.desc("gamma"))
    return gamma.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n)


def topic_prevalence(gamma: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Mean γ per topic, with labels when given."""
    p = gamma.groupBy("topic").agg(F.avg("gamma").alias("prevalence"))
    return p.join(labels, "topic", "left") if labels is not None else p


def label_topics(beta: DataFrame, term_totals: DataFrame, n: int = 7, w: float = 0.5, decimals: int = 12) -> DataFrame:
    """P10: topic labels by probability, lift (β / corpus share), FREX
    (weighted harmonic mean of the within-topic rank shares of β and
    exclusivity) and score (β times the distance of its log from the topics' mean log).
    Measures are compared to ``decimals`` places, ties by term."""
    from .topicquality import rank_share, score
    tot = term_totals.select("term", (F.col("n") / term_totals.select(F.sum("n")).scalar()).alias("share"))
    per = Window.partitionBy("term")
    b = beta.join(tot, "term").select(
        "topic", "term", F.round("beta", decimals).alias("beta"), F.round(F.col("beta") / F.col("share"), decimals).alias("lift"),
        F.round(F.col("beta") / F.sum("beta").over(per), decimals).alias("_e"), F.round(score(beta), decimals).alias("score"))
    b = rank_share(rank_share(b, "topic", "_e", "_re"), "topic", "beta", "_rf")
    b = b.withColumn("frex", F.round(1 / (w / F.col("_re") + (1 - w) / F.col("_rf")), decimals))
    out = None
    for m in ("beta", "lift", "frex", "score"):
        best = Window.partitionBy("topic").orderBy(F.desc(m), "term")
        r = b.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
        r = r.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                                                            lambda s: s["term"]), ", ").alias("label"))
        r = r.withColumn("measure", F.lit(m))
        out = r if out is None else out.unionByName(r)
    return out


def topic_corr(gamma: DataFrame, keys: Iterable[str] = ("doc_id",), max_topics: int = 1000) -> DataFrame:
    """Pearson correlation between topics over documents (γ pivoted to
    one column per topic — the topic count is bounded — then ML Correlation)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    keys = list(keys)
    topics = sorted(r[0] for r in gamma.select("topic").distinct().collect())
    if len(topics) > max_topics:
        raise ValueError("too many topics")
    wide = gamma.groupBy(*keys).pivot("topic", topics).agg(F.first("gamma")).na.fill(0.0)
    cols = [str(t) for t in topics]
    va = VectorAssembler(inputCols=cols, outputCol="_v").transform(wide)
    m = Correlation.corr(va, "_v").head()[0].toArray()
    rows = [(int(a), int(b), float(m[i, j])) for i, a in enumerate(topics) for j, b in enumerate(topics)]
    return gamma.sparkSession.createDataFrame(rows, "topic_a int, topic_b int, corr double")


def intrusion_tasks(beta: DataFrame, n: int = 5, seed: int = 42, decimals: int = 12) -> DataFrame:
    """Word-intrusion items — each topic's top ``n`` words plus one word
    from the bottom half of that topic that is in another topic's top list,
    chosen by a seeded hash."""
    from .relational import hash_key
    from .topicquality import rank_share, top_words
    top = cut_lineage(top_words(beta, n), "intrusion-top")
    others = top.select(F.col("topic").alias("_t"), "term")
    # only words of some top list can intrude: their ranks, among all words of the topic
    ranked = rank_share(beta.select("topic", "term", F.round("beta", decimals).alias("_b")), "topic", "_b", "_r")
    low = ranked.where(F.col("_r") <= 0.5).select("topic", "term")
    cand = low.join(others, "term").filter(F.col("_t") != F.col("topic")).select("topic", "term").distinct()
    cand = cand.withColumn("_h", hash_key(["topic", "term"], seed))
    intr = cand.groupBy("topic").agg(F.min_by("term", "_h").alias("intruder"))
    words = top.groupBy("topic").agg(F.array_sort(F.collect_list("term")).alias("words"))
    return words.join(intr, "topic", "left")


def search_k(counts: DataFrame, ks: Iterable[int], seed: int = 42, max_iter: int = 10,
             held_out: DataFrame | None = None) -> DataFrame:
    """One LDA per K; log-likelihood and perplexity (on ``held_out`` when
    given, else on the fitting set). All measures: :func:`.topicquality.sweep`."""
    spark = counts.sparkSession
    rows = []
    ev = held_out if held_out is not None else counts
    for k in ks:
        m = lda(counts, k, seed=seed, max_iter=max_iter)
        rows.append((int(k), float(m.logLikelihood(ev)), float(m.logPerplexity(ev))))
    return spark.createDataFrame(rows, "k int, log_likelihood double, log_perplexity double")


# ---- keyword-assisted (seeded) topics by variational EM --------------------------------------------

def _digamma(x):
    """ψ(x) for x > 0 (recurrence to x ≥ 6, then the asymptotic series)."""
    import numpy as np
    x = np.asarray(x, dtype=float).copy()
    acc = np.zeros_like(x)
    while np.any(x < 6):
        small = x < 6
        acc[small] -= 1.0 / x[small]
        x[small] += 1.0
    f = 1.0 / (x * x)
    return acc + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


_PART = "kind string, j int, vec array<double>"


#: Numbers of a batch of documents (documents x words x topics), about.
BATCH = 150_000


def _variational(b, c, alpha: float, inner: int):
    """(gamma, expected counts by word and topic) of a batch of documents; b: documents x words x
    topics, c: documents x words, 0 beyond a document's own words."""
    import numpy as np
    k = b.shape[2]
    gamma = np.repeat((alpha + c.sum(axis=1) / k)[:, None], k, axis=1)
    for _ in range(inner):
        phi = b * np.exp(_digamma(gamma))[:, None, :]
        phi *= (c / phi.sum(axis=2))[:, :, None]
        gamma = alpha + phi.sum(axis=1)
    return gamma, phi


def _padded(docs: pd.DataFrame, columns, b):
    """Documents of about the same number of words together: (rows, held, places, counts, own words' weights)."""
    import numpy as np
    js, cs = docs["js"].to_numpy(), docs["cs"].to_numpy()
    sizes = np.array([len(x) for x in js])
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi - lo + 1) * sizes[order[hi]] * b.shape[1] <= BATCH:
            hi += 1
        rows = order[lo:hi]
        held = np.arange(sizes[rows].max())[None, :] < sizes[rows][:, None]
        at, c = np.zeros(held.shape, np.int64), np.zeros(held.shape)
        at[held] = np.searchsorted(columns, np.concatenate([js[r] for r in rows]))
        c[held] = np.concatenate([cs[r] for r in rows])
        yield rows, held, at, c, b[at]
        lo = hi


def seeded_lda(d: DataFrame, seeds: dict, k: int | None = None, alpha: float = 0.1, eta: float = 0.01,
               seed_weight: float = 50.0, iters: int = 15, inner: int = 20, keys: Iterable[str] = ("doc_id",),
               term: str = "term", seed: int = 42):
    """Topics steered by keyword lists (``{topic label: [words]}``);
    topics beyond the seeded ones are free. Variational EM for LDA where the
    M-step adds ``seed_weight`` pseudo-counts to each topic's seed words.

    Topic-word parameters are a table: each block of documents is sent its own
    words' rows and gives their expected counts back (see :mod:`.blocks`). Returns
    ``(beta (topic, label, term, beta), doc topics (doc_id, topic, gamma))``.
    """
    import numpy as np
    from .blocks import aligned, flat, in_blocks, matrix, summed, total
    from .factors import noise
    spark = d.sparkSession
    key = list(keys)[0]
    labels = list(seeds) + [f"topic_{i}" for i in range(len(seeds), k or len(seeds))]
    K = len(labels)
    blocks = in_blocks(d, key, term, label="slda")
    words = spark.createDataFrame([(w, t) for t, ws in enumerate(seeds.values()) for w in ws], f"{term} string, t int")
    steer = words.groupBy(term).agg(F.collect_set("t").alias("ts"))
    weight = F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda t: F.lit(eta) + F.when(
        F.array_contains(F.coalesce("ts", F.array().cast("array<int>")), t), seed_weight).otherwise(0.0))
    prior = cut_lineage(blocks.columns.join(steer, term, "left").select("j", weight.alias("vec")), "slda-prior")

    def begin(batches):
        for pdf in batches:
            yield pd.DataFrame({"j": pdf["j"], "vec": list(matrix(pdf["vec"]) + (noise(pdf["j"].to_numpy(), K, seed) + 1) / 2 if len(pdf) else [])})

    beta = cut_lineage(prior.mapInPandas(begin, "j int, vec array<double>"), "slda-beta")

    def sizes(rows: DataFrame):
        return total(rows.withColumn("j", F.pmod("j", F.lit(blocks.size))), K)

    totals = sizes(beta)

    def expected(docs: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({"kind": [], "j": [], "vec": []})
        _, _, _, columns, _ = flat(docs["js"], docs["cs"])
        b = aligned(params, columns) / totals
        out = np.zeros_like(b)
        for _, held, at, c, own in _padded(docs, columns, b):
            np.add.at(out, at[held], _variational(own, c, alpha, inner)[1][held])
        words = pd.DataFrame({"kind": "word", "j": columns.astype("int32"), "vec": list(out)})
        return pd.concat([words, pd.DataFrame({"kind": ["size"], "j": [int(docs["block"].iloc[0])], "vec": [out.sum(axis=0)]})], ignore_index=True)

    given = sizes(prior)
    for _ in range(iters if blocks.n_columns else 0):
        parts = cut_lineage(blocks.solve(beta, expected, _PART), "slda-parts")
        new = summed(parts.where("kind = 'word'"), blocks.size)
        # a projection of stored tables, read by the next round only
        beta = new.join(prior.withColumnRenamed("vec", "p"), "j").select("j", F.zip_with("vec", "p", lambda x, y: x + y).alias("vec"))
        totals = given + total(parts.where("kind = 'size'"), K)
    beta = cut_lineage(beta, "slda-beta")

    def shares(docs: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({key: [], "gamma": []})
        _, _, _, columns, _ = flat(docs["js"], docs["cs"])
        b = aligned(params, columns) / totals
        found = np.zeros((len(docs), K))
        for rows, _, _, c, own in _padded(docs, columns, b):
            found[rows] = _variational(own, c, alpha, inner)[0]
        return pd.DataFrame({key: docs[key], "gamma": list(found / found.sum(axis=1, keepdims=True))})

    kind = d.schema[key].dataType.simpleString()
    theta = cut_lineage(blocks.solve(beta, shares, f"`{key}` {kind}, gamma array<double>"), "slda-theta")
    named = spark.createDataFrame([(t, labels[t], float(totals[t])) for t in range(K)], "topic int, label string, size double")
    table = (beta.select("j", F.posexplode("vec").alias("topic", "w")).join(F.broadcast(named), "topic").join(blocks.columns, "j")
             .select("topic", "label", term, (F.col("w") / F.col("size")).alias("beta")))
    return table, theta.select(key, F.posexplode("gamma").alias("topic", "gamma"))


# ---- correlated / structural topic model -----------------------------------------------------------

def stm(d: DataFrame, k: int, covariates: DataFrame | None = None, iters: int = 30, keys: Iterable[str] = ("doc_id",),
        term: str = "term", content: DataFrame | None = None, tol: float = 1e-5):
    """Structural topic model with topic-prevalence covariates
    (``covariates``: ``doc_id`` plus numeric columns; an intercept is added) and
    a content covariate (``content``: ``doc_id`` and one column) - without
    them it is the correlated topic model. See :mod:`quire.operators.structural`.

    Returns ``(beta (topic, term, beta), theta (doc_id, topic, gamma), topic
    correlation (topic_a, topic_b, corr), coefficients (covariate, topic, coef))``."""
    from .structural import fit
    m = fit(d, k, covariates, content, key=list(keys)[0], term=term, iters=iters, tol=tol)
    return m.beta, m.theta, m.correlation, m.coefficients
