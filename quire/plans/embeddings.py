"""Embedding and clustering analyses: ``embeddings`` vectors and
``documents`` word statistics (K1–K21, P1–P18)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import math as M
from ..operators import dfm as D
from ..operators import embeddings as E
from ..operators import clusters as CL
from ..operators import skipgram as SG
from ..operators import topicquality as TQ
from ..operators import tokens as T
from ..operators import topics as P
from ..session import cut_lineage
from ..sources.tables import documents, table
from .registry import register
from .sqlparts import STOP_EN_SQL, tokens_cte

DIM = 64

#: CountVectorizer's own default drops all but 262,144 terms.
NO_CAP = 2**31 - 1


def _vecs(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")


def _en_arrays(spark, sf):
    return T.token_arrays(documents(spark, sf).filter(F.col("lang") == "en").select("doc_id", "text"))


_DVEC = "CAST(embedding AS DOUBLE[])"


# --- K7 nearest by dot product -------------------------------------------------------------------
@register("nearest_vectors", f"""
SELECT vec_id, round(list_dot_product({_DVEC}, (SELECT {_DVEC} FROM embeddings WHERE vec_id = 0)), 6) AS score
FROM embeddings ORDER BY list_dot_product({_DVEC}, (SELECT {_DVEC} FROM embeddings WHERE vec_id = 0)) DESC, vec_id
LIMIT 10""")
def nearest_vectors(spark, sf):
    V = _vecs(spark, sf)
    q = E.vector_of(V, 0, key="vec_id")
    r = E.nearest_to_vector(V, q, 10, key="vec_id")
    return r.select("vec_id", F.round("score", 6).alias("score"))


# --- K12 analogy ------------------------------------------------------------------------------------
@register("analogy_vectors", f"""
WITH q AS (SELECT list_transform(generate_series(1, {DIM}), lambda i: a[i] - b[i] + c[i]) AS q FROM
  (SELECT (SELECT {_DVEC} FROM embeddings WHERE vec_id = 1) AS a, (SELECT {_DVEC} FROM embeddings WHERE vec_id = 2) AS b,
          (SELECT {_DVEC} FROM embeddings WHERE vec_id = 3) AS c))
SELECT vec_id, round(list_cosine_similarity({_DVEC}, q), 6) AS score FROM embeddings, q
WHERE vec_id NOT IN (1, 2, 3) ORDER BY list_cosine_similarity({_DVEC}, q) DESC, vec_id LIMIT 10""")
def analogy_vectors(spark, sf):
    r = E.analogy(_vecs(spark, sf), 1, 2, 3, 10, key="vec_id")
    return r.select("vec_id", F.round("score", 6).alias("score"))


# --- K14 / C12 centroids per label ------------------------------------------------------------------------
_CENTROIDS_SQL = f"""
cl AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v FROM embeddings, generate_series(1, {DIM}) g(i)
       GROUP BY label, i),
cen AS (SELECT label, list(v ORDER BY i) AS c FROM cl GROUP BY label)"""


@register("label_centroids", f"""WITH {_CENTROIDS_SQL}
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(v, 6) AS value FROM cl""")
def label_centroids(spark, sf):
    c = E.mean_vectors(_vecs(spark, sf), "label")
    return c.select("label", F.posexplode("vec").alias("dim", "value")).select(
        "label", "dim", F.round("value", 6).alias("value"))


# --- K16 similarity to centroids ---------------------------------------------------------------------------
@register("centroid_similarity", f"""WITH {_CENTROIDS_SQL},
s AS (SELECT e.vec_id, e.label, cen.label AS cl, list_cosine_similarity({_DVEC}, cen.c) AS cs FROM embeddings e, cen)
SELECT vec_id, label, round(max(cs) FILTER (WHERE cl = label), 6) AS cos_own,
       arg_max(cl, cs) AS best_label FROM s GROUP BY vec_id, label""")
def centroid_similarity(spark, sf):
    V = _vecs(spark, sf)
    cen = E.mean_vectors(V, "label").withColumnRenamed("label", "category")
    s = E.dict_similarity(V.select("vec_id", "vec"), cen, keys=["vec_id"])
    j = s.join(V.select("vec_id", "label"), "vec_id")
    return j.groupBy("vec_id", "label").agg(
        F.round(F.max(F.when(F.col("category") == F.col("label"), F.col("cosine"))), 6).alias("cos_own"),
        F.max_by("category", "cosine").alias("best_label"))


# --- P1 one k-means step from the label centroids -----------------------------------------------------------
@register("kmeans_one_step", f"""WITH {_CENTROIDS_SQL},
d AS (SELECT e.vec_id, cen.label AS cluster, list_distance({_DVEC}, cen.c) AS dist FROM embeddings e, cen),
a AS (SELECT vec_id, arg_min(cluster, (dist, cluster)) AS cluster, min(dist) AS dist FROM d GROUP BY vec_id)
SELECT cluster, count(*) AS n, round(avg(dist), 6) AS mean_dist FROM a GROUP BY cluster""")
def kmeans_one_step(spark, sf):
    V = _vecs(spark, sf)
    cen = E.mean_vectors(V, "label").withColumnRenamed("label", "cluster")
    a = P.kmeans_assign(V, cen, key="vec_id")
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dist"), 6).alias("mean_dist"))


# --- K8 top vectors per dimension by |value| ------------------------------------------------------------------
@register("dimension_top_vectors", f"""
SELECT dim, vec_id, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT CAST(i - 1 AS INTEGER) AS dim, vec_id, round(CAST(embedding[i] AS DOUBLE), 6) AS value,
         rank() OVER (PARTITION BY i ORDER BY abs(embedding[i]) DESC) AS rank
  FROM embeddings, generate_series(1, {DIM}) g(i)) WHERE rank <= 3""")
def dimension_top_vectors(spark, sf):
    V = _vecs(spark, sf).withColumnRenamed("vec_id", "term")
    r = E.dimension_words(V, range(DIM), 3)
    return r.select("dim", F.col("term").alias("vec_id"), F.round(F.col("value").cast("double"), 6).alias("value"), "rank")


# --- K1 unigram probabilities -----------------------------------------------------------------------------------
@register("unigram_probs_en", f"""
WITH {tokens_cte("(SELECT * FROM documents WHERE lang = 'en')")}
SELECT term, count(*) AS n, round(count(*) / (SELECT count(*) FROM tok), 9) AS p FROM tok GROUP BY term""")
def unigram_probs_en(spark, sf):
    d = D.dfm_from_arrays(_en_arrays(spark, sf))
    u = E.unigram_probs(d)
    return u.select("term", "n", F.round("p", 9).alias("p"))


# --- K2–K4 skip-gram PMI -------------------------------------------------------------------------------------------
@register("skipgram_pmi_en", f"""
WITH {tokens_cte("(SELECT * FROM documents WHERE lang = 'en')")},
nt AS (SELECT doc_id, max(pos) AS nn FROM tok GROUP BY doc_id),
w AS (SELECT DISTINCT t.doc_id, s.s, t.term FROM tok t JOIN nt USING (doc_id),
        generate_series(greatest(1, t.pos - 5), least(t.pos, nt.nn - 5)) AS s(s) WHERE nt.nn >= 6),
pairs AS (SELECT a.term AS term1, b.term AS term2, count(*) AS n FROM w a JOIN w b USING (doc_id, s) GROUP BY 1, 2),
tot AS (SELECT sum(n) AS tn FROM pairs),
uni AS (SELECT term, count(*) / (SELECT count(*) FROM tok) AS p FROM tok GROUP BY term)
SELECT term1, term2, n, round(log10((n / tn) / u1.p / u2.p), 6) AS pmi
FROM pairs, tot, uni u1, uni u2 WHERE n > 20 AND u1.term = term1 AND u2.term = term2""")
def skipgram_pmi_en(spark, sf):
    p = E.skipgram_pmi(_en_arrays(spark, sf), 6, 20)
    return p.select("term1", "term2", "n", F.round("pmi", 6).alias("pmi"))


# --- K9 co-occurrence within ±6 tokens, stop words as pads ------------------------------------------------------------
@register("fcm_top_en", f"""
WITH {tokens_cte("(SELECT * FROM documents WHERE lang = 'en')")},
k AS (SELECT * FROM tok WHERE term NOT IN ({STOP_EN_SQL}))
SELECT a.term AS term1, b.term AS term2, count(*) AS n FROM k a JOIN k b
  ON a.doc_id = b.doc_id AND abs(a.pos - b.pos) BETWEEN 1 AND 6
GROUP BY 1, 2 ORDER BY n DESC, term1, term2 LIMIT 100""")
def fcm_top_en(spark, sf):
    arr = E.pad_array(_en_arrays(spark, sf), drop=T.STOPWORDS_EN)
    f = E.fcm(arr, 6)
    return f.orderBy(F.desc("n"), "term1", "term2").limit(100)


# --- K11 word2vec neighbours (model-based: row check only) ---------------------------------------------------------------
def _all_arrays(spark, sf, *more):
    return T.token_arrays(documents(spark, sf).select("doc_id", "text", *more), keys=["doc_id", *more])


@register("word2vec_neighbours")
def word2vec_neighbours(spark, sf):
    """Skip-gram vectors (300 dimensions, window 6, 5 epochs, words seen 10 times or more)
    of all distinct documents; the 10 nearest words (cosine) to the most frequent one."""
    arr = _all_arrays(spark, sf)
    _, V = E.word2vec(arr, size=300, window=6, min_count=10, epochs=5)
    top = D.topfeatures(D.dfm_from_arrays(arr), 1).select("term")
    q = V.join(top, "term").select(F.col("vec").alias("_q"))
    return E.nearest_to_vector(V, q, 10, measure="cosine")


# --- K18 embeddings of slices, each started from the one before (row check only) ------------------------------------------
@register("slice_meaning_shift")
def slice_meaning_shift(spark, sf):
    """Documents in three slices by id (standing for time); vectors of each
    slice start from those of the one before; the 20 words whose vectors differ most between
    the first and the last slice."""
    arr = _all_arrays(spark, sf)
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int")
    found = SG.temporal_embeddings(arr, third, [0, 1, 2], "chained", size=100, min_count=10, epochs=3)
    return SG.meaning_shift(found, 0, 2).orderBy("cosine", "term").limit(20).withColumn("cosine", F.round("cosine", 6))


# --- K6 SVD of the PMI matrix (row check only) ------------------------------------------------------------------------------
@register("svd_word_vectors")
def svd_word_vectors(spark, sf):
    """256 dimensions of the PMI matrix of all documents' words."""
    p = E.skipgram_pmi(_all_arrays(spark, sf), 6, 20)
    V, _s = E.svd_vectors(p, 256)
    return V.select("term", F.size("vec").alias("dims"), F.round(M.norm("vec"), 6).alias("norm"))


# --- P2 ML k-means cluster sizes (row check only) ---------------------------------------------------------------------------
@register("kmeans_embeddings")
def kmeans_embeddings(spark, sf):
    _, a = P.kmeans_ml(_vecs(spark, sf), 10, seed=1)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


# --- P5–P9 LDA topics on English documents (row check only) --------------------------------------------------------------------
@register("lda_topics_en")
def lda_topics_en(spark, sf):
    from pyspark.ml.feature import CountVectorizer
    arr = T.filter_array(_en_arrays(spark, sf), drop=T.STOPWORDS_EN)
    cv = CountVectorizer(inputCol="toks", outputCol="features", minDF=5.0, vocabSize=NO_CAP).fit(arr)
    counts = cv.transform(arr)
    model = P.lda(counts, 5, seed=42, max_iter=10)
    beta = P.tidy_beta(model, cv.vocabulary, spark)
    gamma = P.tidy_gamma(model, counts)
    labels = P.top_terms(beta, 10)
    return P.topic_prevalence(gamma, labels).select("topic", "label", F.round("prevalence", 6).alias("prevalence"))


# --- K9 + K10 GloVe on English co-occurrences (iterative: row check only) ----------------------------
@register("glove_neighbours")
def glove_neighbours(spark, sf):
    """GloVe vectors (rank 50, at most 8 rounds, until the loss falls by less than 1 %) from ±6
    co-occurrences of all documents with English stop words as pads and terms seen ≥ 10 times; the 10 nearest
    words (cosine) to the most frequent kept term."""
    arr = _all_arrays(spark, sf)
    counts = D.dfm_from_arrays(arr).groupBy("term").agg(F.sum("n").alias("n"))
    keep = counts.filter(F.col("n") >= 10).select("term")
    keep_terms = keep.join(spark.createDataFrame([(w,) for w in T.STOPWORDS_EN], "term string"), "term", "left_anti")
    padded = E.pad_array(arr, drop=T.STOPWORDS_EN)
    f = E.fcm(padded, 6).join(keep_terms.withColumnRenamed("term", "term1"), "term1", "left_semi") \
        .join(keep_terms.withColumnRenamed("term", "term2"), "term2", "left_semi")
    V, _losses = E.glove(f, rank=50, iters=8, tol=0.01)
    top = counts.join(keep_terms, "term").orderBy(F.desc("n"), "term").limit(1).select("term")
    q = V.join(top, "term").select(F.col("vec").alias("_q"))
    r = E.nearest_to_vector(V, q, 10, measure="cosine")
    return r.select("term", F.round("score", 6).alias("score"))


# --- K15 / K17 / K19 on the embedding table (row checks) -------------------------------------------
def _vterms(spark, sf):
    return _vecs(spark, sf).select(F.col("vec_id").cast("string").alias("term"), "vec", "label")


_VSQL = "v AS (SELECT CAST(vec_id AS VARCHAR) AS term, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"


@register("expanded_seeds", f"""
WITH {_VSQL},
s AS (SELECT * FROM (VALUES ('alpha', '0'), ('alpha', '1'), ('beta', '2')) t(category, seed)),
sv AS (SELECT s.category, s.seed, v.vec AS svec FROM s JOIN v ON v.term = s.seed),
sc AS (SELECT sv.category, sv.seed, v.term, list_dot_product(v.vec, sv.svec) AS score FROM sv, v WHERE v.term <> sv.seed),
r AS (SELECT *, row_number() OVER (PARTITION BY category, seed ORDER BY score DESC, term) AS rank FROM sc)
SELECT category, seed, term, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def expanded_seeds(spark, sf):
    """The 5 nearest vectors (dot product) of each seed, per category."""
    V = _vterms(spark, sf)
    seeds = spark.createDataFrame([("alpha", "0"), ("alpha", "1"), ("beta", "2")], "category string, pattern string")
    return E.expand_dict(seeds, V.select("term", "vec"), n=5).select("category", "seed", "term", F.round("score", 6).alias("score"), "rank")


@register("axis_projection_vectors", f"""
WITH {_VSQL},
x AS (SELECT (SELECT vec FROM v WHERE term = '0') AS a, (SELECT vec FROM v WHERE term = '1') AS b,
             (SELECT vec FROM v WHERE term = '2') AS c, (SELECT vec FROM v WHERE term = '3') AS d),
ax AS (SELECT list_transform(generate_series(1, {DIM}), lambda i: (a[i] + c[i]) / 2 - (b[i] + d[i]) / 2) AS axis FROM x)
SELECT term, round(list_cosine_similarity(vec, axis), 6) AS projection FROM v, ax""")
def axis_projection_vectors(spark, sf):
    """Projection of every vector on the axis of two antonym pairs."""
    V = _vterms(spark, sf).select("term", "vec")
    p = E.axis_projection(V, [("0", "1"), ("2", "3")])
    return p.select("term", F.round("projection", 6).alias("projection"))


@register("relative_norm_labels", f"""WITH {_CENTROIDS_SQL}, {_VSQL}
SELECT term, round(list_distance(vec, (SELECT c FROM cen WHERE label = 0))
                   - list_distance(vec, (SELECT c FROM cen WHERE label = 1)), 6) AS relative_norm FROM v""")
def relative_norm_labels(spark, sf):
    """Distance to the centroid of label 0 minus distance to label 1's."""
    V = _vterms(spark, sf)
    cen = E.mean_vectors(V, "label")
    c0 = cen.filter(F.col("label") == 0).select("vec")
    c1 = cen.filter(F.col("label") == 1).select("vec")
    return E.relative_norm(V.select("term", "vec"), c0, c1).select("term", F.round("relative_norm", 6).alias("relative_norm"))


# --- P2–P4 k-means on proportion dfm, top words per cluster (row check) ---------------------------------
@register("kmeans_cluster_terms")
def kmeans_cluster_terms(spark, sf):
    """k-means (k=10) on English documents' proportion vectors (CountVectorizer
    vocabulary, min 5 documents); 10 top words per cluster and cluster sizes."""
    from pyspark.ml.feature import CountVectorizer, Normalizer
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import vector_to_array
    arr = T.filter_array(_en_arrays(spark, sf), drop=T.STOPWORDS_EN)
    cv = CountVectorizer(inputCol="toks", outputCol="counts", minDF=5.0, vocabSize=NO_CAP).fit(arr)
    x = Normalizer(inputCol="counts", outputCol="features", p=1.0).transform(cv.transform(arr))
    m = KMeans(k=10, seed=1, featuresCol="features", predictionCol="cluster").fit(x)
    centers = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(m.clusterCenters())],
                                    "cluster int, vec array<double>")  # k × vocabulary, bounded by the model
    vocab = spark.createDataFrame(list(enumerate(cv.vocabulary)), "idx int, term string")
    terms = P.cluster_terms(centers, vocab, 10)
    sizes = m.transform(x).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    del vector_to_array
    return terms.join(sizes, "cluster", "left")


# --- P12 topic correlations (row check) -----------------------------------------------------------------------
@register("lda_topic_correlation")
def lda_topic_correlation(spark, sf):
    from pyspark.ml.feature import CountVectorizer
    arr = T.filter_array(_en_arrays(spark, sf), drop=T.STOPWORDS_EN)
    cv = CountVectorizer(inputCol="toks", outputCol="features", minDF=5.0, vocabSize=NO_CAP).fit(arr)
    counts = cv.transform(arr)
    model = P.lda(counts, 5, seed=42, max_iter=10)
    return P.topic_corr(P.tidy_gamma(model, counts)).withColumn("corr", F.round("corr", 6))


# --- K20 covariate (source) positions learned with the words (row check) --------------------------------
@register("source_embedding_positions")
def source_embedding_positions(spark, sf):
    """Sources as pseudo-words in the skip-gram PMI matrix of all documents, factorised
    (rank 256) and placed on their first principal component."""
    pos, _V = E.covariate_embeddings(_all_arrays(spark, sf, "source"), "source", size=6, min_n=20, k=256)
    return pos.select("source", F.round("position", 6).alias("position"))


# --- P8, P10, P11, P17, P18 on one LDA fit (row checks) ------------------------------------------------
def _lda_fit(spark, sf, k=5):
    from pyspark.ml.feature import CountVectorizer
    arr = T.filter_array(_en_arrays(spark, sf), drop=T.STOPWORDS_EN)
    cv = CountVectorizer(inputCol="toks", outputCol="features", minDF=5.0, vocabSize=NO_CAP).fit(arr)
    counts = cv.transform(arr)
    model = P.lda(counts, k, seed=42, max_iter=10)
    return arr, cv, counts, model


@register("lda_main_topics")
def lda_main_topics(spark, sf):
    """P8 + P11: main topic per document (counts per topic) and each topic's
    most typical document."""
    _, _, counts, model = _lda_fit(spark, sf)
    gamma = P.tidy_gamma(model, counts)
    main = P.main_topic(gamma).groupBy("topic").agg(F.count(F.lit(1)).alias("n_docs"))
    best = P.top_docs(gamma, 1).groupBy("topic").agg(F.min("doc_id").alias("top_doc"))
    return main.join(best, "topic", "full")


@register("lda_topic_labels")
def lda_topic_labels(spark, sf):
    """P10: topic labels by probability, lift and FREX."""
    arr, cv, _, model = _lda_fit(spark, sf)
    beta = P.tidy_beta(model, cv.vocabulary, spark)
    totals = D.dfm_from_arrays(arr).groupBy("term").agg(F.sum("n").alias("n"))
    return P.label_topics(beta, totals, n=7)


@register("lda_intrusion_tasks")
def lda_intrusion_tasks(spark, sf):
    """Word-intrusion items per topic."""
    _, cv, _, model = _lda_fit(spark, sf)
    beta = P.tidy_beta(model, cv.vocabulary, spark)
    return P.intrusion_tasks(beta, n=5, seed=42).select("topic", F.array_join("words", ", ").alias("words"), "intruder")


@register("lda_search_k")
def lda_search_k(spark, sf):
    """For K = 10, 30, ... 210: coherence, exclusivity, residual dispersion, likelihood of
    held-out words and bound, over all documents' frequent terms."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    r = TQ.sweep(_frequent_terms(docs), range(10, 211, 20))
    return r.select("k", *[F.round(c, 6).alias(c) for c in ("coherence", "exclusivity", "residual", "heldout", "bound")])


@register("dense_cluster_topics")
def dense_cluster_topics(spark, sf):
    """documents' vectors (means of skip-gram vectors) in dense clusters; of each
    cluster its size and the five words with the largest class TF-IDF."""
    arr = _all_arrays(spark, sf)
    d = D.dfm_from_arrays(arr)
    _, V = E.word2vec(arr, size=32, min_count=10, epochs=2)
    vecs = cut_lineage(E.doc_vectors(d, V), "doc-vectors")
    cl = cut_lineage(CL.dense_clusters(vecs, key="doc_id", min_points=5, min_size=10), "clusters")
    w = Window.partitionBy("cluster").orderBy(F.desc("w"), "term")
    top = CL.class_tfidf(d, cl).withColumn("rank", F.row_number().over(w)).where("rank <= 5")
    words = top.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("words"))
    return cl.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs")).join(words, "cluster", "left")


# Keyword lists for the seeded topics (frequent invented words of the corpus).
SEED_TOPICS = {"connective": ["and", "the", "of"], "verbal": ["is", "was", "are"]}


@register("seeded_topics_en")
def seeded_topics_en(spark, sf):
    """Two keyword-assisted topics plus two free ones on English
    documents (terms in ≥ 5 % of documents); top 5 terms per topic."""
    docs = table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "text")
    beta, _theta = P.seeded_lda(_frequent_terms(docs), SEED_TOPICS, k=4, iters=8)
    top = P.top_terms(beta.select("topic", "term", "beta"), 5)
    names = beta.select("topic", F.col("label").alias("name")).distinct()
    return top.join(names, "topic").select("topic", "name", F.col("label").alias("terms"))


def _frequent_terms(docs):
    """The dfm of all documents: terms in at least 5 % of them."""
    d = D.dfm_from_arrays(T.token_arrays(docs))
    return D.dfm_trim(d, n_docs=docs.select(F.count(F.lit(1))), min_docfreq=0.05, docfreq_type="prop")


@register("stm_lang_prevalence")
def stm_lang_prevalence(spark, sf):
    """Structural topic model (K = 30) over all documents with language
    indicators as prevalence covariates; the coefficients per covariate and topic."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    cov = docs.select("doc_id", *[(F.col("lang") == l).cast("double").alias(f"lang_{l}") for l in ("de", "es", "fr")])
    _b, _t, _c, gam = P.stm(_frequent_terms(docs), 30, cov, iters=8, tol=1e-4)
    return gam.withColumn("coef", F.round("coef", 6))


@register("stm_source_content")
def stm_source_content(spark, sf):
    """Structural topic model (K = 5) whose words differ by language
    (content covariate); the five words that a language raises most in each topic."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    beta, _t, _c, _g = P.stm(_frequent_terms(docs), 5, content=docs.select("doc_id", "lang"), iters=5, tol=1e-4)
    mean = beta.groupBy("topic", "term").agg(F.avg("beta").alias("mean"))
    lift = beta.where("group is not null").join(mean, ["topic", "term"]).withColumn("lift", F.col("beta") / F.col("mean"))
    w = Window.partitionBy("group", "topic").orderBy(F.desc("lift"), "term")
    top = lift.withColumn("rank", F.row_number().over(w)).where("rank <= 5")
    return top.select(F.col("group").alias("lang"), "topic", "rank", "term", F.round("lift", 6).alias("lift"))


@register("ctm_topic_correlation")
def ctm_topic_correlation(spark, sf):
    """Correlated topic model (no covariates, K = 30, spectral start) on all
    documents; the correlation matrix of the free logits."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    _b, _t, corr, _g = P.stm(_frequent_terms(docs), 30, iters=8, tol=1e-4)
    return corr.withColumn("corr", F.round("corr", 6))
