"""Further operators on inputs for which every number has an oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import comparisons as N
from ..operators import dfm as D
from ..operators import embeddings as E
from ..operators import lexicon as L
from ..operators import nearest as NN
from ..operators import pretext as PT
from ..operators import relational as R
from ..operators import scaling as Q
from ..operators import textstats as X
from ..operators import tokens as T
from ..operators import topics as P
from ..session import cut_lineage
from ..sources.files import profile
from ..sources.tables import table
from .comparisons import _PAIRS_SQL, _pairs, _wins
from .embeddings import _CENTROIDS_SQL, _DVEC, _vecs
from .lexicon import BOOSTERS, NEGATIONS, VALENCE, _vader_scored_sql
from .registry import ORACLE_SQL, register
from .sqlparts import STOP_EN_SQL, tokens_cte

_TOKEN_ALL = T.token_pattern(keep_punct=True).replace("'", "''")
_NUM = T.NUMBER.replace("'", "''")


# --- A7 ---------------------------------------------------------------------------------------
@register("customer_columns", """
SELECT * FROM (
  SELECT (SELECT count(*) FROM customer) AS rows, c AS "column", count(v) AS non_null, min(v) AS min, max(v) AS max
  FROM (UNPIVOT (SELECT c_name::VARCHAR AS c_name, c_mktsegment::VARCHAR AS c_mktsegment FROM customer) ON COLUMNS(*) INTO NAME c VALUE v) GROUP BY c
  UNION ALL SELECT count(*), 'c_custkey', count(c_custkey), min(c_custkey)::VARCHAR, max(c_custkey)::VARCHAR FROM customer
  UNION ALL SELECT count(*), 'c_nationkey', count(c_nationkey), min(c_nationkey)::VARCHAR, max(c_nationkey)::VARCHAR FROM customer)""")
def customer_columns(spark, sf):
    """Counts, least and largest value of customers' columns."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return profile(c).select("rows", "column", "non_null", "min", "max")


# --- D9 with rows on both sides -------------------------------------------------------------------
@register("customers_without_large_orders", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)""")
def customers_without_large_orders(spark, sf):
    """Customers with no order above 200,000."""
    large = table(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return R.complement(table(spark, sf, "customer").select("c_custkey", "c_name"), large, "c_custkey")


# --- I1, I6: each flag by itself, its rows and positions ---------------------------------------------
@register("tokens_left_by_flag", f"""
WITH a AS (SELECT doc_id, regexp_extract_all(text, '{_TOKEN_ALL}') AS a FROM documents),
t AS (SELECT unnest(a) AS term, unnest(generate_series(1, len(a))) AS pos FROM a),
c AS (SELECT pos, regexp_matches(term, '{_NUM}') AS num, regexp_matches(term, '^\\p{{P}}+$') AS punct, regexp_matches(term, '^\\p{{S}}+$') AS sym FROM t)
SELECT 'punct' AS flag, count(*) AS n, sum(pos)::BIGINT AS positions FROM c WHERE NOT punct
UNION ALL SELECT 'symbols', count(*), sum(pos)::BIGINT FROM c WHERE NOT sym
UNION ALL SELECT 'numbers', count(*), sum(pos)::BIGINT FROM c WHERE NOT num
UNION ALL SELECT 'all', count(*), sum(pos)::BIGINT FROM c WHERE NOT (num OR punct OR sym)""")
def tokens_left_by_flag(spark, sf):
    """What each removal flag leaves, with the sum of the original positions."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = None
    for name, flags in (("punct", {"remove_punct": True}), ("symbols", {"remove_symbols": True}), ("numbers", {"remove_numbers": True}),
                        ("all", {"remove_punct": True, "remove_symbols": True, "remove_numbers": True})):
        one = T.tokens(docs, **flags).agg(F.lit(name).alias("flag"), F.count(F.lit(1)).alias("n"), F.sum("pos").alias("positions"))
        out = one if out is None else out.unionByName(one)
    return out


# --- M9: all four scores per document ------------------------------------------------------------------
@register("vader_scores", _vader_scored_sql())
def vader_scores(spark, sf):
    """M9: compound, positive, neutral and negative share of each labelled document, with
    all rules (words before and after "but", question marks)."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    v = L.vader(docs, VALENCE, BOOSTERS, NEGATIONS, but="but", questions=True)
    return v.select("doc_id", *[F.round(c, 6).alias(c) for c in ("compound", "pos", "neu", "neg")])


# --- N4, N9 -----------------------------------------------------------------------------------------
@register("extraction_prompts_by_direction", f"""
WITH {_PAIRS_SQL}
SELECT item1, item2, replace(replace(replace(replace('{N.EXTRACT_PROMPT_NAMED.replace("'", "''")}', '{{a}}', name1), '{{b}}', name2),
  '{{direction}}', direction), '{{opposite}}', CASE WHEN direction = 'liberal' THEN 'conservative' ELSE 'liberal' END) || name1 AS extract_prompt FROM q""")
def extraction_prompts_by_direction(spark, sf):
    """The second prompt, with direction and both names, to an answer that names the first."""
    p = _pairs(spark, sf).withColumn("answer", F.col("name1"))
    return N.extraction_prompts(p, "answer", "direction", "name1", "name2").select("item1", "item2", "extract_prompt")


def _strength_sql(rounds: int) -> str:
    sql = f"""WITH w AS (SELECT * FROM ({ORACLE_SQL["supplier_win_table"]}) WHERE NOT defective),
g AS (SELECT item1 AS i, item2 AS j, win1 AS w FROM w UNION ALL SELECT item2, item1, win2 FROM w),
n AS (SELECT i, j, count(*) AS n FROM g GROUP BY ALL), t AS (SELECT i, sum(w) AS w FROM g GROUP BY i),
p0 AS (SELECT i, 1.0::DOUBLE AS p FROM t)"""
    for r in range(rounds):
        sql += f""",
r{r} AS (SELECT n.i, greatest(any_value(t.w), 1e-9) / sum(n / (a.p + b.p)) AS p FROM n JOIN t ON t.i = n.i JOIN p{r} a ON a.i = n.i JOIN p{r} b ON b.i = n.j GROUP BY n.i),
p{r + 1} AS (SELECT i, p / (SELECT avg(p) FROM r{r}) AS p FROM r{r})"""
    return sql + f" SELECT i AS item, round(p, 6) AS strength FROM p{rounds}"


@register("strengths_after_four_rounds", _strength_sql(4))
def strengths_after_four_rounds(spark, sf):
    """Bradley-Terry strengths after four rounds."""
    bt = N.bradley_terry(_wins(spark, sf), max_iter=4, tol=0.0)
    return bt.select("item", F.round("strength", 6).alias("strength"))


# --- P1, P3, P4 -----------------------------------------------------------------------------------------
def _assign_sql(n: int) -> str:
    return (f"a{n} AS (SELECT vec_id, arg_min(cluster, (dist, cluster)) AS cluster, min(dist) AS dist FROM "
            f"(SELECT e.vec_id, c{n}.cluster, list_distance({_DVEC}, c{n}.c) AS dist FROM embeddings e, c{n}) GROUP BY vec_id)")


def _update_sql(n: int) -> str:
    return (f"c{n + 1} AS (SELECT cluster, list(v ORDER BY i) AS c FROM (SELECT cluster, i, avg(CAST(embedding[i] AS DOUBLE)) AS v "
            f"FROM embeddings JOIN a{n} USING (vec_id), generate_series(1, 64) g(i) GROUP BY cluster, i) GROUP BY cluster)")


@register("kmeans_three_rounds", f"""WITH {_CENTROIDS_SQL}, c0 AS (SELECT label AS cluster, c FROM cen),
{_assign_sql(0)}, {_update_sql(0)}, {_assign_sql(1)}, {_update_sql(1)}, {_assign_sql(2)}
SELECT cluster, count(*) AS n, round(avg(dist), 6) AS mean_dist, sum(vec_id)::BIGINT AS ids FROM a2 GROUP BY cluster""")
def kmeans_three_rounds(spark, sf):
    """Three assignments with two updates between them, from the labels' centroids."""
    V = _vecs(spark, sf)
    start = E.mean_vectors(V, "label").withColumnRenamed("label", "cluster")
    _, a = P.kmeans_by_hand(V, start, key="vec_id", max_iter=3)
    return a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dist"), 6).alias("mean_dist"), F.sum("vec_id").alias("ids"))


@register("centroid_top_dimensions", f"""WITH {_CENTROIDS_SQL},
r AS (SELECT label AS cluster, 'd' || (i - 1) AS term, rank() OVER (PARTITION BY label ORDER BY round(v, 9) DESC) AS rank FROM cl)
SELECT cluster, string_agg(term, ', ' ORDER BY rank, term) AS top_terms FROM r WHERE rank <= 5 GROUP BY cluster""")
def centroid_top_dimensions(spark, sf):
    """The largest entries of given centres, with their names."""
    c = E.mean_vectors(_vecs(spark, sf), "label").select(F.col("label").alias("cluster"), F.transform("vec", lambda v: F.round(v, 9)).alias("vec"))
    vocab = spark.range(64).select(F.col("id").cast("int").alias("idx"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("term"))
    return P.cluster_terms(c, vocab, 5)


@register("cluster_example_documents", """
SELECT cluster, doc_id FROM (SELECT lang AS cluster, doc_id,
  row_number() OVER (PARTITION BY lang ORDER BY md5('3:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 5""")
def cluster_example_documents(spark, sf):
    """Five random documents of each cluster (here languages)."""
    docs = table(spark, sf, "documents")
    return P.cluster_examples(docs.select("doc_id", F.col("lang").alias("cluster")), docs.select("doc_id"), 5, 3).select("cluster", "doc_id")


# --- Q5 ------------------------------------------------------------------------------------------------
@register("intervals_of_positions", """
SELECT doc_id, round(fit, 6) AS fit, round(fit - 1.959963984540054 / sqrt(n_chars + 1), 6) AS lwr, round(fit + 1.959963984540054 / sqrt(n_chars + 1), 6) AS upr
FROM (SELECT doc_id, n_chars, ln(n_chars + 1) AS fit FROM documents)""")
def intervals_of_positions(spark, sf):
    """Q5: 95 % intervals of given positions and standard errors."""
    docs = table(spark, sf, "documents").select("doc_id", F.ln(F.col("n_chars") + 1).alias("omega"), (1 / F.sqrt(F.col("n_chars") + 1)).alias("se"))
    return Q.wordfish_predict(docs).select("doc_id", *[F.round(c, 6).alias(c) for c in ("fit", "lwr", "upr")])


# --- I17-I19 without stems --------------------------------------------------------------------------------
_STEPS = PT.STEPS
_COMBOS_SQL = "combos AS (SELECT i::INTEGER AS combo, " + ", ".join(
    f"(i >> {len(_STEPS) - 1 - k}) & 1 = 1 AS {s}" for k, s in enumerate(_STEPS)) + f" FROM range(0, {2 ** len(_STEPS)}) r(i))"
_FACTORIAL_SQL = f"""{_COMBOS_SQL},
s AS (SELECT doc_id, text FROM documents WHERE lang = 'en' ORDER BY md5('2:' || doc_id), doc_id LIMIT 50),
t AS (SELECT doc_id, term, lower(term) AS low, regexp_matches(term, '^\\p{{P}}+$') OR regexp_matches(term, '^\\p{{S}}+$') AS is_p,
             regexp_matches(term, '{_NUM}') AS is_n, lower(term) IN ({STOP_EN_SQL}) AS is_stop, term IN ({STOP_EN_SQL}) AS is_stop_as_it_is
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_TOKEN_ALL}')) AS term FROM s)),
f0 AS (SELECT combo, infrequent, doc_id, CASE WHEN lowercase THEN low ELSE term END AS term, count(*) AS n FROM t, combos
       WHERE NOT stem AND NOT (punctuation AND is_p) AND NOT (numbers AND is_n) AND NOT (stopwords AND CASE WHEN lowercase THEN is_stop ELSE is_stop_as_it_is END)
       GROUP BY ALL),
df AS (SELECT combo, term, count(*) AS df FROM f0 GROUP BY ALL),
f AS (SELECT combo, doc_id, term, n FROM f0 JOIN df USING (combo, term) WHERE NOT infrequent OR df / (SELECT count(*) FROM s) >= 0.2)"""


def _factorial(spark, sf):
    docs = table(spark, sf, "documents").where("lang = 'en'").select("doc_id", "text")
    f = PT.factorial_dfm(R.sample_n(docs, 50, "doc_id", seed=2), threshold=0.2)
    plain = PT.combinations(spark).where("not stem").select("combo")
    return cut_lineage(f.join(F.broadcast(plain), "combo"), "factorial-plain")


@register("factorial_feature_counts", f"""WITH {_FACTORIAL_SQL}
SELECT combo, count(DISTINCT term) AS n_features, count(*) AS cells, sum(n)::BIGINT AS tokens FROM f GROUP BY combo""")
def factorial_feature_counts(spark, sf):
    """Features, cells and tokens of the 32 preprocessing combinations without stemming, on
    the 50 documents that the diagnostic is defined on."""
    f = _factorial(spark, sf)
    return f.groupBy("combo").agg(F.countDistinct("term").alias("n_features"), F.count(F.lit(1)).alias("cells"), F.sum("n").alias("tokens"))


@register("pretext_scores_without_stems", f"""WITH {_FACTORIAL_SQL},
len AS (SELECT combo, doc_id, sqrt(sum(n * n)) AS l FROM f GROUP BY ALL),
dot AS (SELECT a.combo, a.doc_id AS doc_a, b.doc_id AS doc_b, sum(a.n * b.n) AS x FROM f a JOIN f b USING (combo, term) WHERE a.doc_id < b.doc_id GROUP BY ALL),
docs AS (SELECT combo, doc_id FROM len),
d AS (SELECT a.combo, a.doc_id AS doc_a, b.doc_id AS doc_b, round(1 - coalesce(x, 0) / (a.l * b.l), 9) AS dist
      FROM len a JOIN len b ON a.combo = b.combo AND a.doc_id < b.doc_id LEFT JOIN dot ON dot.combo = a.combo AND dot.doc_a = a.doc_id AND dot.doc_b = b.doc_id),
r AS (SELECT combo, doc_a, doc_b, rank() OVER (PARTITION BY combo ORDER BY dist) AS r FROM d),
m AS (SELECT a.combo, a.doc_a, a.doc_b, avg(abs(a.r - b.r)) AS moved FROM r a JOIN r b USING (doc_a, doc_b) WHERE a.combo <> b.combo GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY combo ORDER BY moved DESC, doc_a, doc_b) AS k FROM m),
n AS (SELECT count(DISTINCT doc_id) AS n FROM f)
SELECT combo, round(avg(moved) / any_value(n * (n - 1) / 2), 6) AS pretext_score FROM k, n WHERE k <= 20 GROUP BY combo""")
def pretext_scores_without_stems(spark, sf):
    """preText scores of the 32 combinations without stemming."""
    return PT.pretext_scores(_factorial(spark, sf), k=20).withColumn("pretext_score", F.round("pretext_score", 6))


_FREE = [s for s in _STEPS if s not in ("stem", "infrequent")]


@register("kept_token_regression", f"""WITH {_FACTORIAL_SQL},
y AS (SELECT combos.*, t.n / (SELECT sum(n) FROM f WHERE combo = 0) AS y FROM combos JOIN (SELECT combo, sum(n) AS n FROM f GROUP BY combo) t USING (combo) WHERE NOT infrequent)
SELECT term, round(coef, 6) AS coef FROM (
{" UNION ALL ".join(f"SELECT '{s}' AS term, avg(y) FILTER (WHERE {s}) - avg(y) FILTER (WHERE NOT {s}) AS coef FROM y" for s in _FREE)})""")
def kept_token_regression(spark, sf):
    """Regression of the share of tokens kept on the step flags; in a full design a
    coefficient is the difference of two means."""
    n = _factorial(spark, sf).groupBy("combo").agg(F.sum("n").alias("n"))
    whole = n.where("combo = 0").select("n").scalar()
    usual = PT.combinations(spark).where("not infrequent").select("combo")
    y = n.join(usual, "combo").select("combo", (F.col("n") / whole).alias("pretext_score"))
    return PT.pretext_regression(y).where(F.col("term").isin(_FREE)).withColumn("coef", F.round("coef", 6))


# --- L6: boilerplate weights ------------------------------------------------------------------------------
@register("boilerplate_weights", f"""
WITH {tokens_cte("(SELECT item_id AS doc_id, text FROM benchmark)")},
d AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY ALL),
l AS (SELECT doc_id, sqrt(sum(n * n)) AS l FROM d GROUP BY doc_id),
u AS (SELECT doc_id, term, n / l AS w FROM d JOIN l USING (doc_id)),
s AS (SELECT doc_id FROM l ORDER BY md5('11:' || doc_id), doc_id LIMIT 1000),
m AS (SELECT term, sum(w) / (SELECT count(*) FROM s) AS m FROM u JOIN s USING (doc_id) GROUP BY term)
SELECT doc_id AS item_id, round(1 - sum(w * coalesce(m, 0)), 6) AS weight FROM u LEFT JOIN m USING (term) GROUP BY doc_id""")
def boilerplate_weights(spark, sf):
    """Weight of each passage, by its mean cosine to 1,000 random ones."""
    items = T.token_arrays(table(spark, sf, "benchmark").select("item_id", "text"), keys=["item_id"])
    return X.boilerplate_weight(items, ["item_id"], sample=1000, seed=11).select("item_id", F.round("weight", 6).alias("weight"))


# --- O12 nearest neighbours -----------------------------------------------------------------------------------
_KNN_SQL = f"""{tokens_cte("(SELECT d.doc_id, text FROM documents d JOIN labels USING (doc_id))")},
d0 AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE term NOT IN ({STOP_EN_SQL}) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM d0 GROUP BY term),
w AS (SELECT doc_id, term, n * ln((SELECT count(DISTINCT doc_id) FROM d0) / df) AS w FROM d0 JOIN df USING (term)),
l AS (SELECT doc_id, sqrt(sum(w * w)) AS l FROM w GROUP BY doc_id HAVING l > 0),
u AS (SELECT doc_id, term, w / l AS w, ('0x' || substr(md5('4:' || doc_id), 1, 8))::BIGINT % 5 = 0 AS test FROM w JOIN l USING (doc_id)),
s AS (SELECT q.doc_id AS q, d.doc_id AS d, sum(q.w * d.w) AS sim FROM u q JOIN u d USING (term) WHERE q.test AND NOT d.test AND q.w <> 0 AND d.w <> 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(sim, 12) DESC, d)::INTEGER AS rank FROM s)"""


def _knn(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    d = cut_lineage(D.dfm_from_arrays(T.filter_array(T.token_arrays(docs), drop=T.STOPWORDS_EN)), "knn-dfm")
    n = d.select(F.countDistinct("doc_id")).scalar()
    df = d.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = d.join(df, "term").select("doc_id", "term", (F.col("n") * F.ln(n / F.col("df"))).alias("w")).where("w != 0")
    w = cut_lineage(R.folds(w, 5, "doc_id", seed=4), "knn-weights")
    return w.where("fold = 0"), w.where("fold != 0")


@register("nearest_labelled_documents", f"""WITH {_KNN_SQL}
SELECT q, d, round(sim, 6) AS sim, rank FROM r WHERE rank <= 5""")
def nearest_labelled_documents(spark, sf):
    """The five most similar training documents of each test document."""
    test, train = _knn(spark, sf)
    return NN.nearest_documents(test, train, 5).select("q", "d", F.round("sim", 6).alias("sim"), "rank")


@register("knn_quality", f"""WITH {_KNN_SQL},
v AS (SELECT q, quality AS pred, sum(sim) AS v, count(*) AS votes FROM r JOIN labels ON labels.doc_id = r.d WHERE rank <= 5 GROUP BY ALL)
SELECT q AS doc_id, arg_min(pred, (-round(v, 9), pred)) AS pred, arg_min(votes, (-round(v, 9), pred)) AS votes FROM v GROUP BY q""")
def knn_quality(spark, sf):
    """Quality by the five nearest labelled documents."""
    test, train = _knn(spark, sf)
    return NN.knn_classify(test, train, table(spark, sf, "labels"), 5, label="quality")


# --- K16: closeness to one dictionary over the other ------------------------------------------------------------
@register("emotionality_of_vectors", f"""WITH {_CENTROIDS_SQL},
s AS (SELECT vec_id, max(CASE WHEN cen.label = 0 THEN list_cosine_similarity({_DVEC}, c) END) AS a,
             max(CASE WHEN cen.label = 1 THEN list_cosine_similarity({_DVEC}, c) END) AS b FROM embeddings, cen WHERE cen.label IN (0, 1) GROUP BY vec_id)
SELECT vec_id, round(a, 6) AS affect, round(b, 6) AS cognition, round((a + 1) / (b + 1), 6) AS emotionality FROM s""")
def emotionality_of_vectors(spark, sf):
    """Ratio of the closeness to two centroids (affect, cognition)."""
    V = _vecs(spark, sf)
    cen = E.mean_vectors(V.where("label in (0, 1)"), "label").select(F.when(F.col("label") == 0, "affect").otherwise("cognition").alias("category"), "vec")
    e = E.emotionality(E.dict_similarity(V.select("vec_id", "vec"), cen, keys=["vec_id"]), keys=["vec_id"])
    return e.select("vec_id", *[F.round(c, 6).alias(c) for c in ("affect", "cognition", "emotionality")])
