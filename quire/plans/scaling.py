"""Scaling analyses on English ``documents`` (Q1–Q5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dfm as D
from ..operators import scaling as Q
from ..operators import tokens as T
from ..session import cut_lineage
from ..sources.tables import deal, table
from .registry import register
from .sqlparts import STOP_EN_SQL, tokens_cte

# Reference scores by source (the two anchor sources).
REF_SCORES = {"src0": -1.0, "src1": 1.0}


def _en(spark, sf):
    docs = table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "source", "text")
    arr = T.filter_array(T.token_arrays(deal(docs, "doc_id")), drop=T.STOPWORDS_EN)
    return docs, cut_lineage(D.dfm_from_arrays(arr, deal=False), "dfm-en")


def _ref(docs):
    a = F.when(F.col("source") == "src0", REF_SCORES["src0"]).when(F.col("source") == "src1", REF_SCORES["src1"])
    return docs.select("doc_id", a.alias("a")).filter(F.col("a").isNotNull())


_WS_SQL = f"""
docs AS (SELECT doc_id, source, text FROM documents WHERE lang = 'en'),
{tokens_cte('docs')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE term NOT IN ({STOP_EN_SQL}) GROUP BY 1, 2),
ref AS (SELECT doc_id, CASE WHEN source = 'src0' THEN {REF_SCORES['src0']} ELSE {REF_SCORES['src1']} END AS a
        FROM docs WHERE source IN ('src0', 'src1')),
vocab AS (SELECT DISTINCT term FROM dfm),
dr AS (SELECT dfm.*, ref.a FROM dfm JOIN ref USING (doc_id)),
tot AS (SELECT doc_id, a, sum(n) + 1.0 * (SELECT count(*) FROM vocab) AS den FROM dr GROUP BY doc_id, a),
consts AS (SELECT sum(1.0 / den) AS c0, sum(1.0 * a / den) AS ca FROM tot),
obs AS (SELECT term, sum(n / den) AS f, sum(n * dr.a / den) AS fa FROM dr JOIN tot USING (doc_id) GROUP BY term),
ws AS (SELECT term, (ca + coalesce(fa, 0)) / (c0 + coalesce(f, 0)) AS score FROM vocab LEFT JOIN obs USING (term), consts)"""


@register("wordscores_en", f"""WITH {_WS_SQL},
g AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_scored, sum(n * score) AS sx, sum(n * score * score) AS sxx
      FROM dfm JOIN ws USING (term) GROUP BY doc_id),
p AS (SELECT doc_id, n_scored, sx / n_scored AS score,
             sqrt(greatest(sxx / n_scored - (sx / n_scored) * (sx / n_scored), 0)) / sqrt(n_scored) AS se FROM g),
st AS (SELECT avg(score) AS m, stddev_samp(score) AS s FROM p),
sr AS (SELECT stddev_samp(a) AS sr FROM ref)
SELECT doc_id, n_scored, round(score, 6) AS score, round(se, 6) AS se,
       round((score - m) * (sr / s) + m, 6) AS score_lbg FROM p, st, sr""")
def wordscores_en(spark, sf):
    docs, d = _en(spark, sf)
    ref = _ref(docs)
    ws = Q.wordscores_fit(d, ref, smooth=1.0)
    p = Q.wordscores_predict(d, ws, ref, rescale="lbg")
    return p.select("doc_id", "n_scored", *[F.round(c, 6).alias(c) for c in ("score", "se", "score_lbg")])


@register("extreme_words_en", f"""WITH {_WS_SQL},
mm AS (SELECT min(score) AS lo, max(score) AS hi FROM ws),
r AS (SELECT term, score, -1 + (score - lo) * 2 / (hi - lo) AS rescaled FROM ws, mm),
x AS ((SELECT * FROM r ORDER BY round(score, 9) DESC, term LIMIT 10)
      UNION ALL (SELECT * FROM r ORDER BY round(score, 9) ASC, term LIMIT 10))
SELECT term, round(score, 6) AS score, round(rescaled, 6) AS rescaled,
       CASE WHEN rescaled > 0 THEN 'Right' ELSE 'Left' END AS side FROM x""")
def extreme_words_en(spark, sf):
    docs, d = _en(spark, sf)
    ws = Q.wordscores_fit(d, _ref(docs), smooth=1.0)
    # order by rounded scores, as sums differ in their last digits
    both = Q.extreme_words(ws, 10, order=F.round("score", 9))
    return both.select("term", F.round("score", 6).alias("score"), F.round("rescaled", 6).alias("rescaled"), "side")


@register("wordfish_en")
def wordfish_en(spark, sf):
    """Q4 + Q5: Wordfish positions of English documents on the trimmed vocabulary
    (5–95 % document frequency), direction fixed by the first documents of src0
    and src1, with 95 % intervals."""
    docs, d = _en(spark, sf)
    n_docs = docs.select(F.count(F.lit(1)))
    d = D.dfm_trim(d, n_docs=n_docs, min_docfreq=0.05, max_docfreq=0.95, docfreq_type="prop")
    anchors = docs.filter(F.col("source").isin("src0", "src1")).groupBy("source").agg(F.min("doc_id").alias("d"))
    a = {r["source"]: r["d"] for r in anchors.collect()}  # two ids
    pos, _words = Q.wordfish(d, dir=(a["src0"], a["src1"]))
    p = Q.wordfish_predict(pos)
    return p.join(docs.select("doc_id", "source"), "doc_id").select(
        "doc_id", "source", *[F.round(c, 6).alias(c) for c in ("fit", "se", "lwr", "upr")])


@register("user_event_positions")
def user_event_positions(spark, sf):
    """Q6 stand-in: users "follow" the event types they produced; user ideal
    points θ and type positions φ from the spatial following model (row check)."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user"),
                                          F.col("event_type").alias("elite")).distinct()
    users, elites = Q.following_scale(e, iters=15)
    u = users.select(F.lit("user").alias("kind"), F.col("user").alias("id"), F.round("theta", 6).alias("position"))
    el = elites.select(F.lit("elite").alias("kind"), F.col("elite").alias("id"), F.round("phi", 6).alias("position"))
    return u.unionByName(el)
