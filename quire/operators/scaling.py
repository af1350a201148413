"""Scaling documents on a latent dimension (Q1–Q7).

Wordscores is closed-form and linear in the non-zeros of the dfm: with
smoothing ``s`` a reference text ``r`` gives every word it lacks the same
relative frequency ``c_r = s / (T_r + s·V)``, so

    S_w = (Σ_r c_r A_r + Σ_{r∋w} n_wr A_r/(T_r+sV)) / (Σ_r c_r + Σ_{r∋w} n_wr/(T_r+sV))

needs only sums over observed (word, reference) pairs plus two constants —
never the reference × vocabulary grid.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixed import mixed_poisson  # noqa: F401 (these are part of this module's interface)
from .positions import following_scale, wordfish  # noqa: F401


def wordscores_fit(d: DataFrame, ref: DataFrame, smooth: float = 0.0, keys: Iterable[str] = ("doc_id",),
                   term: str = "term") -> DataFrame:
    """Q1: word scores ``(term, score)`` from reference texts ``ref``
    (``keys…, a``). The vocabulary is every feature of ``d``; with
    ``smooth = 0`` words absent from all reference texts get no score."""
    keys = list(keys)
    vocab = d.select(term).distinct()
    n_v = vocab.select(F.count(F.lit(1))).scalar()
    dr = d.join(ref.select(*keys, "a"), keys)
    tot = dr.groupBy(*keys).agg(F.sum("n").alias("t_r"))
    tot = tot.withColumn("den", F.col("t_r") + F.lit(float(smooth)) * n_v)
    consts = tot.join(ref.select(*keys, "a"), keys).agg(
        F.sum(F.lit(float(smooth)) / F.col("den")).alias("c0"),
        F.sum(F.lit(float(smooth)) * F.col("a") / F.col("den")).alias("ca"))
    obs = dr.join(tot.select(*keys, "den"), keys).groupBy(term).agg(
        F.sum(F.col("n") / F.col("den")).alias("f"), F.sum(F.col("n") * F.col("a") / F.col("den")).alias("fa"))
    c0 = consts.select("c0").scalar()
    ca = consts.select("ca").scalar()
    w = vocab.join(obs, term, "left").na.fill(0.0, subset=["f", "fa"])
    return w.select(term, F.try_divide(ca + F.col("fa"), c0 + F.col("f")).alias("score")).filter(F.col("score").isNotNull())


def wordscores_predict(d: DataFrame, scores: DataFrame, ref: DataFrame | None = None,
                       keys: Iterable[str] = ("doc_id",), term: str = "term",
                       rescale: str | None = None) -> DataFrame:
    """Q2: virgin-text scores over scored words: S_v = Σ f_wv S_w with
    f_wv = n_wv / Σ n_wv (scored words only); se = √(Σ f (S_w − S_v)²)/√N_v;
    95% interval. ``rescale='lbg'`` maps raw scores onto the reference metric
    (mean kept, spread = sd of the reference scores)."""
    keys = list(keys)
    j = d.join(scores, term)
    g = j.groupBy(*keys).agg(F.sum("n").alias("n_scored"), F.sum(F.col("n") * F.col("score")).alias("_sx"),
                             F.sum(F.col("n") * F.col("score") * F.col("score")).alias("_sxx"))
    sv = F.col("_sx") / F.col("n_scored")
    var = F.greatest(F.col("_sxx") / F.col("n_scored") - sv * sv, F.lit(0.0))
    out = g.select(*keys, "n_scored", sv.alias("score"), (F.sqrt(var) / F.sqrt("n_scored")).alias("se"))
    out = out.withColumn("lwr", F.col("score") - 1.96 * F.col("se")).withColumn("upr", F.col("score") + 1.96 * F.col("se"))
    if rescale == "lbg":
        if ref is None:
            raise ValueError("lbg rescaling needs the reference scores")
        sd_r = ref.select(F.stddev_samp("a")).scalar()
        stats = out.select(F.avg("score").alias("m"), F.stddev_samp("score").alias("s"))
        m, s = stats.select("m").scalar(), stats.select("s").scalar()
        out = out.withColumn("score_lbg", (F.col("score") - m) * (sd_r / s) + m)
    return out


def extreme_words(scores: DataFrame, n: int = 10, term: str = "term", order=None) -> DataFrame:
    """Q3: ``n`` most left and right words (by ``order``, default the score), their scores
    rescaled to [−1, 1] with the global min/max of all word scores, flagged Left/Right."""
    from .relational import rescale
    order = F.col("score") if order is None else order
    r = rescale(scores, "score", -1.0, 1.0, "rescaled")
    right = r.orderBy(order.desc(), term).limit(n)
    left = r.orderBy(order.asc(), term).limit(n)
    both = right.unionByName(left)
    return both.withColumn("side", F.when(F.col("rescaled") > 0, "Right").otherwise("Left"))


# ---- Wordfish, the following model: see positions.py ------------------------------------------------

def wordfish_predict(docs: DataFrame, level: float = 0.95) -> DataFrame:
    """Q5: positions with a confidence interval ``fit ± z·se``."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(0.5 + level / 2)
    return docs.select("doc_id", F.col("omega").alias("fit"), "se",
                       (F.col("omega") - z * F.col("se")).alias("lwr"), (F.col("omega") + z * F.col("se")).alias("upr"))


def sharing_model(counts: DataFrame, label: str, features: list[str], offset: str | None = None,
                  reg: float = 0.1):
    """Q7: Poisson regression of counts on distance terms with penalised
    effects (``GeneralizedLinearRegression``, family Poisson)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression
    x = VectorAssembler(inputCols=features, outputCol="_x").transform(counts)
    glr = GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_x", labelCol=label,
                                      regParam=reg, maxIter=50)
    if offset:
        glr = glr.setOffsetCol(offset)
    return glr.fit(x)
