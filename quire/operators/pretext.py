"""Factorial preprocessing and preText diagnostics.

Every token carries its step flags once (punctuation, number, lower-case form,
stem, stop word); the 2^6 step combinations are a 64-row table exploded per
token, and one ``groupBy(combo, doc, term)`` yields all 64 dfms. The preText
score needs all pairwise document distances per combination, so it is run on
a seeded sample of documents (as the method prescribes); each combination's
distance matrix is one ``applyInPandas`` group bounded by the sample size.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T

# The preprocessing steps (n-grams off), in the method's order.
STEPS = ["punctuation", "numbers", "lowercase", "stem", "stopwords", "infrequent"]


def combinations(spark) -> DataFrame:
    """All 64 on/off combinations, ``combo`` 0..63 and one boolean per step."""
    rows = [(i, *map(bool, bits)) for i, bits in enumerate(itertools.product([0, 1], repeat=len(STEPS)))]
    return spark.createDataFrame(rows, "combo int, " + ", ".join(f"{s} boolean" for s in STEPS))


def factorial_dfm(docs: DataFrame, threshold: float = 0.2, keys=("doc_id",), stop=T.STOPWORDS_EN) -> DataFrame:
    """``(combo, doc_id, term, n)`` for all 64 combinations; the
    infrequent step drops terms found in fewer than ``threshold`` of the
    documents (within that combination)."""
    keys = list(keys)
    spark = docs.sparkSession
    toks = T.tokens(docs, keys=keys)  # punctuation kept as tokens, original case
    toks = toks.withColumn("_low", F.lower("term"))
    stems = T.stem_map(toks.select(F.col("_low").alias("term")))
    toks = (toks.join(stems.withColumnRenamed("term", "_low").withColumnRenamed("stem", "_stem_low"), "_low")
            .withColumn("_is_p", F.col("term").rlike(T.PUNCT) | F.col("term").rlike(T.SYMBOL))
            .withColumn("_is_n", F.col("term").rlike(T.NUMBER))
            .withColumn("_is_stop", F.col("_low").isin(list(stop))))
    combos = F.broadcast(combinations(spark))  # 64 rows
    x = toks.withColumn("_one", F.lit(1)).join(combos.withColumn("_one", F.lit(1)), "_one").drop("_one")
    drop = ((F.col("punctuation") & F.col("_is_p")) | (F.col("numbers") & F.col("_is_n")) |
            (F.col("stopwords") & F.when(F.col("lowercase"), F.col("_is_stop")).otherwise(F.col("term").isin(list(stop)))))
    # stems are taken of the lower-case form (the stemmer works on lower case)
    form = F.when(F.col("stem"), F.col("_stem_low")).when(F.col("lowercase"), F.col("_low")).otherwise(F.col("term"))
    d = x.filter(~drop).groupBy("combo", *keys, form.alias("term")).agg(F.count(F.lit(1)).alias("n"))
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    df = d.groupBy("combo", "term").agg(F.count(F.lit(1)).alias("_df"))
    inf = F.broadcast(combinations(spark).select("combo", "infrequent"))
    rare = df.join(inf, "combo").filter(F.col("infrequent") & (F.col("_df") / n_docs < threshold)).select("combo", "term")
    return d.join(rare, ["combo", "term"], "left_anti")


_DIST = "combo int, doc_a long, doc_b long, distance double"


def _cosine_distances(pdf: pd.DataFrame) -> pd.DataFrame:
    docs = np.sort(pdf["doc_id"].unique())
    terms = pdf["term"].unique()
    di = {d: i for i, d in enumerate(docs)}
    ti = {t: i for i, t in enumerate(terms)}
    X = np.zeros((len(docs), len(terms)))
    X[pdf["doc_id"].map(di).to_numpy(), pdf["term"].map(ti).to_numpy()] = pdf["n"].to_numpy(dtype=float)
    nrm = np.linalg.norm(X, axis=1)
    nrm[nrm == 0] = 1.0
    S = (X / nrm[:, None]) @ (X / nrm[:, None]).T
    a, b = np.triu_indices(len(docs), k=1)
    return pd.DataFrame({"combo": int(pdf["combo"].iloc[0]), "doc_a": docs[a].astype("int64"),
                         "doc_b": docs[b].astype("int64"), "distance": 1.0 - S[a, b]})


def pretext_scores(fdfm: DataFrame, k: int = 20, max_docs: int = 500) -> DataFrame:
    """Per combination, pairwise cosine distances → ranks of the pairs;
    for each pair the mean absolute rank difference against the other
    combinations; the score is the mean over the ``k`` most-moved pairs,
    divided by the number of pairs. ``fdfm`` must hold a document sample of at
    most ``max_docs`` documents (checked)."""
    n = fdfm.select("doc_id").distinct().count()
    if n > max_docs:
        raise ValueError(f"preText needs a document sample (≤ {max_docs}); got {n}")
    dist = fdfm.groupBy("combo").applyInPandas(_cosine_distances, _DIST).withColumn("distance", F.round("distance", 9))
    ranked = dist.withColumn("r", F.rank().over(Window.partitionBy("combo").orderBy("distance")))
    o = ranked.select(F.col("combo").alias("other"), "doc_a", "doc_b", F.col("r").alias("r_o"))
    j = ranked.join(o, ["doc_a", "doc_b"]).filter(F.col("combo") != F.col("other"))
    moved = j.groupBy("combo", "doc_a", "doc_b").agg(F.avg(F.abs(F.col("r") - F.col("r_o"))).alias("moved"))
    n_pairs = n * (n - 1) / 2
    top = moved.withColumn("_k", F.row_number().over(Window.partitionBy("combo").orderBy(F.desc("moved"), "doc_a", "doc_b")))
    top = top.filter(F.col("_k") <= k)
    return top.groupBy("combo").agg((F.avg("moved") / F.lit(n_pairs)).alias("pretext_score"))


def pretext_regression(scores: DataFrame) -> DataFrame:
    """Linear regression of the preText score on the step flags
    (64 rows): ``(term, coef)`` with the intercept."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    spark = scores.sparkSession
    x = scores.join(combinations(spark), "combo")
    for s in STEPS:
        x = x.withColumn(s, F.col(s).cast("double"))
    va = VectorAssembler(inputCols=STEPS, outputCol="_x").transform(x)
    m = LinearRegression(featuresCol="_x", labelCol="pretext_score").fit(va)
    rows = [("intercept", float(m.intercept))] + [(s, float(c)) for s, c in zip(STEPS, m.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, coef double")
