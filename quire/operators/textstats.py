"""Descriptive inference (L1–L14): lexical diversity, readability and
similarity/distance between documents or groups.

Similarity never self-joins the dfm on ``term`` (that emits every pair of
documents sharing a term, quadratic in a hot term's document frequency):

* :func:`similarity_to` — every document against a bounded, checked set of
  query documents, whose vectors are broadcast;
* :func:`group_distances` — all pairs among a bounded set of groups (sources,
  a sample) from per-partition partial Gram-type matrices computed with numpy
  and summed by cell; the work grows with the vocabulary, not with skew.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import tokens as TK

# ---- lexical diversity ---------------------------------------------------------------


def lexdiv(d: DataFrame, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """TTR = T/N, Guiraud = T/√N, Summer (as printed) = ln T / ln N."""
    keys = list(keys)
    g = d.groupBy(*keys).agg(F.sum("n").alias("ntoken"), F.count(F.lit(1)).alias("ntype"))
    n, t = F.col("ntoken"), F.col("ntype")
    return g.select(*keys, "ntoken", "ntype", (t / n).alias("ttr"), (t / F.sqrt(n)).alias("guiraud"),
                    F.when(n > 1, F.ln(t) / F.ln(n)).alias("summer"))


def mattr(toks: DataFrame, window: int = 50, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Moving-average type-token ratio over windows of ``window`` tokens.

    Exact, without materialising windows: token ``p`` is new in window ``s``
    iff its previous occurrence ``q`` (same term, same document) is before
    ``s``; so it counts in windows ``s ∈ [max(q+1, p−w+1), min(p, N−w+1)]``.
    MATTR = Σ counts / (w · (N−w+1)); documents shorter than ``w`` get TTR.
    ``pos`` must be consecutive (1..N).
    """
    keys = list(keys)
    w = window
    prev = F.lag("pos").over(Window.partitionBy(*keys, "term").orderBy("pos"))
    # document length by aggregate + join (AQE splits a skewed document), not a window
    n = toks.groupBy(*keys).agg(F.max("pos").alias("N"))
    t = toks.select(*keys, "pos", "term", F.coalesce(prev, F.lit(0)).alias("q")).join(n, keys)
    lo = F.greatest(F.col("q") + 1, F.col("pos") - w + 1)
    hi = F.least(F.col("pos"), F.col("N") - w + 1)
    cnt = F.greatest(hi - lo + 1, F.lit(0))
    g = t.groupBy(*keys).agg(F.sum(cnt).alias("_c"), F.max("N").alias("ntoken"),
                             F.sum(F.when(F.col("q") == 0, 1).otherwise(0)).alias("ntype"))
    val = F.when(F.col("ntoken") >= w, F.col("_c") / (F.lit(w) * (F.col("ntoken") - w + 1))) \
        .otherwise(F.col("ntype") / F.col("ntoken"))
    return g.select(*keys, "ntoken", val.alias("mattr"))


# ---- readability ----------------------------------------------------------------------

# Vowels for syllable counting (groups of these are syllables).
VOWELS = "[aeiouyàâäáéèêëíìîïóòôöúùûü]+"


def syllables(word: Column) -> Column:
    """Vowel groups, minus one for a silent final ``e`` (not ``le``), at least 1."""
    groups = F.regexp_count(word, F.lit(VOWELS))
    silent = word.rlike("[^l]e$") & (groups > 1)
    return F.greatest(groups - F.when(silent, 1).otherwise(0), F.lit(1))


def readability(c: DataFrame, keys: Iterable[str] = ("doc_id",), text: str = "text",
                familiar: Iterable[str] | None = None) -> DataFrame:
    """Flesch reading ease, Flesch–Kincaid grade, Coleman–Liau (also
    its estimated cloze percentage) and SMOG per document, and with a list of
    ``familiar`` words the Dale–Chall score, from per-row counts (no shuffle;
    words and syllables are computed once per row)."""
    keys = list(keys)
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TK.WORD), 0)
    sents = F.size(F.regexp_extract_all(F.col(text), F.lit(TK.SENTENCE), 0))
    # every letter of a text is in one of its words
    letters = F.regexp_count(F.lower(F.col(text)), F.lit(r"\p{L}"))
    base = TK.pin(c.select(*keys, words.alias("_w"), sents.alias("n_sent"), letters.alias("n_letters")), "_w")
    hard = F.size(F.filter("_w", lambda x: ~x.isin(list(familiar)))) if familiar is not None else F.lit(None).cast("int")
    base = TK.pin(base.select(*keys, "n_sent", "n_letters", F.size("_w").alias("n_words"), hard.alias("n_hard"),
                              F.transform("_w", syllables).alias("_s")), "_s")
    base = base.select(*keys, "n_sent", "n_words", "n_letters", "n_hard",
                       F.aggregate("_s", F.lit(0), lambda a, x: a + x).alias("n_syl"),
                       F.size(F.filter("_s", lambda x: x >= 3)).alias("n_poly"))
    w, s, sy = F.col("n_words"), F.col("n_sent"), F.col("n_syl")
    wps = F.try_divide(w, s)
    spw = F.try_divide(sy, w)
    return base.select(
        *keys, "n_sent", "n_words", "n_syl", "n_poly", "n_letters",
        (F.lit(206.835) - 1.015 * wps - 84.6 * spw).alias("flesch"),
        (0.39 * wps + 11.8 * spw - 15.59).alias("fk_grade"),
        (0.0588 * F.try_divide(F.col("n_letters") * 100, w) - 0.296 * F.try_divide(s * 100, w) - 15.8).alias("coleman_liau"),
        (1.043 * F.sqrt(F.try_divide(F.col("n_poly") * 30, s)) + 3.1291).alias("smog"),
        (141.8401 - 0.21459 * F.try_divide(F.col("n_letters") * 100, w) + 1.079812 * F.try_divide(s * 100, w)).alias("coleman_liau_ecp"),
        (64 - 0.95 * F.try_divide(F.col("n_hard") * 100, w) - 0.69 * wps).alias("dale_chall"))


def predict_linear(features: DataFrame, coefs: dict[str, float], intercept: float = 0.0,
                   keys: Iterable[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """Covariates × given coefficients (+ intercept) per row."""
    keys = list(keys)
    expr = F.lit(float(intercept))
    for k, v in coefs.items():
        expr = expr + F.col(k) * F.lit(float(v))
    return features.select(*keys, expr.alias(name))


# ---- similarity -----------------------------------------------------------------------

def similarity_to(d: DataFrame, query_ids: list, key: str = "doc_id", term: str = "term",
                  value: str = "w") -> DataFrame:
    """L1/L4: cosine of every document to each of a few query documents.

    Spark decides by measured size how the query vectors are joined.
    Documents sharing no term get 0.
    """
    q = d.filter(F.col(key).isin(query_ids)).select(F.col(key).alias("query"), term, F.col(value).alias("_wq"))
    dots = (d.select(key, term, value).join(q, term)
            .groupBy("query", key).agg(F.sum(F.col(value) * F.col("_wq")).alias("_dot")))
    norms = d.groupBy(key).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_n"))
    qn = norms.filter(F.col(key).isin(query_ids)).select(F.col(key).alias("query"), F.col("_n").alias("_nq"))
    allq = norms.withColumn("query", F.explode(F.array(*[F.lit(x) for x in query_ids])))
    out = (allq.join(F.broadcast(qn), "query").join(dots, ["query", key], "left")
           .select("query", key, F.try_divide(F.coalesce("_dot", F.lit(0.0)), F.col("_n") * F.col("_nq")).alias("cosine")))
    return out


def nearest(sim: DataFrame, query, k: int = 10, value: str = "cosine", key: str = "doc_id",
            skip_self: bool = True, least: bool = False) -> DataFrame:
    """The ``k`` most (or least) similar documents to ``query``, ranked
    1..k with a total order (ties by id); the query itself is skipped."""
    s = sim.filter(F.col("query") == F.lit(query))
    if skip_self:
        s = s.filter(F.col(key) != F.lit(query))
    v = F.col(value)
    o = [v.asc() if least else v.desc(), F.col(key).asc()]
    return s.orderBy(*o).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*o)))


_PAIR_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("a", T.IntegerType()), ("b", T.IntegerType()), ("dot", T.DoubleType()), ("minsum", T.DoubleType()),
    ("shared", T.LongType()), ("canb", T.DoubleType()), ("mink", T.DoubleType())]])


def _gram_partials(n_groups: int, p: float):
    # terms per numpy block, so a block's G×G×terms temporaries stay ~32 MB
    chunk = max(1, 4_000_000 // max(1, n_groups * n_groups))

    def run(it):
        G = n_groups
        own = np.arange(G)
        dot, mins, canb, mink = (np.zeros((G, G)) for _ in range(4))
        shared = np.zeros((G, G), dtype=np.int64)
        for pdf in it:
            if pdf.empty:
                continue
            sizes = pdf["gi"].map(len).to_numpy()
            gi = np.concatenate(pdf["gi"].to_numpy()).astype(np.int64)
            vals = np.concatenate(pdf["vals"].to_numpy()).astype(np.float64)
            # a term of one group (most terms) adds to that group's own cell only
            one = np.repeat(sizes == 1, sizes)
            v = np.abs(vals[one])
            dot[own, own] += np.bincount(gi[one], v * v, minlength=G)
            mins[own, own] += np.bincount(gi[one], v, minlength=G)
            shared[own, own] += np.bincount(gi[one], v != 0, minlength=G).astype(np.int64)
            gi, vals, sizes = gi[~one], vals[~one], sizes[sizes > 1]
            row = np.repeat(np.arange(len(sizes)), sizes)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for s in range(0, len(sizes), chunk):
                n = min(chunk, len(sizes) - s)
                at = slice(ends[s], ends[s + n])
                X = np.zeros((n, G))
                X[row[at] - s, gi[at]] = vals[at]
                nz = (X != 0).astype(np.float64)
                dot += X.T @ X
                shared += (nz.T @ nz).astype(np.int64)
                a = X[:, :, None]
                b = X[:, None, :]
                both = (a != 0) & (b != 0)
                mins += np.where(both, np.minimum(np.abs(a), np.abs(b)), 0.0).sum(axis=0)
                den = np.abs(a) + np.abs(b)
                apart = np.abs(a - b)
                canb += np.where(both, apart / np.where(den == 0, 1, den), 0.0).sum(axis=0)
                mink += np.where(both, apart ** p - np.abs(a) ** p - np.abs(b) ** p, 0.0).sum(axis=0)
        ii, jj = np.meshgrid(own, own, indexing="ij")
        yield pd.DataFrame({"a": ii.ravel().astype("int32"), "b": jj.ravel().astype("int32"),
                            "dot": dot.ravel(), "minsum": mins.ravel(), "shared": shared.ravel(),
                            "canb": canb.ravel(), "mink": mink.ravel()})
    return run


def group_distances(d: DataFrame, group: str, term: str = "term", value: str = "w",
                    max_groups: int = 500, p: float = 3.0) -> DataFrame:
    """All pairs (both orders, diagonal included) among the groups
    of a weighted long table ``(group, term, value)``: cosine, Euclidean,
    Manhattan, Minkowski (of order ``p``), Canberra and (binary) Jaccard.

    The group set is checked against ``max_groups`` (the result has G² rows).
    Each term's ≤ G weights form one row; every partition folds its terms into
    G×G partial sums with numpy (terms of one group without the G×G step);
    partials are summed by cell. Manhattan and Canberra use ``Σ|a−b| = Σa + Σb − 2Σmin`` (weights ≥ 0) and "one-sided
    terms count 1".
    """
    from ..session import cut_lineage
    d = cut_lineage(d.select(group, term, value), "group-dfm")  # read three times below
    groups = d.select(group).distinct()
    n = groups.count()
    if n > max_groups:
        raise ValueError(f"{n} groups exceed max_groups={max_groups}; use similarity_to for many documents")
    # bounded (≤ max_groups rows): a dense index for the groups
    idx = groups.select(group, (F.dense_rank().over(Window.orderBy(group)) - 1).cast("int").alias("gi"))
    idx = F.broadcast(idx)
    per_term = (d.select(group, term, F.col(value).cast("double").alias("v")).join(idx, group)
                .groupBy(term).agg(F.collect_list("gi").alias("gi"), F.collect_list("v").alias("vals")))
    partial = per_term.select("gi", "vals").mapInPandas(_gram_partials(n, p), _PAIR_SCHEMA)
    cells = partial.groupBy("a", "b").agg(F.sum("dot").alias("dot"), F.sum("minsum").alias("minsum"),
                                          F.sum("shared").alias("shared"), F.sum("canb").alias("canb"),
                                          F.sum("mink").alias("mink"))
    tot = (d.select(group, F.col(value).cast("double").alias("v")).groupBy(group)
           .agg(F.sum(F.abs("v")).alias("l1"), F.sum(F.col("v") * F.col("v")).alias("l2"),
                F.sum(F.pow(F.abs("v"), F.lit(p))).alias("lp"),
                F.count(F.when(F.col("v") != 0, 1)).alias("nnz")).join(idx, group))
    ta = F.broadcast(tot.select(F.col("gi").alias("a"), F.col(group).alias(group + "_a"),
                                F.col("l1").alias("l1a"), F.col("l2").alias("l2a"), F.col("nnz").alias("nza"), F.col("lp").alias("lpa")))
    tb = F.broadcast(tot.select(F.col("gi").alias("b"), F.col(group).alias(group + "_b"),
                                F.col("l1").alias("l1b"), F.col("l2").alias("l2b"), F.col("nnz").alias("nzb"), F.col("lp").alias("lpb")))
    j = cells.join(ta, "a").join(tb, "b")
    eu2 = F.greatest(F.col("l2a") + F.col("l2b") - 2 * F.col("dot"), F.lit(0.0))
    return j.select(
        F.col(group + "_a"), F.col(group + "_b"),
        F.try_divide(F.col("dot"), F.sqrt(F.col("l2a") * F.col("l2b"))).alias("cosine"),
        F.when(F.col("a") == F.col("b"), F.lit(0.0)).otherwise(F.sqrt(eu2)).alias("euclidean"),
        (F.col("l1a") + F.col("l1b") - 2 * F.col("minsum")).alias("manhattan"),
        F.when(F.col("a") == F.col("b"), F.lit(0.0)).otherwise(
            F.pow(F.greatest(F.col("lpa") + F.col("lpb") + F.col("mink"), F.lit(0.0)), F.lit(1.0 / p))).alias("minkowski"),
        (F.col("canb") + (F.col("nza") + F.col("nzb") - 2 * F.col("shared"))).alias("canberra"),
        F.try_divide(F.col("shared"), F.col("nza") + F.col("nzb") - F.col("shared")).alias("jaccard"))


def group_word_shares(toks: DataFrame, by: str, a: str, b: str, term: str = "term") -> DataFrame:
    """Share of each word within group ``a`` and ``b`` (count / tokens of
    the group), kept only where both use it, flagged by the larger share."""
    cnt = toks.filter(F.col(by).isin(a, b)).groupBy(by, term).agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.groupBy(by).agg(F.sum("n").alias("total"))
    prop = cnt.join(F.broadcast(tot), by).withColumn("prop", F.col("n") / F.col("total"))
    wide = prop.groupBy(term).pivot(by, [a, b]).agg(F.first("prop")).na.drop(subset=[a, b])
    return wide.withColumn("more", F.when(F.col(a) > F.col(b), F.lit(f"more {a}")).otherwise(F.lit(f"more {b}")))


# ---- text reuse ----------------------------------------------------------------------------

def shingles(arrays: DataFrame, n: int = 5, keys: Iterable[str] = ("doc_id",), col: str = "toks") -> DataFrame:
    """Distinct word n-gram shingles per text ``(keys…, shingle)``."""
    keys = list(keys)
    g = TK.pin(arrays, col).select(*keys, F.explode(F.array_distinct(TK.ngram_array(col, n, " "))).alias("shingle"))
    return g


def text_reuse_candidates(items: DataFrame, docs: DataFrame, n: int = 5, min_shared: int = 2,
                          item_key: str = "item_id", doc_key: str = "doc_id") -> DataFrame:
    """L6 (candidate stage): documents sharing word n-grams with reference
    passages, with shared-shingle count and containment (shared / shingles of
    the passage).

    Spark joins by measured size: passages that fit are broadcast, otherwise
    a skewed partition of a very common shingle is split at run time. Every
    candidate is kept (no cap).
    """
    ia = TK.pin(TK.token_arrays(items, keys=[item_key]), "toks")
    da = TK.pin(TK.token_arrays(docs, keys=[doc_key]), "toks")
    ish = shingles(ia, n, [item_key])
    tot = ish.groupBy(item_key).agg(F.count(F.lit(1)).alias("item_shingles"))
    dsh = shingles(da, n, [doc_key])
    shared = dsh.join(ish, "shingle").groupBy(item_key, doc_key).agg(F.count(F.lit(1)).alias("shared"))
    out = shared.filter(F.col("shared") >= min_shared).join(tot, item_key)
    return out.withColumn("containment", F.col("shared") / F.col("item_shingles"))


# Alignment scores (match, mismatch, gap).
SW_MATCH, SW_MISMATCH, SW_GAP = 2.0, -1.0, -1.0


def smith_waterman(a: list, b: list, match: float = SW_MATCH, mismatch: float = SW_MISMATCH,
                   gap: float = SW_GAP) -> float:
    """Best local alignment score of two token sequences (linear gaps),
    vectorised over anti-diagonals: O(len(a)·len(b)) time, O(len(a)) memory."""
    m, n = len(a), len(b)
    if m == 0 or n == 0:
        return 0.0
    A = np.asarray(a, dtype=object)
    B = np.asarray(b, dtype=object)
    # H on anti-diagonal d holds cells (i, d - i), i = 1..m, j = d - i in 1..n (1-based)
    prev2 = np.zeros(m + 1)
    prev1 = np.zeros(m + 1)
    best = 0.0
    idx = np.arange(m + 1)
    for d in range(2, m + n + 1):
        cur = np.zeros(m + 1)
        lo, hi = max(1, d - n), min(m, d - 1)
        if lo <= hi:
            i = idx[lo:hi + 1]
            j = d - i
            s = np.where(A[i - 1] == B[j - 1], match, mismatch)
            diag = prev2[i - 1] + s            # H[i-1, j-1] is on diagonal d-2
            up = prev1[i - 1] + gap            # H[i-1, j]   is on diagonal d-1
            left = prev1[i] + gap              # H[i, j-1]   is on diagonal d-1
            v = np.maximum(np.maximum(diag, up), np.maximum(left, 0.0))
            cur[lo:hi + 1] = v
            best = max(best, float(v.max()))
        prev2, prev1 = prev1, cur
    return best


def text_reuse_alignment(items: DataFrame, docs: DataFrame, n: int = 5, min_shared: int = 2,
                         item_key: str = "item_id", doc_key: str = "doc_id") -> DataFrame:
    """Candidates by shared shingles (exact, uncapped), then a local
    alignment of each passage with each candidate document (``mapInPandas``,
    one alignment per candidate row). ``aligned`` = score / (2 · passage
    length), 1 for a verbatim copy."""
    cand = text_reuse_candidates(items, docs, n, min_shared, item_key, doc_key)
    it = TK.token_arrays(items, keys=[item_key]).withColumnRenamed("toks", "a")
    dt = TK.token_arrays(docs.join(cand.select(doc_key).distinct(), doc_key, "left_semi"), keys=[doc_key]) \
        .withColumnRenamed("toks", "b")
    j = cand.join(it, item_key).join(dt, doc_key)

    def run(batches):
        for pdf in batches:
            sc = [smith_waterman(list(a), list(b)) for a, b in zip(pdf["a"], pdf["b"])]
            out = pdf[[item_key, doc_key, "shared", "containment"]].copy()
            out["score"] = sc
            out["aligned"] = [s / (SW_MATCH * max(len(a), 1)) for s, a in zip(sc, pdf["a"])]
            yield out
    schema = f"{item_key} long, {doc_key} long, shared long, containment double, score double, aligned double"
    return j.select(item_key, doc_key, "shared", "containment", "a", "b").mapInPandas(run, schema)


def boilerplate_weight(arrays: DataFrame, keys: Iterable[str], sample: int = 1000, seed: int = 42, col: str = "toks") -> DataFrame:
    """``(keys…, weight)`` = 1 − the mean cosine of a text (such as an aligned
    passage) to ``sample`` random ones, chosen by a seeded hash: what is like
    everything is boilerplate.

    The mean over the sample of a cosine is one dot product with the mean of the
    sample's unit vectors, so a text is compared to one vector, not to a thousand."""
    from .relational import sample_n
    keys = list(keys)
    d = cut_lineage(arrays.select(*keys, F.explode(col).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n")), "boiler-dfm")
    size = d.groupBy(*keys).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("_l"))
    unit = d.join(size, keys).select(*keys, "term", (F.col("n") / F.col("_l")).alias("w"))
    some = cut_lineage(sample_n(d.select(*keys).distinct(), sample, keys, seed).select(*keys), "boiler-sample")
    count = some.count()
    mean = unit.join(F.broadcast(some), keys).groupBy("term").agg((F.sum("w") / max(count, 1)).alias("m"))  # at most `sample` rows are broadcast
    near = unit.join(mean, "term", "left").groupBy(*keys).agg(F.sum(F.col("w") * F.coalesce("m", F.lit(0.0))).alias("c"))
    return near.select(*keys, (1 - F.col("c")).alias("weight"))


def weighted_text_reuse(items: DataFrame, docs: DataFrame, n: int = 5, min_shared: int = 2, sample: int = 1000, seed: int = 42,
                        item_key: str = "item_id", doc_key: str = "doc_id") -> DataFrame:
    """Alignments of :func:`text_reuse_alignment` with ``weight`` (of the
    passage among the aligned passages) and ``weighted`` = aligned × weight."""
    found = cut_lineage(text_reuse_alignment(items, docs, n, min_shared, item_key, doc_key), "reuse")
    passages = TK.token_arrays(items.join(found.select(item_key).distinct(), item_key, "left_semi"), keys=[item_key])
    w = boilerplate_weight(passages, [item_key], sample, seed)
    return found.join(w, item_key).withColumn("weighted", F.col("aligned") * F.col("weight"))
