"""Word embeddings and their uses.

Vectors are ``(term, vec ARRAY<FLOAT|DOUBLE>)``. Windows and co-occurrences
are formed inside each document's token array (shifted slices), so the only
shuffle is the final count. Query vectors are scalar subqueries or bounded
broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import math as M
from . import tokens as TK
from .blocks import matrix, total
from .factors import glove, truncated_svd  # noqa: F401 (part of this module's interface)
from .skipgram import skipgram

#: Tokens whose pairs are counted at once; different pairs that a task keeps before it merges them.
SPAN, PAIRS = 1 << 18, 1 << 22


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unigram_probs(d: DataFrame, term: str = "term") -> DataFrame:
    """K1: ``(term, n, p)`` with p = n / total tokens."""
    g = d.groupBy(term).agg(F.sum("n").alias("n"))
    return g.withColumn("p", F.col("n") / g.select(F.sum("n")).scalar())


def window_arrays(toks, size: int) -> Column:
    """All windows of ``size`` consecutive tokens as arrays (none if shorter)."""
    toks = _c(toks)
    k = F.greatest(F.size(toks) - F.lit(size - 1), F.lit(0))
    acc = F.transform(F.slice(toks, F.lit(1), k), lambda x: F.array(x))
    for j in range(1, size):
        acc = F.zip_with(acc, F.slice(toks, F.lit(j + 1), k), lambda a, y: F.concat(a, F.array(y)))
    return acc


def skipgram_pairs(arrays: DataFrame, size: int = 6, col: str = "toks") -> DataFrame:
    """K2 + K3: ordered word pairs sharing a window of ``size`` tokens,
    diagonal included; a word repeated inside one window counts once there.
    Returns ``(term1, term2, n)`` (both orders) and the window count is
    ``n(a, a)`` on the diagonal.

    One row per window (its distinct words), then two generators emit the
    ≤ size² pairs — codegen'd explodes, no self-join on a window id.
    """
    arrays = TK.pin(arrays.select(col), col)
    k = F.greatest(F.size(col) - F.lit(size - 1), F.lit(0))
    wins = F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
                       lambda i: F.array_distinct(F.slice(col, i, size)))
    wins = F.when(k > 0, wins).otherwise(F.array().cast("array<array<string>>"))
    ex = arrays.select(F.explode(wins).alias("_w"))
    ex = ex.select(F.explode("_w").alias("term1"), "_w").select("term1", F.explode("_w").alias("term2"))
    return ex.groupBy("term1", "term2").agg(F.count(F.lit(1)).alias("n"))


def skipgram_pairs_half(arrays: DataFrame, size: int = 6, col: str = "toks") -> DataFrame:
    """K3 in half: counts for ``term1 <= term2`` only (the table is symmetric),
    so the aggregation sees half the rows; :func:`mirror_pairs` restores both
    orders where needed (after filtering)."""
    arrays = TK.pin(arrays.select(col), col)
    k = F.greatest(F.size(col) - F.lit(size - 1), F.lit(0))
    wins = F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
                       lambda i: F.array_sort(F.array_distinct(F.slice(col, i, size))))
    wins = F.when(k > 0, wins).otherwise(F.array().cast("array<array<string>>"))
    ex = arrays.select(F.explode(wins).alias("_w"))
    # in a sorted window, position i pairs with positions j >= i
    ex = ex.select(F.posexplode("_w").alias("_i", "term1"), "_w")
    ex = ex.select("term1", F.explode(F.slice("_w", F.col("_i") + 1, F.size("_w"))).alias("term2"))
    return ex.groupBy("term1", "term2").agg(F.count(F.lit(1)).alias("n"))


def mirror_pairs(half: DataFrame) -> DataFrame:
    """Both orders from a ``term1 <= term2`` table (diagonal once)."""
    off = half.filter(F.col("term1") != F.col("term2"))
    return half.unionByName(off.select(F.col("term2").alias("term1"), F.col("term1").alias("term2"), "n"))


def pmi_table(pairs: DataFrame, uni: DataFrame, min_n: int = 20, half: bool = False) -> DataFrame:
    """K4: PMI = log10(p12 / p1 / p2); p12 is the pair's share of all pair
    counts (computed **before** the filter ``n > min_n``). The pair table is
    written once to the checkpoint folder (it is read for the total and for
    the filter). ``half=True`` takes a :func:`skipgram_pairs_half` table."""
    from ..session import cut_lineage
    pairs = cut_lineage(pairs, "pairs")  # read twice (total, filter): aggregate once
    if half:  # total over both orders; mirror only the (few) kept pairs
        total = pairs.select(F.sum(F.when(F.col("term1") == F.col("term2"), F.col("n")).otherwise(2 * F.col("n")))).scalar()
        pairs = mirror_pairs(pairs.filter(F.col("n") > min_n))
    else:
        total = pairs.select(F.sum("n")).scalar()
    p = pairs.withColumn("p12", F.col("n") / total).filter(F.col("n") > min_n)
    u1 = uni.select(F.col("term").alias("term1"), F.col("p").alias("p1"))
    u2 = uni.select(F.col("term").alias("term2"), F.col("p").alias("p2"))
    j = p.join(u1, "term1").join(u2, "term2")
    return j.select("term1", "term2", "n", F.log10(F.col("p12") / F.col("p1") / F.col("p2")).alias("pmi"))


def _near(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(x, y, n): how often two words are at distance 1..``window`` in a task's token arrays, a row for
    each different pair (in one order), not for each time it is met. Words are numbered within the task."""
    number: dict[str, int] = {}
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        seen, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        return seen, np.bincount(at, np.concatenate([n for _, n in parts]), len(seen)).astype(np.int64)

    def rows(pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(number), pa.string())
        for lo in range(0, len(pairs), 1 << 16):
            some = pairs[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(some >> 32)), words.take(pa.array(some & 0xFFFFFFFF)),
                                              pa.array(n[lo:lo + (1 << 16)])], names=["x", "y", "n"])

    for batch in batches:
        lists = batch.column(0)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        tokens = lists.flatten().dictionary_encode()
        own = np.array([*(number.setdefault(w, len(number)) for w in tokens.dictionary.to_pylist()), -1], np.int64)  # -1: a pad
        code = own[pc.fill_null(tokens.indices, len(own) - 1).to_numpy(zero_copy_only=False)]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        for lo in range(0, len(code), SPAN):
            met = []
            for d in range(1, window + 1):
                first, second = slice(lo, max(lo, min(lo + SPAN, len(code) - d))), slice(lo + d, max(lo, min(lo + SPAN, len(code) - d)) + d)
                x, y = code[first], code[second]
                pair = (doc[first] == doc[second]) & (x >= 0) & (y >= 0)
                met.append(np.minimum(x, y)[pair] << 32 | np.maximum(x, y)[pair])
            parts.append(np.unique(np.concatenate(met), return_counts=True))
            if sum(len(p) for p, _ in parts) > PAIRS:
                parts = [summed()]
                if len(parts[0][0]) > PAIRS // 2:
                    yield from rows(*parts.pop())
    if parts:
        yield from rows(*summed())


def fcm(arrays: DataFrame, window: int = 6, col: str = "toks") -> DataFrame:
    """K9: symmetric co-occurrence counts of tokens at distance 1..``window``
    (``NULL`` entries are pads: they occupy a position but never pair).
    Returns ``(term1, term2, n)`` with both orders. A task counts its own pairs
    first, so that each different pair is shuffled once a task."""
    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _near(batches, window)

    ex = arrays.select(col).mapInArrow(near, "x string, y string, n long")
    half = ex.groupBy(F.least("x", "y").alias("term1"), F.greatest("x", "y").alias("term2")).agg(F.sum("n").alias("n"))
    # a word with itself is a pair in both orders at once
    turns = F.when(F.col("term1") == F.col("term2"), F.array(F.struct("term1", "term2", (2 * F.col("n")).alias("n")))).otherwise(
        F.array(F.struct("term1", "term2", "n"), F.struct(F.col("term2").alias("term1"), F.col("term1").alias("term2"), F.col("n").alias("n"))))
    return half.select(F.inline(turns))


def pad_array(arrays: DataFrame, keep: Iterable[str] | None = None, drop: Iterable[str] | None = None,
              col: str = "toks") -> DataFrame:
    """I15 on arrays: replace tokens not kept (or dropped) by NULL pads."""
    if keep is not None:
        ks = list(keep)
        f = lambda x: F.when(x.isin(ks), x)
    else:
        ds = list(drop or [])
        f = lambda x: F.when(~x.isin(ds), x)
    return arrays.withColumn(col, F.transform(col, f))


def one_row(df: DataFrame, what: str = "query") -> DataFrame:
    """Check that ``df`` holds exactly one row (a bounded side to broadcast)."""
    n = df.limit(2).count()
    if n != 1:
        raise ValueError(f"{what} must be exactly one row, got {n if n < 2 else 'several'}")
    return df


def with_row_of(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a checked one-row table to every row of ``df``
    (broadcast hash join on a constant key)."""
    one = one_row(row).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")


def nearest_to_vector(V: DataFrame, query: DataFrame, n: int = 10, key: str = "term", vec: str = "vec",
                      measure: str = "dot", exclude: Iterable = ()) -> DataFrame:
    """The ``n`` rows of ``V`` closest to a query vector (dot product
    or cosine), ties by key; ``query`` is a one-row table with column ``_q``."""
    j = with_row_of(V.select(key, vec), query.select("_q"))
    score = M.dot(vec, "_q") if measure == "dot" else M.cosine(vec, "_q")
    s = j.select(key, score.alias("score"))
    ex = list(exclude)
    if ex:
        s = s.filter(~F.col(key).isin(ex))
    return s.orderBy(F.desc("score"), key).limit(n)


def vector_of(V: DataFrame, key_value, key: str = "term", vec: str = "vec") -> DataFrame:
    """The vector of one key as a one-row table ``(_q)``."""
    return V.filter(F.col(key) == F.lit(key_value)).select(F.col(vec).alias("_q"))


def analogy(V: DataFrame, a, b, c, n: int = 10, key: str = "term", vec: str = "vec") -> DataFrame:
    """Rank by cosine to ``a − b + c`` (the three inputs excluded)."""
    qa = one_row(vector_of(V, a, key, vec)).withColumnRenamed("_q", "_a")
    qb = one_row(vector_of(V, b, key, vec)).withColumnRenamed("_q", "_b")
    qc = one_row(vector_of(V, c, key, vec)).withColumnRenamed("_q", "_c")
    q = with_row_of(with_row_of(qa, qb), qc).select(M.vec_add(M.vec_sub("_a", "_b"), "_c").alias("_q"))
    return nearest_to_vector(V, q, n, key, vec, "cosine", exclude=[a, b, c])


def mean_vectors(df: DataFrame, by: str | list[str], vec: str = "vec", out: str = "vec") -> DataFrame:
    """Element-wise mean vector per group.

    Uses ML ``Summarizer.mean`` — a real aggregate with partial
    aggregation — on vectors converted in the JVM."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    by = [by] if isinstance(by, str) else list(by)
    v = df.select(*by, array_to_vector(F.col(vec)).alias("_v"))
    g = v.groupBy(*by).agg(Summarizer.mean(F.col("_v")).alias("_m"), F.count(F.lit(1)).alias("n_vectors"))
    return g.select(*by, vector_to_array("_m").alias(out), "n_vectors")


def doc_vectors(d: DataFrame, V: DataFrame, keys: Iterable[str] = ("doc_id",), term: str = "term",
                vec: str = "vec") -> DataFrame:
    """Document vector = unweighted mean over the document's **distinct**
    words that have a vector; documents with none are absent."""
    keys = list(keys)
    j = d.select(*keys, term).distinct().join(V.select(term, vec), term)
    return mean_vectors(j, keys, vec)


def dict_vectors(dictionary: DataFrame, V: DataFrame, term: str = "term", vec: str = "vec") -> DataFrame:
    """Mean vector per category over its words present in ``V``."""
    j = dictionary.select("category", F.col("pattern").alias(term)).join(V.select(term, vec), term)
    return mean_vectors(j, "category", vec)


def dict_similarity(docvecs: DataFrame, centroids: DataFrame, keys: Iterable[str] = ("doc_id",),
                    vec: str = "vec", max_centroids: int = 10_000) -> DataFrame:
    """Cosine of every document vector to every category centroid; the
    centroid table is broadcast after its row count is checked."""
    keys = list(keys)
    n = centroids.count()
    if n > max_centroids:
        raise ValueError(f"{n} centroids exceed {max_centroids}")
    cen = centroids.agg(F.collect_list(F.struct("category", F.col(vec).alias("v"))).alias("_c"))  # one row
    x = with_row_of(docvecs.select(*keys, vec), cen)
    near = F.transform("_c", lambda c: F.struct(c["category"].alias("category"), M.cosine(vec, c["v"]).alias("cosine")))
    return x.select(*keys, F.inline(near))


def expand_dict(seeds: DataFrame, V: DataFrame, n: int = 10, term: str = "term", vec: str = "vec",
                max_seeds: int = 10_000) -> DataFrame:
    """For each seed word, its ``n`` nearest words by dot product,
    collected per category (seed list checked and broadcast)."""
    s = seeds.select("category", F.col("pattern").alias("seed")).join(
        V.select(F.col(term).alias("seed"), F.col(vec).alias("_s")), "seed")
    if s.count() > max_seeds:
        raise ValueError("too many seed words")
    every = s.agg(F.collect_list(F.struct("category", "seed", "_s")).alias("_seeds"))  # one row
    near = F.transform("_seeds", lambda e: F.struct(e["category"].alias("category"), e["seed"].alias("seed"), M.dot(vec, e["_s"]).alias("score")))
    sc = with_row_of(V.select(term, vec), every).select(term, F.inline(near)).filter(F.col(term) != F.col("seed"))
    w = Window.partitionBy("category", "seed").orderBy(F.desc("score"), term)
    return sc.select("category", "seed", term, "score").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def emotionality(similarity: DataFrame, affect: str = "affect", cognition: str = "cognition", keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """How much closer a document is to the affect dictionary than to the
    cognition dictionary: (1 + cosine) / (1 + cosine), NULL where one is missing.
    similarity: as from :func:`dict_similarity`."""
    keys = list(keys)
    side = [F.max(F.when(F.col("category") == c, F.col("cosine"))) for c in (affect, cognition)]
    g = similarity.groupBy(*keys).agg(side[0].alias("affect"), side[1].alias("cognition"))
    return g.select(*keys, "affect", "cognition", F.try_divide(F.col("affect") + 1, F.col("cognition") + 1).alias("emotionality"))


def axis_projection(V: DataFrame, pairs: list[tuple], term: str = "term", vec: str = "vec") -> DataFrame:
    """axis = mean of (left − right) over antonym pairs; each word's cosine
    with the axis."""
    lefts = V.join(F.broadcast(V.sparkSession.createDataFrame([(a,) for a, _ in pairs], f"{term} string")), term)
    rights = V.join(F.broadcast(V.sparkSession.createDataFrame([(b,) for _, b in pairs], f"{term} string")), term)
    ml = mean_vectors(lefts.withColumn("_g", F.lit(1)), "_g", vec, "_l")
    mr = mean_vectors(rights.withColumn("_g", F.lit(1)), "_g", vec, "_r")
    axis = ml.join(mr, "_g").select(M.vec_sub("_l", "_r").alias("_axis"))
    return with_row_of(V.select(term, vec), axis).select(term, M.cosine(vec, "_axis").alias("projection"))


def relative_norm(V: DataFrame, c1: DataFrame, c2: DataFrame, term: str = "term", vec: str = "vec") -> DataFrame:
    """‖w − c1‖ − ‖w − c2‖ per word (negative = closer to group 1);
    ``c1``/``c2`` are one-row tables holding a centroid in ``vec``."""
    j = with_row_of(with_row_of(V.select(term, vec), c1.select(F.col(vec).alias("_c1"))),
                    c2.select(F.col(vec).alias("_c2")))
    return j.select(term, (M.euclidean(vec, "_c1") - M.euclidean(vec, "_c2")).alias("relative_norm"))


def dimension_words(V: DataFrame, dims: Iterable[int], n: int = 10, term: str = "term",
                    vec: str = "vec", drop: Iterable[str] = ()) -> DataFrame:
    """K8: per dimension, the ``n`` words with largest |value| (ties kept)."""
    ex = V.select(term, F.posexplode(vec).alias("dim", "value")).filter(F.col("dim").isin(list(dims)))
    if drop:
        ex = ex.filter(~F.col(term).isin(list(drop)))
    w = Window.partitionBy("dim").orderBy(F.desc(F.abs("value")))
    return ex.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= n)


def plot_table(V: DataFrame, lo: int, hi: int, dims: int = 2, term: str = "term", key: str = "idx",
               vec: str = "vec") -> DataFrame:
    """First ``dims`` coordinates for rows with ``lo <= key <= hi``."""
    sub = V.filter(F.col(key).between(lo, hi))
    return sub.select(term, *[F.col(vec)[i].alias(f"dim{i + 1}") for i in range(dims)])


def svd_vectors(pmi: DataFrame, k: int, term1: str = "term1", term2: str = "term2", value: str = "pmi"):
    """K6: truncated SVD of the sparse PMI matrix; word vectors = U (rows),
    each column's sign fixed so that its largest-|value| entry (ties: the first
    term) is positive. Returns ``((term, vec), singular values)``; see :mod:`.factors`."""
    return truncated_svd(pmi, k, term1, term2, value)


def word2vec(arrays: DataFrame, size: int = 300, window: int = 6, min_count: int = 10, epochs: int = 5,
             seed: int = 42, col: str = "toks", start: DataFrame | None = None):
    """Skip-gram word2vec with negative sampling on distinct texts; returns
    ``(loss of each pass, vectors (term, vec))``; see :mod:`.skipgram`."""
    V, losses = skipgram(arrays, size, window, min_count, epochs, seed=seed, col=col, start=start)
    return losses, V


def procrustes_align(base: DataFrame, other: DataFrame, term: str = "term", vec: str = "vec") -> DataFrame:
    """Rotate ``other`` onto ``base`` (orthogonal Procrustes over shared
    words): the d×d cross-product is summed in the tasks, its SVD on the driver
    (d×d is bounded by the dimension), the rotation applied in the tasks."""
    import numpy as np

    j = base.select(term, F.col(vec).cast("array<double>").alias("a")).join(
        other.select(term, F.col(vec).cast("array<double>").alias("b")), term)
    first = other.select(F.size(vec)).first()
    if first is None:
        return other.select(term, vec)
    dim = first[0]

    def cross(batches):
        out = np.zeros((dim, dim))
        for pdf in batches:
            if len(pdf):
                out += matrix(pdf["b"]).T @ matrix(pdf["a"])
        yield pd.DataFrame({"j": [0], "vec": [out.ravel()]})

    parts = j.select("a", "b").mapInPandas(cross, "j int, vec array<double>")
    parts = parts.withColumn("j", F.pmod(F.monotonically_increasing_id(), F.lit(16)).cast("int"))
    u, _, vt = np.linalg.svd(total(parts, dim * dim).reshape(dim, dim))
    rotation = u @ vt
    kind = other.schema[term].dataType.simpleString()

    def rotate(batches):
        for pdf in batches:
            yield pd.DataFrame({term: pdf[term], vec: list(matrix(pdf[vec]) @ rotation) if len(pdf) else []})

    return other.select(term, F.col(vec).cast("array<double>").alias(vec)).mapInPandas(rotate, f"`{term}` {kind}, `{vec}` array<double>")


def covariate_embeddings(arrays: DataFrame, covariate: str, size: int = 6, min_n: int = 20, k: int = 16,
                         col: str = "toks", max_values: int = 10_000):
    """Covariate values learned with the words. Each document's
    covariate becomes a pseudo-word ``<cov>`` that co-occurs with every word of
    the document (its count = the word's count there); these pairs join the
    skip-gram pairs, the PMI matrix is factorised (K6), and the covariate
    vectors are placed on their first principal component (the number of
    covariate values is checked against ``max_values``).

    Returns ``(positions (value, position), vectors (term, vec))``.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    n_vals = arrays.select(covariate).distinct().count()
    if n_vals > max_values:
        raise ValueError(f"{n_vals} covariate values exceed {max_values}")
    tag = F.concat(F.lit("<"), F.col(covariate).cast("string"), F.lit(">"))
    words = arrays.select(covariate, F.explode(col).alias("term"))
    wc = words.groupBy(covariate, "term").agg(F.count(F.lit(1)).alias("n"))
    cov_pairs = wc.select(F.col("term").alias("term1"), tag.alias("term2"), "n")
    cov_pairs = cov_pairs.unionByName(cov_pairs.select(F.col("term2").alias("term1"), F.col("term1").alias("term2"), "n"))
    pairs = skipgram_pairs(arrays.select(col), size).unionByName(cov_pairs)
    tot_w = wc.select(F.sum("n")).scalar()
    uni_w = wc.groupBy("term").agg(F.sum("n").alias("n"))
    uni_c = wc.groupBy(tag.alias("term")).agg(F.sum("n").alias("n"))
    uni = uni_w.unionByName(uni_c).withColumn("p", F.col("n") / (2 * tot_w))
    pmi = pmi_table(pairs, uni, min_n)
    V, _s = svd_vectors(pmi, k)
    cv = V.filter(F.col("term").startswith("<"))
    pca = PCA(k=1, inputCol="_v", outputCol="_p").fit(cv.select(array_to_vector("vec").alias("_v")))
    pos = pca.transform(cv.withColumn("_v", array_to_vector("vec")))
    pos = pos.select(F.regexp_replace("term", "^<|>$", "").alias(covariate),
                     vector_to_array("_p")[0].alias("position"))
    return pos, V


def skipgram_pmi(arrays: DataFrame, size: int = 6, min_n: int = 20, col: str = "toks") -> DataFrame:
    """K1–K4 in one job: unigram probabilities, window pair counts and PMI
    for pairs seen more than ``min_n`` times (both orders).

    Pair counts are aggregated on 64-bit term hashes (cheaper keys than
    strings) when the hash is collision-free on this vocabulary — checked
    exactly (distinct hashes = distinct terms) — else on the strings; only the
    (few) kept pairs are joined back to their words.
    """
    from ..session import cut_lineage
    from .dfm import dfm_from_arrays
    arrays = TK.pin(arrays.select(col), col)
    uni = cut_lineage(unigram_probs(dfm_from_arrays(arrays, keys=[], col=col)).withColumn("h", F.xxhash64("term")),
                      "unigram")
    n_terms, n_hashes = uni.agg(F.count(F.lit(1)), F.countDistinct("h")).first()
    if n_terms != n_hashes:  # a collision: count on the strings
        return pmi_table(skipgram_pairs_half(arrays, size, col), uni.drop("h"), min_n, half=True)
    hashed = arrays.select(F.transform(col, lambda x: F.xxhash64(x)).alias(col))
    k = F.greatest(F.size(col) - F.lit(size - 1), F.lit(0))
    wins = F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
                       lambda i: F.array_sort(F.array_distinct(F.slice(col, i, size))))
    wins = F.when(k > 0, wins).otherwise(F.array().cast("array<array<bigint>>"))
    ex = hashed.select(F.explode(wins).alias("_w"))
    ex = ex.select(F.posexplode("_w").alias("_i", "h1"), "_w")
    ex = ex.select("h1", F.explode(F.slice("_w", F.col("_i") + 1, F.size("_w"))).alias("h2"))
    pairs = cut_lineage(ex.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "pairs-h")
    total = pairs.select(F.sum(F.when(F.col("h1") == F.col("h2"), F.col("n")).otherwise(2 * F.col("n")))).scalar()
    kept = pairs.filter(F.col("n") > min_n)
    both = kept.unionByName(kept.filter(F.col("h1") != F.col("h2")).select(
        F.col("h2").alias("h1"), F.col("h1").alias("h2"), "n"))
    u1 = uni.select(F.col("h").alias("h1"), F.col("term").alias("term1"), F.col("p").alias("p1"))
    u2 = uni.select(F.col("h").alias("h2"), F.col("term").alias("term2"), F.col("p").alias("p2"))
    j = both.join(u1, "h1").join(u2, "h2")
    return j.select("term1", "term2", "n", F.log10(F.col("n") / total / F.col("p1") / F.col("p2")).alias("pmi"))
