"""Document-feature tables.

A dfm is long: ``(doc_id, term, n)``; weighted forms carry ``w``. Sparse
vectors appear only at the ML boundary (:func:`to_vectors`).

Counting is ``groupBy(doc, term)``: since a document's tokens share a
partition, the partial aggregate is already final and the shuffle carries
dfm rows only. Term-level statistics (document frequency, totals) shuffle by
term, with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tokens import remove_stopwords


def _scalar(x) -> Column:
    """A number, a Column, or a one-value DataFrame (scalar subquery)."""
    if isinstance(x, DataFrame):
        return x.scalar()
    if isinstance(x, Column):
        return x
    return F.lit(x)


def dfm_from_arrays(arrays: DataFrame, keys: Iterable[str] = ("doc_id",), col: str = "toks", deal: bool = True) -> DataFrame:
    """J1 from token arrays: explode, then count per ``(doc, term)``.

    deal: arrays are dealt by document first; counting then needs no exchange
    of its own (about the same bytes move, but as arrays instead of one row per
    term), nor do sums and joins by document on the result. False where the texts were dealt
    already (:func:`quire.sources.tables.deal`).
    """
    keys = list(keys)
    dealt = arrays.select(*keys, col)
    dealt = dealt.repartition(*keys) if keys and deal else dealt
    return dfm(dealt.select(*keys, F.explode(col).alias("term")), keys)


def docfreq_from_arrays(arrays: DataFrame, col: str = "toks") -> DataFrame:
    """Document frequency of each term, from the distinct terms of each array: no dfm is made."""
    return arrays.select(F.explode(F.array_distinct(col)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


#: Kept terms up to which arrays are trimmed in their rows.
MAX_KEPT = 5000


def trim_arrays(arrays: DataFrame, n_docs, min_share: float, max_share: float = 1.0, col: str = "toks",
                max_kept: int = MAX_KEPT) -> tuple[DataFrame | None, DataFrame]:
    """J4 by share of documents, on arrays: (arrays of kept terms only, kept
    (term, df)). Terms in at least a share p of the documents are at most the mean number of a document's types / p,
    whatever the corpus, so they are listed (a hashed set, no join); beyond
    ``max_kept`` the first is None and the dfm has to be trimmed by a join."""
    from ..session import cut_lineage
    share = F.col("df") / _scalar(n_docs)
    kept = cut_lineage(docfreq_from_arrays(arrays, col).where((share >= F.lit(min_share)) & (share <= F.lit(max_share))), "kept-terms")
    words = [r[0] for r in kept.select("term").limit(max_kept + 1).collect()]
    if len(words) > max_kept:
        return None, kept
    if not words:
        return arrays.withColumn(col, F.slice(col, 1, 0)), kept
    # as one SQL text: a column per word would be a call to the JVM each
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return arrays.withColumn(col, F.expr(f"filter(`{col}`, x -> x IN ({quoted}))")), kept


def tfidf_from_arrays(arrays: DataFrame, n_docs, stats: DataFrame | None = None, keys: Iterable[str] = ("doc_id",), col: str = "toks") -> DataFrame:
    """J9 (shares of the document's length, log10 of N / df) from token arrays
    that are dealt by document: the length is the array's size, carried in the row, so no total is aggregated or joined."""
    keys = list(keys)
    stats = stats if stats is not None else docfreq_from_arrays(arrays, col)
    # one projection computes the array, the next one reads it
    from .tokens import pin
    rows = pin(arrays.select(*keys, col), col).select(*keys, F.size(col).alias("_len"), F.explode(col).alias("term"))
    d = rows.groupBy(*keys, "term", "_len").agg(F.count(F.lit(1)).alias("n"))
    idf = stats.select("term", F.log10(_scalar(n_docs) / F.col("df")).alias("_idf"))
    return d.join(idf, "term").select(*keys, "term", "n", (F.col("n") / F.col("_len") * F.col("_idf")).alias("w"))


def dfm(toks: DataFrame, keys: Iterable[str] = ("doc_id",), term: str = "term") -> DataFrame:
    """J1 from long tokens: ``groupBy(doc, term).count()`` (partial + final aggregate)."""
    keys = list(keys)
    return toks.groupBy(*keys, term).agg(F.count(F.lit(1)).alias("n"))


def docfreq(d: DataFrame, term: str = "term") -> DataFrame:
    """Document frequency and total count per term."""
    return d.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))


def topfeatures(d: DataFrame, n: int = 10, term: str = "term") -> DataFrame:
    """``n`` most frequent features (ties broken by term)."""
    tot = d.groupBy(term).agg(F.sum("n").alias("n"))
    return tot.orderBy(F.desc("n"), F.asc(term)).limit(n)


def featnames(d: DataFrame, term: str = "term") -> DataFrame:
    """J3."""
    return d.select(term).distinct()


def dfm_trim(d: DataFrame, n_docs=None, min_docfreq=None, max_docfreq=None,
             docfreq_type: str = "count", min_termfreq=None, max_termfreq=None,
             term: str = "term") -> DataFrame:
    """Keep terms whose document frequency (count, or share of
    ``n_docs``) and total frequency lie within the inclusive bounds.

    The kept vocabulary is joined back with a semi-join; AQE turns it into a
    broadcast when its measured size is small (with a share bound ``p`` it holds
    at most ``avg types per document / p`` terms, independent of corpus size).
    """
    stats = docfreq(d, term)
    cond = F.lit(True)
    if docfreq_type == "prop":
        if n_docs is None:
            n_docs = d.select(F.countDistinct(*[c for c in d.columns if c not in (term, "n", "w")]))
        df_val = F.col("df") / _scalar(n_docs)
    else:
        df_val = F.col("df")
    if min_docfreq is not None:
        cond = cond & (df_val >= F.lit(min_docfreq))
    if max_docfreq is not None:
        cond = cond & (df_val <= F.lit(max_docfreq))
    if min_termfreq is not None:
        cond = cond & (F.col("tf") >= F.lit(min_termfreq))
    if max_termfreq is not None:
        cond = cond & (F.col("tf") <= F.lit(max_termfreq))
    keep = stats.filter(cond).select(term)
    return d.join(keep, term, "left_semi")


def dfm_trim_stats(d: DataFrame, n_docs, min_docfreq=None, max_docfreq=None, docfreq_type: str = "count",
                   term: str = "term", stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J4 returning ``(trimmed dfm, kept stats (term, df, tf))`` so later steps
    (tf-idf) reuse the document frequencies instead of recounting. ``stats``: the table
    of all terms, where it is made already (its further columns are kept)."""
    stats = stats if stats is not None else docfreq(d, term)
    df_val = F.col("df") / _scalar(n_docs) if docfreq_type == "prop" else F.col("df")
    cond = F.lit(True)
    if min_docfreq is not None:
        cond = cond & (df_val >= F.lit(min_docfreq))
    if max_docfreq is not None:
        cond = cond & (df_val <= F.lit(max_docfreq))
    keep = stats.filter(cond)
    return d.join(keep.select(term), term, "left_semi"), keep


def dfm_remove(d: DataFrame, words, term: str = "term") -> DataFrame:
    """Remove features (fixed list or table)."""
    return remove_stopwords(d, words, term)


def dfm_stem(d: DataFrame, stem_map: DataFrame, keys: Iterable[str] = ("doc_id",),
             term: str = "term") -> DataFrame:
    """Replace feature names by stems from a ``(term, stem)`` map and merge counts."""
    keys = list(keys)
    j = d.join(stem_map, term, "left").withColumn(term, F.coalesce("stem", term))
    return j.groupBy(*keys, term).agg(F.sum("n").alias("n"))


def ntoken_ntype(d: DataFrame, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Tokens and types per document."""
    return d.groupBy(*keys).agg(F.sum("n").alias("ntoken"), F.count(F.lit(1)).alias("ntype"))


def dfm_weight_prop(d: DataFrame, keys: Iterable[str] = ("doc_id",), value: str = "n") -> DataFrame:
    """Each count as a share of its document's total."""
    keys = list(keys)
    tot = d.groupBy(*keys).agg(F.sum(value).alias("_tot"))
    return d.join(tot, keys).withColumn("w", F.col(value) / F.col("_tot")).drop("_tot")


def dfm_tfidf(d: DataFrame, n_docs, keys: Iterable[str] = ("doc_id",), term: str = "term",
              base: float = 10.0, scheme_tf: str = "prop", stats: DataFrame | None = None) -> DataFrame:
    """Tf × idf with idf = log_base(N / df) (no smoothing; Spark ML's IDF differs).

    ``scheme_tf='prop'`` uses shares of the document total, ``'count'`` raw counts.
    ``stats`` (``term, df``) may be passed when already computed (e.g. by a
    trim: trimming removes terms, never documents, so df is unchanged).
    """
    keys = list(keys)
    stats = (stats.select(term, F.col("df").alias("_df")) if stats is not None
             else d.groupBy(term).agg(F.count(F.lit(1)).alias("_df")))
    ratio = _scalar(n_docs) / F.col("_df")
    idf = F.log10(ratio) if base == 10 else (F.ln(ratio) if base == "e" else F.log(float(base), ratio))
    if scheme_tf == "prop":  # document totals by aggregate + join (AQE splits a skewed document)
        d = d.join(d.groupBy(*keys).agg(F.sum("n").alias("_tot")), keys)
        tf = F.col("n") / F.col("_tot")
    else:
        tf = F.col("n")
    return (d.join(stats.select(term, idf.alias("_idf")), term)
            .withColumn("w", tf * F.col("_idf")).drop("_idf", "_tot"))


def dfm_match(d: DataFrame, vocab: DataFrame, term: str = "term") -> DataFrame:
    """Keep only the features of ``vocab`` (missing ones are implicit zeros)."""
    return d.join(vocab.select(term).distinct(), term, "left_semi")


def drop_empty(docs: DataFrame, d: DataFrame, keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Documents with at least one feature."""
    keys = list(keys)
    return docs.join(d.select(*keys).distinct(), keys, "left_semi")


def dfm_group(d: DataFrame, docvars: DataFrame, by: str, keys: Iterable[str] = ("doc_id",),
              term: str = "term", value: str = "n") -> DataFrame:
    """Sum a dfm's rows over a document variable → ``(by, term, value)``."""
    keys = list(keys)
    j = d.join(docvars.select(*keys, by), keys)
    return j.groupBy(by, term).agg(F.sum(value).alias(value))


def vocabulary(d: DataFrame, term: str = "term") -> DataFrame:
    """Term index (0-based, by term order), document and total frequency.

    The index is a dense rank over the sorted vocabulary, computed by a global
    range sort (no single-partition window).
    """
    from ..sources.files import with_row_id
    stats = docfreq(d, term)
    v = with_row_id(stats, [F.col(term)], "idx")
    return v.withColumn("idx", (F.col("idx") - 1).cast("int"))


def to_vectors(d: DataFrame, vocab: DataFrame, size: int, keys: Iterable[str] = ("doc_id",),
               term: str = "term", value: str = "n", out: str = "features") -> DataFrame:
    """Per-document ``SparseVector`` over ``vocab`` indices (ML boundary only).

    Entries are gathered per document (bounded by its number of types). A
    stored vector is a struct of type, size, indices and values, so the rows are written as such
    structs and read back as vectors: no Python touches them.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType
    from ..session import scratch_path
    keys = list(keys)
    j = d.join(vocab.select(term, "idx"), term)
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("idx", F.col(value).cast("double").alias("v")))).alias("_e"))
    raw = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
                   F.transform("_e", lambda e: e["idx"]).alias("indices"), F.transform("_e", lambda e: e["v"]).alias("values"))
    rows = g.select(*keys, raw.alias(out))
    spark = d.sparkSession
    path = scratch_path(spark, "vectors")
    rows.write.parquet(path)
    schema = StructType([*[rows.schema[k] for k in keys], StructField(out, VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def dense_slice(d: DataFrame, doc_ids: list, terms: list, keys: str = "doc_id",
                term: str = "term", value: str = "n") -> DataFrame:
    """A small dense slice for inspection (bounded lists of ids and terms)."""
    sub = d.filter(F.col(keys).isin(doc_ids) & F.col(term).isin(terms))
    return sub.groupBy(keys).pivot(term, terms).agg(F.first(value)).na.fill(0)
