"""Corpus operators.

A corpus is a DataFrame ``(doc_id, text, <docvars…>)``; docvars are ordinary
columns. Nothing here collects to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens as T


def corpus(df: DataFrame, text_field: str = "text", docid_field: str | None = None) -> DataFrame:
    """B1: name the text column ``text`` and the id column ``doc_id``; the
    other columns stay as docvars. Without an id a unique one is attached."""
    out = df.withColumnRenamed(text_field, "text") if text_field != "text" else df
    if docid_field is None:
        if "doc_id" not in out.columns:
            out = out.withColumn("doc_id", F.monotonically_increasing_id())
    elif docid_field != "doc_id":
        out = out.withColumnRenamed(docid_field, "doc_id")
    rest = [c for c in out.columns if c not in ("doc_id", "text")]
    return out.select("doc_id", "text", *rest)


def duplicate_ids(c: DataFrame) -> DataFrame:
    """B1: ids used more than once (empty when names are unique)."""
    return c.groupBy("doc_id").count().filter(F.col("count") > 1)


def corpus_summary(c: DataFrame, docvars: list[str] | None = None) -> DataFrame:
    """B2: types, tokens and sentences per document with docvars.

    Tokens keep punctuation (as the corpus summary counts them); types are
    distinct lower-case tokens. All per-row array functions, on one token
    array per row: no shuffle.
    """
    docvars = docvars if docvars is not None else [x for x in c.columns if x not in ("doc_id", "text")]
    sents = F.regexp_count(F.col("text"), F.lit(T.SENTENCE)).cast("int")
    rows = c.select("doc_id", *docvars, sents.alias("sentences"),
                    F.regexp_extract_all(F.lower("text"), F.lit(T.token_pattern(True, False)), 0).alias("_t"))
    return T.pin(rows, "_t").select("doc_id", *docvars, F.size(F.array_distinct("_t")).alias("types"),
                                    F.size("_t").alias("tokens"), "sentences")


def ndoc(c: DataFrame) -> int:
    """B3 (an action)."""
    return c.count()


def add_length(c: DataFrame, name: str = "text_length") -> DataFrame:
    """Docvar with the number of characters."""
    return c.withColumn(name, F.char_length("text"))


def corpus_meta(c: DataFrame, **fields) -> DataFrame:
    """One-row corpus metadata: given fields plus document count."""
    extra = [F.lit(v).alias(k) for k, v in fields.items()]
    return c.agg(F.count(F.lit(1)).alias("ndoc"), *extra)


def corpus_subset(c: DataFrame, predicate) -> DataFrame:
    """B6."""
    return c.filter(predicate)


def texts(c: DataFrame) -> DataFrame:
    """B7."""
    return c.select("doc_id", "text")


def group_texts(c: DataFrame, by: str, order: str = "doc_id") -> DataFrame:
    """The texts of each group as one ordered document in long form
    ``(by, part, text)`` — ``part`` is the ``order`` value, so the parts sort in
    document order without any per-group window.

    Downstream operators treat ``by`` as the document key (tokens and dfms of
    the grouped document are the union of its parts), so a group holding a
    third of the corpus is never gathered into a single row or task.
    """
    return c.select(by, F.col(order).alias("part"), "text")


def group_texts_summary(c: DataFrame, by: str, sep: str = "\n\n") -> DataFrame:
    """B8 measures of the concatenated text per group without building it:
    documents, characters of the joined text (separators included) and an
    order-insensitive content fingerprint (sum of 32-bit md5 prefixes)."""
    fp = F.conv(F.substring(F.md5("text"), 1, 8), 16, 10).cast("long")
    g = c.groupBy(by).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.char_length("text")).alias("_c"),
                          F.sum(fp).alias("fingerprint"))
    return g.select(by, "n_docs", (F.col("_c") + (F.col("n_docs") - 1) * len(sep)).alias("n_chars"), "fingerprint")


def concat_group_texts(c: DataFrame, by: str, sep: str = "\n\n", order: str = "doc_id",
                       max_docs: int = 10_000) -> DataFrame:
    """B8 as one string per group, for groups known to be small: the largest
    group is checked against ``max_docs`` first."""
    biggest = c.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    if biggest > max_docs:
        raise ValueError(f"a group holds {biggest} documents (> {max_docs}); use group_texts (long form)")
    g = c.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("text").alias("t")))).alias("_p"))
    return g.select(by, F.array_join(F.transform("_p", lambda s: s["t"]), sep).alias("text"))


def tokens_over_time(c: DataFrame, date_col: str) -> DataFrame:
    """Documents, tokens (punctuation kept) and mean tokens per document by calendar year."""
    per = c.select(F.year(F.col(date_col)).alias("year"),
                   F.regexp_count(F.col("text"), F.lit(T.token_pattern(True, False))).alias("tokens"))
    return per.groupBy("year").agg(F.count(F.lit(1)).alias("n_docs"),
                                   F.sum("tokens").alias("tokens"),
                                   F.avg("tokens").alias("mean_tokens"))


def reshape_units(c: DataFrame, to: str = "sentences") -> DataFrame:
    """Re-cut the unit of analysis; docvars are carried along.

    ``sentences`` and ``paragraphs`` give ``(doc_id, unit, text, …)``.
    """
    rest = [x for x in c.columns if x not in ("doc_id", "text")]
    if to == "sentences":
        parts = F.transform(F.regexp_extract_all(F.col("text"), F.lit(T.SENTENCE), 0), lambda x: F.trim(x))
    elif to == "paragraphs":
        parts = F.filter(F.transform(F.split(F.col("text"), r"\n\s*\n|\n"), lambda x: F.trim(x)), lambda x: x != "")
    else:
        raise ValueError("to must be 'sentences' or 'paragraphs' (use group_texts for groups)")
    ex = c.select("doc_id", *rest, F.posexplode(parts).alias("unit", "text"))
    return ex.withColumn("unit", (F.col("unit") + 1).cast("int"))
