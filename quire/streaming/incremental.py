"""Streaming documents through the same operators as batch.

The reference has no streaming operators; tokenising, dictionary lookup and
counting are stateless or plain aggregations, so they run unchanged on a
streaming DataFrame: a file source of document tables, token arrays built per
row, and a running ``groupBy`` whose state Spark checkpoints (so a restarted
query resumes without recounting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tokens as T

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stream_documents(spark: SparkSession, path: str, schema: str = DOC_SCHEMA,
                     max_files_per_trigger: int = 1) -> DataFrame:
    """A streaming DataFrame over a folder of document parquet files."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def running_term_counts(docs: DataFrame, by: str = "lang", stop=T.STOPWORDS_EN) -> DataFrame:
    """Running token counts per ``(by, term)`` (update/complete output mode)."""
    arr = T.filter_array(T.token_arrays(docs, keys=[by]), drop=stop)
    return arr.select(by, F.explode("toks").alias("term")).groupBy(by, "term").agg(F.count(F.lit(1)).alias("n"))


def dictionary_scores_stream(docs: DataFrame, positive: list[str], negative: list[str]) -> DataFrame:
    """Per-document positive/negative counts from fixed word lists (stateless:
    append mode)."""
    arr = T.token_arrays(docs, keys=["doc_id"])
    pos = F.size(F.filter("toks", lambda x: x.isin(positive)))
    neg = F.size(F.filter("toks", lambda x: x.isin(negative)))
    return arr.select("doc_id", pos.alias("positive"), neg.alias("negative"))
