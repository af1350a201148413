"""Access to the driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of ``{sf_dir}/{name}.parquet``; projections and filters reach the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt over the session's slots, by ``keys`` where given, if its scan has
    fewer partitions than there are slots: a small file is one row group and so one
    task, however many slots wait. A larger table has partitions enough and is left
    where it is."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if slots < 2 or df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)


#: Bytes of a scan's files for each part that :func:`deal` makes, about.
PART = 8 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by their listing (nothing of their content is read); 0 without files."""
    files = df.inputFiles()
    if not files:
        return 0
    return df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0


def deal(df: DataFrame, *keys: str, part: int = PART) -> DataFrame:
    """``df`` dealt by ``keys``, before what is heavy and grows: counts, sums
    and joins by these keys then need no exchange of their own, and texts are smaller than
    their tokens. The parts grow in number with the files that are read, not in size: what a
    task counts, sorts or joins stays the same."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(slots, -(-stored_bytes(df) // part)), *keys)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, on all slots (see :func:`spread`)."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")
