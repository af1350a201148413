"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import cut_lineage, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the cluster's shared checkpoint folder and read
    back: later steps neither recompute it nor depend on a lost executor."""
    return cut_lineage(df, label)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner delete the shuffles of finished jobs to which no plan refers any more."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def ready(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ship_package(spark)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that clash with none of ``df``'s columns
    (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column: value i is bytes[offsets[i]:offsets[i+1]].
    Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes objects; nulls are empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of a partition that is sorted by ``keys`` (longs), cut at group
    borders: yields (table, starts) where every group is complete and
    ``starts`` holds each group's first row, then the number of rows."""
    kept: list[pa.RecordBatch] = []

    def borders(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        first, last = ([kept[i].column(k)[j].as_py() for k in keys] for i, j in ((0, 0), (-1, -1)))
        if first == last:
            continue  # one group goes on
        t = pa.Table.from_batches(kept).combine_chunks()
        starts = borders(t)
        cut = int(starts[-1])
        yield t.slice(0, cut), starts
        kept = t.slice(cut).to_batches()
    if kept:
        t = pa.Table.from_batches(kept).combine_chunks()
        yield t, np.append(borders(t), t.num_rows)


def with_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` after making the package importable in the workers."""
    ready(df.sparkSession)
    return df.mapInArrow(fn, schema)


def ddl(df: DataFrame, *more: str) -> str:
    """``df``'s schema as a DDL string, with more fields at its end."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*fields, *more])


def same(a, b):
    """Null-safe equality of two columns."""
    return F.col(a).eqNullSafe(F.col(b)) if isinstance(a, str) else a.eqNullSafe(b)
