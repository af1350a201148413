"""Sparse matrices in blocks of rows, for models whose parameters are tables.

A model over a dfm (or an edge list) has parameters per row (document) and per column
(term). Here neither side is ever on the driver or broadcast: rows are dealt into
blocks of bounded size, each block is sent the parameters of just those columns that it
holds (a routing table is written once), and what the blocks add up
for a column is summed in blocks of columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.files import with_row_id

#: Non-zero cells of a block, about.
CELLS = 200_000


@dataclass
class Blocks:
    """``rows``: (block, key, js, cs, others...), one row per matrix row;
    ``routes``: (j, block), which block holds which columns; ``columns``:
    (term, j); ``size``: number of blocks."""

    key: str
    rows: DataFrame
    routes: DataFrame
    columns: DataFrame
    size: int
    n_columns: int

    def solve(self, params: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
        """fn(rows of a block, parameters of its columns) for each block.
        params: (j, ...), a row per column."""
        routed = self.routes.join(params, "j")
        return self.rows.groupBy("block").cogroup(routed.groupBy("block")).applyInPandas(fn, schema)

    def each(self, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
        """fn(rows of a block) for each block."""
        return self.rows.groupBy("block").applyInPandas(fn, schema)


def numbered(d: DataFrame, term: str = "term", label: str = "blocks") -> DataFrame:
    """(term, j): the distinct terms in order, from 0, as a stored table."""
    return cut_lineage(with_row_id(d.select(term).where(F.col(term).isNotNull()).distinct(), [F.col(term)], "j")
                       .withColumn("j", (F.col("j") - 1).cast("int")), f"{label}-columns")


def in_blocks(d: DataFrame, key: str, term: str = "term", value: str = "n", more: DataFrame | None = None,
              cells: int = CELLS, label: str = "blocks", columns: DataFrame | None = None) -> Blocks:
    """``d`` (key, term, value) in blocks; ``more``: further columns by key
    (rows without them have nulls). columns: the (term, j) to use, if they are known already."""
    spark = d.sparkSession
    columns = columns if columns is not None else numbered(d, term, label)
    coded = cut_lineage(d.join(columns, term).select(key, "j", F.col(value).cast("double").alias("c")), f"{label}-cells")
    cell_count, n_columns = coded.count(), columns.count()
    # enough blocks for the session's slots, unless they would be tiny
    size = max(1, -(-cell_count // cells), min(spark.sparkContext.defaultParallelism, cell_count // 5000))
    rows = (coded.groupBy(key).agg(F.collect_list(F.struct("j", "c")).alias("s"))
            .select(F.pmod(F.xxhash64(key), F.lit(size)).cast("int").alias("block"), key, F.array_sort("s").alias("s"))
            .select("block", key, F.col("s.j").alias("js"), F.col("s.c").alias("cs")))
    if more is not None:
        rows = rows.join(more, key, "left")
    rows = cut_lineage(rows, f"{label}-rows")
    routes = cut_lineage(rows.select("block", F.explode("js").alias("j")).distinct(), f"{label}-routes")
    return Blocks(key, rows, routes, columns, size, n_columns)


def flat(js, cs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a block's rows: (row number, local column, count, columns, row starts);
    ``columns`` are the distinct column numbers, in order."""
    sizes = np.array([len(x) for x in js], dtype=np.int64)
    every = np.concatenate([np.asarray(x, np.int64) for x in js]) if len(sizes) else np.zeros(0, np.int64)
    counts = np.concatenate([np.asarray(x, float) for x in cs]) if len(sizes) else np.zeros(0)
    columns, local = np.unique(every, return_inverse=True)
    return np.repeat(np.arange(len(sizes)), sizes), local, counts, columns, np.concatenate([[0], np.cumsum(sizes)])


def matrix(column) -> np.ndarray:
    """A pandas column of equally long arrays as a matrix."""
    return np.stack([np.asarray(x, float) for x in column]) if len(column) else np.zeros((0, 0))


def aligned(params: pd.DataFrame, columns: np.ndarray, field: str = "vec") -> np.ndarray:
    """The parameters of ``columns``, in that order."""
    order = np.argsort(params["j"].to_numpy(), kind="stable")
    return matrix(params[field].to_numpy()[order[np.searchsorted(params["j"].to_numpy()[order], columns)]])


def summed(parts: DataFrame, size: int, schema: str = "j int, vec array<double>",
           fn: Callable[[np.ndarray, np.ndarray], pd.DataFrame] | None = None) -> DataFrame:
    """Sums of the vectors ``vec`` by ``j``, in ``size`` blocks of columns. fn(columns, sums)
    may make something else of a block's sums."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        v = matrix(pdf["vec"])
        columns, local = np.unique(pdf["j"].to_numpy(), return_inverse=True)
        order = np.argsort(local, kind="stable")
        starts = np.searchsorted(local[order], np.arange(len(columns)))
        total = np.add.reduceat(v[order], starts, axis=0) if len(columns) else v
        return fn(columns, total) if fn else pd.DataFrame({"j": columns.astype("int32"), "vec": list(total)})

    return (parts.select("j", "vec").withColumn("part", F.pmod("j", F.lit(size)))
            .groupBy("part").applyInPandas(add, schema))


def total(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of vectors of fixed width, a row per block: first in a few
    tasks, then on the driver."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"vec": [matrix(pdf["vec"]).sum(axis=0)]})

    some = parts.select("j", "vec").withColumn("part", F.pmod("j", F.lit(16))).groupBy("part").applyInPandas(add, "vec array<double>")
    out = np.zeros(width)
    for r in some.collect():  # 16 rows
        out += np.asarray(r["vec"])
    return out
