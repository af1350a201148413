"""Relational helpers.

Most of these are one Spark call; the helpers fix semantics that differ from
Spark's defaults (ties kept in top-n, deterministic hash samples, exact-size
splits, scalar totals without cross joins).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import with_row_id


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- C: projections and reshaping ---------------------------------------------------

def clean_names(df: DataFrame) -> DataFrame:
    """Lower snake-case column names."""
    def fix(n):
        n = re.sub(r"[^0-9a-zA-Z]+", "_", n)
        n = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", n).lower().strip("_")
        return n or "x"
    return df.toDF(*[fix(c) for c in df.columns])


def case_when(*branches: tuple[Column, object], default=None) -> Column:
    """C4: first true branch wins; unmatched rows get ``default`` (NULL)."""
    expr = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def pivot_wider(df: DataFrame, id_cols: list[str], names_from: str, values_from: str,
                values: list | None = None, fill=None, agg: Callable = F.first) -> DataFrame:
    """Long → wide. Pass ``values`` (the new column names) to skip the
    extra distinct-values job and fix the column order."""
    g = df.groupBy(*id_cols)
    p = g.pivot(names_from, values) if values is not None else g.pivot(names_from)
    out = p.agg(agg(values_from))
    return out.na.fill(fill) if fill is not None else out


def pivot_longer(df: DataFrame, id_cols: list[str], cols: list[str], names_to: str = "name",
                 values_to: str = "value") -> DataFrame:
    """Wide → long (``unpivot``); the value columns must share a type."""
    return df.unpivot(id_cols, cols, names_to, values_to)


def unite(df: DataFrame, name: str, cols: list[str], sep: str = "_", remove: bool = True) -> DataFrame:
    """C9."""
    out = df.withColumn(name, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))
    return out.drop(*[c for c in cols if c != name]) if remove else out


def unnest(df: DataFrame, col: str, outer: bool = False) -> DataFrame:
    """One row per element; arrays of structs become columns."""
    from pyspark.sql.types import ArrayType, StructType
    dt = df.schema[col].dataType
    rest = [c for c in df.columns if c != col]
    if isinstance(dt, ArrayType) and isinstance(dt.elementType, StructType):
        return df.select(*rest, (F.inline_outer if outer else F.inline)(col))
    return df.select(*rest, (F.explode_outer if outer else F.explode)(col).alias(col))


def collapse(df: DataFrame, by: list[str] | str, col: str, order: str | None = None,
             sep: str = ", ", desc: bool = False, out: str | None = None) -> DataFrame:
    """C11: a group's values, ordered, joined into one string. Meant for
    bounded groups (top-n lists, labels); for open-ended groups keep the long
    form."""
    by = [by] if isinstance(by, str) else list(by)
    order = order or col
    key = F.col(order)
    s = F.struct((-key if desc else key).alias("o"), F.col(col).cast("string").alias("v"))
    g = df.groupBy(*by).agg(F.array_sort(F.collect_list(s)).alias("_l"))
    return g.select(*by, F.array_join(F.transform("_l", lambda x: x["v"]), sep).alias(out or col))


def across(df: DataFrame, by: list[str], cols: list[str], fn: Callable = F.avg,
           suffix: str = "") -> DataFrame:
    """The same aggregate over many columns."""
    return df.groupBy(*by).agg(*[fn(c).alias(c + suffix) for c in cols])


def order_within(df: DataFrame, by: list[str] | str, value: str, desc: bool = True,
                 tie: str | None = None, name: str = "order") -> DataFrame:
    """Display order of labels inside each group (1 = first)."""
    by = [by] if isinstance(by, str) else list(by)
    o = [F.col(value).desc() if desc else F.col(value).asc()] + ([F.col(tie).asc()] if tie else [])
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*o)))


def rescale(df: DataFrame, col: str, lo: float = -1.0, hi: float = 1.0, name: str | None = None) -> DataFrame:
    """C14: min-max rescale with the *global* min and max (two scalar subqueries)."""
    mn = df.select(F.min(col)).scalar()
    mx = df.select(F.max(col)).scalar()
    val = F.lit(lo) + (F.col(col) - mn) * F.lit(hi - lo) / F.try_divide(mx - mn, F.lit(1.0))
    return df.withColumn(name or col + "_rescaled", val)


# ---- D: joins and set operations -----------------------------------------------------

def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns as NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def bind_cols(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Column bind — by key, never by position."""
    return left.join(right, key, "inner")


def complement(all_ids: DataFrame, subset: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``all_ids`` whose key is not in ``subset``."""
    return all_ids.join(subset.select(key), key, "left_anti")


# ---- E: aggregation -----------------------------------------------------------------

def share(df: DataFrame, n: str = "n", name: str = "share") -> DataFrame:
    """N / sum(n) over the whole table (total as a scalar subquery)."""
    return df.withColumn(name, F.col(n) / df.select(F.sum(n)).scalar())


def share_within(df: DataFrame, by: list[str] | str, n: str = "n", name: str = "share") -> DataFrame:
    """E4 per group: totals by a partial aggregate joined back (a skewed group
    is split by AQE's skew join; a window would put it in one task)."""
    by = [by] if isinstance(by, str) else list(by)
    tot = df.groupBy(*by).agg(F.sum(n).alias("_tot"))
    return df.join(tot, by).withColumn(name, F.col(n) / F.col("_tot")).drop("_tot")


def group_value_on_rows(df: DataFrame, by: list[str] | str, value: str, fn=F.avg, name: str | None = None) -> DataFrame:
    """a group aggregate kept on every row, by aggregate + join (the group
    table is small and AQE broadcasts it; a window would send each group to
    one task)."""
    by = [by] if isinstance(by, str) else list(by)
    name = name or f"{value}_group"
    g = df.groupBy(*by).agg(fn(value).alias(name))
    return df.join(g, by)


def count_by(df: DataFrame, *by: str, name: str = "n") -> DataFrame:
    """E1."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """E5: counts of ``a`` × ``b`` as a wide table (0 where absent)."""
    g = df.groupBy(a)
    p = g.pivot(b, values) if values is not None else g.pivot(b)
    return p.count().na.fill(0)


def top_categories(df: DataFrame, col: str, k: int) -> DataFrame:
    """``k`` most frequent values (ties broken by value)."""
    return count_by(df, col).orderBy(F.desc("n"), F.asc(col)).limit(k)


def coverage_ratio(toks: DataFrame, classes: DataFrame, by: list[str], num: str, den: str,
                   term: str = "term", cls: str = "class") -> DataFrame:
    """Per unit, tokens of class ``num`` over tokens of class ``den``."""
    j = toks.join(classes.select(term, cls), term)
    g = j.groupBy(*by).agg(F.sum(F.when(F.col(cls) == num, 1).otherwise(0)).alias("n_num"),
                           F.sum(F.when(F.col(cls) == den, 1).otherwise(0)).alias("n_den"))
    return g.withColumn("ratio", F.try_divide(F.col("n_num"), F.col("n_den")))


# ---- F: windows, ordering, sampling ---------------------------------------------------

def top_n(df: DataFrame, by: list[str] | str | None, value: str | Column, n: int,
          desc: bool = True, name: str = "rank") -> DataFrame:
    """top ``n`` per group **with ties kept** (``rank() <= n``).

    Spark plans a partial ``WindowGroupLimit`` before the shuffle, so a hot
    group sends at most ``n`` rows (plus ties) per map partition.
    """
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    v = _c(value)
    w = Window.partitionBy(*by).orderBy(v.desc() if desc else v.asc()) if by else \
        Window.orderBy(v.desc() if desc else v.asc())
    return df.withColumn(name, F.rank().over(w)).filter(F.col(name) <= n)


def hash_key(cols: Iterable[str], seed: int) -> Column:
    """Deterministic pseudo-random order key, independent of partitioning:
    ``md5('<seed>:<key>…')`` as hex text (reproducible in any SQL engine)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def hash_bucket(cols: Iterable[str], seed: int) -> Column:
    """First 32 bits of :func:`hash_key` as a non-negative number."""
    return F.conv(F.substring(hash_key(cols, seed), 1, 8), 16, 10).cast("long")


def sample_n(df: DataFrame, n: int, key: list[str] | str, seed: int = 42,
             by: list[str] | str | None = None) -> DataFrame:
    """``n`` rows chosen by a seeded hash of ``key`` (per group with ``by``).

    Global: top-``n`` by hash (``TakeOrderedAndProject``, partial per
    partition). Per group: ``row_number`` on the hash with a partial group limit.
    """
    key = [key] if isinstance(key, str) else list(key)
    h = hash_key(key, seed)
    if by is None:
        return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(h, *key)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def sample_groups(df: DataFrame, group: str, n: int, seed: int = 42) -> DataFrame:
    """F8: sample ``n`` groups, then bring back all their rows (semi-join)."""
    chosen = sample_n(df.select(group).distinct(), n, group, seed)
    return df.join(chosen, group, "left_semi")


def split_exact(df: DataFrame, frac: float, key: list[str] | str, seed: int = 42,
                name: str = "split") -> DataFrame:
    """O1: exact-size train/test split: the first ``ceil(frac·n)`` rows in seeded
    hash order are ``train``. The dense rank comes from a range-partitioned
    sort (no single-partition window)."""
    key = [key] if isinstance(key, str) else list(key)
    n = df.select(F.count(F.lit(1))).scalar()
    ranked = with_row_id(df.withColumn("_h", hash_key(key, seed)), [F.col("_h"), *[F.col(k) for k in key]], "_rk")
    return ranked.withColumn(name, F.when(F.col("_rk") <= F.ceil(n * F.lit(frac)), "train").otherwise("test")).drop("_h", "_rk")


def folds(df: DataFrame, k: int, key: list[str] | str, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold 0..k-1 from a seeded hash of the key."""
    key = [key] if isinstance(key, str) else list(key)
    return df.withColumn(name, F.pmod(hash_bucket(key, seed), F.lit(k)).cast("int"))
