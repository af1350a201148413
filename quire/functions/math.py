"""Math and vector scalars (H1–H6).

Vectors are ``ARRAY<FLOAT|DOUBLE>`` columns; all functions use higher-order
array expressions (``zip_with``/``aggregate``), evaluated in the JVM.
Ratios use ``try_divide`` and logs are guarded so NaN never appears.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["safe_div", "safe_log", "safe_log10", "dot", "norm", "cosine", "euclidean",
           "vec_add", "vec_sub", "vec_scale", "angle_deg", "na_to"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """H1: a / b, NULL when b is 0."""
    return F.try_divide(_c(a), _c(b))


def safe_log(x) -> Column:
    """H1: natural log, NULL for x <= 0 (R gives -Inf at 0)."""
    x = _c(x)
    return F.when(x > 0, F.ln(x))


def safe_log10(x) -> Column:
    """H1: base-10 log, NULL for x <= 0."""
    x = _c(x)
    return F.when(x > 0, F.log10(x))


def dot(a, b) -> Column:
    """H2: dot product of two equal-length arrays."""
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    """H2: Euclidean norm."""
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))


def cosine(a, b) -> Column:
    """H2: cosine similarity; NULL when a vector has norm 0."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a, b) -> Column:
    """H3: Euclidean distance of two vectors (the formula, on its arguments)."""
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def vec_add(a, b) -> Column:
    """H4: element-wise sum."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") + y.cast("double"))


def vec_sub(a, b) -> Column:
    """H4: element-wise difference."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double"))


def vec_scale(a, k) -> Column:
    """Multiply a vector by a scalar column or number."""
    k = k if isinstance(k, Column) else F.lit(float(k))
    return F.transform(_c(a), lambda x: x.cast("double") * k)


def angle_deg(a, b) -> Column:
    """H5: angle between two vectors in degrees (cosine clamped to [-1, 1])."""
    cos = F.least(F.greatest(cosine(a, b), F.lit(-1.0)), F.lit(1.0))
    return F.degrees(F.acos(cos))


def na_to(c, value=0) -> Column:
    """H6: replace NULL (and NaN for doubles) by ``value``."""
    c = _c(c)
    return F.when(c.isNull() | F.isnan(c), F.lit(value)).otherwise(c)
