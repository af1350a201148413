"""Golden values for the column functions (vectors, strings)."""

import math

import pytest
from pyspark.sql import functions as F

from quire.functions import (angle_deg, cosine, euclidean, is_retweet, n_chars, str_count, str_locate,
                             str_remove, str_sub, strip_prefix, strip_suffix, to_title, vec_add, vec_sub)


def _one(spark, **cols):
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} array<double>" for k in cols))


@pytest.mark.parametrize("a,b,expected", [
    ([1, 2, 3], [1, 2, 3], 1.0), ([1, 2, 3], [-1, -2, -3], -1.0), ([1, 2, 3, 0], [0, 0, 0, 1], 0.0)])
def test_cosine_golden(spark, a, b, expected):
    df = _one(spark, a=[float(x) for x in a], b=[float(x) for x in b])
    assert df.select(cosine("a", "b")).first()[0] == pytest.approx(expected)


def test_euclidean_golden(spark):
    df = _one(spark, a=[0.0, 2.51, 3.6, 0.0], b=[0.0, 2.3, 3.1, 9.2])
    assert df.select(euclidean("a", "b")).first()[0] == pytest.approx(math.sqrt(84.9341), abs=1e-9)
    df2 = _one(spark, a=[1.0, 2.0, 3.0], b=[1.0, 2.0, 3.0])
    assert df2.select(euclidean("a", "b")).first()[0] == 0.0


def test_angles_golden(spark):
    df = spark.createDataFrame([([3.0, 3.0], [6.0, 0.0], [12.0, 12.0])], "a array<double>, b array<double>, c array<double>")
    r = df.select(angle_deg("a", "b"), angle_deg("b", "b"), angle_deg("b", "c"), cosine("a", "c")).first()
    assert r[0] == pytest.approx(45.0)
    assert r[1] == pytest.approx(0.0, abs=1e-6)
    assert r[2] == pytest.approx(45.0)
    assert r[3] == pytest.approx(1.0)


def test_vector_arithmetic(spark):
    df = _one(spark, a=[1.0, 2.0], b=[0.5, 4.0])
    r = df.select(vec_add("a", "b"), vec_sub("a", "b")).first()
    assert r[0] == [1.5, 6.0] and r[1] == [0.5, -2.0]


def test_string_functions(spark):
    df = spark.createDataFrame([("RT the cat sat.",), ("no match here",), ("Senator Jane Doe.",)], "s string")
    rows = df.select(n_chars("s").alias("n"), str_count("s", "a").alias("c"), str_locate("s", "cat").alias("loc"),
                     str_sub("s", 1, 2).alias("sub"), str_sub("s", -4).alias("tail"), is_retweet("s").alias("rt"),
                     strip_suffix("s", ".").alias("nodot"), strip_prefix("s", "Senator ").alias("nopre"),
                     str_remove("s", "[aeiou]").alias("rm1"), to_title(F.lit("ABC_news test")).alias("t")).collect()
    a, b, c = rows
    assert a.n == 15 and a.c == 2 and (a.loc.start, a.loc.end) == (8, 10)
    assert b.loc.start is None and b.loc.end is None
    assert a.sub == "RT" and a.tail == "sat." and a.rt and not b.rt
    assert c.nodot == "Senator Jane Doe" and c.nopre == "Jane Doe."
    assert a.rm1 == "RT th cat sat."
    assert a.t == "Abc_news Test"
