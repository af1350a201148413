"""Relational helpers: ties, samples, row ids, rescale, pivots."""

from pyspark.sql import functions as F

from quire.operators import relational as R
from quire.sources.files import profile, with_row_id


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 5.0), ("g", 3, 4.0), ("h", 4, 1.0)], "grp string, id int, v double")
    got = sorted((r.grp, r.id) for r in R.top_n(df, "grp", "v", 1).collect())
    assert got == [("g", 1), ("g", 2), ("h", 4)]


def test_sample_is_deterministic_and_sized(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    a = [r.k for r in R.sample_n(df, 10, "k", seed=1).collect()]
    b = [r.k for r in R.sample_n(df.repartition(7), 10, "k", seed=1).collect()]
    assert len(a) == 10 and sorted(a) == sorted(b)
    g = R.sample_n(df.withColumn("g", F.col("k") % 3), 4, "k", by="g")
    assert sorted(r["count"] for r in g.groupBy("g").count().collect()) == [4, 4, 4]


def test_row_ids_dense_in_order(spark):
    df = spark.range(0, 50).withColumn("v", (F.col("id") * 7) % 50).repartition(5)
    rows = with_row_id(df, [F.desc("v")], "rid").orderBy("rid").collect()
    assert [r.rid for r in rows] == list(range(1, 51))
    assert [r.v for r in rows] == sorted((r.v for r in rows), reverse=True)


def test_rescale_and_share(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "id int, x double")
    r = [x.x_rescaled for x in R.rescale(df, "x").orderBy("id").collect()]
    assert r == [-1.0, 0.0, 1.0]
    s = [x.share for x in R.share(df.withColumnRenamed("x", "n"), "n").orderBy("id").collect()]
    assert abs(sum(s) - 1) < 1e-12


def test_pivots_and_collapse(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "id string, k string, v int")
    w = {r.id: (r.x, r.y) for r in R.pivot_wider(df, ["id"], "k", "v", ["x", "y"], fill=0).collect()}
    assert w == {"a": (1, 2), "b": (3, 0)}
    long = R.pivot_longer(spark.createDataFrame([("a", 1, 2)], "id string, x int, y int"), ["id"], ["x", "y"])
    assert sorted((r.name, r.value) for r in long.collect()) == [("x", 1), ("y", 2)]
    c = {r.id: r.k for r in R.collapse(df, "id", "k").collect()}
    assert c == {"a": "x, y", "b": "x"}


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, s string")
    p = {r.column: r for r in profile(df).collect()}
    assert p["s"].non_null == 1 and p["x"].max == "2" and p["x"].rows == 2
