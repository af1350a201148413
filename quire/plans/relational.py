"""Relational analyses on the star schema and ``events`` (A6, C*, D*, E*, F*, N6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources.files import with_row_id
from ..sources.tables import table
from .registry import register

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _t(spark, sf, name):
    return table(spark, sf, name)


# D1 + E1 + E4: customers per nation (nations without customers kept) and share
@register("nation_customer_share", """
SELECT n.n_name, count(c.c_custkey) AS n,
       round(count(c.c_custkey) / (SELECT count(*) FROM customer), 6) AS share
FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name""")
def nation_customer_share(spark, sf):
    nation, cust = _t(spark, sf, "nation"), _t(spark, sf, "customer")
    j = nation.join(cust, nation.n_nationkey == cust.c_nationkey, "left")
    g = j.groupBy("n_name").agg(F.count("c_custkey").alias("n"))
    total = cust.select(F.count(F.lit(1))).scalar()
    return g.withColumn("share", F.round(F.col("n") / total, 6))


# E5 + C7: segment × priority cross-tabulation, one column per priority
_PRI_COLS = ["p1_urgent", "p2_high", "p3_medium", "p4_not_specified", "p5_low"]


@register("segment_priority_crosstab", f"""
SELECT c.c_mktsegment,
       {', '.join(f"count(*) FILTER (WHERE o.o_orderpriority = '{p}') AS {c}" for p, c in zip(PRIORITIES, _PRI_COLS))}
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment""")
def segment_priority_crosstab(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_orderpriority")
    wide = R.crosstab(j, "c_mktsegment", "o_orderpriority", PRIORITIES)
    return wide.toDF("c_mktsegment", *_PRI_COLS)


# Measures per return flag, wide → long
@register("lineitem_measures_long", """
WITH m AS (SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty,
                  round(sum(l_extendedprice), 2) AS sum_price,
                  round(avg(l_discount), 6) AS avg_disc
           FROM lineitem GROUP BY l_returnflag)
UNPIVOT m ON sum_qty, sum_price, avg_disc INTO NAME measure VALUE value""")
def lineitem_measures_long(spark, sf):
    li = _t(spark, sf, "lineitem")
    m = li.groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
                                       F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
                                       F.round(F.avg("l_discount"), 6).alias("avg_disc"))
    return R.pivot_longer(m, ["l_returnflag"], ["sum_qty", "sum_price", "avg_disc"], "measure", "value")


# Parts never ordered; D4: customers that placed orders, per segment
@register("parts_never_ordered", """
SELECT p_brand, count(*) AS n FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)
GROUP BY p_brand""")
def parts_never_ordered(spark, sf):
    p, li = _t(spark, sf, "part"), _t(spark, sf, "lineitem")
    anti = R.complement(p, li.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return R.count_by(anti, "p_brand")


@register("segment_active_customers", """
SELECT c_mktsegment, count(*) AS n FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
GROUP BY c_mktsegment""")
def segment_active_customers(spark, sf):
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    semi = c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    return R.count_by(semi, "c_mktsegment")


# C15 + E3: yearly order measures
@register("orders_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
       round(sum(o_totalprice), 2) AS total, round(min(o_totalprice), 2) AS min_price,
       round(max(o_totalprice), 2) AS max_price, round(avg(o_totalprice), 4) AS mean_price
FROM orders GROUP BY 1""")
def orders_by_year(spark, sf):
    o = _t(spark, sf, "orders")
    return (o.groupBy(F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                 F.round(F.min("o_totalprice"), 2).alias("min_price"),
                 F.round(F.max("o_totalprice"), 2).alias("max_price"),
                 F.round(F.avg("o_totalprice"), 4).alias("mean_price")))


# top 3 parts by retail price per brand, ties kept
@register("top_parts_per_brand", """
SELECT p_brand, p_partkey, p_retailprice, rank FROM (
  SELECT p_brand, p_partkey, p_retailprice,
         CAST(rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS INTEGER) AS rank
  FROM part) WHERE rank <= 3""")
def top_parts_per_brand(spark, sf):
    p = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return R.top_n(p, "p_brand", "p_retailprice", 3)


# group mean kept on every row
@register("order_price_vs_priority_mean", """
SELECT o_orderkey, o_orderpriority,
       round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS diff_from_mean
FROM orders""")
def order_price_vs_priority_mean(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    j = R.group_value_on_rows(o, "o_orderpriority", "o_totalprice", F.avg, "_m")
    return j.select("o_orderkey", "o_orderpriority", F.round(F.col("o_totalprice") - F.col("_m"), 4).alias("diff_from_mean"))


# C15 + C7: events per day and type, wide
@register("events_daily_wide", f"""
SELECT CAST(ts AS DATE) AS day,
       {', '.join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES)}
FROM events GROUP BY 1""")
def events_daily_wide(spark, sf):
    e = _t(spark, sf, "events").select(F.to_date("ts").alias("day"), "event_type")
    return R.pivot_wider(R.count_by(e, "day", "event_type"), ["day"], "event_type", "n",
                         values=EVENT_TYPES, fill=0)


# JSON property parsed, averaged per type
@register("events_props_json", """
SELECT event_type, round(avg(CAST(json_extract(props, '$.k') AS INTEGER)), 6) AS mean_k,
       count(*) AS n, round(sum(value), 2) AS total_value
FROM events GROUP BY event_type""")
def events_props_json(spark, sf):
    e = _t(spark, sf, "events")
    k = F.from_json("props", "k INT")["k"]
    return e.groupBy("event_type").agg(F.round(F.avg(k), 6).alias("mean_k"), F.count(F.lit(1)).alias("n"),
                                       F.round(F.sum("value"), 2).alias("total_value"))


# F4 + F5: top 10 users by total value (ties broken by user id)
@register("top_users_by_value", """
SELECT user_id, round(sum(value), 2) AS total_value, count(*) AS n FROM events
GROUP BY user_id ORDER BY sum(value) DESC, user_id LIMIT 10""")
def top_users_by_value(spark, sf):
    e = _t(spark, sf, "events")
    g = e.groupBy("user_id").agg(F.sum("value").alias("_v"), F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("_v"), "user_id").limit(10).select("user_id", F.round("_v", 2).alias("total_value"), "n")


# seeded hash sample of documents; F7 by group; F8 sampled groups
@register("sample_documents", """
SELECT doc_id, lang, source FROM documents
ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))), doc_id LIMIT 25""")
def sample_documents(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    return R.sample_n(d, 25, "doc_id", seed=42)


@register("sample_per_lang", """
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
         ORDER BY md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR))), doc_id) AS r FROM documents)
WHERE r <= 5""")
def sample_per_lang(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    return R.sample_n(d, 5, "doc_id", seed=7, by="lang")


@register("sampled_sources_docs", """
WITH s AS (SELECT source FROM (SELECT DISTINCT source FROM documents)
           ORDER BY md5(concat_ws(':', '3', source)), source LIMIT 3)
SELECT source, count(*) AS n, sum(n_chars) AS chars FROM documents WHERE source IN (SELECT source FROM s)
GROUP BY source""")
def sampled_sources_docs(spark, sf):
    d = _t(spark, sf, "documents")
    s = R.sample_groups(d.select("source", "n_chars"), "source", 3, seed=3)
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


# C14: account balance rescaled to [-1, 1] with global min and max
@register("supplier_balance_rescaled", """
SELECT s_suppkey, round(-1 + (s_acctbal - (SELECT min(s_acctbal) FROM supplier)) * 2
       / ((SELECT max(s_acctbal) FROM supplier) - (SELECT min(s_acctbal) FROM supplier)), 6) AS score
FROM supplier""")
def supplier_balance_rescaled(spark, sf):
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    out = R.rescale(s, "s_acctbal", -1.0, 1.0, "score")
    return out.select("s_suppkey", F.round("score", 6).alias("score"))


# C1 + C9 + G8: united, title-cased location labels
@register("nation_labels", """
SELECT n_nationkey AS nation_key,
       concat_ws('_', lower(r.r_name), lower(n.n_name)) AS location,
       upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2)) AS title
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def nation_labels(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    j = j.select(F.col("n_nationkey").alias("nation_key"), F.lower("r_name").alias("r"), F.lower("n_name").alias("n"),
                 F.initcap("n_name").alias("title"))
    return R.unite(j, "location", ["r", "n"], "_").select("nation_key", "location", "title")


# Union by name with missing columns; D10: intersection
@register("parties_union", """
SELECT name, kind, count(*) AS n, count(segment) AS with_segment FROM (
  SELECT c_name AS name, 'customer' AS kind, c_mktsegment AS segment FROM customer
  UNION ALL BY NAME
  SELECT s_name AS name, 'supplier' AS kind FROM supplier) GROUP BY name, kind""")
def parties_union(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"),
                                         F.col("c_mktsegment").alias("segment"))
    s = _t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    u = R.bind_rows(c, s)
    return u.groupBy("name", "kind").agg(F.count(F.lit(1)).alias("n"), F.count("segment").alias("with_segment"))


@register("shared_nations", """
SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def shared_nations(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = _t(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return c.intersect(s)


# C11 + E7: each customer's order keys, ordered, as one string
@register("customer_order_lists", """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY o_orderkey) AS orders, count(*) AS n
FROM orders GROUP BY o_custkey""")
def customer_order_lists(spark, sf):
    """C11: all of each customer's orders, their keys collapsed in order."""
    top = _t(spark, sf, "orders").select("o_custkey", "o_orderkey")
    lists = R.collapse(top, "o_custkey", "o_orderkey", out="orders")
    return lists.join(R.count_by(top, "o_custkey"), "o_custkey")


# Right join; C4: case_when with unmatched → NULL; C6: drop_na
@register("nation_supplier_right", """
SELECT n.n_name, s.s_suppkey,
       CASE WHEN s.s_acctbal < 0 THEN 'negative' WHEN s.s_acctbal > 5000 THEN 'high' END AS band
FROM supplier s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def nation_supplier_right(spark, sf):
    s, n = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "right")
    band = R.case_when((F.col("s_acctbal") < 0, "negative"), (F.col("s_acctbal") > 5000, "high"))
    return j.select("n_name", "s_suppkey", band.alias("band"))


@register("part_size_classes", """
SELECT p_size_class, count(*) AS n, count(DISTINCT p_brand) AS brands FROM (
  SELECT p_brand, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' END AS p_size_class
  FROM part) WHERE p_size_class IS NOT NULL GROUP BY p_size_class""")
def part_size_classes(spark, sf):
    p = _t(spark, sf, "part")
    cls = R.case_when((F.col("p_size") <= 10, "small"), (F.col("p_size") <= 30, "medium"))
    x = p.select("p_brand", cls.alias("p_size_class")).na.drop(subset=["p_size_class"])
    return x.groupBy("p_size_class").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("brands"))


# Distinct rows
@register("distinct_segment_nation", """
SELECT DISTINCT c_mktsegment, c_nationkey FROM customer""")
def distinct_segment_nation(spark, sf):
    return _t(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


# A6 + F2: dense row ids in a total order
@register("order_row_ids", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_id FROM orders""")
def order_row_ids(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_row_id(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], "row_id").select("o_orderkey", "row_id")


# Top categories
@register("top_part_types", """
SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 3""")
def top_part_types(spark, sf):
    return R.top_categories(_t(spark, sf, "part"), "p_type", 3).withColumnRenamed("p_type", "p_type")


# The same aggregate across several columns
@register("lineitem_means_by_status", """
SELECT l_linestatus, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount,
       round(avg(l_tax), 6) AS l_tax FROM lineitem GROUP BY l_linestatus""")
def lineitem_means_by_status(spark, sf):
    li = _t(spark, sf, "lineitem")
    return R.across(li, ["l_linestatus"], ["l_quantity", "l_discount", "l_tax"], lambda c: F.round(F.avg(c), 6))


# Hash folds
@register("customer_folds", """
SELECT fold, count(*) AS n FROM (
  SELECT CAST((('0x' || substr(md5(concat_ws(':', '11', CAST(c_custkey AS VARCHAR))), 1, 8))::BIGINT) % 5 AS INTEGER) AS fold
  FROM customer) GROUP BY fold""")
def customer_folds(spark, sf):
    c = R.folds(_t(spark, sf, "customer"), 5, "c_custkey", seed=11)
    return R.count_by(c, "fold")


# Order of labels within a group
@register("brand_order_within_size", """
SELECT p_size, p_brand, row_number() OVER (PARTITION BY p_size ORDER BY n DESC, p_brand) AS "order", n FROM (
  SELECT p_size, p_brand, count(*) AS n FROM part GROUP BY p_size, p_brand)""")
def brand_order_within_size(spark, sf):
    g = R.count_by(_t(spark, sf, "part"), "p_size", "p_brand")
    return R.order_within(g, "p_size", "n", tie="p_brand")


# Q7 stand-in: Poisson regression of event counts (row check)
@register("event_count_model")
def event_count_model(spark, sf):
    """Q7: Poisson GLM of per-user, per-type event counts on the user's mean
    value and a purchase indicator (penalised); coefficients out."""
    from ..operators.scaling import sharing_model
    e = _t(spark, sf, "events")
    c = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                               F.avg("value").alias("mean_value"))
    c = c.withColumn("is_purchase", (F.col("event_type") == "purchase").cast("double"))
    m = sharing_model(c, "n", ["mean_value", "is_purchase"], reg=0.01)
    rows = [("intercept", float(m.intercept))] + [(k, float(v)) for k, v in zip(["mean_value", "is_purchase"], m.coefficients)]
    return spark.createDataFrame(rows, "term string, coef double").withColumn("coef", F.round("coef", 6))


# A1 / A3 / A4 / A5: the table written in a file format and read back by the readers
@register("conversations_csv_roundtrip", """
SELECT role, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars,
       CAST(sum(length(text) - length(replace(text, chr(10), ''))) AS BIGINT) AS newlines
FROM conversations GROUP BY role""")
def conversations_csv_roundtrip(spark, sf):
    """CSV with header: texts holding commas, quotes and newlines survive."""
    from ..session import scratch_path
    from ..sources.files import read_csv
    path = scratch_path(spark, "conv-csv")
    conv = _t(spark, sf, "conversations")
    conv.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').csv(path)
    back = read_csv(spark, path, schema="conv_id long, turn long, role string, text string")
    return back.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).cast("long").alias("chars"),
                                    F.sum(F.char_length("text") - F.char_length(F.regexp_replace("text", "\\n", ""))).cast("long").alias("newlines"))


@register("documents_json_roundtrip", """
SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang""")
def documents_json_roundtrip(spark, sf):
    """JSON lines written and read back naming the text field."""
    from ..session import scratch_path
    from ..sources.files import read_json, write_json
    path = scratch_path(spark, "docs-json")
    write_json(_t(spark, sf, "documents").select("doc_id", F.col("text").alias("body"), "lang"), path)
    back = read_json(spark, path, text_field="body",
                     schema=__import__("pyspark.sql.types", fromlist=["x"]).StructType.fromDDL("doc_id long, body string, lang string"))
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).cast("long").alias("chars"))


@register("vectors_text_roundtrip", """
SELECT label % 2 AS parity, count(*) AS n, round(sum(CAST(embedding[1] AS DOUBLE)), 4) AS sum_first,
       round(sum(CAST(embedding[64] AS DOUBLE)), 4) AS sum_last
FROM embeddings GROUP BY 1""")
def vectors_text_roundtrip(spark, sf):
    """Vectors written as 'word v1 … v64' text lines and read back (A4)."""
    from ..session import scratch_path
    from ..sources.files import read_vectors
    path = scratch_path(spark, "vec-txt")
    e = _t(spark, sf, "embeddings")
    line = F.concat_ws(" ", F.concat(F.lit("w"), F.col("vec_id").cast("string"), F.lit("_"), F.col("label").cast("string")),
                       F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    v = read_vectors(spark, path, 64)
    parity = (F.regexp_extract("term", "_([0-9]+)$", 1).cast("int") % 2).alias("parity")
    return v.groupBy(parity).agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.sum(F.col("vec")[0].cast("double")), 4).alias("sum_first"),
                                 F.round(F.sum(F.col("vec")[63].cast("double")), 4).alias("sum_last"))
