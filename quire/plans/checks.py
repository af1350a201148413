"""Queries for operators that no other analysis exercises: string parts, unit
reshaping, dfm selection, document vectors, file formats with damaged lines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import math as M
from ..functions import strings as S
from ..operators import comparisons as N
from ..operators import corpus as C
from ..operators import dfm as D
from ..operators import embeddings as E
from ..operators import lexicon as L
from ..operators import relational as R
from ..operators import textstats as TS
from ..operators import tokens as T
from ..sources.tables import table
from .descriptive import READ_BASE_SQL
from .registry import register
from .sqlparts import STOP_EN_SQL, WORD_SQL, tokens_cte


# --- G6 -------------------------------------------------------------------------------------
@register("locate_first_mail", """
SELECT doc_id, CAST(strpos(text, m) AS INTEGER) AS start_at, CAST(strpos(text, m) + length(m) - 1 AS INTEGER) AS end_at
FROM (SELECT doc_id, text, regexp_extract(text, 'mail[0-9]+') AS m FROM documents) WHERE m <> ''""")
def locate_first_mail(spark, sf):
    """First mail host in each document that names one: where it starts and ends."""
    found = table(spark, sf, "documents").select("doc_id", S.str_locate("text", "mail[0-9]+").alias("p"))
    return found.where("p.start is not null").select("doc_id", F.col("p.start").cast("int").alias("start_at"),
                                                     F.col("p.end").cast("int").alias("end_at"))


# --- G9, G12, G13 ---------------------------------------------------------------------------
@register("nation_name_parts", """
SELECT n_nationkey, substr(n_name, 2, 3) AS part, substr(n_name, greatest(length(n_name) - 2, 1), 3) AS last_three,
       regexp_replace(n_name, '[AO]', '') AS without_first, regexp_replace(n_name, '[AO]', '', 'g') AS without_all,
       trim('  ' || n_name || ' ') AS trimmed FROM nation""")
def nation_name_parts(spark, sf):
    """Substrings by position from either end, removal of the first and of all matches, trimming."""
    return table(spark, sf, "nation").select(
        "n_nationkey", S.str_sub("n_name", 2, 4).alias("part"), S.str_sub("n_name", -3).alias("last_three"),
        S.str_remove("n_name", "[AO]").alias("without_first"), S.str_remove_all("n_name", "[AO]").alias("without_all"),
        S.str_trim(F.concat(F.lit("  "), "n_name", F.lit(" "))).alias("trimmed"))


@register("part_type_words", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS word FROM part) GROUP BY word""")
def part_type_words(spark, sf):
    """How often each blank-separated word occurs in part types."""
    words = table(spark, sf, "part").select(S.str_split("p_type", " ").alias("word"))
    return R.count_by(R.unnest(words, "word"), "word")


# --- G15 ------------------------------------------------------------------------------------
@register("retweet_share_by_role", """
SELECT role, sum(CASE WHEN lower(substr(t, 1, 3)) = 'rt ' THEN 1 ELSE 0 END)::BIGINT AS n_retweets, count(*) AS n
FROM (SELECT role, CASE WHEN turn % 2 = 0 THEN 'RT ' || text ELSE text END AS t FROM conversations) GROUP BY role""")
def retweet_share_by_role(spark, sf):
    """Turns marked as passed on (every other turn gets the mark here)."""
    marked = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("RT "), "text")).otherwise(F.col("text"))
    t = table(spark, sf, "conversations").select("role", S.is_retweet(marked).cast("int").alias("r"))
    return t.groupBy("role").agg(F.sum("r").alias("n_retweets"), F.count(F.lit(1)).alias("n"))


# --- H5, H6 ---------------------------------------------------------------------------------
@register("angles_to_first_vector", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
q AS (SELECT v AS q FROM e ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(degrees(acos(least(greatest(list_inner_product(v, q) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(q, q))), -1), 1))), 4) AS angle
FROM e, q""")
def angles_to_first_vector(spark, sf):
    """Angle in degrees between every vector and the first one."""
    e = table(spark, sf, "embeddings")
    first = e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("q"))
    return e.join(first).select("vec_id", F.round(M.angle_deg("embedding", "q"), 4).alias("angle"))


@register("orders_per_customer_filled", """
SELECT c_custkey, coalesce(n, 0) AS n_orders, coalesce(s, 0.0) AS total
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def orders_per_customer_filled(spark, sf):
    """Customers with their number of orders, zero where there is none."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("s"))
    c = table(spark, sf, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n_orders"), M.na_to("s", 0.0).alias("total"))


# --- C10, D7, D3 / D9 -----------------------------------------------------------------------
@register("turns_nested_and_unnested", """
SELECT conv_id, turn, role, length(text) AS chars FROM conversations""")
def turns_nested_and_unnested(spark, sf):
    """Turns gathered per conversation as structs and taken apart again."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.char_length("text").cast("long").alias("chars"))
    nested = t.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "chars")).alias("turns"))
    return R.unnest(nested, "turns")


@register("customer_columns_bound", """
SELECT c_custkey, c_name, c_acctbal FROM customer""")
def customer_columns_bound(spark, sf):
    """Two column sets of one table bound by key."""
    c = table(spark, sf, "customer")
    return R.bind_cols(c.select("c_custkey", "c_name"), c.select("c_custkey", "c_acctbal"), "c_custkey")


@register("parts_not_in_large_lines", """
SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)""")
def parts_not_in_large_lines(spark, sf):
    """Parts that no line of 45 or more names (anti-join with rows left)."""
    large = table(spark, sf, "lineitem").where("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return R.complement(table(spark, sf, "part").select("p_partkey", "p_brand"), large, "p_partkey")


# --- B4, B6, B7, B8 -------------------------------------------------------------------------
@register("long_german_texts", """
SELECT doc_id, length(text) AS text_length, md5(text) AS text_md5 FROM documents WHERE lang = 'de' AND length(text) > 2000""")
def long_german_texts(spark, sf):
    """Length as a document variable, a subset by it, and the texts alone."""
    c = C.corpus_subset(C.add_length(C.corpus(table(spark, sf, "documents"))), (F.col("lang") == "de") & (F.col("text_length") > 2000))
    return C.texts(c).join(c.select("doc_id", F.col("text_length").cast("long")), "doc_id").select(
        "doc_id", "text_length", F.md5("text").alias("text_md5"))


@register("conversation_texts_in_order", """
SELECT conv_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5 FROM conversations GROUP BY conv_id""")
def conversation_texts_in_order(spark, sf):
    """Each conversation as one text, its turns in order."""
    g = C.concat_group_texts(table(spark, sf, "conversations"), "conv_id", order="turn")
    return g.select("conv_id", F.md5("text").alias("text_md5"))


# --- I6, I11 --------------------------------------------------------------------------------
@register("word_tokens_by_lang", f"""
WITH {tokens_cte('documents', keys='doc_id, lang')}
SELECT lang, count(*) AS n FROM tok WHERE NOT regexp_matches(term, '^[0-9]+$') GROUP BY lang""")
def word_tokens_by_lang(spark, sf):
    """Tokens per language without punctuation, symbols and numbers (each class removed by its flag)."""
    t = T.tokens(table(spark, sf, "documents"), keys=["doc_id", "lang"], lower=True, remove_punct=True,
                 remove_symbols=True, remove_numbers=True)
    return t.where(F.col("term").rlike(rf"^(?:{T.WORD})$") & ~F.col("term").rlike("^[0-9]+$")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"))


LEMMAS = [("the", "DET"), ("der", "DET"), ("die", "DET"), ("le", "DET"), ("la", "DET"), ("is", "be"), ("are", "be"), ("was", "be")]


@register("lemma_counts", f"""
WITH {tokens_cte('documents')},
lem(term, lemma) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in LEMMAS)})
SELECT coalesce(lemma, term) AS lemma, count(*) AS n FROM tok LEFT JOIN lem USING (term) WHERE coalesce(lemma, term) IN ('DET', 'be') GROUP BY 1""")
def lemma_counts(spark, sf):
    """Tokens replaced by their lemma from a user table; how often each lemma occurs."""
    t = T.unnest_tokens(table(spark, sf, "documents").select("doc_id", "text"))
    lemmas = spark.createDataFrame(LEMMAS, "term string, lemma string")
    out = T.lemmatize(t, lemmas)
    return R.count_by(out.where(F.col("term").isin("DET", "be")).select(F.col("term").alias("lemma")), "lemma")


# --- J2, J6, J8, J10, J11 -------------------------------------------------------------------
@register("top_features_all", f"""
WITH {tokens_cte('documents')}
SELECT term, count(*) AS n FROM tok GROUP BY term ORDER BY n DESC, term LIMIT 25""")
def top_features_all(spark, sf):
    """The 25 most frequent features of all documents."""
    return D.topfeatures(D.dfm_from_arrays(T.token_arrays(table(spark, sf, "documents").select("doc_id", "text"))), 25)


@register("matched_feature_shares", f"""
WITH {tokens_cte("documents")},
d AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE term NOT IN ('the', 'of') GROUP BY 1, 2),
v AS (SELECT DISTINCT term FROM {"(SELECT unnest(regexp_extract_all(lower(text), '" + WORD_SQL + "')) AS term FROM benchmark)"}),
m AS (SELECT d.* FROM d JOIN v USING (term))
SELECT (SELECT count(DISTINCT doc_id) FROM m) AS n_docs, (SELECT sum(n)::BIGINT FROM m) AS n_tokens,
  (SELECT round(sum(w), 6) FROM (SELECT n / sum(n) OVER (PARTITION BY doc_id) AS w, term FROM m) WHERE term = 'and') AS share_of_and""")
def matched_feature_shares(spark, sf):
    """Features removed, the rest matched to the benchmark's vocabulary, documents without features
    dropped, counts as shares of their document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    d = D.dfm_remove(D.dfm_from_arrays(T.token_arrays(docs)), ["the", "of"])
    vocab = T.unnest_tokens(table(spark, sf, "benchmark").select("item_id", "text"), keys=["item_id"]).select("term")
    m = D.dfm_match(d, vocab)
    left = D.drop_empty(docs, m)
    w = D.dfm_weight_prop(m)
    one = left.agg(F.count(F.lit(1)).alias("n_docs")).join(w.agg(
        F.sum("n").alias("n_tokens"), F.round(F.sum(F.when(F.col("term") == "and", F.col("w"))), 6).alias("share_of_and")))
    return one


@register("stemmed_feature_count", f"""
WITH {tokens_cte('documents')}
SELECT regexp_replace(term, '(ing|ed|s)$', '') AS term, count(*) AS n FROM tok WHERE term IN ('this', 'thing', 'ting', 'ed', 'is', 'as') GROUP BY 1""")
def stemmed_feature_count(spark, sf):
    """A dfm whose features are replaced by stems from a table, and merged."""
    words = ["this", "thing", "ting", "ed", "is", "as"]
    d = D.dfm_from_arrays(T.token_arrays(table(spark, sf, "documents").select("doc_id", "text"))).where(F.col("term").isin(words))
    stems = d.select("term").distinct().withColumn("stem", F.regexp_replace("term", "(ing|ed|s)$", ""))
    return D.dfm_stem(d, stems).groupBy("term").agg(F.sum("n").alias("n"))


# --- J12 ------------------------------------------------------------------------------------
@register("vocabulary_index", f"""
WITH {tokens_cte('documents')},
s AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf FROM tok GROUP BY term)
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, tf FROM s""")
def vocabulary_index(spark, sf):
    """The whole vocabulary with a dense index in term order and its frequencies."""
    return D.vocabulary(D.dfm_from_arrays(T.token_arrays(table(spark, sf, "documents").select("doc_id", "text")))).select(
        "term", "idx", "df", "tf")


# --- K13, K21 -------------------------------------------------------------------------------
@register("grouped_document_vectors", """
SELECT vec_id % 7 AS doc_id, count(*) AS n_vectors, round(avg(embedding[1]::DOUBLE), 6) AS d1, round(avg(embedding[64]::DOUBLE), 6) AS d64
FROM embeddings GROUP BY 1""")
def grouped_document_vectors(spark, sf):
    """Documents as the mean of the vectors of their distinct words (here: ids)."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("term"), F.col("embedding").alias("vec"), "vec_id")
    words = e.select((F.col("vec_id") % 7).alias("doc_id"), "term")
    v = E.doc_vectors(words.union(words), e.select("term", "vec"))
    return v.select("doc_id", "n_vectors", F.round(F.col("vec")[0], 6).alias("d1"), F.round(F.col("vec")[63], 6).alias("d64"))


@register("vector_plot_table", """
SELECT CAST(vec_id AS VARCHAR) AS term, embedding[1]::DOUBLE AS dim1, embedding[2]::DOUBLE AS dim2 FROM embeddings WHERE vec_id BETWEEN 50 AND 99""")
def vector_plot_table(spark, sf):
    """Coordinates of a range of vectors for a plot."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("term"), "vec_id", F.col("embedding").alias("vec"))
    return E.plot_table(e, 50, 99, key="vec_id").select("term", *[F.col(c).cast("double").alias(c) for c in ("dim1", "dim2")])


# --- M12 ------------------------------------------------------------------------------------
@register("scored_turns", """
SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE length(text)::DOUBLE END AS score,
       CASE WHEN role = 'system' THEN 'ValueError: system text' END AS error FROM conversations""")
def scored_turns(spark, sf):
    """A user function scores texts in batches; rows on which it fails keep the error."""
    import pandas as pd

    def score(texts):
        if texts.str.startswith("!system ").any():
            raise ValueError("system text")
        return pd.DataFrame({"score": texts.str.len().astype(float)})

    t = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "system", F.concat(F.lit("!system "), "text")).otherwise(F.col("text")).alias("text"))
    return L.score_table(t, score, "text", "score double", keys=["conv_id", "turn"])


# --- A2, A5 ---------------------------------------------------------------------------------
@register("damaged_json_lines", """
SELECT CASE WHEN conv_id % 5 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n, sum(CASE WHEN conv_id % 5 = 0 THEN 0 ELSE length(text) END)::BIGINT AS chars
FROM conversations GROUP BY 1""")
def damaged_json_lines(spark, sf):
    """JSON lines, those of every fifth conversation cut short: good rows and damaged lines apart."""
    from pyspark.sql.types import StructType

    from ..session import scratch_path
    from ..sources.files import read_jsonl
    path = scratch_path(spark, "damaged-json")
    line = F.to_json(F.struct("conv_id", "text"))
    cut = F.when(F.col("conv_id") % 5 == 0, F.left(line, F.char_length(line) - 2)).otherwise(line)
    table(spark, sf, "conversations").select(cut.alias("value")).write.text(path)
    good, bad = read_jsonl(spark, path, StructType.fromDDL("conv_id long, text string"))
    return (good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars"))
            .unionByName(bad.agg(F.lit("bad").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("chars"))))


@register("saved_orders_by_status", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def saved_orders_by_status(spark, sf):
    """A table saved in parts by status and loaded again."""
    from ..session import scratch_path
    from ..sources.files import load_table, save_table
    path = scratch_path(spark, "saved-orders")
    save_table(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    return load_table(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# --- L10 ------------------------------------------------------------------------------------
@register("readability_familiar_words", f"""
WITH {READ_BASE_SQL},
h AS (SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '{WORD_SQL}'), lambda x: x NOT IN ({STOP_EN_SQL}))) AS n_hard FROM documents)
SELECT doc_id, round(141.8401 - 0.21459 * (n_letters * 100 / n_words) + 1.079812 * (n_sent * 100 / n_words), 6) AS coleman_liau_ecp,
       round(64 - 0.95 * (n_hard * 100 / n_words) - 0.69 * (n_words / n_sent), 6) AS dale_chall
FROM base JOIN h USING (doc_id)""")
def readability_familiar_words(spark, sf):
    """Coleman–Liau cloze percentage, and Dale–Chall with the stop words as the familiar ones."""
    r = TS.readability(table(spark, sf, "documents").select("doc_id", "text"), familiar=T.STOPWORDS_EN)
    return r.select("doc_id", *[F.round(c, 6).alias(c) for c in ("coleman_liau_ecp", "dale_chall")])


# --- N6 -------------------------------------------------------------------------------------
CSV_KEYS = 1000


@register("csv_answers_to_rows", """
SELECT s_nationkey AS nation, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS line,
       s_name AS name, CAST(s_suppkey AS VARCHAR) AS key FROM supplier""")
def csv_answers_to_rows(spark, sf):
    """Answers that hold a CSV text with a header, one row per line of it: an
    answer per nation and range of ``CSV_KEYS`` keys, so none grows with the table."""
    s = table(spark, sf, "supplier").withColumn("part", F.floor(F.col("s_suppkey") / CSV_KEYS))
    line = F.concat(F.lit('"'), "s_name", F.lit('" , '), F.col("s_suppkey").cast("string"))
    answers = s.groupBy(F.col("s_nationkey").alias("nation"), "part").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("l")))).alias("a"))
    text = F.concat(F.lit("name,key\n"), F.array_join(F.transform("a", lambda x: x["l"]), "\n"))
    rows = N.csv_answer_rows(answers.select("nation", "part", text.alias("answer")), "answer", ["name", "key"])
    earlier = Window.partitionBy("n").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(F.col("nation").alias("n"), F.col("part").alias("p")).agg(F.max("line").alias("lines"))
    before = sizes.select("n", "p", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    return (rows.join(before, F.col("nation").eqNullSafe(F.col("n")) & F.col("part").eqNullSafe(F.col("p")))
            .select("nation", (F.col("line") + F.col("before")).cast("int").alias("line"), "name", "key"))
