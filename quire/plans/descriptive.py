"""Descriptive inference over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dfm as D
from ..operators import relational as R
from ..operators import textstats as S
from ..operators import tokens as T
from ..session import cut_lineage
from ..sources.tables import deal, documents, table
from .registry import register
from .sqlparts import STOP_EN_SQL, WORD_SQL, SENT_SQL, tokens_cte

_VOW = S.VOWELS


def _docs(spark, sf, *cols):
    return documents(spark, sf).select(*cols)


def _r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


# --- L7/L8 lexical diversity ---------------------------------------------------------------------
@register("lexdiv_docs", f"""
WITH {tokens_cte('documents')},
g AS (SELECT doc_id, count(*) AS ntoken, count(DISTINCT term) AS ntype FROM tok GROUP BY doc_id)
SELECT doc_id, ntoken, ntype, round(ntype / ntoken, 6) AS ttr, round(ntype / sqrt(ntoken), 6) AS guiraud,
       round(CASE WHEN ntoken > 1 THEN ln(ntype) / ln(ntoken) END, 6) AS summer
FROM g""")
def lexdiv_docs(spark, sf):
    d = D.dfm_from_arrays(T.token_arrays(_docs(spark, sf, "doc_id", "text")))
    L = S.lexdiv(d)
    return L.select("doc_id", "ntoken", "ntype", *_r6("ttr", "guiraud", "summer"))


@register("mattr_docs", f"""
WITH {tokens_cte('documents')},
t AS (SELECT doc_id, pos, coalesce(lag(pos) OVER (PARTITION BY doc_id, term ORDER BY pos), 0) AS q,
             max(pos) OVER (PARTITION BY doc_id) AS nn FROM tok),
c AS (SELECT doc_id, max(nn) AS ntoken, count(*) FILTER (WHERE q = 0) AS ntype,
             sum(greatest(least(pos, nn - 50 + 1) - greatest(q + 1, pos - 50 + 1) + 1, 0)) AS s FROM t GROUP BY doc_id)
SELECT doc_id, CAST(ntoken AS INTEGER) AS ntoken,
       round(CASE WHEN ntoken >= 50 THEN s / (50 * (ntoken - 50 + 1)) ELSE ntype / ntoken END, 6) AS mattr
FROM c""")
def mattr_docs(spark, sf):
    t = T.unnest_tokens(_docs(spark, sf, "doc_id", "text"))
    m = S.mattr(t, window=50)
    return m.select("doc_id", "ntoken", *_r6("mattr"))


# --- L10/L11 readability ------------------------------------------------------------------------------
_SYL = (f"list_transform(regexp_extract_all(lower(text), '{WORD_SQL}'), lambda x: greatest("
        f"len(regexp_extract_all(x, '{_VOW}')) - CASE WHEN regexp_matches(x, '[^l]e$') "
        f"AND len(regexp_extract_all(x, '{_VOW}')) > 1 THEN 1 ELSE 0 END, 1))")
READ_BASE_SQL = f"""
base AS (SELECT doc_id,
  CAST(len(regexp_extract_all(text, '{SENT_SQL}')) AS INTEGER) AS n_sent,
  CAST(len(regexp_extract_all(lower(text), '{WORD_SQL}')) AS INTEGER) AS n_words,
  CAST(coalesce(list_sum({_SYL}), 0) AS INTEGER) AS n_syl,
  CAST(len(list_filter({_SYL}, lambda x: x >= 3)) AS INTEGER) AS n_poly,
  CAST(coalesce(list_sum(list_transform(regexp_extract_all(lower(text), '{WORD_SQL}'),
       lambda x: len(regexp_extract_all(x, '\\p{{L}}')))), 0) AS INTEGER) AS n_letters
  FROM documents)"""


@register("readability_docs", f"""
WITH {READ_BASE_SQL}
SELECT doc_id, n_sent, n_words, n_syl, n_poly, n_letters,
  round(206.835 - 1.015 * (n_words / n_sent) - 84.6 * (n_syl / n_words), 6) AS flesch,
  round(0.39 * (n_words / n_sent) + 11.8 * (n_syl / n_words) - 15.59, 6) AS fk_grade,
  round(0.0588 * (n_letters * 100 / n_words) - 0.296 * (n_sent * 100 / n_words) - 15.8, 6) AS coleman_liau,
  round(1.043 * sqrt(n_poly * 30 / n_sent) + 3.1291, 6) AS smog
FROM base""")
def readability_docs(spark, sf):
    r = S.readability(_docs(spark, sf, "doc_id", "text"))
    return r.select("doc_id", "n_sent", "n_words", "n_syl", "n_poly", "n_letters",
                    *_r6("flesch", "fk_grade", "coleman_liau", "smog"))


# --- L9 / F1 / C5: mean TTR by year kept on rows, then distinct -------------------------------------------
@register("ttr_by_year", f"""
WITH {tokens_cte('documents')},
g AS (SELECT doc_id, count(DISTINCT term) / count(*) AS ttr FROM tok GROUP BY doc_id)
SELECT DISTINCT CAST(year(DATE '2000-01-01' + CAST(doc_id AS INTEGER)) AS INTEGER) AS year,
       round(avg(ttr) OVER (PARTITION BY year(DATE '2000-01-01' + CAST(doc_id AS INTEGER))), 6) AS mean_ttr
FROM g""")
def ttr_by_year(spark, sf):
    from pyspark.sql import Window
    d = D.dfm_from_arrays(T.token_arrays(_docs(spark, sf, "doc_id", "text")))
    L = S.lexdiv(d).withColumn("year", F.year(F.date_add(F.lit("2000-01-01").cast("date"), F.col("doc_id").cast("int"))))
    on_rows = R.group_value_on_rows(L, "year", "ttr", F.avg, "mean_ttr")
    return on_rows.select("year", F.round("mean_ttr", 6).alias("mean_ttr")).distinct()


# --- L12: mean readability per year, long form ---------------------------------------------------------------
@register("readability_by_year_long", f"""
WITH {READ_BASE_SQL},
m AS (SELECT CAST(year(DATE '2000-01-01' + CAST(doc_id AS INTEGER)) AS INTEGER) AS year,
        round(avg(206.835 - 1.015 * (n_words / n_sent) - 84.6 * (n_syl / n_words)), 6) AS flesch,
        round(avg(0.39 * (n_words / n_sent) + 11.8 * (n_syl / n_words) - 15.59), 6) AS fk_grade
      FROM base GROUP BY 1)
UNPIVOT m ON flesch, fk_grade INTO NAME measure VALUE value""")
def readability_by_year_long(spark, sf):
    r = S.readability(_docs(spark, sf, "doc_id", "text"))
    r = r.withColumn("year", F.year(F.date_add(F.lit("2000-01-01").cast("date"), F.col("doc_id").cast("int"))))
    m = r.groupBy("year").agg(F.round(F.avg("flesch"), 6).alias("flesch"), F.round(F.avg("fk_grade"), 6).alias("fk_grade"))
    return R.pivot_longer(m, ["year"], ["flesch", "fk_grade"], "measure", "value")


# --- L1 / L4 / F6: similarity of every English document to one document ---------------------------------------
_EN_TFIDF_SQL = f"""
docs AS (SELECT doc_id, source, text FROM documents WHERE lang = 'en'),
{tokens_cte('docs')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE term NOT IN ({STOP_EN_SQL}) GROUP BY doc_id, term),
nd AS (SELECT count(*) AS nd FROM docs),
dfreq AS (SELECT term, count(*) AS df FROM dfm GROUP BY term),
keep AS (SELECT term, df FROM dfreq, nd WHERE df / nd >= 0.05 AND df / nd <= 0.95),
trimmed AS (SELECT d.doc_id, d.term, d.n FROM dfm d JOIN keep USING (term)),
w AS (SELECT t.doc_id, t.term, t.n / sum(t.n) OVER (PARTITION BY t.doc_id) * log10(nd / k.df) AS w
      FROM trimmed t JOIN keep k USING (term), nd)"""

_SIM_SQL = f"""
WITH {_EN_TFIDF_SQL},
q AS (SELECT min(doc_id) AS qid FROM docs),
qv AS (SELECT term, w AS wq FROM w WHERE doc_id = (SELECT qid FROM q)),
dots AS (SELECT doc_id, sum(w * wq) AS dot FROM w JOIN qv USING (term) GROUP BY doc_id),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
sim AS (SELECT n.doc_id, coalesce(dots.dot, 0) / (n.nrm * (SELECT nrm FROM norms WHERE doc_id = (SELECT qid FROM q))) AS cosine
        FROM norms n LEFT JOIN dots USING (doc_id))"""


def _en_tfidf(spark, sf):
    docs = table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "source", "text")
    arr = T.filter_array(T.token_arrays(deal(docs, "doc_id")), drop=T.STOPWORDS_EN)
    n_docs = docs.select(F.count(F.lit(1)))
    trimmed, kept = D.trim_arrays(arr, n_docs, 0.05, 0.95)
    if trimmed is None:
        w = D.dfm_tfidf(D.dfm_match(D.dfm_from_arrays(arr, deal=False), kept), n_docs=n_docs, stats=kept)
    else:
        w = D.tfidf_from_arrays(trimmed, n_docs, kept)
    # the weighted table feeds norms, query vectors and dot products
    return docs, cut_lineage(w, "tfidf-en")


def _first_en(docs):
    # one bounded value (an id) comes back to the driver to name the query document
    return docs.agg(F.min("doc_id")).first()[0]


@register("similarity_to_first_en", _SIM_SQL + "\nSELECT doc_id, round(cosine, 6) AS cosine FROM sim")
def similarity_to_first_en(spark, sf):
    docs, w = _en_tfidf(spark, sf)
    q = _first_en(docs)
    sim = S.similarity_to(w, [q])
    return sim.select("doc_id", F.round("cosine", 6).alias("cosine"))


@register("nearest_to_first_en", _SIM_SQL + """
SELECT doc_id, cosine, CAST(rank AS INTEGER) AS rank FROM (
  SELECT doc_id, round(cosine, 9) AS cosine, row_number() OVER (ORDER BY round(cosine, 9) DESC, doc_id) AS rank
  FROM sim WHERE doc_id <> (SELECT qid FROM q)) WHERE rank <= 20""")
def nearest_to_first_en(spark, sf):
    docs, w = _en_tfidf(spark, sf)
    q = _first_en(docs)
    sim = S.similarity_to(w, [q]).withColumn("cosine", F.round("cosine", 9))
    return S.nearest(sim, q, k=20).select("doc_id", "cosine", "rank")


# --- E8 + L1–L3: distances between sources over the grouped dfm -------------------------------------------------
@register("source_distances", f"""
WITH {tokens_cte('documents', keys='doc_id, source')},
g AS (SELECT source, term, CAST(count(*) AS DOUBLE) AS n FROM tok GROUP BY source, term),
tot AS (SELECT source, sum(abs(n)) AS l1, sum(n * n) AS l2, sum(n * n * n) AS l3, count(*) AS nnz FROM g GROUP BY source),
sh AS (SELECT a.source AS sa, b.source AS sb, sum(a.n * b.n) AS dot, sum(least(a.n, b.n)) AS mins,
              count(*) AS shared, sum(abs(a.n - b.n) / (a.n + b.n)) AS canb,
              sum(pow(abs(a.n - b.n), 3) - pow(a.n, 3) - pow(b.n, 3)) AS mink
       FROM g a JOIN g b USING (term) GROUP BY 1, 2),
pairs AS (SELECT a.source AS sa, b.source AS sb FROM tot a, tot b)
SELECT p.sa AS source_a, p.sb AS source_b,
  round(coalesce(dot, 0) / sqrt(ta.l2 * tb.l2), 6) AS cosine,
  round(CASE WHEN p.sa = p.sb THEN 0 ELSE sqrt(greatest(ta.l2 + tb.l2 - 2 * coalesce(dot, 0), 0)) END, 6) AS euclidean,
  round(ta.l1 + tb.l1 - 2 * coalesce(mins, 0), 6) AS manhattan,
  round(CASE WHEN p.sa = p.sb THEN 0 ELSE pow(greatest(ta.l3 + tb.l3 + coalesce(mink, 0), 0), 1.0 / 3) END, 4) AS minkowski,
  round(coalesce(canb, 0) + (ta.nnz + tb.nnz - 2 * coalesce(shared, 0)), 6) AS canberra,
  round(coalesce(shared, 0) / (ta.nnz + tb.nnz - coalesce(shared, 0)), 6) AS jaccard
FROM pairs p JOIN tot ta ON ta.source = p.sa JOIN tot tb ON tb.source = p.sb
LEFT JOIN sh ON sh.sa = p.sa AND sh.sb = p.sb""")
def source_distances(spark, sf):
    arrays = T.token_arrays(_docs(spark, sf, "doc_id", "source", "text"), keys=["source"])
    # counted by source at once: combined in each task, no document is counted by itself
    g = D.dfm(arrays.select("source", F.explode("toks").alias("term")), ["source"])
    out = S.group_distances(g, "source", value="n")
    return out.select("source_a", "source_b", *_r6("cosine", "euclidean", "manhattan", "canberra", "jaccard"),
                      F.round("minkowski", 4).alias("minkowski"))


# --- L5: similarity grid of a seeded sample of documents ------------------------------------------------------------
@register("sample_similarity_grid", f"""
WITH {_EN_TFIDF_SQL},
s AS (SELECT doc_id FROM docs ORDER BY md5(concat_ws(':', '5', CAST(doc_id AS VARCHAR))), doc_id LIMIT 20),
ws AS (SELECT * FROM w WHERE doc_id IN (SELECT doc_id FROM s)),
norms AS (SELECT doc_id, sum(w * w) AS l2 FROM ws GROUP BY doc_id),
sh AS (SELECT a.doc_id AS da, b.doc_id AS db, sum(a.w * b.w) AS dot FROM ws a JOIN ws b USING (term) GROUP BY 1, 2)
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b, round(coalesce(dot, 0) / sqrt(a.l2 * b.l2), 6) AS cosine
FROM norms a, norms b LEFT JOIN sh ON sh.da = a.doc_id AND sh.db = b.doc_id""")
def sample_similarity_grid(spark, sf):
    docs, w = _en_tfidf(spark, sf)
    s = R.sample_n(docs.select("doc_id"), 20, "doc_id", seed=5)
    ws = w.join(s, "doc_id", "left_semi")
    out = S.group_distances(ws, "doc_id", value="w")
    return out.select("doc_id_a", "doc_id_b", F.round("cosine", 6).alias("cosine"))


# --- L13: sophistication score from given coefficients ----------------------------------------------------------------
# Fixed demo coefficients: easiness falls with words per sentence and syllables per word.
SOPHISTICATION = {"intercept": 0.5, "words_per_sentence": -0.05, "syllables_per_word": -0.8}


@register("sophistication_scores", f"""
WITH {READ_BASE_SQL}
SELECT doc_id, round({SOPHISTICATION['intercept']} + ({SOPHISTICATION['words_per_sentence']}) * (n_words / n_sent)
       + ({SOPHISTICATION['syllables_per_word']}) * (n_syl / n_words), 6) AS score FROM base""")
def sophistication_scores(spark, sf):
    r = S.readability(_docs(spark, sf, "doc_id", "text"))
    f = r.select("doc_id", (F.col("n_words") / F.col("n_sent")).alias("words_per_sentence"),
                 (F.col("n_syl") / F.col("n_words")).alias("syllables_per_word"))
    coefs = {k: v for k, v in SOPHISTICATION.items() if k != "intercept"}
    p = S.predict_linear(f, coefs, SOPHISTICATION["intercept"])
    return p.select("doc_id", F.round("score", 6).alias("score"))
