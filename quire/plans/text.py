"""Token, dfm and corpus analyses over ``documents``, ``pages`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import dfm as D
from ..operators import tokens as T
from ..session import cut_lineage
from ..sources.tables import deal, documents, table
from .registry import register
from .sqlparts import STOP_EN_SQL, TOKEN_SQL, WORD_SQL, SENT_SQL, tokens_cte, lit_list


def _r(c, k=6):
    return F.round(c, k)


# --- flagship: distinctive terms per source (I2, I8, J1, J4, J9, E8, F3) -------------
TOP_TERMS_SQL = f"""
WITH docs AS (SELECT doc_id, source, text FROM documents WHERE lang = 'en'),
{tokens_cte('docs')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok WHERE term NOT IN ({STOP_EN_SQL}) GROUP BY doc_id, term),
nd AS (SELECT count(*) AS nd FROM docs),
dfreq AS (SELECT term, count(*) AS df FROM dfm GROUP BY term),
keep AS (SELECT term, df FROM dfreq, nd WHERE df / nd >= 0.05 AND df / nd <= 0.95),
trimmed AS (SELECT d.doc_id, d.term, d.n FROM dfm d JOIN keep USING (term)),
w AS (SELECT t.doc_id, t.term,
             t.n / sum(t.n) OVER (PARTITION BY t.doc_id) * log10(nd / k.df) AS w
      FROM trimmed t JOIN keep k USING (term), nd),
g AS (SELECT source, term, sum(w) AS tfidf FROM w JOIN docs USING (doc_id) GROUP BY source, term),
r AS (SELECT source, term, round(tfidf, 6) AS tfidf,
             CAST(rank() OVER (PARTITION BY source ORDER BY round(tfidf, 9) DESC) AS INTEGER) AS rank FROM g)
SELECT source, term, tfidf, rank FROM r WHERE rank <= 10
"""


def top_terms_by_source(spark, sf_dir, k: int = 10):
    docs = documents(spark, sf_dir).filter(F.col("lang") == "en").select("doc_id", "source", "text")
    arrays = T.filter_array(T.token_arrays(docs, keys=["doc_id", "source"]), drop=T.STOPWORDS_EN)
    n_docs = table(spark, sf_dir, "documents").filter(F.col("lang") == "en").select(F.count(F.lit(1)))
    trimmed, kept = D.trim_arrays(arrays, n_docs, 0.05, 0.95)
    idf = kept.select("term", F.log10(n_docs.scalar() / F.col("df")).alias("idf"))
    if trimmed is None:
        d = D.dfm_match(D.dfm_from_arrays(arrays), kept)
        g = D.dfm_group(D.dfm_tfidf(d, n_docs=n_docs, stats=kept), docs, "source", value="w")
    else:
        # a source's weight of a term is its idf times the sum of 1 / length over its tokens
        rows = T.pin(trimmed.select("source", "toks"), "toks").select("source", (1 / F.size("toks")).alias("tf"), F.explode("toks").alias("term"))
        g = rows.groupBy("source", "term").agg(F.sum("tf").alias("tf")).join(idf, "term").select("source", "term", (F.col("tf") * F.col("idf")).alias("w"))
    ranked = g.withColumn("rank", F.rank().over(
        Window.partitionBy("source").orderBy(F.round("w", 9).desc())))
    return ranked.filter(F.col("rank") <= k).select("source", "term", _r(F.col("w")).alias("tfidf"), "rank")


register("top_terms_by_source", TOP_TERMS_SQL)(top_terms_by_source)


def _docs(spark, sf, *cols):
    d = documents(spark, sf)
    return d.select(*cols) if cols else d


# --- B2 corpus summary ----------------------------------------------------------------
@register("corpus_summary", f"""
SELECT doc_id, lang, source,
  CAST(len(list_distinct(list_transform(regexp_extract_all(text, '{TOKEN_SQL}'), lambda x: lower(x)))) AS INTEGER) AS types,
  CAST(len(regexp_extract_all(text, '{TOKEN_SQL}')) AS INTEGER) AS tokens,
  CAST(len(regexp_extract_all(text, '{SENT_SQL}')) AS INTEGER) AS sentences
FROM documents""")
def corpus_summary(spark, sf):
    return C.corpus_summary(_docs(spark, sf, "doc_id", "text", "lang", "source"))


# --- B9 tokens over time (date derived from the id) ------------------------------------
@register("tokens_by_year", f"""
SELECT CAST(year(DATE '2000-01-01' + CAST(doc_id AS INTEGER)) AS INTEGER) AS year, count(*) AS n_docs,
       CAST(sum(len(regexp_extract_all(text, '{TOKEN_SQL}'))) AS BIGINT) AS tokens,
       round(avg(len(regexp_extract_all(text, '{TOKEN_SQL}'))), 6) AS mean_tokens
FROM documents GROUP BY 1""")
def tokens_by_year(spark, sf):
    d = _docs(spark, sf, "doc_id", "text").withColumn(
        "date", F.date_add(F.lit("2000-01-01").cast("date"), F.col("doc_id").cast("int")))
    out = C.tokens_over_time(d, "date")
    return out.withColumn("mean_tokens", F.round("mean_tokens", 6))


# --- B8 texts concatenated per source ----------------------------------------------------
@register("texts_by_source", """
SELECT source, count(*) AS n_docs,
       CAST(length(string_agg(text, chr(10) || chr(10) ORDER BY doc_id)) AS BIGINT) AS n_chars,
       CAST(sum(('0x' || substr(md5(text), 1, 8))::BIGINT) AS BIGINT) AS fingerprint
FROM documents GROUP BY source""")
def texts_by_source(spark, sf):
    return C.group_texts_summary(_docs(spark, sf, "doc_id", "source", "text"), "source", sep="\n\n")


# --- I3 / B10 sentences -----------------------------------------------------------------
@register("sentence_stats", f"""
SELECT doc_id, count(*) AS n_sentences, round(avg(length(trim(s))), 6) AS mean_chars FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{SENT_SQL}')) AS s FROM documents)
GROUP BY doc_id""")
def sentence_stats(spark, sf):
    u = C.reshape_units(_docs(spark, sf, "doc_id", "text"), "sentences")
    return u.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"),
                                   F.round(F.avg(F.char_length("text")), 6).alias("mean_chars"))


# --- I4 bigrams; I5 bigrams after stop-word removal ---------------------------------------
@register("top_bigrams", f"""
WITH {tokens_cte('documents')}
SELECT a.term || ' ' || b.term AS ngram, count(*) AS n
FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
GROUP BY 1 ORDER BY n DESC, ngram LIMIT 50""")
def top_bigrams(spark, sf):
    g = T.unnest_ngrams(_docs(spark, sf, "doc_id", "text"), 2)
    c = g.groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "ngram").limit(50)


@register("top_clean_bigrams", f"""
WITH {tokens_cte('documents')},
kept AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos
         FROM tok WHERE term NOT IN ({STOP_EN_SQL}))
SELECT a.term || '_' || b.term AS ngram, count(*) AS n
FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
GROUP BY 1 ORDER BY n DESC, ngram LIMIT 50""")
def top_clean_bigrams(spark, sf):
    arr = T.filter_array(T.token_arrays(_docs(spark, sf, "doc_id", "text")), drop=T.STOPWORDS_EN)
    g = T.tokens_ngrams(arr, 2).select(F.explode("toks").alias("ngram"))
    c = g.groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "ngram").limit(50)


# --- I1 / I6 token classes ----------------------------------------------------------------
_TOKEN_ALL = T.token_pattern(keep_punct=True).replace("'", "''")
_NUM = T.NUMBER.replace("'", "''")


@register("token_classes_by_lang", f"""
SELECT lang, CASE WHEN regexp_matches(term, '{_NUM}') THEN 'number'
                  WHEN regexp_matches(term, '^\\p{{P}}+$') THEN 'punct'
                  WHEN regexp_matches(term, '^\\p{{S}}+$') THEN 'symbol'
                  ELSE 'word' END AS class, count(*) AS n
FROM (SELECT lang, unnest(regexp_extract_all(text, '{_TOKEN_ALL}')) AS term FROM documents)
GROUP BY 1, 2""")
def token_classes_by_lang(spark, sf):
    t = T.tokens(_docs(spark, sf, "doc_id", "lang", "text"), keys=["doc_id", "lang"])
    term = F.col("term")
    cls = (F.when(term.rlike(T.NUMBER), "number").when(term.rlike(T.PUNCT), "punct")
           .when(term.rlike(T.SYMBOL), "symbol").otherwise("word"))
    return t.groupBy("lang", cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))


# --- I8 stop-word share -----------------------------------------------------------------------
_STOP_BY_LANG = " OR ".join(f"(lang = '{k}' AND term IN ({lit_list(v)}))" for k, v in T.STOPWORDS.items())


@register("stopword_share_by_lang", f"""
WITH {tokens_cte('documents', keys='doc_id, lang')}
SELECT lang, count(*) AS n_tokens, count(*) FILTER (WHERE {_STOP_BY_LANG}) AS n_stop,
       round(count(*) FILTER (WHERE {_STOP_BY_LANG}) / count(*), 6) AS share
FROM tok GROUP BY lang""")
def stopword_share_by_lang(spark, sf):
    t = T.unnest_tokens(_docs(spark, sf, "doc_id", "lang", "text"), keys=["doc_id", "lang"])
    stop = F.lit(False)
    for lang, words in T.STOPWORDS.items():  # each language has its own list
        stop = stop | ((F.col("lang") == lang) & F.col("term").isin(list(words)))
    g = t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.count(F.when(stop, 1)).alias("n_stop"))
    return g.withColumn("share", F.round(F.col("n_stop") / F.col("n_tokens"), 6))


# --- J1 / J7 tokens and types per document ------------------------------------------------------
@register("doc_ntoken_ntype", f"""
WITH {tokens_cte('documents')}
SELECT doc_id, count(*) AS ntoken, count(DISTINCT term) AS ntype FROM tok GROUP BY doc_id""")
def doc_ntoken_ntype(spark, sf):
    d = D.dfm_from_arrays(T.token_arrays(_docs(spark, sf, "doc_id", "text")))
    return D.ntoken_ntype(d)


# --- J2 / F3 top features per language (ties kept) ------------------------------------------------
@register("top_features_by_lang", f"""
WITH {tokens_cte('documents', keys='doc_id, lang')},
c AS (SELECT lang, term, count(*) AS n FROM tok WHERE term NOT IN ({STOP_EN_SQL}) GROUP BY lang, term)
SELECT lang, term, n, rank FROM (
  SELECT lang, term, n, CAST(rank() OVER (PARTITION BY lang ORDER BY n DESC) AS INTEGER) AS rank FROM c)
WHERE rank <= 10""")
def top_features_by_lang(spark, sf):
    from ..operators import relational as R
    arr = T.filter_array(T.token_arrays(_docs(spark, sf, "doc_id", "lang", "text"), keys=["doc_id", "lang"]),
                         drop=T.STOPWORDS_EN)
    d = D.dfm_from_arrays(arr, keys=["doc_id", "lang"])
    g = d.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return R.top_n(g, "lang", "n", 10)


# --- J4 (count) / J5 trims ---------------------------------------------------------------------------
@register("feature_trim_counts", f"""
WITH {tokens_cte('documents')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
st AS (SELECT term, count(*) AS df, sum(n) AS tf FROM dfm GROUP BY term)
SELECT (SELECT count(*) FROM st) AS n_features,
       (SELECT count(*) FROM st WHERE df >= 2) AS n_df2,
       (SELECT count(*) FROM dfm WHERE term IN (SELECT term FROM st WHERE df >= 2)) AS rows_df2,
       (SELECT count(*) FROM st WHERE tf >= 10) AS n_tf10,
       (SELECT count(*) FROM dfm WHERE term IN (SELECT term FROM st WHERE tf >= 10)) AS rows_tf10""")
def feature_trim_counts(spark, sf):
    d = D.dfm_from_arrays(T.token_arrays(_docs(spark, sf, "doc_id", "text")))
    a = D.dfm_trim(d, min_docfreq=2)
    b = D.dfm_trim(d, min_termfreq=10)
    return spark.range(1).select(
        D.featnames(d).select(F.count(F.lit(1))).scalar().alias("n_features"),
        D.featnames(a).select(F.count(F.lit(1))).scalar().alias("n_df2"),
        a.select(F.count(F.lit(1))).scalar().alias("rows_df2"),
        D.featnames(b).select(F.count(F.lit(1))).scalar().alias("n_tf10"),
        b.select(F.count(F.lit(1))).scalar().alias("rows_tf10"))


# --- J9 top tf-idf terms per document -----------------------------------------------------------------
@register("doc_top_tfidf", f"""
WITH {tokens_cte('documents')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
nd AS (SELECT count(*) AS nd FROM documents),
dfreq AS (SELECT term, count(*) AS df FROM dfm GROUP BY term),
w AS (SELECT doc_id, term, n / sum(n) OVER (PARTITION BY doc_id) * log10(nd / df) AS w
      FROM dfm JOIN dfreq USING (term), nd)
SELECT doc_id, term, round(w, 6) AS tfidf, rank FROM (
  SELECT doc_id, term, w, CAST(rank() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC) AS INTEGER) AS rank FROM w)
WHERE rank <= 3""")
def doc_top_tfidf(spark, sf):
    from ..operators import relational as R
    arrays = T.token_arrays(deal(table(spark, sf, "documents").select("doc_id", "text"), "doc_id"))
    w = D.tfidf_from_arrays(arrays, table(spark, sf, "documents").select(F.count(F.lit(1))))
    top = R.top_n(w, "doc_id", F.round("w", 9), 3)
    return top.select("doc_id", "term", F.round("w", 6).alias("tfidf"), "rank")


# --- I20 keyword in context ------------------------------------------------------------------------------
@register("kwic_mail", f"""
WITH {tokens_cte('documents')},
hits AS (SELECT doc_id, pos, term AS keyword FROM tok WHERE regexp_matches(term, '^mail[0-9]+$'))
SELECT h.doc_id, h.pos, h.keyword,
  coalesce((SELECT string_agg(t.term, ' ' ORDER BY t.pos) FROM tok t
            WHERE t.doc_id = h.doc_id AND t.pos BETWEEN h.pos - 3 AND h.pos - 1), '') AS pre,
  coalesce((SELECT string_agg(t.term, ' ' ORDER BY t.pos) FROM tok t
            WHERE t.doc_id = h.doc_id AND t.pos BETWEEN h.pos + 1 AND h.pos + 3), '') AS post
FROM hits h""")
def kwic_mail(spark, sf):
    return T.kwic(T.token_arrays(_docs(spark, sf, "doc_id", "text")), "^mail[0-9]+$", window=3)


# --- I12 compounds ---------------------------------------------------------------------------------------
_PHRASES = ["of the", "in the", "to the"]


@register("compound_phrases", f"""
WITH {tokens_cte("(SELECT * FROM documents WHERE lang = 'en')")}
SELECT a.term || '_' || b.term AS term, count(*) AS n
FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
WHERE a.term || ' ' || b.term IN ({', '.join("'" + p + "'" for p in _PHRASES)})
GROUP BY 1""")
def compound_phrases(spark, sf):
    docs = _docs(spark, sf, "doc_id", "lang", "text").filter(F.col("lang") == "en")
    arr = T.tokens_compound(T.token_arrays(docs), _PHRASES)
    ex = arr.select(F.explode("toks").alias("term")).filter(F.col("term").contains("_"))
    return ex.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


# --- I13 collocations --------------------------------------------------------------------------------------
@register("collocations_en", f"""
WITH {tokens_cte("(SELECT * FROM documents WHERE lang = 'en')")},
kept AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS pos
         FROM tok WHERE term NOT IN ({STOP_EN_SQL})),
pairs AS (SELECT a.term AS w1, b.term AS w2 FROM kept a JOIN kept b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
c AS (SELECT w1, w2, count(*) AS n11 FROM pairs GROUP BY 1, 2),
tot AS (SELECT sum(n11) AS nn FROM c),
f AS (SELECT w1, sum(n11) AS n1_ FROM c GROUP BY 1),
s AS (SELECT w2, sum(n11) AS n_1 FROM c GROUP BY 1),
t AS (SELECT c.w1, c.w2, n11, n11 + 0.5 AS a, n1_ - n11 + 0.5 AS b, n_1 - n11 + 0.5 AS cc,
             nn - n1_ - n_1 + n11 + 0.5 AS d, n1_, n_1, nn
      FROM c JOIN f USING (w1) JOIN s USING (w2), tot WHERE n11 >= 2)
SELECT w1 || ' ' || w2 AS collocation, n11 AS count,
       round(ln(a) + ln(d) - ln(b) - ln(cc), 6) AS lambda,
       round((ln(a) + ln(d) - ln(b) - ln(cc)) / sqrt(1/a + 1/b + 1/cc + 1/d), 6) AS z,
       round(ln(n11 * nn / (n1_ * n_1)), 6) AS pmi
FROM t""")
def collocations_en(spark, sf):
    docs = _docs(spark, sf, "doc_id", "lang", "text").filter(F.col("lang") == "en")
    arr = T.filter_array(T.token_arrays(docs), drop=T.STOPWORDS_EN)
    c = T.collocations(arr, min_count=2)
    return c.select("collocation", "count", *[F.round(x, 6).alias(x) for x in ("lambda", "z", "pmi")])


# --- L14 word shares by role ------------------------------------------------------------------------------
@register("role_word_shares", f"""
WITH {tokens_cte('conversations', keys='conv_id, turn, role')},
c AS (SELECT role, term, count(*) AS n FROM tok
      WHERE term NOT IN ({STOP_EN_SQL}) AND NOT regexp_matches(term, '[0-9]') AND role IN ('user', 'assistant')
      GROUP BY 1, 2),
p AS (SELECT role, term, n / sum(n) OVER (PARTITION BY role) AS prop FROM c),
w AS (SELECT term, max(prop) FILTER (WHERE role = 'user') AS "user",
             max(prop) FILTER (WHERE role = 'assistant') AS assistant FROM p GROUP BY term)
SELECT term, round("user", 9) AS "user", round(assistant, 9) AS assistant,
       CASE WHEN "user" > assistant THEN 'more user' ELSE 'more assistant' END AS more
FROM w WHERE "user" IS NOT NULL AND assistant IS NOT NULL""")
def role_word_shares(spark, sf):
    from ..operators.textstats import group_word_shares
    conv = table(spark, sf, "conversations")
    t = T.unnest_tokens(conv, keys=["conv_id", "turn", "role"])
    t = T.drop_digits(T.remove_stopwords(t))
    s = group_word_shares(t, "role", "user", "assistant")
    return s.select("term", F.round("user", 9).alias("user"), F.round("assistant", 9).alias("assistant"), "more")


# --- I16 HTML to text ----------------------------------------------------------------------------------------
def _html_sql(col: str) -> str:
    from ..functions.strings import HTML_COMMENTS, HTML_ENTITIES, HTML_TAGS
    x = col
    x = f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g')"
    x = f"regexp_replace({x}, '{HTML_COMMENTS}', ' ', 'g')"
    x = f"regexp_replace({x}, '{HTML_TAGS}', ' ', 'g')"
    for k, v in HTML_ENTITIES.items():
        x = f"replace({x}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"trim({x})"


@register("page_text", f"""
SELECT page_id, CAST(length({_html_sql('html')}) AS INTEGER) AS n_chars, md5({_html_sql('html')}) AS text_md5
FROM pages""")
def page_text(spark, sf):
    p = T.strip_html_table(table(spark, sf, "pages"), "html", "text")
    return p.select("page_id", F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


# --- I10 / J6 stemmed features (Porter on the vocabulary) -------------------------------------
@register("stemmed_top_features")
def stemmed_top_features(spark, sf):
    """Top 20 stems of English documents after stop-word removal; stemming
    happens once per distinct term and is joined back (row check only: the
    SQL engine's stemmer needs an extension download)."""
    docs = _docs(spark, sf, "doc_id", "lang", "text").filter(F.col("lang") == "en")
    t = T.remove_stopwords(T.unnest_tokens(docs))
    d = D.dfm(T.tokens_wordstem(t))
    return D.topfeatures(d, 20)


# --- L6 text reuse: benchmark passages inside documents ---------------------------------------
_SHINGLE_N = 5


def _shingle_sql(src: str, key: str) -> str:
    return (f"SELECT DISTINCT {key}, array_to_string(a[i:i + {_SHINGLE_N - 1}], ' ') AS shingle FROM "
            f"(SELECT {key}, a, unnest(generate_series(1, len(a) - {_SHINGLE_N - 1})) AS i FROM "
            f"(SELECT {key}, regexp_extract_all(lower(text), '{WORD_SQL}') AS a FROM {src}))")


@register("text_reuse_benchmark", f"""
WITH ish AS ({_shingle_sql('benchmark', 'item_id')}),
dsh AS ({_shingle_sql('documents', 'doc_id')}),
tot AS (SELECT item_id, count(*) AS item_shingles FROM ish GROUP BY item_id),
sh AS (SELECT item_id, doc_id, count(*) AS shared FROM dsh JOIN ish USING (shingle) GROUP BY 1, 2)
SELECT item_id, doc_id, shared, item_shingles, round(shared / item_shingles, 6) AS containment
FROM sh JOIN tot USING (item_id) WHERE shared >= 2""")
def text_reuse_benchmark(spark, sf):
    from ..operators.textstats import text_reuse_candidates
    items = table(spark, sf, "benchmark")
    docs = _docs(spark, sf, "doc_id", "text")
    c = text_reuse_candidates(items, docs, n=_SHINGLE_N, min_shared=2)
    return c.select("item_id", "doc_id", "shared", "item_shingles", F.round("containment", 6).alias("containment"))


# --- I17–I19 factorial preprocessing and preText (document sample by design) ------------------
def _pretext(spark, sf):
    from ..operators import pretext as PT
    from ..operators import relational as R
    docs = _docs(spark, sf, "doc_id", "lang", "text").filter(F.col("lang") == "en").select("doc_id", "text")
    sample = R.sample_n(docs, 50, "doc_id", seed=2)
    f = cut_lineage(PT.factorial_dfm(sample, threshold=0.2), "factorial-dfm")
    return PT, cut_lineage(PT.pretext_scores(f, k=20), "pretext")


@register("pretext_scores")
def pretext_scores(spark, sf):
    """preText score of each of the 64 preprocessing combinations on a seeded
    sample of 50 English documents (the diagnostic compares all document
    pairs, so it is defined on a sample)."""
    PT, s = _pretext(spark, sf)
    return s.join(PT.combinations(spark), "combo").withColumn("pretext_score", F.round("pretext_score", 6))


@register("pretext_regression")
def pretext_regression(spark, sf):
    """Regression of the preText scores on the six step flags."""
    PT, s = _pretext(spark, sf)
    return PT.pretext_regression(s).withColumn("coef", F.round("coef", 6))


# --- E9 coverage ratio: dictionary-word tokens per function-word token, by source -------------
@register("coverage_ratio_by_source", f"""
WITH {tokens_cte('documents', keys='doc_id, source')},
cls AS (SELECT term, CASE WHEN term IN ({STOP_EN_SQL}) THEN 'function'
                          WHEN term IN ('good', 'great', 'fine', 'bad', 'poor', 'not') THEN 'sentiment' END AS class
        FROM (SELECT DISTINCT term FROM tok))
SELECT source, CAST(count(*) FILTER (WHERE class = 'sentiment') AS BIGINT) AS n_num,
       CAST(count(*) FILTER (WHERE class = 'function') AS BIGINT) AS n_den,
       CAST(count(*) FILTER (WHERE class = 'sentiment') AS DOUBLE) / count(*) FILTER (WHERE class = 'function') AS ratio
FROM tok JOIN cls USING (term) WHERE class IS NOT NULL GROUP BY source""")
def coverage_ratio_by_source(spark, sf):
    from ..operators.relational import coverage_ratio
    t = T.unnest_tokens(_docs(spark, sf, "doc_id", "source", "text"), keys=["doc_id", "source"])
    rows = [(w, "function") for w in T.STOPWORDS_EN] + \
        [(w, "sentiment") for w in ("good", "great", "fine", "bad", "poor", "not") if w not in T.STOPWORDS_EN]
    classes = spark.createDataFrame(rows, "term string, class string")
    r = coverage_ratio(t, F.broadcast(classes), ["source"], "sentiment", "function")
    return r.select("source", F.col("n_num").cast("long"), F.col("n_den").cast("long"), F.col("ratio").cast("double"))


@register("text_reuse_aligned")
def text_reuse_aligned(spark, sf):
    """Benchmark passages found in documents — shingle candidates, then the
    local alignment score of each candidate (row check: no SQL alignment)."""
    from ..operators.textstats import text_reuse_alignment
    items = table(spark, sf, "benchmark")
    docs = _docs(spark, sf, "doc_id", "text")
    a = text_reuse_alignment(items, docs, n=_SHINGLE_N, min_shared=2)
    return a.select("item_id", "doc_id", "shared", F.round("score", 3).alias("score"), F.round("aligned", 6).alias("aligned"))


# --- J13 dense slice of the dfm for inspection -------------------------------------------------
_SLICE_TERMS = ["the", "of", "and", "de", "la"]
_SLICE_COLS = ", ".join(
    "CAST(coalesce(max(n) FILTER (WHERE term = '%s'), 0) AS BIGINT) AS \"%s\"" % (t, t) for t in _SLICE_TERMS)


@register("dfm_dense_slice", f"""
WITH {tokens_cte('documents')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
ids AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 5)
SELECT doc_id, {_SLICE_COLS}
FROM ids LEFT JOIN dfm USING (doc_id) GROUP BY doc_id""")
def dfm_dense_slice(spark, sf):
    """The first five documents × five fixed features, zeros filled."""
    docs = _docs(spark, sf, "doc_id", "text")
    d = D.dfm_from_arrays(T.token_arrays(docs))
    ids = [r[0] for r in docs.select("doc_id").orderBy("doc_id").limit(5).collect()]  # five ids
    sl = D.dense_slice(d, ids, ["the", "of", "and", "de", "la"])
    base = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    out = base.join(sl, "doc_id", "left").na.fill(0)
    return out.select("doc_id", *[F.col(t).cast("long").alias(t) for t in ["the", "of", "and", "de", "la"]])


# --- B1 / B3 / B5 corpus construction and metadata -------------------------------------------------
@register("corpus_metadata", """
SELECT 'documents' AS source_table, count(*) AS ndoc,
       (SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS duplicate_ids
FROM documents""")
def corpus_metadata(spark, sf):
    """Build the corpus (text field named, ids checked for uniqueness) and its
    one-row metadata."""
    c = C.corpus(table(spark, sf, "documents"), text_field="text", docid_field="doc_id")
    dup = C.duplicate_ids(c).select(F.count(F.lit(1))).scalar()
    return C.corpus_meta(c, source_table="documents").select("source_table", "ndoc", dup.alias("duplicate_ids"))


@register("customer_profile_table")
def customer_profile_table(spark, sf):
    """Per-column profile of ``customer`` (row check: approximate distinct)."""
    from ..sources.files import profile
    return profile(table(spark, sf, "customer"))


# --- B10 paragraphs as the unit of analysis ---------------------------------------------------------
@register("paragraph_stats", """
SELECT doc_id, count(*) AS n_paragraphs, CAST(sum(length(p)) AS BIGINT) AS chars FROM (
  SELECT doc_id, unnest(list_filter(list_transform(string_split_regex(text, '\\n\\s*\\n|\\n'), lambda x: trim(x)),
                                    lambda x: x <> '')) AS p FROM documents)
GROUP BY doc_id""")
def paragraph_stats(spark, sf):
    u = C.reshape_units(_docs(spark, sf, "doc_id", "text"), "paragraphs")
    return u.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_paragraphs"),
                                   F.sum(F.char_length("text")).cast("long").alias("chars"))
