"""Dictionary analyses (M1–M11) over ``conversations``, ``documents`` and ``labels``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dfm as D
from ..operators import lexicon as L
from ..operators import relational as R
from ..operators import tokens as T
from ..session import cut_lineage
from ..sources.tables import table
from .registry import register
from .sqlparts import tokens_cte

# An invented two-category dictionary (patterns ending in * are prefixes).
SENTIMENT = {"negative": ["bad", "poor", "not", "er*", "nd*", "ly"],
             "positive": ["good", "great", "fine", "ble*", "ing*", "tion"]}
CATEGORIES = ["negative", "positive"]

# Weights for the weighted tone (per pattern).
TONE_WEIGHTS = {"bad": -2.0, "poor": -1.5, "not": -0.5, "er*": -0.8, "nd*": -0.4, "ly": -0.2,
                "good": 2.0, "great": 2.5, "fine": 1.0, "ble*": 0.6, "ing*": 0.3, "tion": 0.9}

# Sub-category "strong" rolls up into "positive".
STRONG = {"strong": ["great", "best", "ble*"]}
PARENTS = [("strong", "positive")]

# A small valence lexicon, boosters and negations for the VADER-style scorer.
VALENCE = {"good": 1.9, "great": 3.1, "fine": 0.8, "tion": 1.2, "ble": 1.5, "bad": -2.5, "poor": -2.1,
           "er": -1.1, "nd": -0.9, "ly": -0.5}
BOOSTERS = {"very": 1.0, "really": 1.0, "extremely": 1.0}
NEGATIONS = ["not", "no", "never", "nicht", "pas"]


def _dict_sql(entries, weights=None):
    rows = []
    for cat, pats in entries.items():
        for p in pats:
            w = (weights or {}).get(p, 1.0)
            rows.append(f"('{cat}', '{p.rstrip('*')}', {float(w)}, {str(p.endswith('*')).upper()})")
    return "(VALUES " + ", ".join(rows) + ") AS dict(category, pattern, weight, is_prefix)"


def _resolve_sql(vocab: str, entries, weights=None) -> str:
    return (f"SELECT v.term, d.category, max(d.weight) AS weight FROM {vocab} v JOIN {_dict_sql(entries, weights)} "
            f"ON (d.is_prefix AND starts_with(v.term, d.pattern)) OR (NOT d.is_prefix AND v.term = d.pattern) "
            f"GROUP BY v.term, d.category").replace("JOIN (VALUES", "JOIN (VALUES").replace(" AS dict(", " AS d(")


_CONV_COUNTS_SQL = f"""
{tokens_cte('conversations', keys='conv_id, turn')},
dfm AS (SELECT conv_id, turn, term, count(*) AS n FROM tok GROUP BY 1, 2, 3),
vocab AS (SELECT DISTINCT term FROM dfm),
m AS ({_resolve_sql('vocab', SENTIMENT)}),
c AS (SELECT conv_id, turn, category, sum(n) AS n FROM dfm JOIN m USING (term) GROUP BY 1, 2, 3),
wide AS (SELECT k.conv_id, k.turn, k.role,
           CAST(coalesce(sum(n) FILTER (WHERE category = 'negative'), 0) AS BIGINT) AS negative,
           CAST(coalesce(sum(n) FILTER (WHERE category = 'positive'), 0) AS BIGINT) AS positive
         FROM conversations k LEFT JOIN c USING (conv_id, turn) GROUP BY 1, 2, 3)"""


def _conv_counts(spark, sf):
    """Turns with their counts per category, inside each row."""
    keys = ["conv_id", "turn", "role"]
    return L.count_in_rows(T.token_arrays(table(spark, sf, "conversations"), keys=keys), SENTIMENT, keys)


def _conv_counts_by_join(spark, sf):
    """The same through the dfm and the dictionary as tables."""
    conv = table(spark, sf, "conversations")
    keys = ["conv_id", "turn"]
    d = cut_lineage(D.dfm_from_arrays(T.token_arrays(conv, keys=keys), keys=keys), "dfm-turns")
    dic = L.dictionary_table(spark, SENTIMENT)
    w = L.lookup_wide(conv, d, dic, CATEGORIES, keys=keys)
    return w.join(conv.select(*keys, "role"), keys)


@register("conversation_dictionary_counts", f"WITH {_CONV_COUNTS_SQL}\nSELECT conv_id, turn, negative, positive FROM wide")
def conversation_dictionary_counts(spark, sf):
    return _conv_counts_by_join(spark, sf).select("conv_id", "turn", *CATEGORIES)


@register("conversation_polarity", f"""WITH {_CONV_COUNTS_SQL}
SELECT conv_id, turn, role, negative, positive, positive - negative AS score,
       round(ln((positive + 0.5) / (negative + 0.5)), 6) AS polarity FROM wide""")
def conversation_polarity(spark, sf):
    w = _conv_counts(spark, sf)
    return w.select("conv_id", "turn", "role", "negative", "positive",
                    (F.col("positive") - F.col("negative")).alias("score"),
                    F.round(L.polarity("positive", "negative"), 6).alias("polarity"))


@register("polarity_by_role", f"""WITH {_CONV_COUNTS_SQL}
SELECT role, count(*) AS n, round(avg(positive - negative), 6) AS mean_score,
       round(avg(ln((positive + 0.5) / (negative + 0.5))), 6) AS mean_polarity FROM wide GROUP BY role""")
def polarity_by_role(spark, sf):
    w = _conv_counts(spark, sf)
    return w.groupBy("role").agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.avg(F.col("positive") - F.col("negative")), 6).alias("mean_score"),
                                 F.round(F.avg(L.polarity("positive", "negative")), 6).alias("mean_polarity"))


@register("polarity_label_shares", f"""WITH {_CONV_COUNTS_SQL}
SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM wide), 6) AS share FROM (
  SELECT CASE WHEN positive - negative > 0 THEN 'Positive' WHEN positive - negative < 0 THEN 'Negative' END AS label
  FROM wide) GROUP BY label""")
def polarity_label_shares(spark, sf):
    w = _conv_counts(spark, sf)
    lab = w.select(L.label_by_sign(F.col("positive") - F.col("negative")).alias("label"))
    c = R.count_by(lab, "label")
    return R.share(c, "n").withColumn("share", F.round("share", 6))


@register("extreme_turns", f"""WITH {_CONV_COUNTS_SQL}
(SELECT 'most positive' AS direction, conv_id, turn, positive - negative AS score FROM wide
 ORDER BY score DESC, conv_id, turn LIMIT 5)
UNION ALL
(SELECT 'most negative' AS direction, conv_id, turn, positive - negative AS score FROM wide
 ORDER BY score ASC, conv_id, turn LIMIT 5)""")
def extreme_turns(spark, sf):
    w = _conv_counts(spark, sf).withColumn("score", F.col("positive") - F.col("negative"))
    top = w.orderBy(F.desc("score"), "conv_id", "turn").limit(5).select(
        F.lit("most positive").alias("direction"), "conv_id", "turn", "score")
    bot = w.orderBy(F.asc("score"), "conv_id", "turn").limit(5).select(
        F.lit("most negative").alias("direction"), "conv_id", "turn", "score")
    return top.unionByName(bot)


@register("document_tone", f"""
WITH {tokens_cte('documents')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
vocab AS (SELECT DISTINCT term FROM dfm),
m0 AS ({_resolve_sql('vocab', SENTIMENT, TONE_WEIGHTS)}),
m AS (SELECT term, avg(weight) AS weight FROM m0 GROUP BY term)
SELECT doc_id, sum(n) AS n_dict, CAST(sum(n * CAST(round(weight * 10000) AS BIGINT)) AS DOUBLE) / (sum(n) * 10000.0) AS tone
FROM dfm JOIN m USING (term) GROUP BY doc_id""")
def document_tone(spark, sf):
    docs = table(spark, sf, "documents")
    d = D.dfm_from_arrays(T.token_arrays(docs))
    dic = L.dictionary_table(spark, SENTIMENT, TONE_WEIGHTS)
    t = L.tone(d, dic)
    return t.select("doc_id", "n_dict", "tone")


@register("hierarchical_counts", f"""
WITH {tokens_cte('documents')},
dfm AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
vocab AS (SELECT DISTINCT term FROM dfm),
m AS ({_resolve_sql('vocab', {**SENTIMENT, 'positive': SENTIMENT['positive'] + STRONG['strong'], **STRONG})})
SELECT category, sum(n) AS n, count(DISTINCT doc_id) AS n_docs FROM dfm JOIN m USING (term) GROUP BY category""")
def hierarchical_counts(spark, sf):
    docs = table(spark, sf, "documents")
    d = D.dfm_from_arrays(T.token_arrays(docs))
    dic = L.dictionary_table(spark, {**SENTIMENT, **STRONG})
    parents = spark.createDataFrame(PARENTS, "category string, parent string")
    closed = L.dictionary_closure(dic, parents)
    long = L.lookup(d, closed)
    return long.groupBy("category").agg(F.sum("n").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@register("label_attribute_means", """
WITH l AS (SELECT doc_id, CAST(quality AS DOUBLE) AS quality, CAST(toxic AS DOUBLE) AS toxic FROM labels),
long AS (UNPIVOT l ON quality, toxic INTO NAME attribute VALUE value)
SELECT d.lang, attribute, count(*) AS n, round(avg(value), 6) AS mean FROM long JOIN documents d USING (doc_id)
GROUP BY d.lang, attribute""")
def label_attribute_means(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"),
                                            F.col("toxic").cast("double").alias("toxic"))
    long = R.pivot_longer(lab, ["doc_id"], ["quality", "toxic"], "attribute", "value")
    j = long.join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return j.groupBy("lang", "attribute").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


def _vader_words_sql() -> str:
    """CTEs of the words' valences ``s`` of the documents ``d``."""
    from .sqlparts import WORD_SQL
    lex = ", ".join(f"('{k}', {float(v)})" for k, v in VALENCE.items())
    bst = ", ".join(f"('{k}', {float(v)})" for k, v in BOOSTERS.items())
    negs = ", ".join(f"'{n}'" for n in NEGATIONS)
    return f"""
WITH d AS (SELECT d.doc_id, d.lang, d.text, l.quality, upper(d.text) = d.text AS allcaps,
                  least(len(regexp_extract_all(d.text, '!')), {L.EXCL_MAX}) AS excl
           FROM documents d JOIN labels l USING (doc_id)),
raw AS (SELECT doc_id, unnest(generate_series(1, len(a))) AS pos, unnest(a) AS w
        FROM (SELECT doc_id, regexp_extract_all(text, '{WORD_SQL}') AS a FROM d)),
t AS (SELECT doc_id, pos, w, lower(w) AS t,
             lag(lower(w), 1) OVER (PARTITION BY doc_id ORDER BY pos) AS p1,
             lag(lower(w), 2) OVER (PARTITION BY doc_id ORDER BY pos) AS p2,
             lag(lower(w), 3) OVER (PARTITION BY doc_id ORDER BY pos) AS p3 FROM raw),
lex AS (SELECT * FROM (VALUES {lex}) x(term, v)),
bst AS (SELECT * FROM (VALUES {bst}) x(term, b)),
s AS (SELECT t.doc_id, coalesce(lex.v, 0.0) AS v,
             CASE WHEN t.w = upper(t.w) AND t.w <> lower(t.w) AND NOT d.allcaps
                  THEN {L.CAPS_INCR} * sign(coalesce(lex.v, 0.0)) ELSE 0.0 END AS caps,
             (coalesce(b1.b, 0.0) * {L.B_INCR} * 1.0 + coalesce(b2.b, 0.0) * {L.B_INCR} * 0.95
              + coalesce(b3.b, 0.0) * {L.B_INCR} * 0.9) * sign(coalesce(lex.v, 0.0)) AS boost,
             coalesce(t.p1 IN ({negs}), false) OR coalesce(t.p2 IN ({negs}), false)
               OR coalesce(t.p3 IN ({negs}), false) AS neg
      FROM t JOIN d USING (doc_id) LEFT JOIN lex ON lex.term = t.t
           LEFT JOIN bst b1 ON b1.term = t.p1 LEFT JOIN bst b2 ON b2.term = t.p2 LEFT JOIN bst b3 ON b3.term = t.p3)"""


def _vader_sql() -> str:
    return f"""{_vader_words_sql()},
sc AS (SELECT doc_id, sum(CASE WHEN v = 0 THEN 0.0 WHEN neg THEN (v + caps + boost) * ({L.N_SCALAR})
                               ELSE v + caps + boost END) AS total FROM s GROUP BY doc_id),
c AS (SELECT d.doc_id, d.lang, d.quality,
             coalesce(sc.total, 0.0) + sign(coalesce(sc.total, 0.0)) * d.excl * {L.EXCL_INCR} AS tt FROM d LEFT JOIN sc USING (doc_id)),
p AS (SELECT lang, quality, tt / sqrt(tt * tt + {L.ALPHA}) AS compound FROM c)
SELECT lang, count(*) AS n, round(avg(CASE WHEN (CASE WHEN compound > 0 THEN 1 ELSE 0 END) = quality THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(compound), 6) AS mean_compound FROM p GROUP BY lang"""


def _vader_scored_sql() -> str:
    """All four scores by document, with the rules for "but" and question marks."""
    return f"""{_vader_words_sql().replace("SELECT t.doc_id, coalesce(lex.v", "SELECT t.doc_id, t.pos, t.t AS word, coalesce(lex.v")},
bt AS (SELECT doc_id, min(pos) AS but_at FROM s WHERE word = 'but' GROUP BY doc_id),
x AS (SELECT s.doc_id, CASE WHEN v = 0 THEN 0.0 WHEN neg THEN (v + caps + boost) * ({L.N_SCALAR}) ELSE v + caps + boost END
             * CASE WHEN but_at IS NULL OR pos = but_at THEN 1.0 WHEN pos < but_at THEN {L.BUT_BEFORE} ELSE {L.BUT_AFTER} END AS v FROM s LEFT JOIN bt USING (doc_id)),
sc AS (SELECT doc_id, sum(v) AS total, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0.0 END) AS p, abs(sum(CASE WHEN v < 0 THEN v - 1 ELSE 0.0 END)) AS n,
              count(*) FILTER (WHERE v = 0)::DOUBLE AS u FROM x GROUP BY doc_id),
q AS (SELECT doc_id, len(regexp_extract_all(text, '[?]')) AS q FROM d),
c AS (SELECT d.doc_id, coalesce(total, 0.0) AS t, coalesce(p, 0.0) AS p, coalesce(n, 0.0) AS n, coalesce(u, 0.0) AS u,
             excl * {L.EXCL_INCR} + CASE WHEN q.q < 2 THEN 0.0 WHEN q.q <= 3 THEN q.q * {L.QUEST_INCR} ELSE {L.QUEST_MAX} END AS mark
      FROM d JOIN q USING (doc_id) LEFT JOIN sc USING (doc_id)),
e AS (SELECT doc_id, t + sign(t) * mark AS t, p + CASE WHEN p > n THEN mark ELSE 0.0 END AS p, n + CASE WHEN n > p THEN mark ELSE 0.0 END AS n, u FROM c)
SELECT doc_id, round(t / sqrt(t * t + {L.ALPHA}), 6) AS compound, CASE WHEN p + n + u > 0 THEN round(p / (p + n + u), 6) END AS pos,
  CASE WHEN p + n + u > 0 THEN round(u / (p + n + u), 6) END AS neu, CASE WHEN p + n + u > 0 THEN round(n / (p + n + u), 6) END AS neg FROM e"""


@register("vader_quality_accuracy", _vader_sql())
def vader_quality_accuracy(spark, sf):
    """M9 + M10: VADER-style compound per labelled document, class = compound > 0,
    accuracy against ``labels.quality`` per language."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    v = L.vader(docs, VALENCE, BOOSTERS, NEGATIONS)
    j = v.join(docs.select("doc_id", "lang", "quality"), "doc_id")
    j = j.withColumn("pred", L.threshold("compound"))
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("n"),
                                 F.round(F.avg((F.col("pred") == F.col("quality")).cast("double")), 6).alias("accuracy"),
                                 F.round(F.avg("compound"), 6).alias("mean_compound"))
