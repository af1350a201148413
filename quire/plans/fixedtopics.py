"""Topic tables and measures (P6-P12, P17, P18) on a model with fixed parameters,
so that every number has an oracle: one topic per language, beta the smoothed share
of a word in the language's tokens, gamma the mean of its words' topic shares."""

from __future__ import annotations

from functools import cached_property, reduce
from operator import add

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import dfm as D
from ..operators import tokens as T
from ..operators import topicquality as TQ
from ..operators import topics as P
from ..session import cut_lineage
from ..sources.tables import deal, table
from .registry import register
from .sqlparts import tokens_cte

LANGS = ["de", "en", "es", "fr"]
MIN_DOCS = 5
_TOPIC_SQL = "CASE lang " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(LANGS)) + " END"

MODEL_SQL = f"""{tokens_cte("(SELECT * FROM documents WHERE lang IN ('de', 'en', 'es', 'fr'))")},
alld AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY 1, 2),
kept AS (SELECT term FROM alld GROUP BY term HAVING count(*) >= {MIN_DOCS}),
dfm AS (SELECT * FROM alld JOIN kept USING (term)),
dl AS (SELECT doc_id, ({_TOPIC_SQL})::INTEGER AS topic FROM documents),
cnt AS (SELECT topic, term, sum(n)::BIGINT AS c FROM dfm JOIN dl USING (doc_id) GROUP BY ALL),
tot AS (SELECT t.topic, coalesce(sum(c), 0)::BIGINT + 0.1 * (SELECT count(*) FROM kept) AS size
        FROM (VALUES (0), (1), (2), (3)) t(topic) LEFT JOIN cnt USING (topic) GROUP BY t.topic),
beta AS (SELECT tot.topic, kept.term, (coalesce(c, 0) + 0.1) / size AS beta FROM tot CROSS JOIN kept LEFT JOIN cnt ON cnt.topic = tot.topic AND cnt.term = kept.term),
rel AS (SELECT topic, term, beta / sum(beta) OVER (PARTITION BY term) AS r FROM beta),
gamma AS (SELECT doc_id, topic, round(sum(n * r) / sum(n), 9) AS gamma FROM dfm JOIN rel USING (term) GROUP BY doc_id, topic)"""


class Model:
    """Of the documents' languages: ``cells`` (the dfm), ``totals`` (term, n), ``beta``, the trimmed
    dfm ``d`` and ``gamma``, which are made when they are asked for.

    Texts are dealt by document once. A cell carries how often its document's id stands under
    each language (``times``; never for a null id), so that one aggregate by term gives document frequencies, totals
    and the languages' counts. Topics stay side by side in a row until the end, so a cell moves once for beta, once more for gamma."""

    def __init__(self, spark, sf):
        docs = table(spark, sf, "documents").where(F.col("lang").isin(LANGS)).select("doc_id", "lang", "text")
        same = Window.partitionBy("doc_id")
        times = F.array(*[F.count(F.when((F.col("lang") == v) & F.col("doc_id").isNotNull(), 1)).over(same).cast("int") for v in LANGS])
        rows = deal(docs, "doc_id").select("doc_id", times.alias("times"), "text")
        keys = ["doc_id", "times"]
        self.cells = cut_lineage(D.dfm_from_arrays(T.token_arrays(rows, keys=keys), keys, deal=False), "ft-all")
        stats = cut_lineage(self.cells.groupBy("term").agg(
            F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"),
            *[F.sum(F.col("n") * F.col("times")[i]).alias(f"c{i}") for i in range(len(LANGS))]), "ft-terms")
        trimmed, kept = D.dfm_trim_stats(self.cells, None, min_docfreq=MIN_DOCS, stats=stats)
        self._trimmed = trimmed.select("doc_id", "term", "n")
        self.totals = kept.select("term", F.col("tf").alias("n"))
        n_terms, *counts = kept.agg(F.count(F.lit(1)), *[F.sum(f"c{i}") for i in range(len(LANGS))]).first()
        self._share = kept.select("term", *[((F.col(f"c{i}") + 0.1) / F.lit((c or 0) + 0.1 * n_terms)).alias(f"b{i}") for i, c in enumerate(counts)])

    @cached_property
    def beta(self):
        """(topic, term, beta), stored."""
        by = F.posexplode(F.array(*[f"b{i}" for i in range(len(LANGS))])).alias("topic", "beta")
        return cut_lineage(self._share.select("term", by).select("topic", "term", "beta"), "ft-beta")

    @cached_property
    def d(self):
        """(doc_id, term, n) of the terms that are kept, stored."""
        return cut_lineage(self._trimmed, "ft-dfm")

    @cached_property
    def gamma(self):
        """(doc_id, topic, gamma), stored."""
        topics = range(len(LANGS))
        every = reduce(add, [F.col(f"b{i}") for i in topics])
        rel = self._share.select("term", *[(F.col(f"b{i}") / every).alias(f"r{i}") for i in topics])
        sums = self._trimmed.join(rel, "term").groupBy("doc_id").agg(F.sum("n").alias("s"), *[F.sum(F.col("n") * F.col(f"r{i}")).alias(f"s{i}") for i in topics])
        shares = F.array(*[F.round(F.col(f"s{i}") / F.col("s"), 9) for i in topics])
        return cut_lineage(sums.select("doc_id", F.posexplode(shares).alias("topic", "gamma")), "ft-gamma")


@register("fixed_topic_words", f"""WITH {MODEL_SQL},
r AS (SELECT topic, term, rank() OVER (PARTITION BY topic ORDER BY beta DESC) AS rank FROM beta)
SELECT topic, string_agg(term, ', ' ORDER BY rank, term) AS label FROM r WHERE rank <= 10 GROUP BY topic""")
def fixed_topic_words(spark, sf):
    """Ten top words of each topic."""
    return P.top_terms(Model(spark, sf).beta, 10)


@register("fixed_main_topics", f"""WITH {MODEL_SQL},
m AS (SELECT doc_id, arg_min(topic, (-gamma, topic)) AS topic, max(gamma) AS gamma FROM gamma GROUP BY doc_id)
SELECT doc_id, topic, gamma FROM m""")
def fixed_main_topics(spark, sf):
    """The most probable topic of each document."""
    return P.main_topic(Model(spark, sf).gamma)


@register("fixed_top_docs", f"""WITH {MODEL_SQL},
r AS (SELECT doc_id, topic, gamma, rank() OVER (PARTITION BY topic ORDER BY gamma DESC)::INTEGER AS rank FROM gamma)
SELECT * FROM r WHERE rank <= 5""")
def fixed_top_docs(spark, sf):
    """The documents most typical of each topic, ties kept."""
    return P.top_docs(Model(spark, sf).gamma, 5).select("doc_id", "topic", "gamma", "rank")


@register("fixed_topic_prevalence", f"""WITH {MODEL_SQL},
r AS (SELECT topic, term, rank() OVER (PARTITION BY topic ORDER BY beta DESC) AS rank FROM beta),
l AS (SELECT topic, string_agg(term, ', ' ORDER BY rank, term) AS label FROM r WHERE rank <= 3 GROUP BY topic)
SELECT topic, round(avg(gamma), 6) AS prevalence, any_value(label) AS label FROM gamma LEFT JOIN l USING (topic) GROUP BY topic""")
def fixed_topic_prevalence(spark, sf):
    """Mean share of each topic, with its label."""
    m = Model(spark, sf)
    return P.topic_prevalence(m.gamma, P.top_terms(m.beta, 3)).select("topic", F.round("prevalence", 6).alias("prevalence"), "label")


def _rank_share_sql(value: str, group: str = "topic") -> str:
    return (f"(rank() OVER (PARTITION BY {group} ORDER BY {value}) + (count(*) OVER (PARTITION BY {group}, {value}) - 1) / 2)"
            f" / count(*) OVER (PARTITION BY {group})")


@register("fixed_topic_labels", f"""WITH {MODEL_SQL},
share AS (SELECT term, sum(n) / (SELECT sum(n) FROM dfm) AS share FROM dfm GROUP BY term),
b AS (SELECT topic, term, round(beta, 12) AS beta, round(beta / share, 12) AS lift, round(beta / sum(beta) OVER (PARTITION BY term), 12) AS e,
             round(beta * (ln(beta) - avg(ln(beta)) OVER (PARTITION BY term)), 12) AS score FROM beta JOIN share USING (term)),
f AS (SELECT *, round(1 / (0.5 / ({_rank_share_sql("e")}) + 0.5 / ({_rank_share_sql("beta")})), 12) AS frex FROM b),
u AS (SELECT topic, term, 'beta' AS measure, beta AS v FROM f UNION ALL SELECT topic, term, 'lift', lift FROM f
      UNION ALL SELECT topic, term, 'frex', frex FROM f UNION ALL SELECT topic, term, 'score', score FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY topic, measure ORDER BY v DESC, term) AS rank FROM u)
SELECT topic, measure, string_agg(term, ', ' ORDER BY rank) AS label FROM r WHERE rank <= 7 GROUP BY ALL""")
def fixed_topic_labels(spark, sf):
    """P10: labels by probability, lift, FREX and score."""
    m = Model(spark, sf)
    return P.label_topics(m.beta, m.totals, n=7).select("topic", "measure", "label")


@register("fixed_topic_correlation", f"""WITH {MODEL_SQL}
SELECT a.topic AS topic_a, b.topic AS topic_b, round(corr(a.gamma, b.gamma), 6) AS corr
FROM gamma a JOIN gamma b USING (doc_id) GROUP BY 1, 2""")
def fixed_topic_correlation(spark, sf):
    """Correlation of topic shares over documents."""
    return P.topic_corr(Model(spark, sf).gamma).withColumn("corr", F.round("corr", 6))


@register("fixed_word_intrusion", f"""WITH {MODEL_SQL},
r AS (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY beta DESC, term) AS rank FROM beta),
top AS (SELECT topic, term FROM r WHERE rank <= 5),
s AS (SELECT topic, term, {_rank_share_sql("b")} AS share FROM (SELECT topic, term, round(beta, 12) AS b FROM beta)),
c AS (SELECT DISTINCT s.topic, s.term FROM s JOIN top ON top.term = s.term AND top.topic <> s.topic WHERE share <= 0.5),
i AS (SELECT topic, arg_min(term, md5(concat_ws(':', '42', topic::VARCHAR, term))) AS intruder FROM c GROUP BY topic)
SELECT topic, string_agg(term, ', ' ORDER BY term) AS words, any_value(intruder) AS intruder FROM top LEFT JOIN i USING (topic) GROUP BY topic""")
def fixed_word_intrusion(spark, sf):
    """Five top words and an intruder for each topic."""
    t = P.intrusion_tasks(Model(spark, sf).beta, n=5, seed=42)
    return t.select("topic", F.array_join("words", ", ").alias("words"), "intruder")


@register("fixed_topic_intrusion", f"""WITH {MODEL_SQL},
r AS (SELECT doc_id, topic, row_number() OVER (PARTITION BY doc_id ORDER BY gamma DESC, topic) AS rank, count(*) OVER (PARTITION BY doc_id) AS k FROM gamma),
i AS (SELECT doc_id, arg_min(topic, md5(concat_ws(':', '42', doc_id::VARCHAR, topic::VARCHAR))) AS intruder FROM r WHERE rank > greatest(1, k // 2) GROUP BY doc_id)
SELECT doc_id, list(topic ORDER BY rank) AS topics, any_value(intruder) AS intruder FROM r LEFT JOIN i USING (doc_id) WHERE rank <= 1 GROUP BY doc_id""")
def fixed_topic_intrusion(spark, sf):
    """Each document's top topic and one that doesn't belong."""
    return TQ.topic_intrusion(Model(spark, sf).gamma, n=1, seed=42)


@register("fixed_topic_quality", f"""WITH {MODEL_SQL},
r AS (SELECT topic, term, beta, row_number() OVER (PARTITION BY topic ORDER BY beta DESC, term) AS rank FROM beta),
top AS (SELECT * FROM r WHERE rank <= 10),
held AS (SELECT doc_id, topic, rank FROM dfm JOIN top USING (term)),
single AS (SELECT topic, rank, count(*) AS n FROM held GROUP BY ALL),
both_ AS (SELECT a.topic, a.rank AS ra, b.rank AS rb, count(*) AS n FROM held a JOIN held b ON a.doc_id = b.doc_id AND a.topic = b.topic AND a.rank < b.rank GROUP BY ALL),
coh AS (SELECT a.topic, sum(ln((coalesce(x.n, 0) + 1) / s.n)) AS coherence FROM top a JOIN top b ON a.topic = b.topic AND a.rank < b.rank
        JOIN single s ON s.topic = a.topic AND s.rank = a.rank LEFT JOIN both_ x ON x.topic = a.topic AND x.ra = a.rank AND x.rb = b.rank GROUP BY a.topic),
e AS (SELECT topic, term, round(beta, 12) AS f, round(beta / sum(beta) OVER (PARTITION BY term), 12) AS e FROM beta),
x AS (SELECT topic, term, 1 / (0.7 / ({_rank_share_sql("e")}) + 0.3 / ({_rank_share_sql("f")})) AS frex FROM e),
exc AS (SELECT topic, sum(frex) AS exclusivity FROM x JOIN top USING (topic, term) GROUP BY topic)
SELECT topic, round(coherence, 6) AS coherence, round(exclusivity, 6) AS exclusivity FROM coh JOIN exc USING (topic)""")
def fixed_topic_quality(spark, sf):
    """Semantic coherence and exclusivity of each topic."""
    m = Model(spark, sf)
    # only top words' cells count, and these words are all kept: no need to trim the others
    q = TQ.semantic_coherence(m.beta, m.cells).join(TQ.exclusivity(m.beta), "topic")
    return q.select("topic", F.round("coherence", 6).alias("coherence"), F.round("exclusivity", 6).alias("exclusivity"))


@register("fixed_heldout_and_residual", f"""WITH {MODEL_SQL},
h AS (SELECT *, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT % 10 = 0 THEN floor(n * 0.5)::BIGINT
        + (n % 2 = 1 AND ('0x' || substr(md5('42:' || doc_id || ':' || term), 1, 8))::BIGINT % 1000 < 500)::INT ELSE 0 END AS h FROM dfm),
q AS (SELECT doc_id, term, sum(beta * gamma) AS q FROM dfm JOIN gamma USING (doc_id) JOIN beta USING (topic, term) GROUP BY ALL),
l AS (SELECT doc_id, sum(h * ln(q)) / sum(h) AS l FROM h JOIN q USING (doc_id, term) WHERE h > 0 GROUP BY doc_id),
fit AS (SELECT doc_id, term, n - h AS n FROM h WHERE n > h),
size AS (SELECT doc_id, sum(n) AS size FROM fit GROUP BY doc_id),
c AS (SELECT doc_id, sum((n - size * q) ** 2 / (size * q)) AS x, any_value(size) - sum(size * q) AS rest
      FROM fit JOIN q USING (doc_id, term) JOIN size USING (doc_id) GROUP BY doc_id),
kv AS (SELECT 4 AS k, (SELECT count(*) FROM kept) AS v)
SELECT round((SELECT avg(l) FROM l), 6) AS heldout, round(sum(x + rest) / (count(*) * any_value(v) - count(*) * (any_value(k) - 1) - any_value(k) * (any_value(v) - 1)), 6) AS residual
FROM c, kv""")
def fixed_heldout_and_residual(spark, sf):
    """Likelihood of words held out of a tenth of the documents, and the
    dispersion of what is left."""
    m = Model(spark, sf)
    fit, held = (cut_lineage(x, "ft-split") for x in TQ.split_words(m.d))
    row = TQ.heldout_likelihood(m.beta, m.gamma, held).join(TQ.residual_dispersion(m.beta, m.gamma, fit))
    return row.select(F.round("heldout", 6).alias("heldout"), F.round("residual", 6).alias("residual"))
