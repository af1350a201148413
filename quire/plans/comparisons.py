"""Pairwise-comparison and prompt tables (N1–N12); suppliers stand in for
legislators, customers for survey profiles."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from ..operators import comparisons as N
from ..sources.tables import table
from .registry import register

K = 3
SEED = 42


def _items(spark, sf):
    s = table(spark, sf, "supplier")
    code = F.when(F.col("s_nationkey") % 3 == 0, 100).when(F.col("s_nationkey") % 3 == 1, 200).otherwise(328)
    return s.select("s_suppkey", "s_name", "s_acctbal", code.alias("code"))


def _pairs(spark, sf):
    it = _items(spark, sf)
    m = N.matchups(it, "s_suppkey", K, SEED)
    a = it.select(F.col("s_suppkey").alias("item1"), F.col("s_name").alias("name1"),
                  F.col("s_acctbal").alias("bal1"), N.party("code").alias("party1"))
    b = it.select(F.col("s_suppkey").alias("item2"), F.col("s_name").alias("name2"),
                  F.col("s_acctbal").alias("bal2"), N.party("code").alias("party2"))
    p = m.join(a, "item1").join(b, "item2")
    return N.build_prompts(p, "name1", "name2", "party1", "party2")


_PAIRS_SQL = f"""
it AS (SELECT s_suppkey, s_name, s_acctbal,
              CASE WHEN s_nationkey % 3 = 0 THEN 100 WHEN s_nationkey % 3 = 1 THEN 200 ELSE 328 END AS code FROM supplier),
r AS (SELECT s_suppkey, row_number() OVER (ORDER BY md5(concat_ws(':', '{SEED}', CAST(s_suppkey AS VARCHAR))), s_suppkey) - 1 AS rk
      FROM it),
n AS (SELECT count(*) AS n FROM it),
m AS (SELECT a.s_suppkey AS item1, b.s_suppkey AS item2, CAST(j AS INTEGER) AS round
      FROM r a, generate_series(1, {K}) g(j), n, r b WHERE b.rk = (a.rk + j) % n.n),
p AS (SELECT m.*, i1.s_name AS name1, i1.s_acctbal AS bal1,
             CASE i1.code WHEN 200 THEN 'R' WHEN 100 THEN 'D' ELSE 'I' END AS party1,
             i2.s_name AS name2, i2.s_acctbal AS bal2,
             CASE i2.code WHEN 200 THEN 'R' WHEN 100 THEN 'D' ELSE 'I' END AS party2
      FROM m JOIN it i1 ON i1.s_suppkey = m.item1 JOIN it i2 ON i2.s_suppkey = m.item2),
q AS (SELECT *, CASE WHEN party1 = 'R' AND party2 = 'R' THEN 'conservative' ELSE 'liberal' END AS direction FROM p)"""

_PRE, _REST = N.COMPARE_PROMPT.split("{direction}")
_M1, _REST = _REST.split("{a}")
_M2, _POST = _REST.split("{b}")


@register("supplier_matchups", f"""WITH {_PAIRS_SQL}
SELECT item1, item2, round, party1, party2, direction,
       '{_PRE}' || direction || '{_M1}' || name1 || '{_M2}' || name2 || '{_POST}' AS prompt FROM q""")
def supplier_matchups(spark, sf):
    p = _pairs(spark, sf)
    return p.select("item1", "item2", "round", "party1", "party2", "direction", "prompt")


def stub_answers(pdf: pd.DataFrame) -> pd.Series:
    """A deterministic stand-in for a hosted model (user-supplied in real use):
    answers from the balance, with some answers prefixed/terminated and some
    unusable, wrapped in a chat-completion JSON body."""
    out = []
    for i1, i2, n1, n2, b1, b2, d in zip(pdf["item1"], pdf["item2"], pdf["name1"], pdf["name2"],
                                         pdf["bal1"], pdf["bal2"], pdf["direction"]):
        s = int(i1) + int(i2)
        if s % 11 == 0:
            content = "I cannot answer that."
        elif abs(b1 - b2) < 500:
            content = "Tie"
        else:
            w = (n1 if b1 >= b2 else n2) if d == "conservative" else (n1 if b1 <= b2 else n2)
            content = f"Senator {w}." if s % 7 == 0 else w
        out.append(json.dumps({"choices": [{"message": {"content": f" {content} "}}]}))
    return pd.Series(out)


def _wins(spark, sf):
    p = _pairs(spark, sf).select("item1", "item2", "name1", "name2", "bal1", "bal2", "direction", "prompt")
    r = N.ask(p, stub_answers)
    r = r.withColumn("raw", N.parse_response("response"))
    r = r.withColumn("answer", N.clean_answer("raw", "name1", "name2"))
    return N.win_table(r, "item1", "item2", "name1", "name2", "answer")


@register("supplier_win_table", f"""WITH {_PAIRS_SQL},
a AS (SELECT *, CASE WHEN (item1 + item2) % 11 = 0 THEN 'I cannot answer that.'
                     WHEN abs(bal1 - bal2) < 500 THEN 'Tie'
                     WHEN (item1 + item2) % 7 = 0 THEN 'Senator ' || w || '.' ELSE w END AS raw
      FROM (SELECT *, CASE WHEN direction = 'conservative' THEN (CASE WHEN bal1 >= bal2 THEN name1 ELSE name2 END)
                           ELSE (CASE WHEN bal1 <= bal2 THEN name1 ELSE name2 END) END AS w FROM q)),
c AS (SELECT *, regexp_replace(regexp_replace(trim(raw), '\\.$', ''), '^Senator ', '') AS c0 FROM a),
d AS (SELECT *, CASE WHEN c0 = name1 OR c0 = name2 OR c0 = 'Tie' THEN c0 END AS answer FROM c),
w AS (SELECT *, CAST(CASE WHEN answer = 'Tie' THEN 0.5
                     WHEN answer = name1 THEN (CASE WHEN direction = 'conservative' THEN 1.0 ELSE 0.0 END)
                     WHEN answer = name2 THEN (CASE WHEN direction = 'conservative' THEN 0.0 ELSE 1.0 END) END AS DOUBLE) AS win1 FROM d)
SELECT item1, item2, direction, answer, win1, 1 - win1 AS win2, win1 IS NULL AS defective FROM w""")
def supplier_win_table(spark, sf):
    return _wins(spark, sf)


@register("supplier_strengths")
def supplier_strengths(spark, sf):
    """Bradley–Terry strengths from the win table (iterative: row check only)."""
    bt = N.bradley_terry(_wins(spark, sf), max_iter=30, tol=1e-5)
    return bt.select("item", F.round("strength", 6).alias("strength"), F.round("log_strength", 6).alias("log_strength"))


# Profile template and questions.
PROFILE = "A %s customer from %s with an account balance of %.2f."
QUESTIONS = ["Do you plan to order again next month?", "Would you recommend us to a colleague?"]


def _profiles(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_mktsegment", "n_name", "c_acctbal")
    return N.profiles(j, PROFILE, ["c_mktsegment", "n_name", "c_acctbal"])


@register("customer_profiles", f"""
SELECT c_custkey, q AS question,
       printf('{PROFILE}', c_mktsegment, n_name, c_acctbal) || ' ' || q AS prompt
FROM customer JOIN nation ON c_nationkey = n_nationkey,
     (VALUES {', '.join("('" + q + "')" for q in QUESTIONS)}) AS t(q)""")
def customer_profiles(spark, sf):
    p = N.with_questions(_profiles(spark, sf), QUESTIONS)
    return p.select("c_custkey", "question", F.concat_ws(" ", "profile", "question").alias("prompt"))


def balance_answer(pdf: pd.DataFrame) -> pd.Series:
    """Stand-in answer function: 1 when the profile's balance exceeds 4500."""
    bal = pdf["profile"].str.extract(r"balance of (-?[0-9]+(?:\.[0-9]+)?)")[0].astype(float)
    return (bal > 4500).astype(int).astype(str)


@register("segment_answer_gap", """
WITH s AS (SELECT c_mktsegment, avg(CASE WHEN round(c_acctbal, 2) > 4500 THEN 1.0 ELSE 0.0 END) AS synthetic
           FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
b AS (SELECT c_mktsegment, avg(CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                                                 AND o.o_orderpriority = '1-URGENT') THEN 1.0 ELSE 0.0 END) AS benchmark
      FROM customer c GROUP BY 1)
SELECT c_mktsegment, round(synthetic, 6) AS synthetic, round(benchmark, 6) AS benchmark,
       round(synthetic - benchmark, 6) AS difference FROM s FULL JOIN b USING (c_mktsegment)""")
def segment_answer_gap(spark, sf):
    prof = _profiles(spark, sf)
    ans = N.ask(prof.select("c_custkey", "c_mktsegment", "profile"), balance_answer, out="answer")
    syn = ans.select("c_mktsegment", F.col("answer").cast("double").alias("v"))
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey")).distinct().withColumn("v", F.lit(1.0))
    bench = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(urgent, "c_custkey", "left").na.fill(0.0, ["v"])
    g = N.compare_groups(syn, bench.select("c_mktsegment", "v"), "c_mktsegment", "v")
    return g.select("c_mktsegment", *[F.round(c, 6).alias(c) for c in ("synthetic", "benchmark", "difference")])


# Few-shot examples.
EXAMPLES = "Text: I love it -> 1\nText: I hate it -> -1"


@register("prompt_templates", f"""
WITH u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
t AS (SELECT conv_id, turn, 'zero_shot' AS kind, '{N.TEMPLATES['zero_shot'].split('{text}')[0]}' || text AS prompt, text FROM u
      UNION ALL
      SELECT conv_id, turn, 'few_shot', 'Classify the sentiment of this text as -1, 0 or 1.' || chr(10) ||
             'Text: I love it -> 1' || chr(10) || 'Text: I hate it -> -1' || chr(10) || 'Text: ' || text, text FROM u
      UNION ALL
      SELECT conv_id, turn, 'role', '{N.TEMPLATES['role'].split('{text}')[0]}' || text, text FROM u)
SELECT conv_id, turn, kind, md5(prompt) AS prompt_md5,
       CASE CAST(length(text) % 3 AS INTEGER) - 1 WHEN -1 THEN 'negative' WHEN 0 THEN 'neutral' WHEN 1 THEN 'positive' END AS label
FROM t""")
def prompt_templates(spark, sf):
    u = table(spark, sf, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    u = u.withColumn("examples", F.lit(EXAMPLES))
    out = None
    for kind in ("zero_shot", "few_shot", "role"):
        p = N.prompt_template(u, kind, examples="examples").withColumn("kind", F.lit(kind))
        out = p if out is None else out.unionByName(p)
    code = (F.char_length("text") % 3) - 1
    return out.select("conv_id", "turn", "kind", F.md5("prompt").alias("prompt_md5"), N.answer_label(code).alias("label"))
