"""Prompt, answer and pairwise-comparison tables.

Answer functions are supplied by the user and run batch by batch in
``mapInPandas``; everything around them (pairing, prompt text, parsing,
cleaning, win coding, strengths) is DataFrame work.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.files import with_row_id
from .relational import hash_key


def matchups(items: DataFrame, id_col: str, k: int, seed: int = 42) -> DataFrame:
    """Every item gets ``k`` opponents.

    Items are ranked 0..n−1 by a seeded hash; item at rank r meets the items at
    ranks r+1 … r+k (mod n). Each item appears in at least ``k`` pairs (``k``
    as first, ``k`` as second), duplicates are possible when ``k ≥ n/2``; the
    work is O(n·k) — no all-pairs table. ``k`` must lie in 1..n−1.
    """
    n = items.select(F.count(F.lit(1))).scalar()
    ranked = with_row_id(items.select(id_col).withColumn("_h", hash_key([id_col], seed)),
                         [F.col("_h"), F.col(id_col)], "_r").select(id_col, (F.col("_r") - 1).alias("_r"))
    ex = ranked.select(F.col(id_col).alias("item1"), "_r", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_j"))
    ex = ex.withColumn("_o", F.pmod(F.col("_r") + F.col("_j"), n))
    opp = ranked.select(F.col(id_col).alias("item2"), F.col("_r").alias("_o"))
    return ex.join(opp, "_o").select("item1", "item2", F.col("_j").alias("round"))


def check_k(items: DataFrame, k: int) -> None:
    n = items.count()
    if not 1 <= k <= n - 1:
        raise ValueError(f"k must be in 1..{n - 1}")


def party(code: Column | str) -> Column:
    """Party letter from a numeric code: 200 → R, 100 → D, otherwise I."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c == 200, "R").when(c == 100, "D").otherwise("I")


# Prompt wording.
COMPARE_PROMPT = "Which of these two senators is more {direction}: {a} or {b}? Answer with one name, or Tie."
EXTRACT_PROMPT = "Extract the senator's name from this answer; reply with the name only, or Tie: "
EXTRACT_PROMPT_NAMED = ("Read the answer below. Which of the two, {a} or {b}, does it hold to be more {direction}? "
                        "If it calls one of them more {opposite} or more moderate, the other one counts. "
                        "Reply with the full name only, or Tie if it says neither. Answer: ")


def build_prompts(pairs: DataFrame, name1: str, name2: str, party1: str, party2: str) -> DataFrame:
    """Comparison direction (both R → conservative, otherwise liberal) and prompt text."""
    direction = F.when((F.col(party1) == "R") & (F.col(party2) == "R"), "conservative").otherwise("liberal")
    pre, rest = COMPARE_PROMPT.split("{direction}")
    mid1, rest = rest.split("{a}")
    mid2, post = rest.split("{b}")
    prompt = F.concat(F.lit(pre), direction, F.lit(mid1), F.col(name1), F.lit(mid2), F.col(name2), F.lit(post))
    return pairs.withColumn("direction", direction).withColumn("prompt", prompt)


def extraction_prompts(df: DataFrame, answer: str = "answer", direction: str | None = None,
                       name1: str | None = None, name2: str | None = None) -> DataFrame:
    """Second-stage prompt from a first answer. With the columns of the
    direction asked (``liberal`` or ``conservative``) and of both names, the
    prompt asks for that direction and names the two."""
    if direction is None:
        return df.withColumn("extract_prompt", F.concat(F.lit(EXTRACT_PROMPT), F.col(answer)))
    opposite = F.when(F.col(direction) == "liberal", "conservative").otherwise("liberal")
    prompt = F.lit(EXTRACT_PROMPT_NAMED)
    for mark, value in (("{a}", F.col(name1)), ("{b}", F.col(name2)), ("{direction}", F.col(direction)), ("{opposite}", opposite)):
        prompt = F.replace(prompt, F.lit(mark), value)
    return df.withColumn("extract_prompt", F.concat(prompt, F.col(answer)))


def ask(df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], out: str = "response",
        waits: Sequence[float] = (1.0, 2.0)) -> DataFrame:
    """Run every row through a user answer function, batch by batch.

    ``fn`` receives a pandas batch (all columns) and returns one string per row.
    On an error the batch is retried after each wait in ``waits``; if it still
    fails, each row is tried alone and a failing row gets a NULL answer and its
    error text. The table is never cut.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + \
        f", `{out}` string, `{out}_error` string"

    def run(it):
        for pdf in it:
            res, err = None, None
            for w in [0.0, *waits]:
                if w:
                    time.sleep(w)
                try:
                    res = list(fn(pdf))
                    err = [None] * len(pdf)
                    break
                except Exception as e:  # noqa: BLE001
                    err = f"{type(e).__name__}: {e}"
            if res is None:
                res, err = [], []
                for i in range(len(pdf)):
                    try:
                        res.append(list(fn(pdf.iloc[i:i + 1]))[0])
                        err.append(None)
                    except Exception as e:  # noqa: BLE001
                        res.append(None)
                        err.append(f"{type(e).__name__}: {e}")
            o = pdf.copy()
            o[out] = res
            o[f"{out}_error"] = err
            yield o
    return df.mapInPandas(run, schema)


def parse_response(col: str = "response", out: str = "answer") -> Column:
    """Nested JSON ``choices[0].message.content`` → trimmed text."""
    schema = "choices array<struct<message: struct<content: string>>>"
    return F.trim(F.from_json(F.col(col), schema)["choices"][0]["message"]["content"]).alias(out)


def parse_csv_answer(col: str) -> Column:
    """A CSV answer line → array of trimmed fields."""
    return F.transform(F.split(F.col(col), ","), lambda x: F.trim(x))


def csv_answer_rows(df: DataFrame, col: str, fields: list[str], header: bool = True) -> DataFrame:
    """An answer that is a whole CSV text → one row per line with the named
    fields (strings, trimmed; a short line has NULLs), other columns repeated."""
    lines = F.filter(F.split(F.col(col), r"\r?\n"), lambda x: F.trim(x) != "")
    lines = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))) if header else lines
    schema = ", ".join(f"`{f}` string" for f in fields)
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.posexplode(lines).alias("line", "_l")).withColumn("_r", F.from_csv("_l", schema))
    return rows.select(*rest, (F.col("line") + 1).alias("line"), *[F.trim(F.col(f"_r.`{f}`")).alias(f) for f in fields])


def clean_answer(answer: str, name1: str, name2: str, prefix: str = "Senator ") -> DataFrame | Column:
    """Strip one trailing period and a leading prefix; keep the answer only
    if it is one of both names or ``Tie`` (else NULL)."""
    a = F.regexp_replace(F.trim(F.col(answer)), r"\.$", "")
    a = F.regexp_replace(a, "^" + prefix, "")
    ok = (a == F.col(name1)) | (a == F.col(name2)) | (a == F.lit("Tie"))
    return F.when(ok, a)


def win_table(df: DataFrame, item1: str, item2: str, name1: str, name2: str, answer: str,
              direction: str = "direction") -> DataFrame:
    """Win coding where "win" = more **conservative**: in a liberal
    comparison the named winner scores 0 and the loser 1; in a conservative
    one 1 and 0; a tie 0.5 each; an unusable answer is kept and flagged."""
    a, d = F.col(answer), F.col(direction)
    first = a == F.col(name1)
    second = a == F.col(name2)
    tie = a == F.lit("Tie")
    cons = d == "conservative"
    w1 = (F.when(tie, 0.5).when(first, F.when(cons, 1.0).otherwise(0.0))
          .when(second, F.when(cons, 0.0).otherwise(1.0)))
    return df.select(F.col(item1).alias("item1"), F.col(item2).alias("item2"), d.alias("direction"),
                     a.alias("answer"), w1.alias("win1"), (1 - w1).alias("win2"), w1.isNull().alias("defective"))


def bradley_terry(wins: DataFrame, max_iter: int = 100, tol: float = 1e-6) -> DataFrame:
    """Bradley–Terry strengths by minorisation–maximisation:
    p_i ← W_i / Σ_j n_ij / (p_i + p_j), normalised to mean 1 (log scale
    returned too). Pairs and wins are aggregated once and checkpointed; the
    strengths table (one row per item) is joined, never collected, and is
    written to the checkpoint folder every round so the plan stays constant.
    """
    ensure_checkpoint_dir(wins.sparkSession)
    w = wins.filter(~F.col("defective"))
    a = w.select(F.col("item1").alias("i"), F.col("item2").alias("j"), F.col("win1").alias("w"))
    b = w.select(F.col("item2").alias("i"), F.col("item1").alias("j"), F.col("win2").alias("w"))
    games = cut_lineage(a.unionByName(b), "bt-games")
    nij = cut_lineage(games.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")), "bt-pairs")
    wi = cut_lineage(games.groupBy("i").agg(F.sum("w").alias("W")), "bt-wins")
    p = wi.select("i", F.lit(1.0).alias("p"))
    for _ in range(max_iter):
        pj = p.select(F.col("i").alias("j"), F.col("p").alias("pj"))
        den = nij.join(p, "i").join(pj, "j").groupBy("i").agg(F.sum(F.col("n") / (F.col("p") + F.col("pj"))).alias("den"))
        raw = wi.join(den, "i").select("i", (F.greatest(F.col("W"), F.lit(1e-9)) / F.col("den")).alias("p"))
        new = cut_lineage(raw.select("i", (F.col("p") / raw.select(F.avg("p")).scalar()).alias("p")), "bt-p")
        delta = new.join(p.withColumnRenamed("p", "_o"), "i").select(F.max(F.abs(F.col("p") - F.col("_o")))).first()[0]
        p = new
        if delta is not None and delta < tol:
            break
    return p.select(F.col("i").alias("item"), F.col("p").alias("strength"), F.ln("p").alias("log_strength"))


def profiles(df: DataFrame, template: str, cols: Sequence[str], out: str = "profile") -> DataFrame:
    """Profile text from attribute columns with a ``format_string`` template."""
    return df.withColumn(out, F.format_string(template, *[F.col(c) for c in cols]))


def with_questions(df: DataFrame, questions: Sequence[str], out: str = "question") -> DataFrame:
    """Every profile × a fixed, bounded list of questions."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(q) for q in questions])))


def compare_groups(synthetic: DataFrame, benchmark: DataFrame, by: str, value: str) -> DataFrame:
    """Group mean of synthetic answers next to the benchmark mean."""
    s = synthetic.groupBy(by).agg(F.avg(value).alias("synthetic"))
    b = benchmark.groupBy(by).agg(F.avg(value).alias("benchmark"))
    return s.join(b, by, "full").withColumn("difference", F.col("synthetic") - F.col("benchmark"))


# Prompt templates and answer codes.
TEMPLATES = {
    "zero_shot": "Classify the sentiment of this text as -1, 0 or 1: {text}",
    "few_shot": "Classify the sentiment of this text as -1, 0 or 1.\n{examples}\nText: {text}",
    "role": "You are an expert annotator. Classify the sentiment of this text as -1, 0 or 1: {text}",
}
ANSWER_LABELS = {-1: "negative", 0: "neutral", 1: "positive"}


def prompt_template(df: DataFrame, kind: str, text: str = "text", examples: str | None = None,
                    out: str = "prompt") -> DataFrame:
    """Zero-shot, few-shot (with an examples column) or role prompt."""
    t = TEMPLATES[kind]
    pre, post = t.split("{text}")
    if "{examples}" in pre:
        a, b = pre.split("{examples}")
        head = F.concat(F.lit(a), F.coalesce(F.col(examples), F.lit("")), F.lit(b))
    else:
        head = F.lit(pre)
    return df.withColumn(out, F.concat(head, F.col(text), F.lit(post)))


def answer_label(code: Column | str) -> Column:
    """Answer code −1/0/1 → label (other codes → NULL)."""
    c = F.col(code) if isinstance(code, str) else code
    e = None
    for k, v in ANSWER_LABELS.items():
        e = F.when(c == k, v) if e is None else e.when(c == k, v)
    return e
