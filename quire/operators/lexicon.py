"""Dictionaries and ready-made scores.

A dictionary is a table ``(category, pattern, weight)``; a pattern ending in
``*`` matches every token with that prefix. Patterns are resolved **once
against the vocabulary** (distinct terms), exact ones by an equi-join and
prefix ones by an equi-join on the term's prefix of each pattern length — no
non-equi join — and the resulting ``term → category`` map is joined to the
dfm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from pyspark.sql import types as T

from . import tokens as TK


def dictionary_table(spark: SparkSession, entries: Mapping[str, Iterable[str]],
                     weights: Mapping[str, float] | None = None) -> DataFrame:
    """Build ``(category, pattern, weight, is_prefix)`` from ``{category: [patterns]}``."""
    rows = []
    for cat, pats in entries.items():
        for p in pats:
            p = p.lower()
            w = float((weights or {}).get(p, 1.0))
            rows.append((cat, p.rstrip("*"), w, p.endswith("*")))
    schema = "category string, pattern string, weight double, is_prefix boolean"
    return spark.createDataFrame(rows, schema)


def dictionary_closure(dictionary: DataFrame, parents: DataFrame) -> DataFrame:
    """M7: add every ancestor category of each entry (``parents``:
    ``(category, parent)``), so sub-category matches roll up. Levels are added
    until one has no entry; a cycle of categories is an error."""
    limit = parents.select("category").distinct().count()
    out = level = dictionary
    for depth in range(limit + 1):
        level = level.join(parents, "category").drop("category").withColumnRenamed("parent", "category")
        level = cut_lineage(level.select(*dictionary.columns).distinct(), "closure")
        if level.isEmpty():
            return out.distinct()
        out = out.unionByName(level)
    raise ValueError("the categories have a cycle")


def resolve(vocab: DataFrame, dictionary: DataFrame, term: str = "term") -> DataFrame:
    """Map vocabulary terms to categories: ``(term, category, weight)``.

    A term matched by several patterns of one category keeps the largest
    weight once (a token counts once per category).
    """
    v = vocab.select(term).distinct()
    exact = dictionary.filter(~F.col("is_prefix"))
    prefix = dictionary.filter(F.col("is_prefix")).withColumn("_len", F.char_length("pattern"))
    m1 = v.join(exact, v[term] == exact["pattern"]).select(term, "category", "weight")
    lens = prefix.select("_len").distinct()
    # each vocabulary term is cut at the (few) distinct prefix lengths → equi-join
    cut = v.join(F.broadcast(lens), F.char_length(term) >= F.col("_len")) \
        .withColumn("_pre", F.substring(term, 1, F.col("_len")))
    m2 = cut.join(prefix, (cut["_pre"] == prefix["pattern"]) & (cut["_len"] == prefix["_len"])) \
        .select(term, "category", "weight")
    return m1.unionByName(m2).groupBy(term, "category").agg(F.max("weight").alias("weight"))


def lookup(d: DataFrame, dictionary: DataFrame, keys: Iterable[str] = ("doc_id",),
           term: str = "term") -> DataFrame:
    """M2/M8: dictionary counts per document, long ``(keys…, category, n)``."""
    keys = list(keys)
    m = resolve(d.select(term), dictionary, term)
    j = d.join(m, term)
    return j.groupBy(*keys, "category").agg(F.sum("n").alias("n"))


def lookup_wide(docs: DataFrame, d: DataFrame, dictionary: DataFrame, categories: list[str],
                keys: Iterable[str] = ("doc_id",), term: str = "term") -> DataFrame:
    """M2: one column per category (in the given order), every document kept
    with zeros where nothing matched."""
    keys = list(keys)
    long = lookup(d, dictionary, keys, term)
    wide = long.groupBy(*keys).pivot("category", categories).agg(F.first("n"))
    out = docs.select(*keys).join(wide, keys, "left").na.fill(0, subset=categories)
    return out.select(*keys, *[F.col(c).cast("long").alias(c) for c in categories])


def count_in_rows(arrays: DataFrame, entries: Mapping[str, Iterable[str]], keep: Iterable[str] = ("doc_id",),
                  col: str = "toks") -> DataFrame:
    """M2 for a dictionary stated in the program: one column per category,
    counted inside each row's token array (no join, no shuffle). Patterns as in
    :func:`dictionary_table`; a token counts once per category."""
    import re

    def counted(patterns: Iterable[str]) -> Column:
        exact = [p for p in patterns if not p.endswith("*")]
        prefixes = "|".join(re.escape(p[:-1]) for p in patterns if p.endswith("*"))
        hit = {"exact": lambda t: t.isin(exact), "prefix": lambda t: t.rlike(f"^(?:{prefixes})"),
               "both": lambda t: t.isin(exact) | t.rlike(f"^(?:{prefixes})")}
        return F.size(F.filter(col, hit["both" if exact and prefixes else "exact" if exact else "prefix"])).cast("long")

    counts = [counted(list(patterns)).alias(category) for category, patterns in entries.items()]
    return arrays.select(*keep, *counts)


def polarity(pos: Column | str, neg: Column | str, smooth: float = 0.5) -> Column:
    """M1: log((pos + s) / (neg + s)); defined for all counts ≥ 0."""
    p = F.col(pos) if isinstance(pos, str) else pos
    n = F.col(neg) if isinstance(neg, str) else neg
    return F.ln((p + smooth) / (n + smooth))


def label_by_sign(score: Column | str, positive: str = "Positive", negative: str = "Negative") -> Column:
    """M5: label from the sign of a score; 0 gets NULL (no neutral branch)."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > 0, positive).when(s < 0, negative)


def tone(d: DataFrame, dictionary: DataFrame, keys: Iterable[str] = ("doc_id",), term: str = "term",
         decimals: int = 12) -> DataFrame:
    """M6: weighted tone Σ n·w / Σ n over dictionary words, per document.

    Weights are summed as decimals, so a sum doesn't depend on the order of
    its parts; ``decimals`` places hold any weight that a dictionary states.
    """
    keys = list(keys)
    m = resolve(d.select(term), dictionary, term).groupBy(term).agg(F.avg("weight").alias("weight"))
    j = d.join(m, term).withColumn("_wi", F.col("weight").cast(f"decimal(24,{decimals})"))
    g = j.groupBy(*keys).agg(F.sum(F.col("n").cast("decimal(12,0)") * F.col("_wi")).alias("_s"), F.sum("n").alias("n_dict"))
    return g.select(*keys, "n_dict", (F.col("_s").cast("double") / F.col("n_dict")).alias("tone"))


# ---- VADER-style valence scoring ---------------------------------------------------------

# VADER constants (booster increment, negation scalar, caps
# emphasis, exclamation increment and cap, normalisation alpha).
B_INCR = 0.293
N_SCALAR = -0.74
CAPS_INCR = 0.733
EXCL_INCR = 0.292
EXCL_MAX = 4
# ... question marks (two or three: each; more: in all), words before and after "but"
QUEST_INCR = 0.18
QUEST_MAX = 0.96
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
ALPHA = 15.0


def _shift(arr: Column, k: int) -> Column:
    """Array shifted right by ``k`` (NULL-padded), same length as ``arr``."""
    size = F.size(arr)
    pad = F.array_repeat(F.lit(None).cast("string"), F.least(F.lit(k), size))
    return F.concat(pad, F.slice(arr, F.lit(1), F.greatest(size - k, F.lit(0))))


def _marks(text: Column, questions: bool) -> Column:
    """What exclamation (and question) marks add."""
    out = F.least(F.regexp_count(text, F.lit("!")), F.lit(EXCL_MAX)) * EXCL_INCR
    if questions:
        n = F.regexp_count(text, F.lit("[?]"))
        out = out + F.when(n < 2, 0.0).when(n <= 3, n * QUEST_INCR).otherwise(QUEST_MAX)
    return out


def vader(c: DataFrame, lexicon: Mapping[str, float], boosters: Mapping[str, float] | None = None,
          negations: Iterable[str] = (), keys: Iterable[str] = ("doc_id",), text: str = "text",
          but: str | None = None, questions: bool = False) -> DataFrame:
    """M9: valence scores per text → ``compound, pos, neu, neg``.

    but: a word (such as ``but``) after whose first occurrence valences count
    half as much again and before which they count half. questions: two or three
    question marks add 0.18 each, more 0.96 in all, in the direction of the sum.

    Rules: word valence from ``lexicon``; a negation among the three previous
    tokens multiplies by −0.74; boosters (value +1 increases, −1 dampens) in
    the three previous tokens add ±0.293 (scaled 1, 0.95, 0.9) in the
    valence's direction; an all-caps word in
    a text that is not all caps adds ±0.733; ``!`` (at most 4) add 0.292 each
    in the direction of the sum; compound = x / √(x² + 15).

    Lexicons are bounded literal maps; the look-back uses shifted copies of the
    token array, so each text is scored in its own row (no shuffle).
    """
    keys = list(keys)
    lex = F.create_map(*[x for k, v in lexicon.items() for x in (F.lit(k.lower()), F.lit(float(v)))])
    boosters = boosters or {}
    bst = F.create_map(*[x for k, v in boosters.items() for x in (F.lit(k.lower()), F.lit(float(v)))]) \
        if boosters else None
    negs = [n.lower() for n in negations]
    raw = F.regexp_extract_all(F.col(text), F.lit(TK.WORD), 0)
    base = c.select(*keys, raw.alias("_raw"),
                    (F.upper(F.col(text)) == F.col(text)).alias("_allcaps"),
                    _marks(F.col(text), questions).alias("_excl"))
    low = F.transform("_raw", lambda x: F.lower(x))
    z = F.arrays_zip(F.col("_raw").alias("w"), low.alias("t"),
                     _shift(low, 1).alias("p1"), _shift(low, 2).alias("p2"), _shift(low, 3).alias("p3"))

    def score(e):
        v = F.coalesce(F.try_element_at(lex, e["t"]), F.lit(0.0))
        sign = F.signum(v)
        caps = F.when((e["w"] == F.upper(e["w"])) & (e["w"] != F.lower(e["w"])) & ~F.col("_allcaps"),
                      CAPS_INCR * sign).otherwise(0.0)
        boost = F.lit(0.0)
        if bst is not None:
            for p, scale in (("p1", 1.0), ("p2", 0.95), ("p3", 0.9)):
                boost = boost + F.coalesce(F.try_element_at(bst, e[p]), F.lit(0.0)) * B_INCR * scale * sign
        neg = F.lit(False)
        for p in ("p1", "p2", "p3"):
            neg = neg | F.coalesce(e[p].isin(negs), F.lit(False)) if negs else neg
        val = v + caps + boost
        return F.when(v == 0, F.lit(0.0)).otherwise(F.when(neg, val * N_SCALAR).otherwise(val))

    valences = F.transform(z, score)
    if but is not None:
        both = F.array(F.struct(valences.alias("v"), F.array_position(low, F.lit(but.lower())).alias("at")))  # each computed once
        valences = F.element_at(F.transform(both, lambda s: F.transform(s["v"], lambda v, i: F.when(
            (s["at"] == 0) | (i + 1 == s["at"]), v).when(i + 1 < s["at"], v * BUT_BEFORE).otherwise(v * BUT_AFTER))), 1)
    scored = base.select(*keys, "_excl", valences.alias("_v"))
    total = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x)
    pos = F.aggregate("_v", F.lit(0.0), lambda a, x: a + F.when(x > 0, x + 1).otherwise(0.0))
    negs_ = F.aggregate("_v", F.lit(0.0), lambda a, x: a + F.when(x < 0, x - 1).otherwise(0.0))
    neu = F.size(F.filter("_v", lambda x: x == 0)).cast("double")
    s = scored.select(*keys, total.alias("_t"), pos.alias("_p"), negs_.alias("_n"), neu.alias("_u"), "_excl")
    excl_mag = F.col("_excl")
    t = F.col("_t") + F.signum("_t") * excl_mag
    compound = t / F.sqrt(t * t + ALPHA)
    p = F.col("_p") + F.when(F.col("_p") > F.abs("_n"), excl_mag).otherwise(0.0)
    n = F.abs("_n") + F.when(F.abs("_n") > F.col("_p"), excl_mag).otherwise(0.0)
    tot = p + n + F.col("_u")
    return s.select(*keys, compound.alias("compound"), F.try_divide(p, tot).alias("pos"),
                    F.try_divide(F.col("_u"), tot).alias("neu"), F.try_divide(n, tot).alias("neg"))


def threshold(score: Column | str, cut: float = 0.0) -> Column:
    """Class 1 when score > cut, else 0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > cut, 1).otherwise(0)


def score_table(df: DataFrame, fn: Callable[[pd.Series], pd.DataFrame], text: str,
                out_schema: str, keys: Iterable[str] = ("doc_id",), max_tokens: int | None = None) -> DataFrame:
    """Score a text column with a user function, batch by batch
    (``mapInPandas``). A failing batch is retried row by row; a failing row
    keeps NULL scores and the error message in ``error`` ("safe output").
    ``max_tokens`` cuts each text to its first N blank-separated tokens before
    scoring (models with a length limit); the table itself is never cut.
    """
    keys = list(keys)
    fields = [f.strip().split()[0] for f in out_schema.split(",")]
    schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keys] + [out_schema, "error string"])

    def run(it):
        for pdf in it:
            texts = pdf[text].fillna("")
            if max_tokens:
                texts = texts.map(lambda s: " ".join(s.split()[:max_tokens]))
            try:
                res = fn(texts).reset_index(drop=True)
                res["error"] = None
            except Exception:  # noqa: BLE001 - per-row retry below
                rows = []
                for s in texts:
                    try:
                        r = fn(pd.Series([s])).iloc[0].to_dict()
                        r["error"] = None
                    except Exception as e:  # noqa: BLE001
                        r = {f: None for f in fields}
                        r["error"] = f"{type(e).__name__}: {e}"
                    rows.append(r)
                res = pd.DataFrame(rows, columns=fields + ["error"])
            out = pd.concat([pdf[keys].reset_index(drop=True), res[fields + ["error"]]], axis=1)
            yield out

    return df.select(*keys, text).mapInPandas(run, schema)
