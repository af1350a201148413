"""Tokens and preprocessing.

Two shapes, both keyed by the document id:

* token arrays ``(doc_id, toks ARRAY<STRING>)`` — one row per document, built
  without a shuffle; n-grams and windows are computed on them in place;
* long tokens ``(doc_id, pos, term)`` — canonical for joins and counts; ``pos``
  is the 1-based position in the *original* text, so removing tokens leaves
  pads and neighbours stay non-adjacent.

Fixed word lists are applied with ``isin`` (a hashed ``InSet``), not joins.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import strip_html

# Token patterns (Java regex; identical in RE2 for the SQL oracle).
WORD = r"[\p{L}\p{M}\p{N}]+(?:['’][\p{L}\p{M}\p{N}]+)*"
URL = r"(?:https?://|www\.)[^\s<>\"']+"
OTHER = r"[^\s\p{L}\p{M}\p{N}]"
SENTENCE = r"[^\s.!?][^.!?]*(?:[.!?]+|$)"
NUMBER = r"^[\p{N}]+(?:[.,][\p{N}]+)*$"
PUNCT = r"^\p{P}+$"
SYMBOL = r"^\p{S}+$"
HAS_DIGIT = r"[0-9]"

# English stop words (function words), lower case, apostrophes as typed.
STOPWORDS_EN = (
    "a about above after again against all am an and any are aren't as at be because been "
    "before being below between both but by can't cannot could couldn't did didn't do does "
    "doesn't doing don't down during each few for from further had hadn't has hasn't have "
    "haven't having he he'd he'll he's her here here's hers herself him himself his how how's "
    "i i'd i'll i'm i've if in into is isn't it it's its itself let's me more most mustn't my "
    "myself no nor not of off on once only or other ought our ours ourselves out over own same "
    "shan't she she'd she'll she's should shouldn't so some such than that that's the their "
    "theirs them themselves then there there's these they they'd they'll they're they've this "
    "those through to too under until up very was wasn't we we'd we'll we're we've were weren't "
    "what what's when when's where where's which while who who's whom why why's with won't "
    "would wouldn't you you'd you'll you're you've your yours yourself yourselves"
).split()

# German, French and Spanish function words (short lists).
STOPWORDS_DE = ("aber alle als also am an auch auf aus bei bin bis bist da dann das dass dem den "
                "der des die dies doch du durch ein eine einem einen einer es für hat hatte ich ihr im "
                "in ist ja kein man mit nach nicht noch nur oder sich sie sind so über um und uns von "
                "vor war was wie wir zu zum zur").split()
STOPWORDS_FR = ("au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais "
                "me même mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur "
                "ta te tes toi ton tu un une vos votre vous").split()
STOPWORDS_ES = ("a al algo como con de del el ella en era es esta este fue ha la las le lo los más "
                "me mi muy no nos o para pero por que se sin su sus también te tu un una y ya").split()

STOPWORDS = {"en": STOPWORDS_EN, "de": STOPWORDS_DE, "fr": STOPWORDS_FR, "es": STOPWORDS_ES}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_pattern(keep_punct: bool = False, keep_url: bool = True) -> str:
    """Alternation used to cut text: URLs first (so they stay whole), then words,
    then (optionally) each other non-blank character."""
    parts = ([URL] if keep_url else []) + [WORD] + ([OTHER] if keep_punct else [])
    return "|".join(f"(?:{p})" for p in parts) if len(parts) > 1 else parts[0]


def token_arrays(df: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",),
                 lower: bool = True, pattern: str = WORD, out: str = "toks") -> DataFrame:
    """Token array per document (narrow: no shuffle), computed once per row
    (see :func:`pin`)."""
    t = _c(text)
    t = F.lower(t) if lower else t
    return pin(df.select(*keys, F.regexp_extract_all(t, F.lit(pattern), 0).alias(out)), out)


def pin(df: DataFrame, col: str) -> DataFrame:
    """Compute ``col`` once per row before several expressions read it.

    Expressions that slice one array many times (n-grams, windows, look-backs)
    would otherwise re-run the tokenizer for each slice once the optimizer
    inlines the projection; a one-element generator keeps it materialised.
    """
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(F.array(F.col(col))).alias(col))


def explode_tokens(arrays: DataFrame, keys: Iterable[str] = ("doc_id",), col: str = "toks",
                   out: str = "term") -> DataFrame:
    """Token arrays → long tokens ``(keys…, pos, term)`` with 1-based ``pos``."""
    ex = arrays.select(*keys, F.posexplode(col).alias("pos", out))
    return ex.withColumn("pos", (F.col("pos") + 1).cast("int"))


def tokens(df: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",),
           lower: bool = False, remove_punct: bool = False, remove_numbers: bool = False,
           remove_symbols: bool = False, remove_url: bool = False,
           keep_punct: bool = True) -> DataFrame:
    """Word tokens in order; by default nothing is removed and
    punctuation is kept as tokens. Each ``remove_*`` flag drops a token class
    but keeps the original positions (pads)."""
    keys = list(keys)
    pat = token_pattern(keep_punct=keep_punct or remove_punct or remove_symbols, keep_url=True)
    long = explode_tokens(token_arrays(df, text, keys, lower, pat), keys)
    term = F.col("term")
    drop = F.lit(False)
    if remove_punct:
        drop = drop | term.rlike(PUNCT)
    if remove_symbols:
        drop = drop | term.rlike(SYMBOL)
    if remove_numbers:
        drop = drop | term.rlike(NUMBER)
    if remove_url:
        drop = drop | term.rlike("^" + URL + "$")
    return long.filter(~drop) if (remove_punct or remove_symbols or remove_numbers or remove_url) else long


def unnest_tokens(df: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",),
                  out: str = "term") -> DataFrame:
    """Tidy tokenizer — lower case, punctuation dropped, one row per token."""
    keys = list(keys)
    return explode_tokens(token_arrays(df, text, keys, True, WORD), keys, out=out)


def sentence_arrays(df: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",),
                    lower: bool = True) -> DataFrame:
    """Sentences per document: runs of text closed by ``.``, ``!`` or ``?``
    (terminators kept), trimmed."""
    t = _c(text)
    t = F.lower(t) if lower else t
    s = F.regexp_extract_all(t, F.lit(SENTENCE), 0)
    return df.select(*keys, F.transform(s, lambda x: F.trim(x)).alias("sents"))


def unnest_sentences(df: DataFrame, text: str = "text", keys: Iterable[str] = ("doc_id",),
                     lower: bool = True) -> DataFrame:
    """One row per sentence ``(keys…, pos, sentence)``."""
    keys = list(keys)
    return explode_tokens(sentence_arrays(df, text, keys, lower), keys, col="sents", out="sentence")


def ngram_array(toks, n: int, sep: str = " ") -> Column:
    """n-grams of an array column; arrays shorter than ``n`` give an empty array.

    Built from ``n`` shifted slices merged by ``zip_with``, so the input array
    is evaluated a fixed number of times (never once per element).
    """
    toks = _c(toks)
    if n == 1:
        return toks
    k = F.greatest(F.size(toks) - F.lit(n - 1), F.lit(0))
    acc = F.slice(toks, F.lit(1), k)
    for j in range(1, n):
        acc = F.zip_with(acc, F.slice(toks, F.lit(j + 1), k), lambda x, y: F.concat(x, F.lit(sep), y))
    return acc


def unnest_ngrams(df: DataFrame, n: int = 2, text: str = "text", keys: Iterable[str] = ("doc_id",),
                  sep: str = " ", out: str = "ngram") -> DataFrame:
    """I4: word n-grams as rows ``(keys…, pos, ngram)``; ``pos`` is the start."""
    keys = list(keys)
    arr = pin(token_arrays(df, text, keys, True, WORD), "toks")
    g = arr.select(*keys, ngram_array("toks", n, sep).alias("grams"))
    return explode_tokens(g, keys, col="grams", out=out)


def tokens_ngrams(arrays: DataFrame, n: int | Iterable[int] = 2, keys: Iterable[str] = ("doc_id",),
                  col: str = "toks", sep: str = "_") -> DataFrame:
    """N-grams of an (already filtered) token array, joined by ``_``;
    several sizes at once give one array holding all of them (sizes in order)."""
    keys = list(keys)
    ns = [n] if isinstance(n, int) else list(n)
    arrays = pin(arrays, col)
    parts = [ngram_array(col, k, sep) for k in ns]
    allg = parts[0] if len(parts) == 1 else F.flatten(F.array(*parts))
    return arrays.select(*keys, allg.alias(col))


def filter_array(arrays: DataFrame, col: str = "toks", drop: Iterable[str] = (),
                 drop_pattern: str | None = None) -> DataFrame:
    """Remove listed words (hashed set) and/or pattern matches from a token array,
    re-indexing the survivors (as quanteda does without padding)."""
    words = list(drop)

    def keep(x):
        k = F.lit(True)
        if words:
            k = k & ~x.isin(words)
        if drop_pattern:
            k = k & ~x.rlike(drop_pattern)
        return k
    return arrays.withColumn(col, F.filter(col, keep))


def remove_stopwords(toks: DataFrame, words: Iterable[str] | DataFrame = STOPWORDS_EN,
                     term: str = "term") -> DataFrame:
    """I8 / D3: drop stop words from long tokens (positions kept).

    A fixed list becomes a hashed ``InSet`` filter (no join at all); a stop-word
    table is removed by a left-anti join that the planner may broadcast once its
    measured size is small (AQE).
    """
    if isinstance(words, DataFrame):
        w = words.select(F.col(words.columns[0]).alias(term)).distinct()
        return toks.join(w, term, "left_anti")
    return toks.filter(~F.col(term).isin(list(words)))


def drop_digits(toks: DataFrame, term: str = "term") -> DataFrame:
    """Drop tokens holding a digit."""
    return toks.filter(~F.col(term).rlike(HAS_DIGIT))


def tokens_select(toks: DataFrame, features: DataFrame | Iterable[str], term: str = "term") -> DataFrame:
    """Keep only listed features; original ``pos`` kept (padding)."""
    if isinstance(features, DataFrame):
        f = features.select(F.col(features.columns[0]).alias(term)).distinct()
        return toks.join(f, term, "left_semi")
    return toks.filter(F.col(term).isin(list(features)))


def tokens_compound(arrays: DataFrame, phrases: Iterable[str], col: str = "toks",
                    sep: str = "_", keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Join given multi-word expressions into one token (longest first,
    left first), on token arrays. ``phrases`` is a fixed list of blank-separated
    phrases."""
    keys = list(keys)
    phrases = sorted({p.lower() for p in phrases}, key=lambda p: (-len(p.split()), p))
    # Match on a joined string with unit separators so phrase boundaries are exact.
    joined = F.concat(F.lit("\u001f"), F.array_join(col, "\u001f"), F.lit("\u001f"))
    for p in phrases:
        words = p.split()
        if len(words) < 2:
            continue
        src = "\u001f" + "\u001f".join(words) + "\u001f"
        dst = "\u001f" + sep.join(words) + "\u001f"
        # replace repeatedly to catch overlapping neighbours sharing a separator
        joined = F.replace(F.replace(joined, F.lit(src), F.lit(dst)), F.lit(src), F.lit(dst))
    inner = F.expr("substring(_j, 2, length(_j) - 2)")
    out = arrays.withColumn("_j", joined)
    out = out.withColumn(col, F.when(F.length("_j") > 2, F.split(inner, "\u001f")).otherwise(F.array().cast("array<string>")))
    return out.drop("_j")


def kwic(arrays: DataFrame, pattern: str, window: int = 5, keys: Iterable[str] = ("doc_id",),
         col: str = "toks") -> DataFrame:
    """Keyword in context — for each token matching ``pattern`` its
    position and the ``window`` tokens before and after, cut out of the
    document's token array (no join, no shuffle)."""
    places = F.filter(F.transform(col, lambda t, i: F.when(t.rlike(pattern), i + 1)), lambda p: p.isNotNull())
    hits = arrays.select(*keys, col, F.explode(places).alias("pos"))
    before = F.least(F.col("pos") - 1, F.lit(window))
    return hits.select(*keys, "pos", F.element_at(F.col(col), F.col("pos")).alias("keyword"),
                       F.array_join(F.slice(col, F.col("pos") - before, before), " ").alias("pre"),
                       F.array_join(F.slice(col, F.col("pos") + 1, window), " ").alias("post"))


def strip_html_table(df: DataFrame, col: str = "html", out: str = "text") -> DataFrame:
    """I16 on a table."""
    return df.withColumn(out, strip_html(col))


def lemmatize(toks: DataFrame, lemmas: DataFrame, term: str = "term") -> DataFrame:
    """Replace tokens by a lemma from a user table ``(term, lemma)``;
    tokens without a lemma are kept as they are."""
    lm = lemmas.select(F.col("term").alias("_t"), F.col("lemma").alias("_l"))
    j = toks.join(lm, toks[term] == lm["_t"], "left")
    return j.withColumn(term, F.coalesce(F.col("_l"), F.col(term))).drop("_t", "_l")


def collocations(arrays: DataFrame, col: str = "toks", min_count: int = 2,
                 smoothing: float = 0.5) -> DataFrame:
    """Adjacent word pairs scored by λ (log odds ratio of the 2×2
    table of first/second word, each cell + ``smoothing``), its z statistic and
    PMI.

    Pairs are formed inside each document's array (no shuffle). A word's
    margins are its counts but for texts' last (first) tokens, so neither the margins nor
    the total need the pairs. Pairs are counted by 64-bit hashes of their words where
    no two words share one (checked), else by the words, in one aggregate
    that is not stored; kept pairs get their words and margins by a join each.
    """
    from ..session import cut_lineage
    arrays = pin(arrays.select(col), col)
    k = F.size(col)
    told = arrays.select(F.posexplode(col).alias("_i", "term"), k.alias("_k"))
    margins = cut_lineage(told.groupBy("term").agg(
        F.sum(F.when(F.col("_i") < F.col("_k") - 1, 1).otherwise(0)).alias("n1_"),
        F.sum(F.when(F.col("_i") > 0, 1).otherwise(0)).alias("n_1")).withColumn("h", F.xxhash64("term")), "word-margins")
    n_words, n_hashes, n_all = margins.agg(F.count(F.lit(1)), F.count_distinct("h"), F.sum("n1_")).first()
    key = (lambda x: F.xxhash64(x)) if n_words == n_hashes else (lambda x: x)
    coded = pin(arrays.select(F.transform(col, key).alias("_h")), "_h")
    last = F.greatest(F.size("_h") - 1, F.lit(0))
    pairs = coded.select(F.explode(F.arrays_zip(F.slice("_h", F.lit(1), last).alias("a"), F.slice("_h", F.lit(2), last).alias("b"))).alias("_p"))
    counts = pairs.groupBy(F.col("_p.a").alias("_a"), F.col("_p.b").alias("_b")).agg(F.count(F.lit(1)).alias("n11")).where(F.col("n11") >= min_count)
    by = "h" if n_words == n_hashes else "term"
    t = (counts.join(margins.select(F.col(by).alias("_a"), F.col("term").alias("w1"), "n1_"), "_a")
         .join(margins.select(F.col(by).alias("_b"), F.col("term").alias("w2"), "n_1"), "_b"))
    n_all = F.lit(int(n_all or 0))
    s = F.lit(float(smoothing))
    a = F.col("n11") + s
    b = F.col("n1_") - F.col("n11") + s
    c = F.col("n_1") - F.col("n11") + s
    d = n_all - F.col("n1_") - F.col("n_1") + F.col("n11") + s
    lam = F.ln(a) + F.ln(d) - F.ln(b) - F.ln(c)
    se = F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    pmi = F.ln(F.col("n11") * n_all / (F.col("n1_") * F.col("n_1")))
    return t.select(F.concat_ws(" ", "w1", "w2").alias("collocation"), F.col("n11").alias("count"),
                    lam.alias("lambda"), (lam / se).alias("z"), pmi.alias("pmi"))


def _stemmer(lang: str):
    from ..functions.snowball import STEMMERS
    from ..functions.stemmer import porter
    if lang != "en" and lang not in STEMMERS:
        raise ValueError(f"no stemmer for {lang!r}; there are en, {', '.join(STEMMERS)}")
    return porter if lang == "en" else STEMMERS[lang]


def stem_map(terms: DataFrame, term: str = "term", lang: str = "en") -> DataFrame:
    """``(term, stem)`` for the distinct terms of ``terms``, by the rules of
    a language (en, de, es, fr, pt), computed once per vocabulary entry in Arrow batches."""
    rules = _stemmer(lang)

    def stems(s: pd.Series) -> pd.Series:
        return s.map(rules)

    v = terms.select(term).distinct()
    return v.select(term, F.pandas_udf(stems, "string")(F.col(term)).alias("stem"))


def tokens_wordstem(toks: DataFrame, term: str = "term", lang: str = "en") -> DataFrame:
    """Replace each token by its stem (positions kept). The stem map is
    built on the vocabulary and joined back (AQE broadcasts it when small)."""
    m = stem_map(toks, term, lang)
    return toks.join(m, term).withColumn(term, F.col("stem")).drop("stem")
