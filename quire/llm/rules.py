"""Quality rules by weak supervision.

Each rule looks at counts of one text and votes: 1 (good), -1 (bad) or 0 (no
opinion). Nobody knows how far a rule can be trusted, so that is estimated
without labels: expectation-maximisation for a model in which every text is
good or bad, and each rule votes by probabilities of its own for either. The
posterior probability that a text is good replaces the filter that all rules
must pass.

The model needs of the corpus only how often each pattern of votes occurs:
at most 3^rules rows, counted over all texts by Spark, so its size doesn't
depend on the corpus. The posterior is a function of the pattern and is
joined back by it.

Counts of a text (words are runs of anything but ASCII white space):
n_words; word_chars (code points in words); n_symbols (of ``#*$%&|<>``);
n_dup_lines (lines with a word that equal an earlier one); n_repeat_words
(words in five-word windows that occur twice or more, the first time
included); n_upper (words without lower-case
ASCII, at least two upper-case); n_lines (with a word); n_same (words equal to the
word before); n_plain (words of letters and bytes beyond ASCII, a full stop or
comma may follow); n_distinct (different words).

Null texts have no words; empty texts and texts of blanks likewise; texts with
fewer than five words have no windows; repeated rows are judged alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored, table, texts, utf8, with_arrow

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
MULTIPLIER = 0x9E3779B97F4A7C15
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_same",
          "n_plain", "n_distinct"]

#: (name, bad if, good if): conditions on the counts; a rule abstains where neither holds. That a
#: text lacks one fault says little, so rules for a fault don't vote good; "prose" asks for all signs at once.
RULES = (
    ("length", "n_words < 10", "n_words >= 50"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words", "false"),
    ("symbols", "20 * n_symbols > n_words", "false"),
    ("plain", "10 * n_plain < 6 * n_words", "10 * n_plain >= 9 * n_words"),
    ("dup_lines", "10 * n_dup_lines > 3 * n_lines", "false"),
    ("repeats", "100 * n_repeat_words > 20 * n_words", "false"),
    ("shouting", "10 * n_upper > 3 * n_words", "false"),
    ("stutter", "20 * n_same > n_words and n_words >= 10", "false"),
    ("distinct", "10 * n_distinct < n_words and n_words >= 20", "false"),
    ("prose", "false", "n_words >= 20 and n_symbols = 0 and 50 * n_upper <= n_words and 100 * n_same <= 3 * n_words "
                       "and 10 * n_distinct >= 3 * n_words"),
)
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
ROUNDS, TOLERANCE = 200, 1e-9
#: Strength of the prior on accuracies, in votes.
PRIOR = 20.0


def _windows(words: list[bytes]) -> int:
    """Words in five-word windows that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        key = (key ^ h[j:j + n]) * np.uint64(MULTIPLIER)
        key ^= key >> np.uint64(31)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    # equal hashes are looked up: a window counts only if its words are equal
    seen: dict[tuple, int] = {}
    at = np.flatnonzero(twice).tolist()
    grams = [tuple(words[i:i + WINDOW]) for i in at]
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    ends = np.zeros(len(words) + 1, np.int64)
    for i, g in zip(at, grams, strict=True):
        if seen[g] > 1:
            ends[i] += 1
            ends[i + WINDOW] -= 1
    return int((np.cumsum(ends)[:-1] > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """n_words, n_dup_lines, n_repeat_words, n_upper, n_lines, n_same, n_plain, n_distinct of one text."""
    words = text.split()  # of bytes: at ASCII white space only
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = sum(1 for w in words if w.isupper() and sum(65 <= c <= 90 for c in w) > 1)
    same = sum(map(bytes.__eq__, words[1:], words))
    return (len(words), len(lines) - len(set(lines)), _windows(words), upper, len(lines), same,
            len(_PLAIN.findall(text)), len(set(words)))


_PLAIN = re.compile(rb"(?<![^ \t-\r])[A-Za-z\x80-\xff]+[.,]?(?![^ \t-\r])")
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
#: Bytes that begin a code point of a word: neither ASCII white space nor a continuation.
_IS_CHAR = np.array([not (c == 32 or 9 <= c <= 13 or 0x80 <= c < 0xC0) for c in range(256)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, offsets = utf8(b.column(1))
        per = np.array([counts_of(t) for t in texts(b.column(1))], dtype=np.int64).reshape(-1, 8)
        found = dict(zip(["n_words", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", "n_same",
                          "n_plain", "n_distinct"], per.T, strict=True))
        found["word_chars"] = _per_text(_IS_CHAR[raw], offsets)
        found["n_symbols"] = _per_text(_IS_SYMBOL[raw], offsets)
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(found[c]) for c in COUNTS]], names=["id", *COUNTS])


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, counts...) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return with_arrow(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")), _count,
                      f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def votes(rules=RULES) -> list[Column]:
    """A column per rule: 1, -1 or 0."""
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).alias(f"vote_{name}") for name, bad, good in rules]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns (rows of -1, 0, 1) and how often each occurs.
    Returns the posterior probability of good for each pattern, the accuracies
    [bad/good, rule] (how often a rule that votes is right, for bad and for
    good texts) and the share of good texts. An abstention says nothing.

    The start (most texts good, every rule mostly right) and a prior of
    ``PRIOR`` votes for each accuracy, mostly right too, give the two classes their meaning."""
    bad, good = (patterns == -1).astype(float), (patterns == 1).astype(float)
    right = np.array([[0.7] * patterns.shape[1], [0.95] * patterns.shape[1]])
    share, before = 0.85, -np.inf
    post = np.full(len(patterns), share)
    for _ in range(rounds):
        logs = np.stack([bad @ np.log(right[0]) + good @ np.log(1 - right[0]) + np.log(1 - share),
                         good @ np.log(right[1]) + bad @ np.log(1 - right[1]) + np.log(share)])
        top = logs.max(axis=0)
        both = np.exp(logs - top)
        post = both[1] / both.sum(axis=0)
        fit = float((counts * (top + np.log(both.sum(axis=0)))).sum())
        weights = (counts * (1 - post), counts * post)
        for k, (w, hit, miss, start) in enumerate(zip(weights, (bad, good), (good, bad), (0.7, 0.95), strict=True)):
            right[k] = (w @ hit + PRIOR * start) / (w @ (hit + miss) + PRIOR)
        share = float(np.clip((weights[1].sum() + 0.85 * PRIOR) / (counts.sum() + PRIOR), 1e-6, 1 - 1e-6))
        if fit - before <= TOLERANCE * max(1.0, abs(fit)):
            break
        before = fit
    return post, right, share


def judge(counts: DataFrame, rules=RULES) -> DataFrame:
    """Measured rows with ``p_good`` and the votes. ``counts`` is read twice, so
    it should be a stored table."""
    names = [f"vote_{r[0]}" for r in rules]
    voted = counts.select("*", *votes(rules))
    # at most 3^rules rows, whatever the corpus is
    seen = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()
    if not seen:
        return voted.withColumn("p_good", F.lit(None).cast("double"))
    patterns = np.array([[r[c] for c in names] for r in seen], dtype=np.int64)
    post, _, _ = estimate(patterns, np.array([r["n"] for r in seen], dtype=float))
    rows = [(*map(int, p), float(q)) for p, q in zip(patterns, post, strict=True)]
    found = counts.sparkSession.createDataFrame(rows, ", ".join(f"{c} int" for c in names) + ", p_good double")
    return voted.join(F.broadcast(found), names)


def op8_quality_rules(spark, sf_dir):
    """Counts, base verdict and posterior verdict of every row of ``documents``."""
    found = judge(stored(measure(table(spark, sf_dir, "documents")), "rules"))
    failed = F.expr(BASE_FAILED)
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & (F.col("p_good") >= 0.5)).alias("kept"), "p_good")
