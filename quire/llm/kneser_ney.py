"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model is over symbols. ``BYTES``: each UTF-8 byte is one (digits are read as 0), in n-grams
of 5, so the table of counts grows with the corpus and no two letters, marks or scripts are taken
for one another. ``LETTERS``: each byte is one of ``S`` = 48 classes (small letters
apart, capitals, digits and kinds of punctuation together, the bytes of other letters
in ten classes), in n-grams of ``ORDER`` = 4. Counts come from
every text that is labelled trusted. They are summed in each task, dealt by
n-gram and joined, shard by shard, with the sums of their contexts and with the
next lower order, whose counts are numbers of different symbols before an
n-gram. Discounts come from the counts of counts.

Neither counts nor model reach the driver or every task. Texts are dealt into blocks of about
``BLOCK`` bytes by a hash of their row; a block asks for its different n-grams, each once. What is
asked is joined, order by order, with the shards of the counts, which gives an n-gram's
bits, and these go back to the block, where they meet its texts. Moved are the texts and
a row per block and different n-gram, not a row per n-gram and document.

A document's score is how many bits it takes beyond what its language's trusted
documents would (their mean per symbol), over the spread that a text of its length
has: the root of its symbols, ``WEIGHT`` more for very short texts, growing in
proportion for texts beyond ``SPREAD`` symbols. Perplexity is 2^(bits / symbols).
One trusted document in ``HELD`` (by a hash of its id), and of each language that with
the lowest hash, is kept out of the model. These give each language its mean and its
limit, the ``QUANTILE`` of their scores; a document above its language's limit is
rejected. A language with fewer than ``ENOUGH`` such documents has its own mean but
the limit of all, one without any also the mean of all. Quantiles are
taken exactly from counts of scores rounded to 1/1000.

Null and empty texts have no score and are rejected; a text of any length is
scored whole; repeated rows are judged alike; without trusted documents nothing
is rejected but texts without a score; a null language is one of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import ddl, drop_shuffles, fresh, ready, stored, table, utf8, with_arrow
from quire.session import forget

ORDER = 4
S = 48
WEIGHT = 100
SPREAD = 2000
QUANTILE = 0.999
HELD = 3
#: Documents held out that a language needs for a quantile of its own.
ENOUGH = 200
STEP = 1000
#: Languages whose limits may be sent to every task.
BROADCAST = 10_000
#: Symbols scored or counted at once.
CHUNK = 1 << 19
#: Bytes of text in a block, about; n-grams that a task keeps before it merges them.
BLOCK = 24_000_000
HELD_BACK = 1 << 22


def _classes() -> np.ndarray:
    t = np.zeros(256, np.int64)  # line ends and control bytes
    t[32] = 1
    t[48:58] = 2
    t[65:91] = 3
    t[97:123] = np.arange(4, 30)
    for cls, chars in enumerate((b".", b",", b"!?;:", b"#*$%&|<>", b"+=~^_@/\\`", b"'\"()[]{}-"), 30):
        t[list(chars)] = cls
    t[128:192] = 36 + np.arange(64) % 10
    t[192:196] = 46
    t[196:] = 47
    return t


CLASSES = _classes()


class Symbols(NamedTuple):
    """The symbol (below ``size``) of each byte, and the order of the n-grams; n-grams have to fit a long."""
    of: np.ndarray
    size: int
    order: int


LETTERS = Symbols(CLASSES, S, ORDER)
#: Each byte is a symbol; digits are read as 0, as numbers say little of quality and most are seen once.
BYTES = Symbols(np.where((np.arange(256) >= 48) & (np.arange(256) < 58), 48, np.arange(256)), 256, 5)


def grams(raw: np.ndarray, offsets: np.ndarray, symbols: Symbols = LETTERS) -> np.ndarray:
    """The n-gram of every symbol: each text is preceded by order - 1
    line ends, which have no n-gram themselves."""
    pad = symbols.order - 1
    n = len(offsets) - 1
    line = np.full(len(raw) + pad * n, symbols.of[10], np.int64)
    lengths = np.diff(offsets)
    own = np.repeat(np.arange(1, n + 1) * pad, lengths) + np.arange(len(raw))
    line[own] = symbols.of[raw]
    code = line.copy()
    for back in range(1, symbols.order):
        code[back:] += line[:-back] * symbols.size ** back
    return code[own]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo..hi of a batch with about CHUNK bytes each."""
    raw, offsets = utf8(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, their summed counts) of several such pairs."""
    seen, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return seen, np.bincount(at, np.concatenate([n for _, n in parts]), len(seen)).astype(np.int64)


def counts(texts: DataFrame, text: str = "text", symbols: Symbols = LETTERS) -> DataFrame:
    """(g, n): how often each n-gram occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for b in batches:
            for _, _, raw, offsets in _slices(b, 0):
                found = pc.value_counts(pa.array(grams(raw, offsets, symbols)))
                parts.append((found.field("values").to_numpy(), found.field("counts").to_numpy()))
                if sum(len(g) for g, _ in parts) > HELD_BACK:
                    parts = [_summed(parts)]
                    if len(parts[0][0]) > HELD_BACK // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts.pop()], names=["g", "n"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _summed(parts)], names=["g", "n"])

    return (with_arrow(texts.select(F.col(f"`{text}`").alias("text")), count, "g long, n long")
            .groupBy("g").agg(F.sum("n").alias("n")))


def _discounts(n: DataFrame) -> list[float]:
    """The discounts for counts 1, 2 and 3 or more (Chen and Goodman)."""
    of = {r["n"]: r["k"] for r in n.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    n1, n2, n3, n4 = (of.get(i, 0) for i in range(1, 5))
    y = n1 / max(1, n1 + 2 * n2)
    raw = [i + 1 - (i + 2) * y * after / max(1, at) for i, (at, after) in enumerate(((n1, n2), (n2, n3), (n3, n4)))]
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw)]


def levels(top: DataFrame, symbols: Symbols = LETTERS) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (g, h, a), the discounted share of each n-gram in
    its context h, and (h, backoff), what the context leaves to the lower order."""
    by_order = [top]
    for order in range(symbols.order - 1, 0, -1):  # a count is the number of different symbols before
        shorter = (F.col("g") % symbols.size ** order).alias("g")
        by_order.append(stored(by_order[-1].groupBy(shorter).agg(F.count(F.lit(1)).alias("n")), "kn"))
    out = []
    for n in reversed(by_order):
        d1, d2, d3 = _discounts(n)
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = n.select("g", F.expr(f"g div {symbols.size}").alias("h"), "n", cut.alias("d"))
        contexts = rows.groupBy("h").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
        shares = rows.join(contexts, "h").select("g", "h", ((F.col("n") - F.col("d")) / F.col("total")).alias("a"))
        out.append((shares, contexts.select("h", (F.col("left") / F.col("total")).alias("backoff"))))
    return out


def probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]], symbols: Symbols = LETTERS) -> DataFrame:
    """(g, p): probability of the last symbol of each n-gram ``asked`` (g, without repeats) in its
    context, seen or not, by joins with the levels of ``model`` from order 1 upwards."""
    by_order = [asked]
    for order in range(symbols.order - 1, 0, -1):
        by_order.append(by_order[-1].select((F.col("g") % symbols.size ** order).alias("g")).distinct())
    p = None
    for order, (wanted, (shares, contexts)) in enumerate(zip(reversed(by_order), model, strict=True), 1):
        rows = wanted.select("g", F.expr(f"g div {symbols.size}").alias("h"), (F.col("g") % symbols.size ** (order - 1)).alias("low"))
        rows = rows.join(shares.select("g", "a"), "g", "left").join(contexts, "h", "left")
        rows = rows.withColumn("lower", F.lit(1.0 / symbols.size)) if p is None else rows.join(p.toDF("low", "lower"), "low")
        p = rows.select("g", (F.coalesce("a", F.lit(0.0)) + F.coalesce("backoff", F.lit(1.0)) * F.col("lower")).alias("p"))
    return p


def model(trusted: DataFrame, text: str = "text") -> np.ndarray:
    """-log2 probability of each n-gram's last symbol in its context, for all
    S^ORDER n-grams of LETTERS (float32, about 21 MB for any corpus): the whole table, to look at.
    Documents are scored without it."""
    p = np.full(S, 1.0 / S)
    for order, (shares, contexts) in enumerate(levels(stored(counts(trusted, text), "kn")), 1):
        back = np.ones(S ** (order - 1))
        c = contexts.toPandas()  # at most S^(order - 1) rows
        back[c["h"].to_numpy(dtype=np.int64)] = c["backoff"]
        lower = p if order == 1 else np.tile(p, S)  # n-gram g has the lower-order n-gram g mod S^(order - 1)
        p = np.repeat(back, S) * lower
        s = shares.select("g", "a").toPandas()  # at most S^order rows
        p[s["g"].to_numpy(dtype=np.int64)] += s["a"].to_numpy()
    return (-np.log2(p)).astype(np.float32)


def _asked(dealt: DataFrame, symbols: Symbols) -> DataFrame:
    """(block, g): the different n-grams of each block. dealt: (text, block), a block's rows in one task."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for b in batches:
            for block in pc.unique(b.column(1)).to_pylist():
                parts = seen.setdefault(block, [])
                for _, _, raw, offsets in _slices(b.filter(pc.equal(b.column(1), block)), 0):
                    parts.append(pc.unique(pa.array(grams(raw, offsets, symbols))))
                if sum(map(len, parts)) > HELD_BACK:
                    parts[:] = [pc.unique(pa.chunked_array(parts))]
        for block, parts in seen.items():
            g = np.sort(pc.unique(pa.chunked_array(parts, pa.int64())).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), block, np.int64)), pa.array(g)], names=["block", "g"])

    return with_arrow(dealt, distinct, "block long, g long")


def with_bits(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], text: str, total: str, n: str,
              keep: list[str] | None = None, symbols: Symbols = LETTERS) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the bits and the symbols of each text, by ``model`` (see :func:`levels`)."""
    names = list(keep or docs.columns)
    whole, block = fresh(docs, "_text", "_block")
    source = docs.select(*[F.col(f"`{c}`") for c in names])
    if text in names:
        whole = text  # a text goes to its block once
    else:
        source = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias(whole))
    size = source.agg(F.sum(F.octet_length(F.col(f"`{whole}`")))).first()[0] or 0
    # rows, not ids, are hashed: null and repeated ids are spread as others
    row = F.xxhash64(*[F.col(f"`{c}`") for c, kind in source.dtypes if "map<" not in kind])
    dealt = source.withColumn(block, F.pmod(row, F.lit(max(1, -(-size // BLOCK)))))
    asked = stored(_asked(dealt.select(F.col(f"`{whole}`"), block).repartition(block), symbols), "kn-asked")
    drop_shuffles(docs.sparkSession)  # the texts were moved for this
    bits = probabilities(asked.select("g").distinct(), model, symbols).select("g", (-F.log2("p")).cast("float").alias("bits"))
    found = stored(asked.join(bits, "g").select(F.col("block").alias(block), "g", "bits"), "kn-found")
    forget(asked)
    at = source.columns.index(whole)

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        table_of, worth = known.column("g").combine_chunks(), known.column("bits").to_numpy()
        sums, sizes = [], []
        for b in texts.to_batches():
            for lo, hi, raw, offsets in _slices(b, at):
                run = np.zeros(len(raw) + 1)
                places = pc.index_in(pa.array(grams(raw, offsets, symbols)), value_set=table_of)
                if places.null_count:
                    raise RuntimeError("an n-gram of the block was not asked for")
                np.cumsum(worth[places.to_numpy()], dtype=np.float64, out=run[1:])
                sums.append(run[offsets[1:]] - run[offsets[:-1]])
                sizes.append(np.diff(offsets))
        new = [np.concatenate([np.zeros(0, kind), *parts]).astype(kind) for parts, kind in ((sums, np.float64), (sizes, np.int64))]
        return pa.Table.from_arrays([*texts.columns[:len(names)], *map(pa.array, new)], names=[*names, total, n])

    ready(docs.sparkSession)
    return dealt.groupBy(block).cogroup(found.groupBy(block)).applyInArrow(
        score, ddl(docs.select(*[F.col(f"`{c}`") for c in names]), f"`{total}` double", f"`{n}` bigint"))


def _quantile(rows: DataFrame, by: list[str]) -> DataFrame:
    """The lowest ``step`` that reaches QUANTILE of the rows, by ``by``. Only counts
    per step meet in a window."""
    steps = rows.groupBy(*by, "step").agg(F.count(F.lit(1)).alias("n"))
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = part.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (steps.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
            .where(F.col("upto") >= QUANTILE * F.col("all")).groupBy(*by).agg(F.min("step").alias("limit")))


def _score(bits, n, mean):
    """Bits beyond the mean over the spread of a text of ``n`` symbols."""
    return (bits - n * mean) / F.sqrt((n + WEIGHT) * (1 + n / SPREAD))


def thresholds(scored: DataFrame, held: DataFrame) -> tuple[DataFrame, dict] | None:
    """(lang, mean, limit) of each language with documents held out, as a stored table,
    and mean and limit of all of them; None without any. scored: (id, lang, bits, n)."""
    known = stored(scored.join(held, "id", "left_semi").where("n > 0").select("lang", "bits", "n"), "kn-known")
    means = known.groupBy(F.col("lang").alias("of")).agg((F.sum("bits") / F.sum("n")).alias("mean"), F.count(F.lit(1)).alias("docs"))
    every = known.agg((F.sum("bits") / F.sum("n")).alias("mean")).first().asDict()
    if every["mean"] is None:
        return None
    score = _score(F.col("bits"), F.col("n"), F.col("mean"))
    steps = stored(known.join(means, F.col("lang").eqNullSafe(F.col("of")))
                   .select("lang", "docs", F.round(score * STEP).cast("long").alias("step")), "kn-steps")
    every["limit"] = _quantile(steps, []).first()["limit"]
    own = _quantile(steps.where(F.col("docs") >= ENOUGH), ["lang"])
    of = means.join(own, F.col("of").eqNullSafe(F.col("lang")), "left").select(
        F.col("of").alias("lang"), "mean", F.coalesce("limit", F.lit(every["limit"])).alias("limit"))
    return stored(of, "kn-limits"), every


def judged(rows: DataFrame, found: tuple[DataFrame, dict] | None, lang: str, bits: str, n: str) -> DataFrame:
    """Scored ``rows`` with two more columns: ``score`` (null without symbols) and ``kept``
    (clear of the rows' names: the last two)."""
    score, kept, of, mean, limit = fresh(rows, "score", "kept", "kn_lang", "kn_mean", "kn_limit")
    size = F.col(f"`{n}`")
    if found is None:
        return rows.withColumn(score, F.when(size > 0, F.lit(0.0))).withColumn(kept, size > 0)
    table_of, every = found
    limits = table_of.toDF(of, mean, limit)
    # a row per language; beyond BROADCAST of them the planner chooses by measured sizes
    limits = F.broadcast(limits) if limits.count() <= BROADCAST else limits
    value = _score(F.col(f"`{bits}`"), size, F.coalesce(F.col(mean), F.lit(every["mean"])))
    bound = F.coalesce(F.col(limit), F.lit(every["limit"]))
    return (rows.join(limits, F.col(f"`{lang}`").eqNullSafe(F.col(of)), "left")
            .withColumn(score, F.when(size > 0, value))
            .withColumn(kept, (size > 0) & (F.round(value * STEP).cast("long") <= bound))
            .drop(of, mean, limit))


def trusted_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Ids of the trusted documents (labelled good and not toxic) that there are, and whether
    each is held out. Only ids and languages move."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("id")).distinct()
    # labels grow with the corpus, so the join is the same at every size
    known = (docs.select(F.col("doc_id").alias("id"), "lang").join(good.hint("merge"), "id", "left_semi")
             .withColumn("key", F.xxhash64("id")))
    lowest = known.groupBy(F.col("lang").alias("of")).agg(F.min("key").alias("low"))
    held = (F.pmod(F.col("key"), F.lit(HELD)) == 0) | (F.col("key") == F.col("low"))
    return (known.join(lowest, F.col("lang").eqNullSafe(F.col("of"))).groupBy("id").agg(F.max(held).alias("held")))


def trusted_texts(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trusted ids as a stored table, (id, held, lang, text) of the documents with these ids and a text)."""
    good = stored(trusted_ids(docs, labels), "kn-trusted")
    text = docs.select(F.col("doc_id").alias("id"), "lang", "text").where("text is not null")
    return good, text.join(good.hint("merge"), "id")


def trained(known: DataFrame, symbols: Symbols) -> list[tuple[DataFrame, DataFrame]]:
    """The levels of the counts of the trusted texts that aren't held out."""
    top = stored(counts(known.where("not held"), symbols=symbols), "kn")
    drop_shuffles(known.sparkSession)
    return levels(top, symbols)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, symbols: Symbols = BYTES
        ) -> tuple[DataFrame, tuple[DataFrame, dict] | None, list[tuple[DataFrame, DataFrame]]]:
    """(scores of all documents as a stored table (id, lang, bits, n), limits, model)."""
    good, known = trusted_texts(docs, labels)
    tables = trained(known, symbols)
    slim = docs.select(F.col("doc_id").alias("id"), "lang", "text")
    scored = stored(with_bits(slim, tables, "text", "bits", "n", ["id", "lang"], symbols), "kn-scores")
    drop_shuffles(spark)
    return scored, thresholds(scored, good.where("held").hint("merge")), tables


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, symbols: Symbols = LETTERS) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    good, known = trusted_texts(docs, labels)
    known = stored(known, "kn-texts")  # read for the counts and for the limits: the texts are moved once
    tables, held = trained(known, symbols), known.where("held")
    limits = thresholds(with_bits(held, tables, "text", "bits", "n", ["id", "lang"], symbols), good.where("held").hint("merge"))
    forget(known)
    total, n = fresh(docs, "kn_bits", "kn_n")
    rows = judged(with_bits(docs, tables, "text", total, n, symbols=symbols), limits, "lang", total, n)
    return rows.where(F.col(rows.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality(spark, sf_dir):
    """Perplexity and verdict of every row of ``documents``."""
    scored, limits, _ = fit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged(scored, limits, "lang", "bits", "n").select(
        F.col("id").alias("doc_id"), "lang", F.col("n").alias("n_symbols"),
        F.when(F.col("n") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n"))).alias("perplexity"), "score", "kept")
