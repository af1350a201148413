"""Mixing sources to target weights by hierarchical budgeting. DataFrame
functions only.

A token budget goes down a tree of levels (domain, language, source). At each
node it is shared among the children by weight; a child whose subtree can't
supply its share (tokens times ``max_epochs``) gives what it can, and its
shortage goes to its siblings, by their weights, until they too are full. As a
node's capacity is the sum of its children's, a shortage reaches a node's own
siblings only when all children are full: siblings come before ancestors.

A leaf's share is met by whole epochs over its documents and then by a prefix,
in tokens, of one more epoch. An epoch's order is that of
md5("seed:epoch:id"), so it is the same on every cluster. The place where the
prefix ends is found without sorting a leaf in one task: token sums by the
first hex digits of the order (combined before the shuffle) give the bucket in
which the budget ends, and only that bucket is sorted.

Texts are not moved: the cut of each leaf (one short row) is stored, counted
and, up to ``LEAVES`` rows, broadcast to the documents, and each document knows by its own hash which
epochs take it. With more leaves than that the documents are joined by leaf.

Null level values form a leaf of their own (``null_name``); a null or
empty text has no tokens and is taken by whole epochs and by every prefix that
reaches it; a value of a level without a given weight has weight 1; an
empty table gives an empty result; ties in the order (the same id twice) are
taken or left together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import fresh, stored, table

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order by which a leaf's tokens are summed: 4096 buckets.
DIGITS = 3

#: Production mix of ``documents``: levels, from the root, as SQL expressions and the weights of their values.
DOMAIN = ("CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 'web' "
          "WHEN source IN ('src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'books' ELSE 'reference' END")
LEVELS = {"domain": DOMAIN, "lang": "lang", "source": "source"}
WEIGHTS = {"domain": {"web": 0.4, "books": 0.3, "reference": 0.3},
           "lang": {"en": 0.6, "de": 0.15, "es": 0.125, "fr": 0.125},
           "source": {}}
MAX_EPOCHS = 4
SEED = 20240601
#: Budget in hundredths of the tokens there are.
SHARE = 200
#: Leaves whose cuts are broadcast (a row of under 200 bytes each).
LEAVES = 50_000


def _bounded(leaves: DataFrame, label: str) -> DataFrame:
    """A row per leaf, stored; marked for a broadcast if there are few."""
    leaves = stored(leaves, label)
    return F.broadcast(leaves) if leaves.count() <= LEAVES else leaves.hint("merge")


def tokens(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order(seed: int, epoch: Column, id_col: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit(""))))


def _weight(level: str, weights: dict) -> Column:
    given = weights.get(level, {})
    out = F.lit(1.0)
    for value, w in given.items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def budgets(leaves: DataFrame, levels: list[str], weights: dict, budget: Column, max_epochs: int) -> DataFrame:
    """Leaves (level columns, ``tokens``) with their ``budget`` in tokens
    (double). ``budget``: the root's, an expression over one row with ``total``.

    The share of each child is min(capacity, weight x water level): in order
    of capacity per weight, the children before the water level are full, and
    what is left is shared by the weights that are left. One row per node;
    each window holds the children of one node."""
    caps = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    nodes = caps.agg(F.sum("tokens").alias("total")).select(F.coalesce(budget, F.lit(0.0)).alias("budget"))
    for depth in range(1, len(levels) + 1):
        keys, level, parents = levels[:depth], levels[depth - 1], levels[:depth - 1]
        children = (caps.groupBy(*keys).agg(F.sum("cap").alias("cap"))
                    .withColumn("w", _weight(level, weights)))
        children = children.join(nodes, parents) if parents else children.crossJoin(nodes)  # the root is one row
        by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
        by_fill = by.orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf"))), level)
        before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
        all_of = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        zero = F.lit(0.0)
        filled = (children
                  .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero))
                  .withColumn("w_before", F.coalesce(F.sum("w").over(before), zero))
                  .withColumn("w_all", F.sum("w").over(all_of))
                  .withColumn("water", F.when(F.col("w_all") - F.col("w_before") > 1e-12,
                                              (F.col("budget") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))))
                  # the first child that its share doesn't fill sets the level for it and all after it
                  .withColumn("level_at", F.min(F.when(F.col("cap") >= F.col("w") * F.col("water"), F.struct(
                      F.col("cap_before").alias("o"), F.col("water").alias("v"))))
                      .over(all_of)["v"])
                  # no such child: all are full
                  .withColumn("given", F.when(F.col("w") <= 0, zero).when(F.col("level_at").isNull(), F.col("cap"))
                              .otherwise(F.least(F.col("cap"), F.greatest(F.col("level_at"), zero) * F.col("w")))))
        nodes = filled.select(*keys, F.col("given").alias("budget"))
    return caps.join(nodes, levels).select(*levels, "tokens", "budget")


def cuts(rows: DataFrame, levels: list[str], weights: dict, share: int, max_epochs: int, seed: int) -> DataFrame:
    """A row per leaf: ``full`` epochs taken whole, and ``last``: documents of
    the next epoch whose order is at most this are taken too (null: none).
    rows: level columns, ``id``, ``n``."""
    leaves = rows.groupBy(*levels).agg(F.sum("n").alias("tokens"))
    shares = (budgets(leaves, levels, weights, F.col("total") * share / 100.0, max_epochs)
              # whole tokens, so that sums of parts don't depend on rounding
              .withColumn("budget", F.floor(F.col("budget") + 1e-6))
              .withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0))
              .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")))
    shares = stored(shares.select(*levels, "tokens", "budget", "full", "rest"), "mix-shares")
    ordered = (rows.join(_bounded(shares.where("rest > 0").select(*levels, "full", "rest"), "mix-open"), levels)
               .withColumn("o", _order(seed, F.col("full"), F.col("id"))))
    sums = (ordered.groupBy(*levels, "rest", F.left("o", F.lit(DIGITS)).alias("bucket")).agg(F.sum("n").alias("n")))
    upto = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    edge = sums.where("before <= rest and before + n > rest").select(
        *levels, F.col("bucket").alias("edge"), F.col("rest") - F.col("before"))
    edge = _bounded(edge.toDF(*levels, "edge", "left_over"), "mix-edge")
    within = (ordered.join(edge, levels).where(F.left("o", F.lit(DIGITS)) == F.col("edge"))
              .groupBy(*levels, "o").agg(F.sum("n").alias("n"), F.first("left_over").alias("left_over")))
    run = Window.partitionBy(*levels).orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (within.withColumn("upto", F.sum("n").over(run)).where("upto <= left_over")
            .groupBy(*levels).agg(F.max("o").alias("last")))
    return (shares.join(edge.select(*levels, "edge"), levels, "left").join(last, levels, "left")
            # before the edge bucket's first document every earlier bucket is whole
            .select(*levels, "tokens", "budget", "full",
                    F.when(F.col("rest") > 0, F.coalesce("last", "edge")).alias("last")))


def mix(docs: DataFrame, levels: dict[str, str] | None = None, weights: dict | None = None,
        share: int = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        id_col: str = "doc_id", text: str = "text", null_name: str = "") -> tuple[DataFrame, list[str]]:
    """The documents in the mix, one row per epoch that takes them: all columns
    of ``docs``, and helper columns [levels..., epoch, tokens], whose names
    (clear of the table's own) come second."""
    levels, weights = levels or LEVELS, weights or WEIGHTS
    names = [f"mix_{k}" for k in levels]
    cols = [F.coalesce(F.expr(e).cast("string"), F.lit(null_name)).alias(n)
            for n, e in zip(names, levels.values(), strict=True)]
    own = {f"mix_{k}": v for k, v in weights.items()}
    rows = docs.select(*cols, F.col(f"`{id_col}`").alias("id"), tokens(F.col(f"`{text}`")).alias("n"))
    leaf = cuts(rows, names, own, share, max_epochs, seed)
    h = fresh(docs, *names, "mix_epoch", "mix_tokens", "mix_full", "mix_last")
    leaf = _bounded(leaf.select(*[F.col(n).alias(x) for n, x in zip(names, h, strict=False)],
                                F.col("full").alias(h[-2]), F.col("last").alias(h[-1])), "mix-cuts")
    epoch, n, full, last = h[-4:]
    out = (docs.select("*", *[c.alias(x) for c, x in zip(cols, h, strict=False)], tokens(F.col(f"`{text}`")).alias(n))
           .join(leaf, h[:len(names)])
           .withColumn(epoch, F.explode(F.sequence(F.lit(0).cast("long"), F.col(full))))
           .where((F.col(epoch) < F.col(full)) | (_order(seed, F.col(epoch), F.col(f"`{id_col}`")) <= F.col(last)))
           .drop(full, last))
    return out, h[:-2]


def op10_mixing(spark, sf_dir):
    """``documents`` in the production mix: which document is taken in which epoch."""
    out, h = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[F.col(x).alias(x.removeprefix("mix_")) for x in h])


def _sql_weight(level: str) -> str:
    given = "".join(f" WHEN {level} = '{v}' THEN {float(w)!r}" for v, w in WEIGHTS[level].items())
    return f"(CASE{given} ELSE 1.0 END)::DOUBLE" if given else "1.0::DOUBLE"


def _sql_level(level: str, keys: list[str], nodes: str) -> str:
    """CTE of the nodes of a level with their budgets."""
    by = ", ".join(keys[:-1])
    part = f"PARTITION BY {by} " if by else ""
    join = f"JOIN {nodes} USING ({by})" if by else f"CROSS JOIN {nodes}"
    return f"""
c_{level} AS (SELECT *, {_sql_weight(level)} AS w FROM (SELECT {", ".join(keys)}, sum(cap) AS cap FROM leaves GROUP BY ALL) {join}),
f_{level} AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS cap_before, sum(w) OVER ({part}) AS w_all, coalesce(sum(w) OVER b, 0) AS w_before
  FROM c_{level} WINDOW b AS ({part}ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g_{level} AS (SELECT *, CASE WHEN w_all - w_before > 1e-12 THEN (budget - cap_before) / (w_all - w_before) END AS water FROM f_{level}),
h_{level} AS (SELECT *, min(CASE WHEN cap >= w * water THEN {{'o': cap_before, 'v': water}} END) OVER ({part}) AS fill FROM g_{level}),
n_{level} AS (SELECT {", ".join(keys)}, CASE WHEN fill IS NULL THEN cap ELSE least(cap, greatest(fill.v, 0) * w) END AS budget FROM h_{level})"""


def sql(docs: str = "documents") -> str:
    """DuckDB SQL for the whole query; the prefix is a plain running sum here."""
    hashed = f"md5('{SEED}:' || {{}}::VARCHAR || ':' || coalesce(doc_id::VARCHAR, ''))"
    return f"""
WITH d AS (SELECT doc_id, {DOMAIN} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM {docs}),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS total, sum(tokens)::DOUBLE * {MAX_EPOCHS} AS cap FROM d GROUP BY ALL),
root AS (SELECT sum(total) * {SHARE} / 100.0::DOUBLE AS budget FROM leaves),
{_sql_level("domain", ["domain"], "root")},
{_sql_level("lang", ["domain", "lang"], "n_domain")},
{_sql_level("source", ["domain", "lang", "source"], "n_lang")},
s AS (SELECT domain, lang, source, total, floor(budget + 1e-6)::BIGINT AS budget,
    CASE WHEN total > 0 THEN floor(floor(budget + 1e-6) / total)::BIGINT ELSE 0 END AS full_epochs FROM n_source JOIN leaves USING (domain, lang, source)),
o AS (SELECT d.*, full_epochs, budget - full_epochs * total AS rest, {hashed.format('full_epochs')} AS ord
    FROM d JOIN s USING (domain, lang, source)),
p AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord) AS upto FROM o)
SELECT doc_id, domain, lang, source, e.epoch, tokens FROM o, unnest(range(0, full_epochs)) AS e(epoch)
UNION ALL SELECT doc_id, domain, lang, source, full_epochs AS epoch, tokens FROM p WHERE rest > 0 AND upto <= rest"""
