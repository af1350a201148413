"""Poisson regression with random effects (Q7) by penalised quasi-likelihood.

log E y = offset + x b + u_g + v_h ... with u ~ N(0, s^2) for each grouping. Rounds
of Newton steps: the fixed effects by normal equations summed over all rows
(their size is the number of features), each grouping's effects by sums of their
own rows; a variance is the mean of squared effects plus their posterior variances. Effects
stay tables joined to the rows, whatever number of groups there is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass
class MixedPoisson:
    """``fixed``: (feature, coef, se); ``effects``: grouping -> (group, effect, se); ``sd``: grouping -> standard deviation."""

    fixed: DataFrame
    effects: dict[str, DataFrame]
    sd: dict[str, float]
    rounds: int


def mixed_poisson(rows: DataFrame, label: str, features: list[str], groupings: list[str], offset: str | None = None,
                  iters: int = 40, tol: float = 1e-4, floor: float = 1e-4) -> MixedPoisson:
    """Fit to ``rows``: a count ``label``, numeric ``features`` (an intercept is
    added), and the columns ``groupings`` with random intercepts. Rows with a null in one of these are left out."""
    spark = rows.sparkSession
    names = ["(intercept)", *features]
    x = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features])
    base = rows.select(*groupings, F.col(label).cast("double").alias("y"), x.alias("x"),
                       (F.col(offset).cast("double") if offset else F.lit(0.0)).alias("o"))
    complete = F.forall("x", lambda v: v.isNotNull()) & F.col("y").isNotNull() & F.col("o").isNotNull()
    for g in groupings:
        complete = complete & F.col(g).isNotNull()
    base = cut_lineage(base.where(complete), "pql-rows")
    p = len(names)
    mean = base.agg(F.sum("y") / F.sum(F.exp("o"))).first()[0]
    b = np.zeros(p)
    b[0] = np.log(mean) if mean else 0.0
    sd = {g: 1.0 for g in groupings}
    effects = {g: cut_lineage(base.select(g).distinct().withColumn("u", F.lit(0.0)).withColumn("h", F.lit(1.0)), "pql-effects") for g in groupings}

    def eta(df: DataFrame):
        fixed = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in b]), lambda a, c: a * c), F.lit(0.0), lambda s, v: s + v)
        out = df
        for i, g in enumerate(groupings):
            out = out.join(effects[g].select(g, F.col("u").alias(f"u{i}")), g)
        total = F.col("o") + fixed
        for i in range(len(groupings)):
            total = total + F.col(f"u{i}")
        return out.withColumn("mu", F.exp(F.least(total, F.lit(30.0))))

    information, done = np.eye(p), 0
    for done in range(1, iters + 1):
        change = 0.0
        sums = eta(base).agg(*[F.sum((F.col("y") - F.col("mu")) * F.col("x")[i]).alias(f"g{i}") for i in range(p)],
                             *[F.sum(F.col("mu") * F.col("x")[i] * F.col("x")[j]).alias(f"h{i}_{j}") for i in range(p) for j in range(i, p)]).first()
        g = np.array([sums[f"g{i}"] or 0.0 for i in range(p)])
        information = np.array([[sums[f"h{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)]) + 1e-9 * np.eye(p)
        step = np.clip(np.linalg.solve(information, g), -1, 1)
        b = b + step
        change = max(change, float(np.abs(step).max(initial=0.0)))
        for name in groupings:
            per = eta(base).groupBy(name).agg(F.sum(F.col("y") - F.col("mu")).alias("r"), F.sum("mu").alias("m"))
            new = effects[name].join(per, name)
            tight = 1 / max(sd[name] ** 2, floor)
            h = F.col("m") + tight
            s = F.least(F.greatest((F.col("r") - F.col("u") * tight) / h, F.lit(-1.0)), F.lit(1.0))
            new = cut_lineage(new.select(name, (F.col("u") + s).alias("u"), h.alias("h"), F.abs(s).alias("s")), "pql-effects")
            m, v, largest = new.agg(F.avg("u"), F.avg(F.col("u") * F.col("u") + 1 / F.col("h")), F.max("s")).first()
            # the groups' mean belongs to the intercept
            b[0] += m or 0.0
            effects[name] = new.select(name, (F.col("u") - F.lit(m or 0.0)).alias("u"), "h")
            fresh = float(np.sqrt(max((v or 0.0) - (m or 0.0) ** 2, floor)))
            change = max(change, abs(fresh - sd[name]), min(largest or 0.0, 1.0))
            sd[name] = fresh
        if change < tol:
            break
    se = np.sqrt(np.diag(np.linalg.inv(information)))
    fixed = spark.createDataFrame([(n, float(c), float(e)) for n, c, e in zip(names, b, se, strict=True)], "feature string, coef double, se double")
    return MixedPoisson(fixed, {g: e.select(g, F.col("u").alias("effect"), (1 / F.sqrt("h")).alias("se")) for g, e in effects.items()}, sd, done)
