"""Wordfish (Q4) and the spatial following model (Q6), with all parameters in tables.

Wordfish: y ~ Poisson(exp(alpha + psi + beta omega)). A Newton step of a
document needs sums over all words, of exp(psi_j + beta_j omega) and its
derivatives: functions of the one number omega. They are summed over the words
at the centres of a grid, with so many derivatives that the Taylor series is exact to
rounding within a cell; each document evaluates the series where it stands. The
words' step is the same with the sides exchanged. So a round costs the
non-zero cells plus both sides, no side sees the other's rows, and the driver
holds a grid.

Following model: P(user i follows elite j) = logit^-1(alpha_j + beta_i - zeta (theta_i - phi_j)^2).
A user's pairs are the elites followed and a sample of the others, weighted to
stand for them all, so that a round is linear in the follows. Users are solved in
blocks, given the elites that occur in them; what they add up for an elite
is its gradient and information.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .blocks import aligned, flat, in_blocks, numbered, summed, total

#: Derivatives kept at a grid centre; half a cell times the largest slope.
TERMS, REACH = 18, 0.5


# ---- Wordfish -------------------------------------------------------------------------------------

class Curve:
    """t -> sum over rows of exp(a + x t) x^k, k = 0, 1, 2, for t from low to
    high. steepest: the largest abs(x)."""

    def __init__(self, rows: DataFrame, a: str, x: str, low: float, high: float, steepest: float):
        half = REACH / max(steepest, 1e-6)
        cells = max(1, int(np.ceil((high - low) / (2 * half))))
        self.low, self.width = low, max(high - low, 1e-9) / cells
        centres = low + self.width * (np.arange(cells) + 0.5)

        def add(batches):
            out = np.zeros((cells, TERMS))
            for pdf in batches:
                av, xv = pdf["a"].to_numpy(), pdf["x"].to_numpy()
                for at in range(0, len(av), 4096):
                    part = xv[at:at + 4096, None]
                    e = np.exp(av[at:at + 4096, None] + part * centres[None, :])
                    for m in range(TERMS):
                        out[:, m] += e.sum(axis=0)
                        e = e * part
            yield pd.DataFrame({"j": [0], "vec": [out.ravel()]})

        parts = rows.select(F.col(a).alias("a"), F.col(x).alias("x")).mapInPandas(add, "j int, vec array<double>")
        self.table = np.zeros((cells, TERMS))
        for r in parts.select(F.posexplode("vec").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():  # a row per number of the grid
            self.table.flat[r["i"]] = r["v"]

    def __call__(self, t: np.ndarray) -> list[np.ndarray]:
        cell = np.clip(((t - self.low) / self.width).astype(np.int64), 0, len(self.table) - 1)
        d = t - (self.low + self.width * (cell + 0.5))
        return [sum(self.table[cell, m + k] * d ** m / factorial(m) for m in range(TERMS - 2)) for k in range(3)]


_STEP = "a double, x double, y double, old double, info_aa double, info_ax double, info_xx double"


def _newton(rows: DataFrame, key: str, kind: str, curve: Curve, prior: float) -> DataFrame:
    """One Newton step of (a, x) for each row: key, a, x, y, yx (counts, and
    counts times the other side's x); ``old``: x before."""
    def step(batches):
        for pdf in batches:
            a, x, y, yx = (pdf[c].to_numpy() for c in ("a", "x", "y", "yx"))
            s0, s1, s2 = (np.exp(a) * s for s in curve(x))
            ga, gx = y - s0, yx - s1 - x / prior ** 2
            haa, hax, hxx = s0 + 1e-9, s1, s2 + 1 / prior ** 2
            det = np.maximum(haa * hxx - hax ** 2, 1e-12)
            da, dx = (hxx * ga - hax * gx) / det, (haa * gx - hax * ga) / det
            size = np.maximum(1.0, np.maximum(np.abs(dx), np.abs(da) / 3))  # long steps are shortened
            yield pd.DataFrame({key: pdf[key], "a": a + da / size, "x": x + dx / size, "y": y, "old": x,
                                "info_aa": haa, "info_ax": hax, "info_xx": hxx})
    return rows.select(key, "a", "x", "y", "yx").mapInPandas(step, f"`{key}` {kind}, {_STEP}")


def wordfish(d: DataFrame, dir: tuple, max_iter: int = 100, tol: float = 1e-4, sigma_beta: float = 3.0,
             sigma_omega: float = 1.0, term: str = "term"):
    """Q4: alternating Newton steps of words and documents, until no position
    moves by ``tol``. Identification: mean omega 0, sd 1, alpha of the first document
    0, omega[dir[0]] < omega[dir[1]]. Returns ``(docs (doc_id, alpha, omega, se), words (term, psi, beta))``."""
    lo, hi = dir
    kind = d.schema["doc_id"].dataType.simpleString()
    words = numbered(d, term, "wf")
    dj = cut_lineage(d.join(words, term).select("doc_id", "j", F.col("n").cast("double").alias("n")), "wf-dfm")
    sizes = cut_lineage(dj.groupBy("doc_id").agg(F.sum("n").alias("y")), "wf-sizes")
    first = sizes.agg(F.min("doc_id")).first()[0]
    if first is None:
        none = d.sparkSession.createDataFrame([], f"doc_id {kind}, alpha double, omega double, se double")
        return none, d.sparkSession.createDataFrame([], f"{term} string, psi double, beta double")
    first_size, n_docs = sizes.where(F.col("doc_id") == first).select("y").first()[0], sizes.count()

    def sided(which) -> DataFrame:
        return dj.where(F.col("doc_id") == which).select("j", F.col("n").alias(f"n{which}"))

    column = cut_lineage(dj.groupBy("j").agg(F.sum("n").alias("y")), "wf-totals")
    contrast = (column.select("j").join(sided(lo).toDF("j", "lo"), "j", "left").join(sided(hi).toDF("j", "hi"), "j", "left")
                .select("j", (F.log(F.coalesce("hi", F.lit(0.0)) + 0.5) - F.log(F.coalesce("lo", F.lit(0.0)) + 0.5)).alias("c")))
    start = dj.join(contrast, "j").groupBy("doc_id").agg((F.sum(F.col("n") * F.col("c")) / F.sum("n")).alias("x"))
    m, s = start.agg(F.avg("x"), F.stddev_samp("x")).first()
    docs = cut_lineage(sizes.join(start, "doc_id").select("doc_id", F.log(F.col("y") / first_size).alias("a"),
                                                          ((F.col("x") - m) / (s or 1.0)).alias("x"), "y"), "wf-docs")
    word = cut_lineage(column.select("j", F.log(F.col("y") / n_docs + 1e-9).alias("a"), F.lit(0.0).alias("x"), "y"), "wf-words")

    def span(rows: DataFrame) -> tuple[float, float]:
        low, high = rows.agg(F.min("x"), F.max("x")).first()
        return low - 1e-6, high + 1e-6

    def largest(at: tuple[float, float]) -> float:
        return max(abs(at[0]), abs(at[1]))

    def anchor(which, column):
        return F.max(F.when(F.col("doc_id") == which, F.col(column)))

    docs_at, words_at = span(docs), (-1e-6, 1e-6)
    for _ in range(max_iter):
        # each side is stored once a round; identification is a projection of what is stored
        yx = dj.join(docs.select("doc_id", "x"), "doc_id").groupBy("j").agg(F.sum(F.col("n") * F.col("x")).alias("yx"))
        curve = Curve(docs, "a", "x", *words_at, largest(docs_at))
        word = cut_lineage(_newton(word.join(yx, "j"), "j", "int", curve, sigma_beta), "wf-words").select("j", "a", "x", "y")
        words_at = span(word)
        yx = dj.join(word.select("j", "x"), "j").groupBy("doc_id").agg(F.sum(F.col("n") * F.col("x")).alias("yx"))
        curve = Curve(word, "a", "x", *docs_at, largest(words_at))
        step = cut_lineage(_newton(docs.join(yx, "doc_id"), "doc_id", kind, curve, sigma_omega), "wf-docs")
        m, s, low, high, shift, x_lo, x_hi = step.agg(F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x"), anchor(first, "a"),
                                                      anchor(lo, "x"), anchor(hi, "x")).first()
        s = s or 1.0
        turn = -1.0 if x_lo is not None and x_hi is not None and x_lo > x_hi else 1.0
        word = word.select("j", (F.col("a") + F.col("x") * m + shift).alias("a"), (F.col("x") * s * turn).alias("x"), "y")
        words_at = tuple(sorted((words_at[0] * s * turn, words_at[1] * s * turn)))
        docs = step.select("doc_id", (F.col("a") - shift).alias("a"), ((F.col("x") - m) / s * turn).alias("x"), "y", "old",
                           "info_aa", (F.col("info_ax") * turn).alias("info_ax"), "info_xx")
        docs_at = tuple(sorted(((low - m) / s * turn - 1e-6, (high - m) / s * turn + 1e-6)))
        if docs.agg(F.max(F.abs(F.col("x") - F.col("old")))).first()[0] < tol:
            break
    det = F.col("info_aa") * F.col("info_xx") - F.col("info_ax") ** 2
    out = docs.select("doc_id", F.col("a").alias("alpha"), F.col("x").alias("omega"), F.sqrt(F.col("info_aa") / det).alias("se"))
    return out, words.join(word, "j").select(term, F.col("a").alias("psi"), F.col("x").alias("beta"))


# ---- spatial following model -----------------------------------------------------------------------

#: Others sampled for each elite that a user follows, and for each user at least.
NEGATIVES, LEAST = 5, 20
_SUMS = "kind string, j int, vec array<double>"


def sampled_pairs(edges: DataFrame, user: str, elite: str, negatives: int = NEGATIVES) -> tuple[DataFrame, DataFrame]:
    """(pairs (user, elite, value), elites (elite, j)). value: 1 for a follow,
    -weight for one of the others, whose weights add up to all others of the user.
    A user's sample is chosen by hashes of the user; where it would be half of all elites, all are taken."""
    follows = cut_lineage(edges.select(user, elite).where(F.col(user).isNotNull() & F.col(elite).isNotNull()).distinct(), "fs-edges")
    elites = numbered(follows, elite, "fs")
    n = elites.count()
    degree = follows.groupBy(user).agg(F.count(F.lit(1)).alias("deg"))
    wanted = F.greatest(F.col("deg") * negatives, F.lit(LEAST))
    drawn = F.when(wanted >= n / 2, F.sequence(F.lit(0), F.lit(max(n - 1, 0)))).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), wanted), lambda r: F.pmod(F.xxhash64(user, r), F.lit(max(n, 1))).cast("int"))))
    others = (degree.select(user, "deg", F.explode(drawn).alias("j")).join(elites, "j")
              .join(follows, [user, elite], "left_anti"))
    kept = others.groupBy(user).agg(F.count(F.lit(1)).alias("kept"))
    others = others.join(kept, user).select(user, elite, (-(n - F.col("deg")) / F.col("kept")).alias("value"))
    return follows.select(user, elite, F.lit(1.0).alias("value")).unionByName(others), elites


def _averages(docs: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
    """Reciprocal averaging: users at the mean of the elites they follow, summed by elite."""
    if docs.empty:
        return pd.DataFrame({"j": [], "vec": []})
    row, local, value, columns, _ = flat(docs["js"], docs["cs"])
    y = aligned(params, columns)[:, 0]
    on = value > 0
    row, local = row[on], local[on]
    x = np.bincount(row, y[local], len(docs)) / np.maximum(np.bincount(row, minlength=len(docs)), 1)
    count = np.bincount(local, minlength=len(columns))
    sums = np.bincount(local, x[row], len(columns))
    return pd.DataFrame({"j": columns.astype("int32"), "vec": list(np.stack([sums, count.astype(float)], axis=1))})


def _users(row, local, value, n, alpha, phi, zeta, steps=12):
    """(beta, theta) of the users of a block, and (residual, weight, distance) of their pairs."""
    w, y = np.abs(value), (value > 0).astype(float)
    on = value > 0
    theta = np.bincount(row[on], phi[local[on]], n) / np.maximum(np.bincount(row[on], minlength=n), 1)
    beta = np.zeros(n)

    def state():
        diff = theta[row] - phi[local]
        p = 1 / (1 + np.exp(-np.clip(alpha[local] + beta[row] - zeta * diff ** 2, -30, 30)))
        return diff, w * (y - p), w * p * (1 - p)

    for _ in range(steps):
        diff, r, h = state()
        slope = -2 * zeta * diff
        gb, gt = np.bincount(row, r, n) - beta, np.bincount(row, r * slope, n) - theta
        hbb, hbt, htt = np.bincount(row, h, n) + 1, np.bincount(row, h * slope, n), np.bincount(row, h * slope ** 2, n) + 1
        det = hbb * htt - hbt ** 2
        beta = beta + np.clip((htt * gb - hbt * gt) / det, -1, 1)
        theta = theta + np.clip((hbb * gt - hbt * gb) / det, -1, 1)
    return beta, theta, *state()


def following_scale(edges: DataFrame, user: str = "user", elite: str = "elite", iters: int = 30, lr: float = 1.0,
                    negatives: int = NEGATIVES, tol: float = 1e-3):
    """Q6: fit the following model. lr: the share of an elite's Newton step
    that is taken. Priors: beta, theta, phi ~ N(0, 1); theta has mean 0 and sd 1; the elite farthest out is
    on the positive side. Start: the first axis of correspondence analysis, by reciprocal averaging.
    Returns ``(users (user, beta, theta), elites (elite, alpha, phi))``."""
    pairs, elites = sampled_pairs(edges, user, elite, negatives)
    user_kind = edges.schema[user].dataType.simpleString()
    blocks = in_blocks(pairs, user, elite, "value", label="fs", columns=elites)
    n_users = blocks.rows.count()
    side = F.pmod(F.xxhash64("j"), F.lit(1 << 20)) / float(1 << 20) - 0.5
    state = cut_lineage(elites.select("j", F.array(side).alias("vec")), "fs-start")
    for _ in range(12):
        means = cut_lineage(summed(blocks.solve(state, _averages, "j int, vec array<double>"), blocks.size)
                            .select("j", (F.col("vec")[0] / F.greatest(F.col("vec")[1], F.lit(1e-9))).alias("y"), F.col("vec")[1].alias("n")), "fs-axis")
        s = means.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y"), F.sum(F.col("n") * F.col("y") * F.col("y")).alias("yy")).first()
        if not s["n"]:
            break
        mean = s["y"] / s["n"]
        sd = max(s["yy"] / s["n"] - mean ** 2, 0.0) ** 0.5 or 1.0
        new = means.select("j", F.array((F.col("y") - mean) / sd).alias("vec"), "n")
        moved = new.join(state.select("j", F.col("vec")[0].alias("old")), "j").agg(F.max(F.abs(F.col("vec")[0] - F.col("old")))).first()[0]
        state = cut_lineage(new, "fs-start")
        if moved < 0.01:
            break
    share = F.least(F.greatest(F.col("n") / max(n_users, 1), F.lit(1e-3)), F.lit(1 - 1e-3)) if "n" in state.columns else F.lit(0.5)
    state = cut_lineage(state.select("j", F.array(F.log(share / (1 - share)), F.col("vec")[0]).alias("vec")), "fs-elites")
    zeta = 1.0

    def sums(docs: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({"kind": [], "j": [], "vec": []})
        row, local, value, columns, _ = flat(docs["js"], docs["cs"])
        p = aligned(params, columns)
        _, theta, diff, r, h = _users(row, local, value, len(docs), p[:, 0], p[:, 1], zeta)
        slope, m = 2 * zeta * diff, len(columns)
        per = np.stack([np.bincount(local, v, m) for v in (r, r * slope, h, h * slope, h * slope ** 2)], axis=1)
        whole = np.array([-(r * diff ** 2).sum(), (h * diff ** 4).sum(), theta.sum(), (theta ** 2).sum(), len(theta)])
        return pd.concat([pd.DataFrame({"kind": "elite", "j": columns.astype("int32"), "vec": list(per)}),
                          pd.DataFrame({"kind": ["all"], "j": [int(docs["block"].iloc[0])], "vec": [whole]})], ignore_index=True)

    for _ in range(iters if n_users else 0):
        parts = cut_lineage(blocks.solve(state, sums, _SUMS), "fs-parts")
        gz, hz, t1, t2, n = total(parts.where("kind = 'all'"), 5)
        m, s = t1 / n, max(t2 / n - (t1 / n) ** 2, 1e-12) ** 0.5
        zeta_new = float(np.clip(zeta + lr * np.clip(gz / (hz + 1e-9), -0.2, 0.2) * 0.5, 0.05, 20.0))
        j = summed(parts.where("kind = 'elite'"), blocks.size).select("j", F.col("vec").alias("g")).join(state, "j")
        a, p, g = F.col("vec")[0], F.col("vec")[1], [F.col("g")[i] for i in range(5)]
        ga, gp = g[0] - a / 25.0, g[1] - p
        haa, hap, hpp = g[2] + 1 / 25.0, g[3], g[4] + 1.0
        det = haa * hpp - hap * hap

        def capped(c):
            return F.least(F.greatest(c, F.lit(-1.0)), F.lit(1.0)) * lr

        new = j.select("j", F.array(a + capped((hpp * ga - hap * gp) / det), (p + capped((haa * gp - hap * ga) / det) - m) / s).alias("vec"), p.alias("old"))
        new = cut_lineage(new, "fs-elites")
        moved = new.agg(F.max(F.abs(F.col("vec")[1] - F.col("old")))).first()[0]
        state, zeta = new.select("j", "vec"), zeta_new * s * s
        if moved < tol:
            break

    def positions(docs: pd.DataFrame, params: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({user: [], "beta": [], "theta": []})
        row, local, value, columns, _ = flat(docs["js"], docs["cs"])
        p = aligned(params, columns)
        beta, theta, *_ = _users(row, local, value, len(docs), p[:, 0], p[:, 1], zeta)
        return pd.DataFrame({user: docs[user], "beta": beta, "theta": theta})

    users = cut_lineage(blocks.solve(state, positions, f"`{user}` {user_kind}, beta double, theta double"), "fs-users")
    found = elites.join(state, "j").select(elite, F.col("vec")[0].alias("alpha"), F.col("vec")[1].alias("phi"))
    st = users.agg(F.avg("theta"), F.stddev_pop("theta")).first()
    m, s = st[0] or 0.0, st[1] or 1.0
    out = found.orderBy(F.desc(F.abs("phi")), elite).select("phi").first()
    turn = -1.0 if out and out[0] < 0 else 1.0
    return (users.select(user, "beta", ((F.col("theta") - m) / s * turn).alias("theta")),
            found.select(elite, "alpha", ((F.col("phi") - m) / s * turn).alias("phi")))
