"""Truncated SVD, GloVe, skip-gram in blocks, and slices of time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import embeddings as E
from quire.operators import factors as FA
from quire.operators import skipgram as SG


def cells(spark, m):
    rows = [(f"r{i:02d}", f"c{j:02d}", float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)]
    return spark.createDataFrame(rows, "term1 string, term2 string, value double")


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    m = np.where(rng.random((20, 12)) < 0.5, rng.normal(size=(20, 12)), 0)
    u, s, _ = np.linalg.svd(m)
    V, got = FA.truncated_svd(cells(spark, m), 5)
    assert got == pytest.approx(s[:5], abs=1e-9)
    rows = {r.term: np.array(r.vec) for r in V.collect()}
    for k in range(5):
        mine = np.array([rows[f"r{i:02d}"][k] for i in range(20)])
        true = u[:, k] * np.sign(u[np.abs(u[:, k]).argmax(), k])
        assert mine == pytest.approx(true, abs=1e-6)
    # columns are terms too; as rows they are empty
    assert all(np.abs(rows[f"c{j:02d}"]).max() < 1e-9 for j in range(12) if f"c{j:02d}" in rows)


def test_svd_of_a_symmetric_table_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 40))
    m = m + m.T
    from quire.operators import blocks
    monkeypatch.setattr(blocks, "CELLS", 200)
    monkeypatch.setattr(FA, "in_blocks", lambda *a, **k: blocks.in_blocks(*a, **k, cells=200))
    rows = [(f"w{i:02d}", f"w{j:02d}", float(m[i, j])) for i in range(40) for j in range(40)]
    V, got = E.svd_vectors(spark.createDataFrame(rows, "term1 string, term2 string, pmi double"), 12)
    assert got == pytest.approx(np.linalg.svd(m)[1][:12], abs=1e-6)
    x = np.array([r.vec for r in V.orderBy("term").collect()])
    assert x.T @ x == pytest.approx(np.eye(12), abs=1e-6)


def test_glove_loss_falls_and_stops(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(25, 3)) * 0.7
    counts = np.exp(v @ v.T + 1)
    rows = [(f"w{i:02d}", f"w{j:02d}", float(counts[i, j])) for i in range(25) for j in range(25) if i != j]
    V, losses = E.glove(spark.createDataFrame(rows, "term1 string, term2 string, n double"), rank=4, iters=12, tol=0.05)
    assert all(b <= a * 1.0001 for a, b in zip(losses, losses[1:], strict=False)) and losses[-1] < 0.2 * losses[0]
    assert V.count() == 25 and len(losses) <= 12
    assert V.agg(F.max(F.size("vec"))).first()[0] == 4


def corpus(n, pairs, seed):
    """Texts in which the words of a pair occur together."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        group = pairs[int(rng.integers(len(pairs)))]
        out.append((i, [str(w) for w in rng.choice(group, 12)] + [f"x{i}"]))
    return out


def test_skipgram_loss_falls_and_neighbours_are_found(spark):
    groups = [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)], [f"c{i}" for i in range(6)]]
    rows = corpus(400, groups, 1)
    arr = spark.createDataFrame(rows + rows[:50], "doc_id long, toks array<string>")  # copies count once
    V, losses = SG.skipgram(arr, size=16, window=5, min_count=10, epochs=6)
    assert losses[-1] < 0.85 * losses[0] and len(losses) == 6
    x = {r.term: np.array(r.vec) for r in V.collect()}
    assert set(x) == {w for g in groups for w in g}  # the words seen once are left out
    cos = lambda a, b: x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b])
    own = np.mean([cos(f"{g}0", f"{g}{i}") for g in "abc" for i in range(1, 6)])
    other = np.mean([cos("a0", "b1"), cos("a0", "c2"), cos("b0", "c3")])
    assert own > other + 0.3
    again, _ = SG.skipgram(arr, size=16, window=5, min_count=10, epochs=6)
    assert {r.term: r.vec for r in again.collect()} == {t: v.tolist() for t, v in x.items()}


def test_slices_show_a_planted_shift_of_meaning(spark):
    a, b = [f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]
    early = [(i, t, 0) for i, t in corpus(300, [[*a, "shift"], b], 2)]
    late = [(i + 1000, t, 1) for i, t in corpus(300, [a, [*b, "shift"]], 3)]
    arr = spark.createDataFrame(early + late, "doc_id long, toks array<string>, year int")
    found = SG.temporal_embeddings(arr, F.col("year"), [0, 1], "chained", size=12, window=5, min_count=10, epochs=5).cache()
    moved = {r.term: r.cosine for r in SG.meaning_shift(found, 0, 1).collect()}
    assert min(moved, key=moved.get) == "shift" and np.median(list(moved.values())) > moved["shift"] + 0.2
    wide = SG.temporal_embeddings(arr, F.col("year"), [0, 1], "overlapping", size=4, min_count=10, epochs=1)
    assert wide.where("slice = 0").count() == wide.where("slice = 1").count() == 13
    with pytest.raises(ValueError):
        SG.temporal_embeddings(arr, F.col("year"), [0], "no such mode")


def test_procrustes_turns_one_space_onto_the_other(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(15, 4))
    q, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    frame = lambda m: spark.createDataFrame([(f"w{i}", [float(v) for v in r]) for i, r in enumerate(m)], "term string, vec array<double>")
    back = {r.term: r.vec for r in E.procrustes_align(frame(x), frame(x @ q)).collect()}
    assert np.array([back[f"w{i}"] for i in range(15)]) == pytest.approx(x)


def test_skipgram_blocks_do_not_multiply_with_the_texts(spark, monkeypatch):
    """A block trains on its texts a part at a time; it isn't cut in more blocks, each of which would be sent the vectors."""
    rng = np.random.default_rng(4)
    rows = [([f"w{int(t)}" for t in rng.integers(0, 8, 12)] + [f"u{i}"],) for i in range(150)]
    arr = spark.createDataFrame(rows, "toks array<string>")
    stored, blocks = SG.cut_lineage, {}

    def watched(table, label="t"):
        out = stored(table, label)
        if label == "sg-rows":
            blocks["n"] = out.select("block").distinct().count()
        return out

    monkeypatch.setattr(SG, "cut_lineage", watched)
    monkeypatch.setattr(SG, "WORDS", 300)
    V, losses = SG.skipgram(arr, size=8, window=3, min_count=10, epochs=3)
    assert blocks["n"] == 1 and V.count() == 8 and losses[-1] < losses[0]
    monkeypatch.setattr(SG, "BLOCK", 500)
    V, losses = SG.skipgram(arr, size=8, window=3, min_count=10, epochs=2, syncs=2)
    assert blocks["n"] > 1 and V.count() == 8 and len(losses) == 4


def test_svd_keeps_no_table_of_earlier_rounds(spark, tmp_path, monkeypatch):
    from quire.operators import factors as FC
    stored, tables = FC.cut_lineage, []

    def watched(table, label="t"):
        out = stored(table, label)
        tables.append((label, out.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]))
        return out

    monkeypatch.setattr(FC, "cut_lineage", watched)
    monkeypatch.setattr(FC, "SLICE", 3)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(12, 12))
    cells = spark.createDataFrame([(f"t{i:02d}", f"t{j:02d}", float(m[i, j])) for i in range(12) for j in range(12)], "term1 string, term2 string, value double")
    V, s = FC.truncated_svd(cells, 3)
    assert s == pytest.approx(np.linalg.svd(m)[1][:3], rel=1e-6) and V.count() == 12
    import os
    left = [label for label, path in tables if label in ("svd-x", "svd-q", "svd-y", "svd-b") and os.path.isdir(path)]
    assert left == []
