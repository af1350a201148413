"""Factorial preprocessing: the 64 combinations apply their steps."""

from quire.operators import pretext as PT


def test_factorial_dfm_steps(spark):
    docs = spark.createDataFrame([(1, "The Cats ran, 3 times!"), (2, "the cat runs")], "doc_id long, text string")
    assert PT.combinations(spark).count() == 64
    f = PT.factorial_dfm(docs, threshold=0.2)
    combos = {r.combo: r for r in PT.combinations(spark).collect()}

    def terms(c):
        return sorted(r.term for r in f.filter(f.combo == c).filter(f.doc_id == 1).collect())
    none = [c for c, r in combos.items() if not any(r[s] for s in PT.STEPS)][0]
    assert terms(none) == sorted(["The", "Cats", "ran", ",", "3", "times", "!"])
    full = [c for c, r in combos.items() if all(r[s] for s in PT.STEPS[:5]) and not r["infrequent"]][0]
    assert terms(full) == ["cat", "ran", "time"]


def test_pretext_scores_shape(spark):
    texts = ["a b c d the", "a b e f of", "c d e f and", "b c d g in", "e f g h to"]
    docs = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")
    s = PT.pretext_scores(PT.factorial_dfm(docs), k=3)
    rows = s.collect()
    assert len(rows) == 64 and all(r.pretext_score >= 0 for r in rows)
