"""Row ids on a million rows, lookups without silent caps, the shared folder."""

import pytest
from pyspark.sql import functions as F

from quire import session
from quire.operators import comparisons as N
from quire.operators import lexicon as L
from quire.operators import topics as P
from quire.operators.relational import split_exact
from quire.sources.files import bad_vector_lines, read_vectors, with_row_id

MILLION = 1_000_000


@pytest.mark.parametrize("aqe,advisory", [("true", "64m"), ("true", "1m"), ("false", "64m")])
def test_row_ids_with_payload_are_dense(spark, aqe, advisory):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    try:
        df = spark.range(MILLION, numPartitions=7).select(
            F.xxhash64("id").alias("k"), F.concat(F.lit("payload "), F.col("id").cast("string")).alias("p"))
        r = with_row_id(df, ["k"], "i").agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"),
                                            F.min("i").alias("lo"), F.max("i").alias("hi"),
                                            F.countDistinct("p").alias("p")).first()
        assert tuple(r) == (MILLION, MILLION, 1, MILLION, MILLION)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_row_ids_follow_the_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, p string")
    assert [(r.k, r.p, r.row_id) for r in with_row_id(df, ["k"]).orderBy("k").collect()] == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]


def test_split_sizes_are_exact(spark):
    df = spark.range(10_001).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    n = {r["split"]: r["count"] for r in split_exact(df, 0.8, "doc_id").groupBy("split").count().collect()}
    assert n == {"train": 8001, "test": 2000}


def test_checkpoint_folder_is_required_outside_one_process(spark, monkeypatch):
    assert session.is_local("local[4]") and session.is_local("local")
    assert not session.is_local("local-cluster[3,2,1000]") and not session.is_local("yarn")

    class Context:
        master = "yarn"
        _jsc = None

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_deep_category_chains_close_and_cycles_raise(spark):
    words = L.dictionary_table(spark, {"c0": ["word"]})
    chain = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(12)], "category string, parent string")
    found = {r.category for r in L.dictionary_closure(words, chain).collect()}
    assert found == {f"c{i}" for i in range(13)}
    ring = spark.createDataFrame([("c0", "c1"), ("c1", "c0")], "category string, parent string")
    with pytest.raises(ValueError):
        L.dictionary_closure(words, ring).count()


def test_vector_words_may_hold_blanks_and_bad_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 2\nnew york 1.0 2.0\ncat 3 4\nbroken 1.0\ndog x 1\n")
    path = str(tmp_path / "v.txt")
    assert {r.term: r.vec for r in read_vectors(spark, path, 2).collect()} == {"new york": [1.0, 2.0], "cat": [3.0, 4.0]}
    assert {r.line for r in bad_vector_lines(spark, path, 2).collect()} == {"2 2", "broken 1.0", "dog x 1"}


def test_tone_keeps_all_places_of_a_weight(spark):
    d = spark.createDataFrame([(1, "w", 3)], "doc_id long, term string, n long")
    dic = L.dictionary_table(spark, {"x": ["w"]}, {"w": 0.123456789})
    assert L.tone(d, dic).first()["tone"] == pytest.approx(0.123456789, abs=1e-12)


def test_extraction_prompt_names_both_and_the_direction(spark):
    df = spark.createDataFrame([("Ann", "Bob", "liberal", "Ann is.")], "a string, b string, d string, answer string")
    text = N.extraction_prompts(df, "answer", "d", "a", "b").first()["extract_prompt"]
    assert "Ann or Bob" in text and "more liberal" in text and "more conservative" in text and text.endswith("Ann is.")


def test_lda_draws_several_passes(spark, monkeypatch):
    import pyspark.ml.clustering as C
    seen = {}

    class Fake:
        def __init__(self, **kw):
            seen.update(kw)

        def fit(self, df):
            return None

    monkeypatch.setattr(C, "LDA", Fake)
    P.lda(None, 3, max_iter=10)
    assert seen["subsamplingRate"] * seen["maxIter"] >= 5
