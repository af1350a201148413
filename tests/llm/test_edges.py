"""Context across neighbouring matches, helper columns with clashing names,
near-duplicates with maps, padding of very short texts, mixes without moving texts."""

import collections

import numpy as np
from pyspark.sql import functions as F

from quire.llm import kneser_ney, mixing, packing, pii, simhash, token_counts
from quire.llm.common import fresh


CONTEXTS = {  # text -> kinds found, text without them
    "SSN: 123-45-6789, 987-65-4321": (["ssn", "ssn"], "SSN: [SSN], [SSN]"),
    "call 555-123-4567 or 555-987-6543": (["tel", "tel"], "call [TEL] or [TEL]"),
    "222-33-4444 / 333-44-5555 (both SSN)": (["ssn", "ssn"], "[SSN] / [SSN] (both SSN)"),
    "555-123-4567, 555-987-6543, 555-111-2222 tel": (["tel"] * 3, "[TEL], [TEL], [TEL] tel"),
    "ssn" + " " * 37 + "123-45-6789": (["ssn"], "ssn" + " " * 37 + "[SSN]"),
    "ssn" + " " * 41 + "123-45-6789": ([], "ssn" + " " * 41 + "123-45-6789"),
    # 40 code points before the second number don't reach the label
    "ssn 123-45-6789" + " " * 30 + "987-65-4321": (["ssn"], "ssn [SSN]" + " " * 30 + "987-65-4321"),
    "no label: 123-45-6789": ([], "no label: 123-45-6789"),
}


def test_context_is_forty_code_points_whatever_lies_between(spark):
    df = spark.createDataFrame(list(enumerate(CONTEXTS)), "doc_id long, text string")
    kinds = collections.defaultdict(list)
    for r in pii.find(df, keep=["doc_id"]).where("kind is not null").orderBy("doc_id", "start").collect():
        kinds[r.doc_id].append(r.kind)
    left = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert [(kinds[i], left[i]) for i in range(len(CONTEXTS))] == list(CONTEXTS.values())


def test_helper_names_never_clash(spark):
    rows = [(i, f"some words of text {i} that are long enough to be a document " * 3, "en") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(i) for i, c in enumerate(("_text", "_TEXT_", "n_words", "kn_bits", "fp", "simhash_hash", "own", "stays", "text_hash", "pii_t",
                                            "mix_epoch", "mix_lang", "id"))})
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    assert kneser_ney.keep_good(spark, docs, labels).columns == docs.columns
    assert simhash.deduplicate(docs).columns == docs.columns
    assert pii.redact(docs).columns == docs.columns
    out, h = mixing.mix(docs, {"lang": "lang"}, {})
    assert [c for c in out.columns if c not in h] == docs.columns and not set(h) & set(docs.columns)
    import public_tokenizers
    counted = token_counts.with_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert counted.columns == [*docs.columns, "n_words_", "n_tokens", "n_unknown"] and counted.count() == 12
    assert fresh(docs, "_text") == ["_text__"]


def test_near_duplicates_with_maps_and_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, 2), (1, text, 1), (2, text, 0), (3, "quite another text with other words in it", 5), (None, text, 7), (4, None, 1), (None, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int").withColumn("m", F.create_map(F.lit("k"), F.col("x")))
    kept = simhash.deduplicate(df).collect()
    assert sorted((r.doc_id, r.x, r.m["k"]) for r in kept) == [(1, 1, 1), (3, 5, 5), (4, 1, 1)]


def test_near_duplicates_are_the_same_by_either_join(spark, monkeypatch):
    base = [" ".join(f"w{(i * 7 + j) % 50}" for j in range(30)) for i in range(8)]
    rows = [(i, base[i % 8]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = sorted(map(tuple, simhash.deduplicate(df).collect()))
    monkeypatch.setattr(simhash, "NAMED", -1)
    assert sorted(map(tuple, simhash.deduplicate(df).collect())) == first
    assert len({t for _, t in first}) == len(first)


def test_very_short_texts_are_packed_with_little_padding(spark):
    df = spark.createDataFrame([(i, " ".join(["word"] * 8)) for i in range(4000)] + [(9000 + i, "") for i in range(3000)],
                               "doc_id long, text string").coalesce(1)
    used = collections.Counter()
    for r in packing.pack(df, *packing.vocabulary()).collect():
        used[r.sequence_id] += r.length
    places = sum(n if n & (n - 1) == 0 else 2048 for n in used.values())
    assert (places - sum(used.values())) / places < 0.02


def test_mix_moves_no_texts(spark, monkeypatch):
    rows = [(i, "a few words " * (i % 9), f"l{i % 3}", f"s{i % 4}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    levels = {"lang": "lang", "source": "source"}
    out, h = mixing.mix(docs, levels, {})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    expected = sorted(map(tuple, out.collect()))
    monkeypatch.setattr(mixing, "LEAVES", -1)  # more leaves than are broadcast: joined by leaf
    assert sorted(map(tuple, mixing.mix(docs, levels, {})[0].collect())) == expected
    assert np.isfinite(len(expected)) and len(expected) > 300
