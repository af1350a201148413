"""Readers and writers: CSV with quotes/newlines, JSON lines with corrupt rows,
JSON arrays, vector text files, parquet round trip."""

import os
import tempfile

from pyspark.sql import types as T

from quire.sources import (load_table, read_csv, read_json, read_jsonl, read_vectors, save_table, write_json)


def _tmp():
    return tempfile.mkdtemp(prefix="quire-test-", dir="/tmp")


def test_csv_quotes_and_newlines(spark):
    d = _tmp()
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write('id,text,party\n1,"He said ""hi""\nand left",D\n2,"a, b",R\n')
    df = read_csv(spark, p)
    rows = {r.id: r for r in df.collect()}
    assert rows[1].text == 'He said "hi"\nand left' and rows[2].text == "a, b" and rows[2].party == "R"


def test_jsonl_good_and_bad(spark):
    d = _tmp()
    p = os.path.join(d, "n.jsonl")
    with open(p, "w") as f:
        f.write('{"headline": "A", "category": "CRIME"}\n{broken json\n{"headline": "B", "category": "SPORTS"}\n')
    schema = T.StructType([T.StructField("headline", T.StringType()), T.StructField("category", T.StringType())])
    good, bad = read_jsonl(spark, p, schema)
    assert sorted(r.headline for r in good.collect()) == ["A", "B"]
    assert [r.line for r in bad.collect()] == ["{broken json"]


def test_json_round_trip_and_array_files(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, body string")
    write_json(df, os.path.join(d, "out"))
    back = read_json(spark, os.path.join(d, "out"), text_field="body")
    assert sorted((r.id, r.text) for r in back.collect()) == [(1, "x"), (2, "y")]
    p = os.path.join(d, "arr.json")
    with open(p, "w") as f:
        f.write('[{"id": 1, "speech": "s1"}, {"id": 2, "speech": "s2"}]')
    arr = read_json(spark, p, text_field="speech", multiline=True)
    assert sorted(r.text for r in arr.collect()) == ["s1", "s2"]


def test_read_vectors(spark):
    d = _tmp()
    p = os.path.join(d, "v.txt")
    with open(p, "w") as f:
        f.write("3 2\nking 0.5 1.5\nqueen 0.25 -1\n")
    v = {r.term: r.vec for r in read_vectors(spark, p, 2).collect()}
    assert v == {"king": [0.5, 1.5], "queen": [0.25, -1.0]}


def test_parquet_round_trip(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    save_table(df, os.path.join(d, "p"))
    assert load_table(spark, os.path.join(d, "p")).first().v == "a"
