"""CSV answers of a hot nation: every line numbered, no answer that grows with the table."""

from pyspark.sql import functions as F

from quire.plans import checks


def test_answers_are_bounded_and_lines_go_on(spark, tmp_path, monkeypatch):
    s = spark.range(7000).select((F.col("id") * 3).alias("s_suppkey"), F.concat(F.lit("Supplier, "), "id").alias("s_name"),
                                 F.when(F.col("id") % 3 == 0, 5).otherwise(7).alias("s_nationkey"))
    s.write.parquet(str(tmp_path / "supplier.parquet"))
    longest, parse = [], checks.N.csv_answer_rows

    def watched(df, col, fields):
        longest.append(df.select(F.max(F.size(F.split(col, "\n")))).first()[0])
        return parse(df, col, fields)

    monkeypatch.setattr(checks.N, "csv_answer_rows", watched)
    got = sorted(map(tuple, checks.csv_answers_to_rows(spark, str(tmp_path)).collect()))
    own = {n: [i for i in range(7000) if (i % 3 == 0) == (n == 5)] for n in (5, 7)}
    assert got == sorted((n, at, f"Supplier, {i}", str(3 * i)) for n in own for at, i in enumerate(own[n], 1))
    assert longest[0] <= 1001
