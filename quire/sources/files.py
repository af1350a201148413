"""File sources and sinks: CSV, JSON lines with corrupt rows, JSON arrays,
word-vector text files, parquet tables, row ids and table profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             multiline: bool = True) -> DataFrame:
    """A1: CSV with header; text cells may hold quotes and, with ``multiline``,
    newlines. Such a file is read by one task; files whose cells have no
    newlines should be read with ``multiline=False``, which splits them.

    Pass ``schema`` on large inputs: inference costs an extra pass over the data.
    """
    r = (spark.read.option("header", True).option("multiLine", multiline)
         .option("escape", '"').option("quote", '"'))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """A2: line-delimited JSON where some lines are corrupt.

    Returns ``(good, bad)``: good rows with the given schema, and the raw text of
    lines that failed to parse (quarantine), both from a single scan plan.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = (spark.read.text(path).where(F.trim("value") != "")
            .select("value", F.from_json("value", full, options).alias("_r")))
    bad = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    return (rows.where(~bad).select(*[F.col(f"_r.`{f.name}`") for f in schema.fields]),
            rows.where(bad).select(F.col("value").alias("line")))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: write a table as JSON lines (one object per row, one file per partition)."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, text_field: str = "text",
              multiline: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """A3: read JSON back and name the text field ``text``.

    ``multiline=True`` reads files holding one JSON array of objects.
    """
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path)
    return df.withColumnRenamed(text_field, "text") if text_field != "text" else df


def read_vectors(spark: SparkSession, path: str, dim: int, sep: str = " ") -> DataFrame:
    """A4: pretrained vectors as text, word first then ``dim`` floats, no quoting.

    The numbers are the last ``dim`` fields, so a word may hold the separator.
    Lines without ``dim`` numbers (a header, damaged lines) are in
    :func:`bad_vector_lines`.
    """
    return _vector_lines(spark, path, dim, sep).where("good").select("term", "vec")


def bad_vector_lines(spark: SparkSession, path: str, dim: int, sep: str = " ") -> DataFrame:
    """A4: the lines that :func:`read_vectors` can't read, as ``line``."""
    return _vector_lines(spark, path, dim, sep).where("not good").select(F.col("value").alias("line"))


def _vector_lines(spark: SparkSession, path: str, dim: int, sep: str) -> DataFrame:
    parts = F.split(F.rtrim("value"), sep if sep != " " else " +")
    lines = spark.read.text(path).select("value", parts.alias("p")).withColumn("k", F.size("p") - dim)
    numbers = F.transform(F.slice("p", F.greatest(F.col("k"), F.lit(0)) + 1, dim), lambda x: x.try_cast("float"))
    lines = lines.select("value", "k", numbers.alias("vec"),
                         F.array_join(F.slice("p", 1, F.greatest(F.col("k"), F.lit(0))), sep).alias("term"))
    return lines.withColumn("good", (F.col("k") >= 1) & (F.size("vec") == dim) & ~F.exists("vec", lambda x: x.isNull()))


def save_table(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> None:
    """A5: persist an intermediate table as parquet (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A5: load a table saved by :func:`save_table`."""
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """A5: keep a fitted Spark ML model (or pipeline model)."""
    model.write().overwrite().save(path)


def load_model(path: str, kind: type):
    """A5: a model saved by :func:`save_model`; kind: its class, e.g. ``LDAModel``'s subclass or ``PipelineModel``."""
    return kind.load(path)


def with_row_id(df: DataFrame, order_by: list[str | Column] | None = None,
                name: str = "row_id") -> DataFrame:
    """Attach a row id.

    With ``order_by`` the id is 1..n in that (total) order: the sorted rows are
    written once to the shared checkpoint folder with their partition and their
    place, and both the offsets and the rows are read from that one table. (Two
    plans of the same sort may sample other range borders, and a join of the two
    would lose rows.) No single-partition window is used.
    Without it the id is unique but not dense (``monotonically_increasing_id``).
    """
    if not order_by:
        return df.withColumn(name, F.monotonically_increasing_id())
    columns = df.columns
    placed = cut_lineage(df.orderBy(*order_by).withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "row-id")
    # one row per partition of the sort: tiny, safe on a single task
    first = placed.groupBy("_pid").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = first.select("_pid", "_m0", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offs), "_pid")
            .select(*[F.col(f"`{c}`") for c in columns], (F.col("_mid") - F.col("_m0") + F.col("_off") + 1).alias(name)))


def profile(df: DataFrame) -> DataFrame:
    """One row per column — type, non-null count, distinct estimate, min, max."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        orderable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        exprs.append(F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(c).alias("non_null"),
            (F.approx_count_distinct(c) if orderable else F.lit(None).cast("long")).alias("approx_distinct"),
            (F.min(c).cast("string") if orderable else F.lit(None).cast("string")).alias("min"),
            (F.max(c).cast("string") if orderable else F.lit(None).cast("string")).alias("max"),
        ))
    row = df.agg(F.array(*exprs).alias("cols"), F.count("*").alias("rows"))
    return row.select("rows", F.inline("cols"))
