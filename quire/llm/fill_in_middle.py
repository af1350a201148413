"""Fill-in-middle by counted quantifiers. DataFrame functions only.

A text of n code points is cut at two places a <= b that a hash of its id
chooses. n comes from ``regexp_count``. Then each row has a pattern of its own,
``(.{a}+)(.{b-a}+)(.*+)``: possessive groups that count code points, so that
one match captures prefix, middle and suffix and puts them down in the order of the
form - no positions are searched, nothing is tried twice, and the matcher doesn't
recurse. Prefix-suffix-middle is ``<P>prefix<S>suffix<M>middle``,
suffix-prefix-middle ``<S>suffix<P>prefix<M>middle``; plain is the text as it is.

A text stays plain if it is empty, if it holds one of the marks (so that the
marks of an output are always those of the form), or by its hash in a share of
rows. Every output can be turned back (:func:`restored`).

``regexp_count`` lists what it counts, so blocks of ``BLOCK`` code points are
counted first and single ones only in what is left: a long text costs a
short list. ``\\G`` lets a block begin only where the last one ended, so
the end of a text isn't scanned from each of its places.

Everything happens inside the row: no shuffle, no state, no Python. Null texts are empty, a null id
hashes like an empty one, repeated rows get the same cuts, an empty table gives an
empty result; helper columns have names that clash with none of the table's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of 100 rows those that stay plain; of 100 others those in suffix-prefix-middle form.
PLAIN, SPM = 10, 20
BLOCK = 256


def code_points(text: Column) -> Column:
    """Code points of a text."""
    blocks = F.regexp_count(text, F.lit(rf"(?s)\G.{{{BLOCK}}}+"))
    rest = F.regexp_replace(text, rf"(?s)\A(?:.{{{BLOCK}}}+)*+", "")
    return blocks.cast("long") * BLOCK + F.regexp_count(rest, F.lit("(?s).")).cast("long")


def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from an id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _marked(text: Column, first: Column, middle: Column, order: str) -> Column:
    """The text cut by one match of the row's own pattern, put down in ``order``."""
    pattern = F.concat(F.lit(r"(?s)\A(.{"), first.cast("string"), F.lit("}+)(.{"), middle.cast("string"), F.lit(r"}+)(.*+)\z"))
    return F.regexp_replace(text, pattern, F.lit(order))


PSM_ORDER = f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"
SPM_ORDER = f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"


def transform(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = SEED, plain: int = PLAIN,
              spm: int = SPM) -> tuple[DataFrame, list[str]]:
    """``docs`` with [n, form, prefix_chars, middle_chars, output] (lengths are
    null for plain texts); the names of these columns, clear of the table's own, come second."""
    names = fresh(docs, "n", "form", "prefix_chars", "middle_chars", "output")
    n, form, first, middle, output = names
    t, h = fresh(docs.select("*", *[F.lit(0).alias(x) for x in names]), "fim_text", "fim_draws")
    rows = docs.withColumn(t, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = rows.withColumns({n: code_points(F.col(t)), h: F.array(*draws(F.col(f"`{id_col}`"), seed))})
    one, two, three, four = (F.col(h)[i] for i in range(4))
    stays = ((F.col(n) == 0) | (three % 100 >= 100 - plain)
             | F.contains(F.col(t), F.lit(PREFIX)) | F.contains(F.col(t), F.lit(SUFFIX)) | F.contains(F.col(t), F.lit(MIDDLE)))
    a, b = one % (F.col(n) + 1), two % (F.col(n) + 1)
    rows = rows.withColumn(form, F.when(stays, "plain").when(four % 100 < spm, "spm").otherwise("psm"))
    cut = F.col(form) != "plain"
    rows = rows.withColumns({first: F.when(cut, F.least(a, b)), middle: F.when(cut, F.greatest(a, b) - F.least(a, b))})
    rows = rows.withColumn(output, F.when(F.col(form) == "psm", _marked(F.col(t), F.col(first), F.col(middle), PSM_ORDER))
                           .when(F.col(form) == "spm", _marked(F.col(t), F.col(first), F.col(middle), SPM_ORDER)).otherwise(F.col(t)))
    return rows.drop(t, h), names


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir):
    """Every whole text of ``documents`` in fill-in-middle form, by its digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, (n, form, first, middle, output) = transform(docs)
    return found.select("doc_id", F.col(n).alias("n"), F.col(form).alias("form"), F.col(first).alias("prefix_chars"),
                        F.col(middle).alias("middle_chars"), F.sha2(F.col(output), 256).alias("output_sha256"),
                        F.sha2(restored(F.col(output), F.col(form)), 256).alias("restored_sha256"))


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {100 - PLAIN}
    THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM e),
g AS (SELECT *, left(t, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g"""
