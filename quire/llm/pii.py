"""Personal data in texts: patterns propose spans, checksums confirm them and
words nearby adjust their score. DataFrame functions only.

Every kind has one pattern, whose matches are taken leftmost and without
overlap; a validator that a match must pass; a score that a passed checksum
and a context word raise; a span is kept if its score reaches ``THRESHOLD``.
The base kinds (email, ip, card, phone) score high enough without context, so
context never removes one of them.

The patterns are written so that the JVM's matcher neither recurses nor
rescans: repeated groups are possessive, and a run of letters or digits is
entered only at its start or where the last match ended (``\\G``). They match
the same spans as the plain forms.

Positions: the text is split at the matches; a match starts where the lengths
of all earlier pieces and matches add up to. The sums run in a window over the
exploded matches of one document, so a text with many spans costs no more
per span than any other. Null texts are empty texts; a document without spans
has empty results; repeated rows stay separate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import fresh, table

THRESHOLD = 0.5
#: Code points before and after a span in which context words count, whatever lies between.
NEAR = 40
#: Matches that can lie within NEAR code points: none has fewer than five.
WITHIN = 8


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float
    valid: Callable[[Column], Column] | None = None
    confirmed: float = 0.0  # added where the validator is a checksum that passed
    context: str = ""  # words, as an alternation
    needs: str = ""  # a text without this string has no match


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _ip(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


def _iban(m: Column) -> Column:
    """ISO 13616: the first four characters go to the end, letters count from
    10, and the number leaves 1 when divided by 97 (taken digit by digit)."""
    s = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.left(s, F.lit(4)))
    rest = F.aggregate(
        F.split(turned, "(?!^)(?!$)"), F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48)
        .otherwise(acc * 100 + F.ascii(c) - 55) % 97)
    return F.length(s).between(15, 34) & (rest == 1)


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.8, context="mail|contact|correo|courriel|kontakt", needs="@"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         0.6, _ip, context="ip|host|server|address|adresse", needs="."),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
         0.5, _card, 0.3, context="card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         0.6, _phone, context="phone|call|tel|fax|mobile|telefon", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         0.3, _iban, 0.5, context="iban|account|konto|cuenta|compte"),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
         0.3, context="ssn|social security|tax id", needs="-"),
    Kind("tel", r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         0.3, context="phone|call|tel|fax|mobile|telefon"),
)
BASE = ("email", "ip", "card", "phone")


def _score(kind: Kind, before: Column, match: Column, after: Column) -> Column:
    """A match's score; null where its validator fails."""
    near = F.lower(F.concat_ws(" ", before, after))
    score = F.lit(kind.score + kind.confirmed)
    if kind.context:
        score = score + F.when(near.rlike(rf"(?:^|[^a-z])(?:{kind.context})"), 0.2).otherwise(0.0)
    return F.when(kind.valid(match), score) if kind.valid else score


def _pieces(df: DataFrame, text: str, kind: Kind, m: str, p: str) -> DataFrame:
    """Adds the matches ``m`` of a kind and, where there are some, the pieces
    ``p`` of text around them (one more than matches)."""
    found = F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))
    if kind.needs:
        found = F.when(F.contains(F.col(text), F.lit(kind.needs)), found)
    df = df.withColumn(m, found)
    return df.withColumn(p, F.when(F.size(m) > 0, F.split(F.col(text), kind.pattern, -1)))


def _scored(kind: Kind, m: str, p: str, item: Callable) -> Column:
    """item(index, piece before, match, score) for each match.

    The context of a match is cut from the ends of the pieces around it and of
    the matches and pieces beyond them, as many as ``NEAR`` code points can hold."""
    pairs = F.arrays_zip(F.col(m).alias("m"), F.slice(F.col(p), F.lit(1), F.size(m)).alias("b"),
                         F.slice(F.col(p), F.lit(2), F.size(m)).alias("a"))
    before = F.transform(pairs, lambda z: F.concat(F.right(z["b"], F.lit(NEAR)), z["m"]))
    after = F.transform(pairs, lambda z: F.concat(z["m"], F.left(z["a"], F.lit(NEAR))))

    def of(s: Column) -> Column:  # bound once, so that nothing is computed again for each match
        return F.transform(s["pairs"], lambda z, i: item(i, z["b"], z["m"], _score(
            kind,
            F.right(F.concat(F.array_join(F.slice(s["before"], F.greatest(i - WITHIN, F.lit(0)) + 1, F.least(i, F.lit(WITHIN))), ""),
                             F.right(z["b"], F.lit(NEAR))), F.lit(NEAR)),
            z["m"],
            F.left(F.concat(F.left(z["a"], F.lit(NEAR)), F.array_join(F.slice(s["after"], i + 2, F.lit(WITHIN)), "")), F.lit(NEAR)))))

    bound = F.array(F.struct(pairs.alias("pairs"), before.alias("before"), after.alias("after")))
    return F.when(F.size(m) > 0, F.element_at(F.transform(bound, of), 1))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
         kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """A row per span: a row number ``rid`` of its document, the columns
    ``keep`` of that document, ``kind_no`` and ``kind``, ``start`` and ``end``
    (code points, end exclusive), ``score``, ``value``. A document without
    spans has one row with null ``kind``."""
    keep = list(keep or [])
    named = [F.col(f"`{c}`").alias(f"k{j}") for j, c in enumerate(keep)]
    df = docs.select(F.monotonically_increasing_id().alias("rid"), *named,
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    arrays = []
    for j, kind in enumerate(kinds):
        df = _pieces(df, "t", kind, f"m{j}", f"p{j}")
        arrays.append(F.coalesce(_scored(kind, f"m{j}", f"p{j}", lambda i, b, m, s, j=j: F.struct(
            F.lit(j).alias("kind_no"), i.alias("ord"), F.length(b).alias("gap"), m.alias("value"),
            s.alias("score"))), F.array().cast(
                "array<struct<kind_no:int,ord:int,gap:int,value:string,score:double>>")))
    ks = [f"k{j}" for j in range(len(keep))]
    rows = df.select("rid", *ks, F.concat(*arrays).alias("s")).select("rid", *ks, F.inline_outer("s"))
    upto = (Window.partitionBy("rid", "kind_no").orderBy("ord")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto))
    names = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("kind_no") + 1)
    good = F.col("score") >= THRESHOLD - 1e-9
    return rows.select("rid", *[F.col(k).alias(c) for k, c in zip(ks, keep, strict=True)],
                       F.when(good, F.col("kind_no")).alias("kind_no"),
                       F.when(good, names).alias("kind"),
                       F.when(good, F.col("end") - F.length("value")).alias("start"),
                       F.when(good, F.col("end")).alias("end"),
                       F.when(good, F.col("score")).alias("score"),
                       F.when(good, F.col("value")).alias("value"))


def digest(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: how many spans of each base kind, the SHA-256 of the
    base spans' list and the list of all spans."""
    ks = find(docs, text, [id_col])
    spans = F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("kind_no", "start", "end", "kind"))))

    def joined(arr: Column) -> Column:
        return F.array_join(F.transform(arr, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    per = ks.groupBy("rid").agg(
        F.first(id_col).alias(id_col),
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE], spans.alias("s"))
    return per.select(
        id_col, *[f"n_{k}" for k in BASE],
        F.sha2(joined(F.filter("s", lambda s: s["kind_no"] < len(BASE))), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars",
           kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The same rows and columns with each kept span replaced by its kind in
    brackets, one kind after another, in place and without a shuffle; a null
    text stays null. ``n_chars``, if the table has it, is counted anew."""
    columns = docs.columns
    t, m, p = fresh(docs, "pii_t", "pii_m", "pii_p")
    df = docs.withColumn(t, F.col(f"`{text}`"))
    for j, kind in enumerate(kinds):
        mj, pj = f"{m}{j}", f"{p}{j}"
        df = _pieces(df, t, kind, mj, pj)
        parts = _scored(kind, mj, pj, lambda i, b, v, s, k=kind: F.concat(
            b, F.when(s >= THRESHOLD - 1e-9, F.lit(f"[{k.name.upper()}]")).otherwise(v)))
        df = df.withColumn(t, F.when(F.size(mj) > 0, F.concat(
            F.array_join(parts, ""), F.element_at(F.col(pj), -1))).otherwise(F.col(t))).drop(mj, pj)
    out = [F.col(t).alias(c) if c == text else
           F.length(t).cast(docs.schema[c].dataType).alias(c) if n_chars and c == n_chars else F.col(f"`{c}`")
           for c in columns]
    return df.select(*out)


def op5_personal_data(spark, sf_dir):
    """Personal data in every whole text of ``documents``."""
    return digest(table(spark, sf_dir, "documents"))
