"""WARC archives: written and read by Spark's text files, record borders checked
as a chain.

Writing. A record is a string, and a text file whose line separator is the
empty line pair that ends every WARC record is a WARC file; Spark writes one
per task. Payloads of at least ``least`` bytes that occur several times are
written once (the row with the largest id), the others as ``revisit`` records.

Reading. The files are split at every ``WARC/1.`` by Spark's line reader, which
cuts a large file into ranges for many tasks; so the magic may be the start of
a record or part of a payload. Each task reports candidates: the offset of a
magic and, from the lengths in the header that follows it (over as many pieces
as it takes to reach the blank line), the offset where the next record must begin. A candidate is a record only if the chain of these
successors leads to it from the start of its file. Pointer jumping finds the
reachable ones: in each round what is reached so far adds what lies 2^k records
further, and the pointers double, so the rounds grow with the logarithm of the
records in a file. A magic that is not reached belongs to the payload before
it, and the pieces are joined again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, table
from quire.session import scratch_path

MAGIC = "WARC/1."
END = "\r\n\r\n"
#: Smallest payload, in bytes, for which copies become revisits.
LEAST = 1000
#: The magic as it is written inside header values (RFC 3986: the same url).
ESCAPED = "WARC/1%2E"
#: Parts into which the rows of one payload are dealt when they meet its count.
SALTS = 32


def records(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
            least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One WARC record (a string without its ending line pair) per row.

    Null payloads are empty. Of equal payloads of ``least`` bytes or more the
    rows with the largest id are responses (a null id counts as smallest;
    repeated rows of that id all are), the others revisits of it. Control
    characters and blanks of a url are escaped, and so is the magic in a url or
    an id; a null url is empty."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))

    def plain(c):
        return F.replace(c, F.lit(MAGIC), F.lit(ESCAPED))

    rows = pages.select(F.col(f"`{id_col}`").alias("id"), body.alias("body"),
                        plain(F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\x00-\x20\x7f]", "%20")).alias("url"))
    rows = rows.select("*", F.octet_length("body").alias("bytes"), F.sha1(F.col("body").cast("binary")).alias("digest"))
    # two steps, so that the rows of one frequent payload are counted in parts; only repeated payloads remain
    copied = (rows.where(F.col("bytes") >= least).groupBy("digest", "bytes")
              .agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("digest", "bytes", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    rows = rows.withColumn("salt", salt).join(copied, ["digest", "bytes", "salt"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))

    def name(c):
        return F.concat(F.lit("<urn:page:"), plain(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("body")))
    head = F.concat(
        F.lit(MAGIC + "1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name("id"), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            name("first_id"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str, compression: str = "gzip", **names) -> None:
    """Write a WARC file per task into ``path``. Gzip files are smaller and are
    read by one task each; with ``compression="none"`` Spark cuts large files
    into ranges."""
    records(pages, **names).write.option("lineSep", END).option("compression", compression).text(path)


def _header(field: str, source: str = "head"):
    return F.regexp_extract(source, rf"(?i)\r\n{field}:[ \t]*([^\r\n]*)", 1)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path``, cut at every magic: ``file``, ``block`` (where
    Spark's range of the file starts), ``seq`` (unique, in order), ``chunk``."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").alias("chunk")))


def candidates(raw: DataFrame) -> DataFrame:
    """Of each piece: ``file``, ``seq``, ``at`` (byte offset of its magic),
    ``next`` (the offset where its successor must begin, null if no valid
    header follows), ``no`` (order in the file). The bytes before a file's first magic
    have order 0 and are no candidate.

    Offsets: a piece begins where the lengths of all before it add up to, first
    over the pieces of a range, then over the ranges of a file.

    Headers: a header ends in the first piece from its magic on that holds a
    blank line (which no magic can cut), and its length is in the first piece
    up to there that names one. One pass from a file's end finds both."""
    part, ends = F.substring_index("chunk", END, 1), F.instr("chunk", END) > 0
    # a length that isn't followed by a line end in its piece goes on after a magic: no number
    told = F.regexp_extract(F.concat(part, F.when(ends, F.lit("\r\n")).otherwise(F.lit(""))),
                            r"(?i)\r\nContent-Length:[^\r\n]*[\r\n]?", 0)
    slim = raw.select("file", "block", "seq", (F.octet_length("chunk") + F.lit(len(MAGIC))).cast("long").alias("width"),
                      F.when(ends, F.octet_length(part)).alias("head_bytes"), told.alias("told"))
    slim = stored(slim.select("file", "block", "seq", "width", "head_bytes", (F.col("told") != "").alias("tells"),
                              F.when(F.col("told").rlike(r"[^\r\n][\r\n]$"), F.regexp_extract("told", r":[ \t]*([^\r\n]*)", 1))
                              .try_cast("long").alias("length")), "warc-pieces")
    sizes = slim.groupBy("file", "block").agg(F.sum("width").alias("bytes"), F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("from"),
                         F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("n_from"))
    in_range = Window.partitionBy("file", "block").orderBy("seq")
    rows = (slim.withColumn("before", F.coalesce(F.sum("width").over(
                in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("n_before", F.row_number().over(in_range) - 1).join(sizes, ["file", "block"]))
    rows = rows.select("file", "seq", (F.col("n_from") + F.col("n_before")).alias("no"),
                       (F.col("from") + F.col("before") - F.lit(len(MAGIC))).alias("at"), "head_bytes", "tells", "length")
    onward = Window.partitionBy("file").orderBy(F.desc("no")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.when(F.col("head_bytes").isNotNull(), F.struct("no", (F.col("at") + len(MAGIC) + F.col("head_bytes")).alias("to")))
    rows = (rows.withColumn("end", F.last(end, ignorenulls=True).over(onward))
            .withColumn("said", F.last(F.when(F.col("tells"), F.struct("no", "length")), ignorenulls=True).over(onward)))
    after = F.col("end.to") + len(END) + F.col("said.length") + len(END)
    whole = (F.col("no") > 0) & (F.col("said.no") <= F.col("end.no")) & (F.col("said.length") >= 0)
    return rows.select("file", "seq", "no", "at", F.when(whole, after).alias("next"))


def reachable(links: DataFrame) -> DataFrame:
    """(file, at) of the candidates that the chain from offset 0 of their file
    reaches. links: (file, at, next)."""
    jump = stored(links.select("file", "at", "next"), "warc-jump")
    reached = stored(jump.where("at = 0").select("file", "at"), "warc-reached")
    count = reached.count()
    while True:
        more = (reached.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
                .join(jump.select("file", "at"), ["file", "at"], "left_semi"))
        reached = stored(reached.union(more).distinct(), "warc-reached")
        now = reached.count()
        if now == count:
            return reached
        count = now
        onward = jump.select("file", F.col("at").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(onward, ["file", "next"], "left").select("file", "at", F.col("far").alias("next")), "warc-jump")


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: ``file``, ``at``, ``record_type``, ``record_id``,
    ``target_uri``, ``refers_to_id``, ``digest`` (as the header has it),
    ``payload`` (binary; null for a revisit). A piece whose magic is not a
    record's is part of the record before it."""
    raw = pieces(spark, path)
    found = stored(candidates(raw), "warc-candidates")
    real = reachable(found.where("no > 0"))
    # the record that a piece belongs to: the last reached one up to it (offsets only, no texts)
    upto = Window.partitionBy("file").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = (found.join(real.withColumn("real", F.lit(True)), ["file", "at"], "left")
             .withColumn("owner", F.max(F.when(F.col("real"), F.col("at"))).over(upto))
             .where("owner is not null")
             .withColumn("parts", F.count(F.lit(1)).over(Window.partitionBy("file", "owner"))))
    ours = raw.select("seq", "chunk").join(owned.select("file", "owner", "no", "parts", "seq"), "seq")
    plain = ours.where("parts = 1").select("file", F.col("owner").alias("at"), "chunk")
    joined = (ours.where("parts > 1").groupBy("file", "owner")
              .agg(F.array_sort(F.collect_list(F.struct("no", "chunk"))).alias("p"))
              .select("file", F.col("owner").alias("at"), F.array_join(F.transform("p", lambda x: x["chunk"]), MAGIC).alias("chunk")))
    both = plain.union(joined)
    both = both.withColumn("head", F.concat(F.lit("\r\n"), F.substring_index("chunk", END, 1), F.lit("\r\n")))
    rest = F.substr("chunk", F.instr("chunk", END) + len(END))
    block = F.substr(rest.cast("binary"), F.lit(1), _header("Content-Length").cast("int"))
    kind = _header("WARC-Type")
    both = both.select("file", "at", "head", kind.alias("record_type"), block.alias("block"))
    http_end = F.instr(F.col("block").cast("string"), END)
    http = _header("Content-Type").startswith("application/http")
    # HTTP headers are ASCII here and in RFC 9110's field values, so characters count bytes
    payload = F.when(http & (http_end > 0), F.substr("block", http_end + len(END))).otherwise(F.col("block"))
    return both.select(
        "file", "at", "record_type", _header("WARC-Record-ID").alias("record_id"),
        _header("WARC-Target-URI").alias("target_uri"),
        F.nullif(_header("WARC-Refers-To"), F.lit("")).alias("refers_to_id"),
        _header("WARC-Payload-Digest").alias("digest"),
        F.when(F.col("record_type") != "revisit", payload).alias("payload"))


def digests(found: DataFrame) -> DataFrame:
    """Per record of :func:`read`: ids as numbers, type, bytes and SHA-1 of the
    full payload; a revisit takes them from the response that it refers to."""
    def number(c):
        return F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    slim = stored(found.select(
        number("record_id").alias("page_id"), "record_type", "record_id", "refers_to_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")),
        "warc-digests")
    whole = (slim.where("record_type = 'response'").where(F.col("payload_bytes") >= LEAST)
             .select(F.col("record_id").alias("refers_to_id"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
             .dropDuplicates(["refers_to_id"]))
    plain = slim.where("record_type != 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = slim.where("record_type = 'revisit'").join(whole, "refers_to_id", "left").select(
        "page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type",
        number("refers_to_id").alias("refers_to"))
    return plain.union(again)


def op9_warc(spark, sf_dir):
    """``pages`` written as WARC archives in the shared folder and read back."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex[:8]}")
    write(table(spark, sf_dir, "pages"), path)
    return digests(read(spark, path))


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m"""
