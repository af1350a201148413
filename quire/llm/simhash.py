"""SimHash near-duplicates by pivot distance tables.

Fingerprints. Words are lower-cased (A-Z), shingles of ``shingle`` words are
hashed (XXH64, seed 42), and a bit of the fingerprint is 1 if it is set in over
half of the hashes.

Links. Two fingerprints link if at most ``MAX_BITS`` = 3 bits differ. All work is on
distinct fingerprints. For each of them the distances to ``PIVOTS`` reference
fingerprints are computed, per block of the 64 bits: a table of BLOCKS x PIVOTS
small numbers whose sum over the blocks is the distance to the pivot. By the
triangle inequality a coordinate of two fingerprints that link differs by at
most 3, and on the blocks where they agree it does not differ at all. With 6
blocks, at least 3 agree; so two that link have equal coordinates on one of the
20 choices of 3 blocks. That choice with its coordinates is a cell; pairs are
sought in cells only, each pair in the first cell that it shares. In a cell,
pairs whose full coordinates differ by more than 3 anywhere are discarded, and
for the survivors the bits are counted.

Bounded tasks. A cell of more than ``CELL`` fingerprints is dealt into parts,
and each two of its parts are a unit of work of their own, so no task holds
a large cell and no pair is lost. A unit of work returns, instead of all its
pairs, links that connect the same fingerprints (a star per connected set).

Groups are the connected components of the links.

Null and empty texts have fingerprint zero, linked like any other; documents
with fewer words than a shingle have one shingle of all words; very long texts
are hashed in slices; repeated rows have the same fingerprint; an empty table
gives an empty result; a null id is never a group's id unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ddl, fresh, stored, table, texts, whole_groups, with_arrow
from quire.llm.components import components

MAX_BITS = 3
SEED = 42
BLOCKS = 6
#: Reference fingerprints; a multiple of 8.
PIVOTS = 32
#: Fingerprints of one cell in one task.
CELL = 16384
#: Rows that are named to be dropped or merged in a broadcast (24 bytes each).
NAMED = 200_000
#: Fingerprints compared with as many others at once; shingles hashed at once.
TILE, SLICE = 1024, 1 << 16

_EDGES = [64 * b // BLOCKS for b in range(BLOCKS + 1)]
MASKS = np.array([((1 << hi) - (1 << lo)) for lo, hi in zip(_EDGES, _EDGES[1:], strict=False)], dtype=np.uint64)
CHOICES = list(combinations(range(BLOCKS), BLOCKS - MAX_BITS))
#: Of each set of differing blocks (as bits) the first choice that avoids it, or -1.
_FIRST = np.array([next((i for i, c in enumerate(CHOICES) if not any(d >> b & 1 for b in c)), -1)
                   for d in range(1 << BLOCKS)], dtype=np.int16)
REFERENCES = np.array([xxhash.xxh64_intdigest(f"pivot {i}", SEED) for i in range(PIVOTS)], dtype=np.uint64)


def fingerprint(text: bytes, shingle: int) -> int:
    """The unsigned 64-bit fingerprint of one text (UTF-8)."""
    words = text.lower().split()  # of bytes: A-Z, and blanks \x20 \x09-\x0D, only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        m = min(SLICE, n - at)
        grams = map(b" ".join, zip(*(words[at + j:at + j + m] for j in range(shingle)), strict=True))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the fingerprint as a signed long."""
    whole, = fresh(docs, "_text")
    source = docs.select(*[F.col(f"`{c}`") for c in (keep or docs.columns)], F.col(f"`{text}`").alias(whole))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in texts(b.column(b.num_columns - 1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], name])

    return with_arrow(source, add, ddl(source.drop(whole), f"`{name}` bigint"))


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """(fingerprints, blocks, pivots): distances to the references by block."""
    return np.bitwise_count((fp[:, None, None] ^ REFERENCES[None, None, :]) & MASKS[None, :, None])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's cells: equal coordinates on a choice of blocks."""
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        words = pivot_table(fp).view(np.uint64)  # 8 coordinates to a number
        mixed = np.zeros((len(fp), BLOCKS), np.uint64)
        for j in range(PIVOTS // 8):
            mixed = (mixed ^ words[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        for i, choice in enumerate(CHOICES):
            key = np.full(len(fp), i + 1, np.uint64)
            for block in choice:
                key = (key ^ mixed[:, block]) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.full(len(fp), i, np.int32)), b.column(0)], names=["cell", "choice", "fp"])


def _linked(fa: np.ndarray, fb: np.ndarray, pa_: np.ndarray, pb: np.ndarray, choice: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a, of b) that link and have ``choice`` as their first cell:
    discarded by coordinate difference, then verified."""
    far = np.zeros((len(fa), len(fb)), bool)
    for p in range(4):  # most pairs go here
        far |= np.abs(pa_[:, None, p] - pb[None, :, p]) > MAX_BITS
    i, j = np.nonzero(~far)
    near = (np.abs(pa_[i, 4:] - pb[j, 4:]).max(axis=1, initial=0) <= MAX_BITS)
    i, j = i[near], j[near]
    x = fa[i] ^ fb[j]
    differ = np.zeros(len(x), np.int64)
    for b in range(BLOCKS):
        differ |= ((x & MASKS[b]) != 0).astype(np.int64) << b
    good = (np.bitwise_count(x) <= MAX_BITS) & (x != 0) & (_FIRST[differ] == choice)
    return i[good], j[good]


def _star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same connected sets as (a, b), at most one per node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each unit of work: a cell, or two parts of a large one."""
    for t, starts in whole_groups(batches, ["cell", "choice", "i", "j"]):
        fp = t.column("fp").to_numpy().view(np.uint64)
        choice, part, i, j = (t.column(c).to_numpy() for c in ("choice", "part", "i", "j"))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        coords = pivot_table(fp).sum(axis=1, dtype=np.int16)
        for lo, hi in zip(starts, starts[1:], strict=False):
            f, c = fp[lo:hi], coords[lo:hi]
            if i[lo] == j[lo]:
                sides = [(a, b) for a in range(0, hi - lo, TILE) for b in range(a, hi - lo, TILE)]
                left = right = np.arange(hi - lo)
            else:
                left, right = (np.flatnonzero(part[lo:hi] == x[lo]) for x in (i, j))
                sides = [(a, b) for a in range(0, len(left), TILE) for b in range(0, len(right), TILE)]
            for a, b in sides:
                ra, rb = left[a:a + TILE], right[b:b + TILE]
                x, y = _linked(f[ra], f[rb], c[ra], c[rb], int(choice[lo]))
                if len(x):
                    out.append(_star(f[ra[x]].view(np.int64), f[rb[y]].view(np.int64)))
        if out:
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints ``fp`` within
    ``MAX_BITS`` bits of each other."""
    cells = with_arrow(fps.select("fp"), _cells, "cell long, choice int, fp long")
    shared = (cells.groupBy("cell", "choice").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .withColumn("parts", F.ceil(F.col("n") / CELL).cast("int")))
    rows = (cells.join(shared.drop("n"), ["cell", "choice"])
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("cell", "choice", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp"))
    keys = ["cell", "choice", "i", "j"]
    return with_arrow(rows.repartition(*keys).sortWithinPartitions(*keys), _links, "a long, b long")


def _roots(prints: DataFrame, low: Column) -> DataFrame:
    """(fp, root, low): each distinct fingerprint, the smallest one that its
    links reach, and the aggregate ``low`` of its rows. prints: (id, ..., fp)."""
    # copies are counted in parts before the shuffle
    fps = stored(prints.groupBy("fp").agg(low.alias("low")), "simhash-fps")
    root = components(links(fps)).toDF("fp", "root")
    return fps.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, group): each row's fingerprint as a signed long, and the
    smallest id that its links reach."""
    prints = with_fingerprint(docs, text, "fp", shingle, [id_col]).toDF("id", "fp")
    prints = stored(prints, "simhash")
    of = _roots(prints, F.min("id"))
    low = of.groupBy("root").agg(F.min("low").alias("group"))
    return prints.join(of.select("fp", "root").join(low, "root").select("fp", "group"), "fp").select("id", "fp", "group")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row of each group: that with the smallest id (a null id only where
    the group has no other). All columns stay. Where several rows of the group
    share that id, one with the smallest text hash stays."""
    key, h, row = fresh(docs, "simhash_id", "simhash_hash", "simhash_row")
    hashed = docs.select(F.col(f"`{id_col}`").alias(key), F.xxhash64(F.col(f"`{text}`")).alias(h), F.col(f"`{text}`").alias(row))
    prints = stored(with_fingerprint(hashed, row, "fp", shingle, [key, h]).toDF("id", "hash", "fp"), "simhash")
    # an id may occur in several groups, a null id in any number: a survivor is
    # known by its id and text, which one group only can have
    of = _roots(prints, F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")))
    chosen = stored(of.groupBy("root").agg(F.min("low").alias("low"))
                    .select(F.col("low.id").alias(key), F.col("low.hash").alias(h)), "simhash-chosen")
    # nearly all rows stay, so the others are named, and the keys with several rows
    rows = prints.select(F.col("id").alias(key), F.col("hash").alias(h)).groupBy(key, h).agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows.join(chosen.withColumn("stays", F.lit(True)).withColumnRenamed(key, "own").withColumnRenamed(h, "text_hash"),
                            F.col(key).eqNullSafe(F.col("own")) & (F.col(h) == F.col("text_hash")), "left")
                  .where("stays is null or n > 1").select(key, h, F.coalesce("stays", F.lit(False)).alias("stays")), "simhash-changed")
    named = F.broadcast(rows) if rows.count() <= NAMED else rows.hint("merge")
    own, text_hash, stays = fresh(docs.select("*", F.lit(0).alias(key), F.lit(0).alias(h), F.lit(0).alias(row)), "own", "text_hash", "stays")
    named = named.toDF(own, text_hash, stays)
    hit = docs.withColumn(h, F.xxhash64(F.col(f"`{text}`"))).withColumn(key, F.col(f"`{id_col}`"))
    hit = hit.join(named, (F.col(h) == F.col(text_hash)) & F.col(key).eqNullSafe(F.col(own)), "left")
    plain = [F.col(f"`{c}`") for c in docs.columns]
    several = hit.where(F.col(stays)).groupBy(h, key).agg(F.min_by(F.struct(*plain), F.struct(*_ordered(docs))).alias(row))
    return hit.where(F.col(stays).isNull()).select(*plain).unionByName(several.select(*[F.col(f"{row}.`{c}`") for c in docs.columns]))


def _ordered(docs: DataFrame) -> list[Column]:
    """The columns as values that have an order (maps as JSON)."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or f.dataType.simpleString() == "variant"
            else F.col(f"`{f.name}`") for f in docs.schema.fields]


def op1_simhash(spark, sf_dir):
    """Fingerprint and group of every row of ``documents``."""
    found = groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("group").alias("component_id"))
