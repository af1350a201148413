"""Removal of repeated passages: every byte that a string of ``least`` bytes
covers which also starts earlier, by suffix arrays.

1. Anchors. Of the ``K``-byte strings in each window of ``least`` bytes the one with the
   smallest hash (leftmost at ties) is the window's anchor. It depends on the
   window's bytes alone, so equal windows have equal anchors at equal places. The
   windows of one anchor are neighbours; together they are a segment of at most
   2 * least - K bytes. So one short row for each segment is dealt out, not one for each
   byte, and windows can be equal only where their anchors are.
2. Segments that are equal as a whole: the earliest is kept and all others are
   repeats, first within a batch of a task, then over the corpus, by anchor. So copies, however
   many, end here, and a hot segment has a row per batch at most.
3. What is left are different segments with the same anchor: borders of
   passages and edits. Their bytes are fetched, dealt by anchor, and each task
   joins those of many anchors to blocks of bounded size. A block's suffix array gives its
   Burrows-Wheeler transform, and breadth-first backward extension of
   intervals - all strings of length 0, then 1, and so on - marks each border
   between neighbours in the suffix array with the length of their common
   prefix, in increasing order. It stops at ``least``: what is not marked by then shares at
   least that many bytes, so the groups of equal windows are known, and all but
   the earliest of a group are repeats.
4. An anchor with more than ``HOT`` different segments would need a large block. Its
   segments are taken apart into windows instead, whose groups are found by an
   aggregate over their hashes (128 bits), which Spark combines in parts.
5. The repeats of a document are united and cut out.

Earlier is a smaller id, or the same id and an earlier start; rows with the
same id and start are not earlier than each other; a null id is smaller than all
others. Null and empty texts, and texts shorter than ``least``, lose nothing. Very long texts are
worked on in overlapping slices. ``docs`` should be a table or a stored result, since
it is read twice and its rows are numbered in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored, table, utf8, whole_groups, with_arrow

LEAST = 100
#: Bytes of an anchor; of a slice of texts (small enough for a processor's cache); of a block with a suffix array.
K = 32
SLICE = 1 << 18
BLOCK = 1 << 21
#: Different segments of one anchor in a block.
HOT = 8000
_POS = np.uint64((1 << 22) - 1)
#: No byte of UTF-8: ends a segment in a block.
STOP = 0xFF
#: Null ids come first.
NO_ID = -(1 << 63)

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _rng.integers(0, 1 << 62, 8, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class _Powers:
    """Powers of an odd number and of its inverse, mod 2^64."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            b, inverse = U(self.base), U(pow(int(self.base), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, b)]))
            self.down = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, inverse)]))
        return self.up, self.down


_POWERS = [_Powers(int(_ODD[6])), _Powers(int(_ODD[7]))]


def span_hash(raw: np.ndarray, which: int = 0):
    """A function (from, to) -> 64-bit hashes of raw[from:to], for arrays of spans."""
    up, down = _POWERS[which].to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((_BYTE if which == 0 else _mix(_BYTE))[raw] * up[:len(raw)], out=sums[1:])
    return lambda lo, hi: _mix((sums[hi] - sums[lo]) * down[lo] + U(0x9E3779B97F4A7C15) * (hi - lo).astype(np.uint64))


def segments(raw: np.ndarray, first: np.ndarray, last: np.ndarray, least: int = LEAST):
    """Segments of texts in one buffer. first, last: each text's first and last
    window start (texts without a window aren't given). Returns (text number,
    first window, last window, anchor hash, segment hash)."""
    n = len(raw)
    h = _BYTE[raw]
    step = 1
    while step < K:  # h[i] is the hash of step bytes from i
        h = h[:-step] * _ODD[step.bit_length() % 6] + h[step:]
        step *= 2
    h = _mix(h)
    low = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    span, step = least - K + 1, 1
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[:len(low) - (span - step)], low[span - step:])
    at = (low & _POS).astype(np.int64)  # anchor of each window of the buffer
    counts = last - first + 1
    own = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    text = np.repeat(np.arange(len(first)), counts)
    a = at[own]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(a)) - 1
    s, e, anchor = own[lo], own[hi], a[lo]
    content = span_hash(raw)(s, e + least) ^ _mix((anchor - s).astype(np.uint64) + U(1))
    return text[lo], s, e, h[anchor], content


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch's texts: (buffer, row numbers, first byte in the
    buffer, first byte in the text, last window start in the buffer)."""
    raw, offsets = utf8(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        if offsets[lo + 1] - offsets[lo] > SLICE:  # a long text in slices that share all but a window
            whole = raw[offsets[lo]:offsets[lo + 1]]
            for at in range(0, len(whole) - LEAST + 1, SLICE):
                part = whole[at:at + SLICE + LEAST - 1]
                yield part, np.array([lo]), np.array([0]), np.array([at]), np.array([len(part) - LEAST])
            lo += 1
            continue
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1)
        rows = np.arange(lo, hi)
        starts, ends = offsets[lo:hi] - offsets[lo], offsets[lo + 1:hi + 1] - offsets[lo]
        fine = ends - starts >= LEAST
        if fine.any():
            yield (raw[offsets[lo]:offsets[hi]], rows[fine], starts[fine], np.zeros(int(fine.sum()), np.int64), ends[fine] - LEAST)
        lo = hi


ROWS = ["anchor", "segment", "id", "rid", "lo", "n"]
KEYED = "anchor long, segment long, id long, rid long, lo long, n int"


def _emit(cols) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=ROWS)


def _united(rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts lo..hi of rows, sorted, joined where they touch."""
    if not len(rid):
        return rid, lo, hi
    o = np.lexsort((lo, rid))
    rid, lo, hi = rid[o], lo[o], hi[o]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (lo[1:] > hi[:-1] + 1)
    at = np.flatnonzero(new)
    return rid[at], lo[at], np.maximum.reduceat(hi, at)


def _spans(rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """Repeats as rows with n < 0: -n window starts from lo."""
    rid, lo, hi = _united(rid, lo, hi)
    zero = np.zeros(len(rid), np.int64)
    return _emit([_mix(rid.astype(np.uint64)).view(np.int64), zero, zero, rid, lo, -(hi - lo + 1)])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rid, text) -> segments, the earliest of equal ones in a batch, and repeats."""
    for b in batches:
        ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        rids = b.column(1).to_numpy()
        found = []
        for raw, rows, starts, shift, last in _texts(b, 2):
            text, s, e, anchor, content = segments(raw, starts, last)
            found.append((rows[text], s - starts[text] + shift[text], e - s, anchor, content))
        if not found:
            continue
        row, begin, more, anchor, content = (np.concatenate(x) for x in zip(*found, strict=True))
        # of equal segments the earliest goes on
        key = anchor ^ (content * U(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        several = np.zeros(len(key), bool)
        several[1:] = same
        several[:-1] |= same
        part = order[several]
        part = part[np.lexsort((begin[part], ids[row[part]], content[part], anchor[part]))]
        a, c, i, p = anchor[part], content[part], ids[row[part]], begin[part]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        head = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(a))))
        drop = part[(i != i[head]) | (p != p[head])]  # equal id and start: not earlier
        if len(drop):
            yield _spans(rids[row[drop]], begin[drop], begin[drop] + more[drop])
        keep = np.ones(len(key), bool)
        keep[drop] = False
        yield _emit([anchor[keep].view(np.int64), content[keep].view(np.int64), ids[row[keep]], rids[row[keep]],
                     begin[keep], more[keep] + 1])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, segment, id, lo): the earliest of equal segments
    goes on if its anchor has other segments too; the others are repeats. Only
    the last class seen and a first class not yet passed on are held."""
    held = None  # first row of the anchor's first class, while it is the only class
    tail = None  # (anchor, segment, id, lo) of the class that the last row belongs to
    for b in batches:
        anchor, segment, ids, rid, lo, n = (b.column(c).to_numpy() for c in ROWS)
        spans = n < 0
        if spans.any():
            yield b.filter(pa.array(spans))
            anchor, segment, ids, rid, lo, n = (x[~spans] for x in (anchor, segment, ids, rid, lo, n))
        if not len(n):
            continue
        new_a = np.ones(len(n), bool)
        new_a[1:] = anchor[1:] != anchor[:-1]
        new_c = new_a.copy()
        new_c[1:] |= segment[1:] != segment[:-1]
        if tail is not None:
            new_a[0] = anchor[0] != tail[0]
            new_c[0] = new_a[0] or segment[0] != tail[1]
        at = np.where(new_c, np.arange(len(n)), -1)
        at = np.maximum.accumulate(at)
        head_id = np.where(at >= 0, ids[at], tail[2] if tail else 0)
        head_lo = np.where(at >= 0, lo[at], tail[3] if tail else 0)
        again = (ids != head_id) | (lo != head_lo)
        if again.any():
            yield _spans(rid[again], lo[again], lo[again] + n[again] - 1)
        # heads: rows that begin a class, or tie with its beginning
        heads = np.flatnonzero(~again)
        run = np.cumsum(new_a)  # anchor's number in this batch; 0: goes on from the batch before
        classes = np.bincount(run, new_c, minlength=run[-1] + 1)
        several = classes > 1
        if held is not None:
            if run[0] == 0 and classes[0] >= 1:  # the held class has company
                yield held
                held, several[0] = None, True
            elif run[0] == 0:
                several[0] = False
            else:
                held = None
        elif run[0] == 0:
            several[0] = True  # its first class was passed on
        out = heads[several[run[heads]]]
        if len(out):
            yield _emit([x[out] for x in (anchor, segment, ids, rid, lo, n)])
        last = int(run[-1])
        if last > 0 and not several[last]:  # its only class so far: wait for the next batch
            mine = heads[run[heads] == last]
            held = _emit([x[mine] for x in (anchor, segment, ids, rid, lo, n)])
        tail = (anchor[-1], segment[-1], head_id[-1], head_lo[-1])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text, [(anchor, id, lo, n)]) -> the segments' bytes."""
    for b in batches:
        raw, offsets = utf8(b.column(1))
        parts = b.column(2)
        flat = parts.flatten()
        counts = np.diff(parts.offsets.to_numpy())
        row = np.repeat(np.arange(b.num_rows), counts)
        anchor, ids, lo, n = (flat.field(j).to_numpy(zero_copy_only=False) for j in range(4))
        begin = offsets[row] + lo
        data = [raw[x:y].tobytes() for x, y in zip(begin.tolist(), (begin + n + LEAST - 1).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(ids), pa.array(b.column(0).to_numpy()[row]), pa.array(lo), pa.array(data, pa.binary())],
            names=["anchor", "id", "rid", "lo", "bytes"])


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``t`` in order of their first ``depth`` bytes, by prefix doubling."""
    n = len(t)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << U(8)) | np.roll(t, -j).astype(np.uint64)
    length = 8
    while True:
        sa = np.argsort(key)
        if length >= depth:
            return sa
        ordered = key[sa]
        rank = np.empty(n, np.uint64)
        rank[sa] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]).astype(np.uint64))
        shift = min(length, depth - length)
        key = rank * U(n + 1) + np.roll(rank, -shift)
        length += shift


def common_borders(t: np.ndarray, sa: np.ndarray, least: int) -> np.ndarray:
    """For each place of the suffix array whether it shares fewer than
    ``least`` bytes with the place before it, by breadth-first backward extension.

    An interval holds the places whose suffixes begin with one string. Extending the string by a
    byte in front leads, by the last-to-first mapping, to an interval whose end
    is a border: if it has no mark yet, its common prefix is the string's length, and
    the interval is extended further. Lengths come in increasing order, so the first mark is right."""
    n = len(t)
    last = t[(sa - 1) % n]  # the Burrows-Wheeler transform
    to = np.empty(n, np.int64)
    to[np.argsort(last, kind="stable")] = np.arange(n)
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(least):
        one = hi - lo == 1
        single = lo[one]
        single = to[single[last[single] != STOP]]  # one place leads to one place
        lo, size = lo[~one], (hi - lo)[~one]
        number = np.repeat(np.arange(len(lo)), size)
        place = np.arange(len(number)) + np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        byte = last[place]
        fine = byte != STOP
        number, place, byte = number[fine], place[fine], byte[fine]
        # places of one interval with the same byte lead to neighbours
        order = np.argsort(number * 256 + byte, kind="stable")
        target, group = to[place[order]], (number * 256 + byte)[order]
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        lo = np.concatenate([target[at], single])
        hi = np.concatenate([target[np.append(at[1:], len(target)) - 1] if len(at) else at, single]) + 1
        fresh = ~marked[hi]
        lo, hi = lo[fresh], hi[fresh]
        marked[hi] = True
        if not len(lo):
            break
    return marked[:n]


def repeats_in_block(data: list[bytes], ids: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment number, window start within it) of all windows of LEAST bytes
    that also start earlier in the block; segments begin at (id, lo)."""
    lengths = np.array([len(x) for x in data])
    t = np.frombuffer(b"".join(x + b"\xff" for x in data), np.uint8)
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    sa = suffix_array(t, LEAST)
    marked = common_borders(t, sa, LEAST)
    segment = np.searchsorted(begin, sa, side="right") - 1
    inside = sa - begin[segment]
    window = inside + LEAST <= lengths[segment]
    group = np.cumsum(marked)[window]
    segment, inside = segment[window], inside[window]
    order_of = np.unique(ids, return_inverse=True)[1]
    where = (order_of[segment].astype(np.int64) << 40) + lo[segment] + inside
    at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    if not len(at):
        return segment, inside
    least = np.repeat(np.minimum.reduceat(where, at), np.diff(np.append(at, len(group))))
    again = where > least
    return segment[again], inside[again]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: whole anchors are joined to blocks."""
    def solve(tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables)
        ids, rid, lo = (t.column(c).to_numpy() for c in ("id", "rid", "lo"))
        segment, inside = repeats_in_block(t.column("bytes").to_pylist(), ids, lo)
        start = lo[segment] + inside
        return _spans(rid[segment], start, start)

    kept, size = [], 0
    for t, starts in whole_groups(batches, ["anchor"]):
        for a, z in zip(starts, starts[1:], strict=False):
            group = t.slice(int(a), int(z - a))
            kept.append(group)
            size += (2 * LEAST) * group.num_rows
            if size >= BLOCK:
                yield solve(kept)
                kept, size = [], 0
    if kept:
        yield solve(kept)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments' bytes -> a row per window, with 128 bits of hash."""
    for b in batches:
        raw, offsets = utf8(b.column(4))
        if not len(raw):
            continue
        n = np.diff(offsets) - LEAST + 1
        row = np.repeat(np.arange(b.num_rows), n)
        inside = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        at = offsets[row] + inside
        one, two = (span_hash(raw, w)(at, at + LEAST).view(np.int64) for w in (0, 1))
        ids, rid, lo = (b.column(j).to_numpy()[row] for j in (1, 2, 3))
        yield _emit([one, two, ids, rid, lo + inside, np.ones(len(row), np.int32)])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, [(lo, n)]) -> what is left of each text."""
    for b in batches:
        raw, offsets = utf8(b.column(1))
        parts = b.column(2)
        flat = parts.flatten()
        at = parts.offsets.to_numpy()
        lo, n = (flat.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (0, 1))
        null = np.asarray(parts.is_null())
        removed, spans, sha = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
        for i in range(b.num_rows):
            text = raw[offsets[i]:offsets[i + 1]].tobytes()
            if not null[i] and at[i + 1] > at[i]:
                s = lo[at[i]:at[i + 1]]
                e = s + n[at[i]:at[i + 1]] + LEAST - 1
                order = np.argsort(s, kind="stable")
                s, reach = s[order], np.maximum.accumulate(e[order])
                new = np.flatnonzero(np.concatenate([[True], s[1:] > reach[:-1]]))
                begin, end = s[new], reach[np.append(new[1:], len(s)) - 1]
                removed[i], spans[i] = (end - begin).sum(), len(begin)
                text = b"".join(text[x:y] for x, y in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True))
            sha.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), pa.array(sha)],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def numbered(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, rid, text): rows with a number each, the same whenever the table is read."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{text}`").alias("text"))


def _resolved(rows: DataFrame) -> DataFrame:
    """Equal segments, by anchor: repeats, and segments that need a comparison."""
    return with_arrow(rows.repartition("anchor").sortWithinPartitions("anchor", "segment", "id", "lo"), _classes, KEYED)


def repeats(rows: DataFrame) -> DataFrame:
    """(rid, lo, n): runs of n window starts whose windows also start earlier.
    rows: as from :func:`numbered`."""
    found = stored(_resolved(with_arrow(rows, _anchors, KEYED)), "repeats")
    open_ones = found.where("n > 0")
    size = open_ones.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(size.where(F.col("n") > HOT).select("anchor"), "repeats-hot")
    per_text = open_ones.groupBy("rid").agg(F.collect_list(F.struct("anchor", "id", "lo", "n")).alias("parts"))
    fetched = with_arrow(rows.select("rid", "text").join(per_text, "rid").select("rid", "text", "parts"), _cut_out,
                         "anchor long, id long, rid long, lo long, bytes binary")
    fetched = stored(fetched, "repeats-bytes")
    calm = fetched.join(hot, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    by_block = with_arrow(calm, _blocks, KEYED)
    windows = with_arrow(fetched.join(hot, "anchor", "left_semi"), _windows, KEYED)
    first = (windows.groupBy("anchor", "segment").agg(F.min(F.struct("id", "lo")).alias("f"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("anchor", "segment", "f"))
    by_hash = windows.join(first, ["anchor", "segment"]).where(F.struct("id", "lo") > F.col("f"))
    runs = by_block.select("rid", "lo", (-F.col("n")).alias("n")).union(by_hash.select("rid", "lo", "n"))
    return found.where("n < 0").select("rid", "lo", (-F.col("n")).alias("n")).union(runs)


def remove(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = numbered(docs, id_col, text)
    per_text = repeats(rows).groupBy("rid").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    whole = rows.join(per_text, "rid", "left").select("id", "text", "runs")
    return with_arrow(whole, _kept, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def op3_repeats(spark, sf_dir):
    """What is left of every text of ``documents`` without repeated passages of 100 bytes."""
    return remove(table(spark, sf_dir, "documents"))
