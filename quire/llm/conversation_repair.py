"""Conversation structure repair by Wagner-Fischer target alignment.

A conversation should alternate: an optional system turn, then user and
assistant in pairs - the role initials match ``(s?(ua)+)?``. The strings of
this grammar are known once their length is: alternating, with an s in front if the
length is odd. So the rows are aligned (Wagner-Fischer) with the one target of each
feasible length, at these costs: Keep a row whose initial is the target's 0,
Rerole it to user or assistant 1, Delete it 2, Insert an empty user or
assistant turn 5; a truncated row that isn't deleted adds 5; blank and
duplicate rows must be deleted. Of all cheapest edits of all lengths that with the ASCII-least audit
(the edits' initials in order) is taken.

Bands. The lengths are tried from the likeliest on. What the cheapest so far
costs is the incumbent: by Ukkonen's argument an alignment of at most that cost
stays on diagonals that are few deletions and insertions away from both corners, so only these
cells are computed, and a length whose corners alone cost more isn't tried at all.
An audit is traced back from the costs-to-go, taking the least letter among the
cheapest steps at each cell; the audits of equally cheap lengths are compared.

Long conversations are a chain of stretches of at most ``STRETCH`` rows. A
stretch is aligned for each place in the grammar where it may begin and end,
and the chain is solved by these costs; an insertion belongs to the
stretch after it. As every path of edits is one of a chain, the result is that
of one alignment, and the work grows with the rows, not with their square.

Faults are found first: a row is blank (no character but ASCII white space),
else a duplicate (role and text seen earlier), else truncated (the last
such character isn't one of ``.!?``).

Distribution. Texts are reduced to a digest, their initial and flags before the
first shuffle. Duplicates are found by (conversation, role, digest), so a hot conversation is
split there. Then a conversation's short rows stream through one task in
order, a stretch at a time, and give its audit; last, the texts stream along it in the same
order and are hashed (or put out) one by one. No task holds a conversation's texts.

Nulls read as one space (role, text, and in the damage's key). Rows of equal turn come in
the order of role, then of the text's digest; null turns come first. Null ids are one
conversation. A conversation without rows has zeros, an empty audit and the
hash of the empty string. Empty tables give empty results; other columns aren't
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, table, with_arrow

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STRETCH = 64
NEVER = 1 << 40
_BLANKS = " \t\n\x0b\x0c\r"
#: Codes of role initials, and of the rows' faults (added to them).
INITIALS = {"u": 1, "a": 2, "s": 3}
MUST, CUT = 4, 8
_U, _A, _S = INITIALS["u"], INITIALS["a"], INITIALS["s"]
#: Places in the grammar: nothing yet; after s; after u; after a pair. The first and last may end it.
START, LED, HALF, PAIR = range(4)


def target(first: int, length: int) -> np.ndarray:
    """The alternating string of a length that begins with ``first``."""
    out = np.empty(length, np.int64)
    if length and first == _S:
        out[0], out[1::2], out[2::2] = _S, _U, _A
    else:
        out[0::2], out[1::2] = first, _U + _A - first
    return out


def bound(n: int, length: int, must: int) -> int:
    """The least that an alignment of n rows, ``must`` of which go, can cost."""
    gone = max(must, n - length)
    return DELETE * gone + INSERT * (length - n + gone)


def align(rows: np.ndarray, goal: np.ndarray, most: int, trailing: bool) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits that turn rows (codes) into
    the goal, or None if they cost more than ``most``. Only the cells of
    Ukkonen's band for ``most`` are computed. trailing: whether insertions may follow the last row."""
    n, m = len(rows), len(goal)

    def corner(d: int) -> int:
        return DELETE * d if d > 0 else -INSERT * d

    # diagonals i - j that both corners can be reached from
    fine = [d for d in range(-m, n + 1) if corner(d) + corner(n - m - d) <= most]
    if not fine:
        return None
    low, high = fine[0], fine[-1]
    to_go = np.full((n + 1, m + 2), NEVER, np.int64)
    slope = INSERT * np.arange(m + 1)
    fixed = m > 0 and goal[0] == _S  # a system turn can't be inserted
    if trailing:
        to_go[n, :m + 1] = INSERT * (m - np.arange(m + 1))
        if fixed:
            to_go[n, 0] = NEVER
    to_go[n, m] = 0
    if m + n - high > 0:
        to_go[n, :max(0, n - high)] = NEVER
    for i in range(n - 1, -1, -1):
        lo, hi = max(0, i - high), min(m, i - low)
        if lo > hi:
            continue
        row = int(rows[i])
        best = DELETE + to_go[i + 1, lo:hi + 1]
        if not row & MUST:
            initial, extra = row & 3, TRUNCATED if row & CUT else 0
            step = np.full(hi + 1 - lo, NEVER, np.int64)
            inside = goal[lo:hi + 1]  # one shorter where hi = m
            step[:len(inside)] = np.where(inside == initial, KEEP, np.where(inside == _S, NEVER, REROLE)) + extra
            best = np.minimum(best, step + to_go[i + 1, lo + 1:hi + 2])
        # insertions: the best cell to the right, at their cost
        shifted = best + slope[lo:hi + 1]
        reach = np.minimum.accumulate(shifted[::-1])[::-1] - slope[lo:hi + 1]
        if fixed and lo == 0:
            reach[0] = best[0]
        to_go[i, lo:hi + 1] = reach
    cost = int(to_go[0, 0])
    if cost > most:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        here = to_go[i, j]
        # letters in ASCII order: D, I, K, R
        if i < n and DELETE + to_go[i + 1, j] == here:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != _S and INSERT + to_go[i, j + 1] == here and (trailing or i < n):
            audit.append("I")
            j += 1
        else:
            audit.append("K" if goal[j] == int(rows[i]) & 3 else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _cheapest(rows: np.ndarray, first: int, lengths: range, trailing: bool) -> tuple[int, str] | None:
    """The cheapest of all feasible lengths, at ties that of the least audit."""
    n, must = len(rows), int(((rows & MUST) > 0).sum())
    found: tuple[int, str] | None = None
    for length in sorted(lengths, key=lambda x: (bound(n, x, must), x)):
        most = found[0] if found else NEVER - 1
        if bound(n, length, must) > most:
            break  # the bounds are in order
        got = align(rows, target(first, length), most if found else _ceiling(rows, first, length), trailing)
        if got and (found is None or got < found):
            found = got
    return found


def _ceiling(rows: np.ndarray, first: int, length: int) -> int:
    """What some alignment with this target costs: everything deleted and
    inserted, or, where the rows that stay are enough for it, the first of them reroled. A first incumbent."""
    stay = rows[(rows & MUST) == 0]
    gone = len(rows) - len(stay)
    if first == _S:  # its s has to be a row's
        return NEVER - 1
    worst = DELETE * len(rows) + INSERT * length
    k = min(len(stay), length)
    some = DELETE * (gone + len(stay) - k) + INSERT * (length - k) + int((REROLE + TRUNCATED * ((stay[:k] & CUT) > 0)).sum())
    return min(worst, some)


@lru_cache(maxsize=1 << 14)
def stretch(codes: bytes, begin: int, closed: bool) -> tuple[tuple[int, int, str], ...]:
    """(end, cost, audit) of the cheapest edits of a stretch of rows that begins
    at a place in the grammar, for each place where it can end. closed: the conversation ends here."""
    rows = np.frombuffer(codes, np.uint8).astype(np.int64)
    n = len(rows)
    # longer targets than this cost more than deleting all rows does
    top = n + (DELETE * n) // INSERT + 3
    out: list[tuple[int, int, str]] = []

    def put(end: int, first: int, lengths: range) -> None:
        if closed and end not in (START, PAIR):
            return
        got = _cheapest(rows, first, lengths, closed)
        if got:
            out.append((end, *got))

    put(begin, _U, range(0, 1))
    if begin == HALF:
        put(PAIR, _A, range(1, top, 2))
        put(HALF, _A, range(2, top, 2))
    else:
        put(PAIR, _U, range(2, top, 2))
        put(HALF, _U, range(1, top, 2))
        if begin == START and (rows & 3 == _S).any():
            put(LED, _S, range(1, 2))
            put(PAIR, _S, range(3, top, 2))
            put(HALF, _S, range(2, top, 2))
    return tuple(out)


def solve(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation's rows, a code each."""
    if not codes:
        return 0, ""
    parts = [codes[i:i + STRETCH] for i in range(0, len(codes), STRETCH)]
    last = len(parts) - 1
    # cost from a place before each stretch to the end, from the last stretch back
    ahead: list[list[int]] = [[NEVER] * 4 for _ in parts] + [[0] * 4]
    for k in range(last, -1, -1):
        for begin in range(4 if k else 1):
            ahead[k][begin] = min((c + ahead[k + 1][end] for end, c, _ in stretch(parts[k], begin, k == last)), default=NEVER)
    place, audit = START, []
    for k, part in enumerate(parts):
        least, place = min((a, end) for end, c, a in stretch(part, place, k == last)
                           if c + ahead[k + 1][end] == ahead[k][place])
        audit.append(least)
    return ahead[0][START], "".join(audit)


def edits(audit: str, rows: int) -> tuple[bool, int]:
    """(whether the target has a system turn, its length) of an audit."""
    length = len(audit) - audit.count("D")
    return length % 2 == 1, length


# ---- rows ---------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by crc32("conv_id:turn") % 20."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    df = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                     (F.crc32(key.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (df.where("fault != 0").withColumn("copy", copies)
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")))


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}


def _order(*after: str) -> list[Column]:
    """The order of rows by conversation; ``after``: what comes before the turn."""
    return [F.asc_nulls_first("id"), *map(F.asc, after), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]


def _rows(docs: DataFrame, id_col: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, turn, role, digest, text): nulls are one space."""
    blank = F.lit(" ")
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                       F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"))
    return slim.select("id", "turn", "role", F.sha2("text", 256).alias("digest"), "text")


def features(rows: DataFrame) -> DataFrame:
    """(id, turn, role, digest, code, again): a short row per row, without its
    text; ``again``: role and text were seen earlier."""
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    initial = F.when(F.startswith("role", F.lit("u")), _U).when(F.startswith("role", F.lit("a")), _A).when(F.startswith("role", F.lit("s")), _S).otherwise(0)
    cut = (trimmed != "") & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    code = initial + F.when(trimmed == "", MUST).otherwise(0) + F.when(cut, CUT).otherwise(0)
    short = rows.select("id", "turn", "role", "digest", code.cast("int").alias("code"))
    seen = Window.partitionBy("id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    return short.withColumn("again", F.row_number().over(seen) > 1)


class _Conversation:
    """Counts of one conversation while its short rows pass."""

    def __init__(self, name):
        self.name, self.codes = name, bytearray()
        self.low = self.high = self.last = None
        self.turns = self.blank = self.again = self.cut = self.illegal = 0
        self.before = None

    def add(self, turn, code: int, again: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last
            self.high = self.last = turn
        initial, blank = code & 3, bool(code & MUST)
        if self.before is not None:
            self.illegal += (self.before, initial) not in _LEGAL
        self.before = initial
        again = again and not blank
        self.blank += blank
        self.again += again
        self.cut += bool(code & CUT) and not again
        self.codes.append(initial + (MUST if blank or again else CUT if code & CUT else 0))

    def plan(self) -> tuple:
        cost, audit = solve(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.name, gaps, self.blank, self.again, self.cut, self.illegal, cost, audit


def _plans(kind: pa.DataType):
    types = [kind, *[pa.int64()] * 6, pa.string()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                          names=["id", *_COUNTS, "audit"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = None, []
        for b in batches:
            for name, turn, code, again in zip(*(b.column(c).to_pylist() for c in ("id", "turn", "code", "again")), strict=True):
                if at is None or at.name != name:
                    if at:
                        out.append(at.plan())
                    at = _Conversation(name)
                at.add(turn, code, again)
            if len(out) >= 2000:
                yield batch(out)
                out = []
        if at:
            out.append(at.plan())
        if out:
            yield batch(out)
    return go


def plans(short: DataFrame) -> DataFrame:
    """(id, counts, cost, audit) of each conversation."""
    from pyspark.sql.pandas.types import to_arrow_type

    field = short.schema["id"].dataType
    dealt = short.repartition("id").sortWithinPartitions(*_order())
    return with_arrow(dealt.select("id", "turn", "code", "again"), _plans(to_arrow_type(field)), f"id {field.simpleString()}, {PLAN}")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(id, role, text, edit, ends): the repaired turns of each conversation, in
    order; ``ends``: the conversation ends here and there is no turn. An audit
    comes before its conversation's rows, which are passed one at a time."""
    name, audit, at, place, goal = None, None, 0, 0, _S

    def inserted():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield name, _role(goal, place), "", "I", False
            at, place = at + 1, place + 1

    for b in batches:
        ids, roles, audits, texts = (b.column(c) for c in ("id", "role", "audit", "text"))
        for i in range(b.num_rows):
            told = audits[i].as_py()
            if told is not None:
                if audit is not None:
                    yield from inserted()
                    yield name, None, None, None, True
                name, audit, at, place = ids[i].as_py(), told, 0, 0
                goal = _S if edits(audit, 0)[0] else _U
                continue
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit != "D":
                yield name, roles[i].as_py() if edit == "K" else _role(goal, place), texts[i].as_py(), edit, False
                place += 1
    if audit is not None:
        yield from inserted()
        yield name, None, None, None, True


def _role(first: int, place: int) -> str:
    return "user" if (place + (first == _S)) % 2 == 0 else "assistant"


def _streamed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """A conversation's audit, then its rows, in order, in one partition."""
    none = F.lit(None).cast("string")
    both = (plan.select("id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("digest"),
                        none.alias("text"), "audit")
            .union(rows.select("id", F.lit(1), "turn", "role", "digest", "text", none)))
    dealt = both.repartition("id").sortWithinPartitions(*_order("kind"))
    return dealt.select("id", "role", "audit", "text")


def _planned(docs: DataFrame, names: tuple[str, str, str, str]) -> tuple[DataFrame, DataFrame]:
    rows = _rows(docs, *names)
    return rows, stored(plans(features(rows)), "repair-plans")


def repaired(docs: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired turns: id, ``turn`` (from 0), ``role``, ``text``, ``edit``
    (K, R or I)."""
    rows, plan = _planned(docs, (id_col, turn, role, text))
    kind = plan.schema["id"].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for name, role_, text_, edit, ends in _walk(batches):
            if ends:
                n = 0
                continue
            out.append({"id": name, "turn": n, "role": role_, "text": text_, "edit": edit})
            n += 1
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return with_arrow(_streamed(rows, plan), go, f"id {kind}, turn long, role string, text string, edit string").withColumnRenamed("id", id_col)


def audits(docs: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation that has rows: id, ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``,
    ``repaired_sha256`` (of the repaired ``role:text`` joined by line ends)."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows, plan = _planned(docs, (id_col, turn, role, text))
    field = plan.schema["id"].dataType
    arrow = to_arrow_type(field)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, first = [], hashlib.sha256(), True
        for name, role_, text_, _, ends in _walk(batches):
            if ends:
                out.append((name, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
            else:
                digest.update(f"{'' if first else chr(10)}{role_}:{text_}".encode())
                first = False
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], arrow), pa.array([o[1] for o in out])], names=["id", "sha"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], arrow), pa.array([o[1] for o in out])], names=["id", "sha"])

    hashed = with_arrow(_streamed(rows, plan), go, f"id {field.simpleString()}, sha string").withColumnRenamed("id", "hashed")
    return (plan.join(hashed, plan["id"].eqNullSafe(hashed["hashed"]))
            .select(F.col("id").alias(id_col), *_COUNTS, "audit", F.col("sha").alias("repaired_sha256")))


def op11_conversation_repair(spark, sf_dir):
    """Damaged ``conversations``, repaired; a row per original conversation."""
    given = table(spark, sf_dir, "conversations")
    found = audits(damaged(given)).withColumnRenamed("conv_id", "found")
    ids = given.select("conv_id").distinct()
    zero = {c: 0 for c in _COUNTS} | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return (ids.join(found, ids["conv_id"].eqNullSafe(found["found"]), "left").drop("found").na.fill(zero))
