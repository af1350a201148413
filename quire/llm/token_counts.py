"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word is cut into the longest vocabulary entry that it
starts with, then the longest continuation, and so on. The counts are found
without building a piece: the vocabulary is a trie of bytes, with a root for word
starts and a root for continuations. Where a word leaves the trie, the failure
link of its node names the node that holds what is left after the longest
pieces so far were cut off, and a number computed beforehand says how many
pieces that were. As the links are followed beforehand too, each byte of a word is
one step in two tables: the next node and the pieces popped. At a word's end
one more table gives the pieces of what the last node still holds. So the time is linear
in the bytes, whatever the vocabulary is.

A byte that no entry begins with counts as a piece of its own, with
``byte_fallback`` (as the vocabulary given here has one entry per byte);
without it, its word is one unknown piece, as is usual for word pieces.

Words are runs of anything but ASCII white space. Null, empty and blank texts
have no tokens; words and texts of any length are taken whole; repeated rows are
counted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ddl, fresh, table, utf8, with_arrow

START, REST, DEAD = 0, 1, -1
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Words are stepped together while more than FEW are left; bytes per slice.
FEW, CHUNK = 16, 1 << 22


def vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """(entries at a word's start, entries inside a word) of a sentence-piece
    model: its mark for a blank stands for a word's start. The byte entries are
    left to ``byte_fallback``."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    start, rest = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        piece = sp.id_to_piece(i)
        (start if piece.startswith("▁") else rest).append(piece.removeprefix("▁").encode())
    return [x for x in start if x], [x for x in rest if x]


class Automaton:
    """``next``, ``popped`` (256 entries per node) and ``end`` (per node).
    ``end`` is -1 where the rest can't be cut into pieces."""

    def __init__(self, start: list[bytes], rest: list[bytes], byte_fallback: bool = True):
        if byte_fallback:
            single = [bytes([c]) for c in range(256)]
            start, rest = start + single, rest + single
        children: list[dict[int, int]] = [{}, {}]
        entry = [False, False]
        for root, words in ((START, start), (REST, rest)):
            for w in words:
                node = root
                for c in w:
                    at = children[node].get(c)
                    if at is None:
                        at = children[node][c] = len(children)
                        children.append({})
                        entry.append(False)
                    node = at
                entry[node] = True
        n = len(children)
        link, pops = np.full(n, DEAD, np.int64), np.zeros(n, np.int64)
        self.next, self.popped = np.full((n, 256), DEAD, np.int32), np.zeros((n, 256), np.uint8)
        self.end = np.zeros(n, np.int32)
        # breadth first: a node's link leads to a node of less depth, or the other root, which is done
        order = [(REST, DEAD, 0), (START, DEAD, 0)]
        at = 0
        while at < len(order):
            node, parent, c = order[at]
            at += 1
            if parent != DEAD:
                if entry[node]:
                    link[node], pops[node] = REST, 1
                elif link[parent] != DEAD:
                    # where the parent's rest goes on with c, after more pieces if need be
                    z = link[parent]
                    link[node] = self.next[z, c]
                    pops[node] = pops[parent] + self.popped[z, c] if link[node] != DEAD else 0
            if link[node] != DEAD:
                z = link[node]
                self.next[node] = self.next[z]
                lost = self.popped[z].astype(np.int64) + pops[node]
                if lost.max(initial=0) > 255:
                    raise ValueError("a vocabulary entry of over 255 pieces")
                self.popped[node] = np.where(self.next[node] == DEAD, 0, lost)
            for b, child in children[node].items():
                self.next[node, b], self.popped[node, b] = child, 0
            order.extend((child, node, b) for b, child in children[node].items())
            if parent != DEAD:
                z = link[node]
                self.end[node] = -1 if z == DEAD or self.end[z] < 0 else self.end[z] + pops[node]

    def pieces(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of the words raw[starts[i]:ends[i]]; -1 where a word can't be cut."""
        out = np.zeros(len(starts), np.int64)
        order = np.argsort(starts - ends, kind="stable")  # longest first
        lengths = (ends - starts)[order]
        at = starts[order]
        state = np.zeros(len(starts), np.int64)
        nxt, popped = self.next.reshape(-1), self.popped.reshape(-1)
        count = np.zeros(len(starts), np.int64)
        step, left = 0, len(starts)
        while True:
            left = int(np.searchsorted(-lengths[:left], -step, side="left"))  # words longer than step
            if left <= FEW:
                break
            i = state[:left] * 256 + raw[at[:left] + step]
            s = nxt[i]
            count[:left] += popped[i]
            dead = s < 0
            if dead.any():
                count[:left][dead] = -(1 << 40)
                s = np.where(dead, 0, s)
            state[:left] = s
            step += 1
        for w in range(left):  # the few longest words, each by itself
            s, c = int(state[w]), int(count[w])
            for b in raw[at[w] + step:at[w] + lengths[w]].tolist():
                c += int(popped[s * 256 + b])
                s = int(nxt[s * 256 + b])
                if s < 0:
                    c, s = -(1 << 40), 0
            state[w], count[w] = s, c
        tail = self.end[state]
        out[order] = np.where((count < 0) | (tail < 0), -1, count + tail)
        return out


_BUILT: dict = {}


def _automaton(key, start: list[bytes], rest: list[bytes], byte_fallback: bool) -> Automaton:
    """Built once per Python worker and vocabulary."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(start, rest, byte_fallback)
    return _BUILT[key]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of all words."""
    inside = ~SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(raw))]
    first[borders] = inside[borders]  # a text's end ends a word
    last = np.zeros(len(raw), bool)
    last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    if len(raw):
        last[-1] = inside[-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def with_counts(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
                byte_fallback: bool = True, names: tuple[str, str, str] = ("n_words", "n_tokens", "n_unknown")) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the numbers of words, tokens and
    unknown words of each text. The vocabulary is read on the driver and sent
    to the tasks; its size doesn't depend on the data. Names that clash with
    columns of the table get a trailing underscore."""
    names = fresh(docs.select(*[F.col(f"`{c}`") for c in (keep or docs.columns)]), *names)
    whole, = fresh(docs, "_text")
    source = docs.select(*[F.col(f"`{c}`") for c in (keep or docs.columns)], F.col(f"`{text}`").alias(whole))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton((path, byte_fallback), *sent.value, byte_fallback)
        for b in batches:
            raw, offsets = utf8(b.column(b.num_columns - 1))
            found = np.zeros((3, b.num_rows), np.int64)
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
                own = offsets[lo:hi + 1] - offsets[lo]
                part = raw[offsets[lo]:offsets[hi]]
                starts, ends, no = words(part, own)
                n = auto.pieces(part, starts, ends)
                found[0, lo:hi] = np.bincount(no, minlength=hi - lo)
                found[1, lo:hi] = np.bincount(no, np.where(n < 0, 1, n), minlength=hi - lo)
                found[2, lo:hi] = np.bincount(no, n < 0, minlength=hi - lo)
                lo = hi
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, found)], names=[*b.schema.names[:-1], *names])

    return with_arrow(source, count, ddl(source.drop(whole), *[f"`{n}` bigint" for n in names]))


def op4_token_counts(spark, sf_dir):
    """Greedy word-piece counts of every whole text of ``documents``."""
    import public_tokenizers

    return with_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
