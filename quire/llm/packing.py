"""Packing examples into sequences by vector bin packing.

An example asks for tokens, one segment, and loss-bearing tokens; a sequence has
a limit for each. Sequences are filled one after another: of the examples at
hand, the one whose demand has the largest dot product with what the sequence
has left (both in shares of the limits) and that fits is placed, until none
fits. Then the gap is closed by the head of the example with the largest
product, which is cut there; the rest stays at hand. A sequence closes when a
limit is reached.

Loss-bearing are all tokens of a piece but its first, which nothing precedes;
where examples have a mask (prompt against answer), only those of them that it
marks. A cut example carries its mask on. Without masks a piece of n tokens has
n - 1 of them, so that ``LOSS`` = ``TOKENS`` - 1 can't be reached first.

Each task packs the rows that it reads, without a shuffle, with a pool of at
most ``POOL`` open examples, so memory doesn't depend on the input and no key
can be too frequent. At a task's end what is left in the last sequence is cut
at powers of two (sequences of such lengths aren't padded), so a task wastes
nothing (but where a task's few last examples are too short to fill the sequence
that was open).

Token ids are those of the given byte-level BPE file as ``tokenizers`` makes
them. Pieces of text that were seen before are looked up; new ones are
encoded by the same vocabulary in ``tiktoken``, which is faster; a
text with characters beyond Latin-1 or with the file's special token is
encoded whole by ``tokenizers``.

Null and empty texts are the end token alone; a very long text is cut into as
many pieces as it needs; repeated rows are packed each; an empty table gives an
empty result; other columns aren't read.
"""

from __future__ import annotations

import base64
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import table, with_arrow

#: Limits of a sequence: tokens, segments, loss-bearing tokens. So many segments
#: fill a sequence unless its pieces have under two tokens on average.
TOKENS, SEGMENTS, LOSS = 2048, 1024, 2047
#: Limit of loss-bearing tokens where examples have masks.
MASKED_LOSS = 1024
END_ID = 1
POOL = 256
#: Remembered pieces of text in a task.
MEMORY = 150_000

SPECIAL = "<|endoftext|>"
# The letters, digits and white space of Latin-1 by Unicode category, for the vocabulary's
# pattern 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class _Pieces(dict):
    """Ids (as bytes) of pieces of text, found when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        ids = self.encode(piece)
        self[piece] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Encoder:
    """Ids of texts, equal to those of ``tokenizers`` with the same file."""

    def __init__(self, json_path: str, ranks_path: str):
        import tiktoken

        self.json_path, self.whole = json_path, None
        with open(ranks_path, "rb") as f:  # a file of the installed vocabulary package
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.pieces = _Pieces(self.bpe.encode_ordinary)
        self.end = np.array([END_ID], dtype="<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        """The text's ids and the end token."""
        if SPECIAL in text or not _latin(text):
            if self.whole is None:  # large, and few texts need it
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.json_path)
            return np.array([*self.whole.encode(text, add_special_tokens=False).ids, END_ID], dtype="<u4")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, LATIN.findall(text))) + self.end, dtype="<u4")


def _resolved(path: str) -> str:
    """The path as the driver gave it, or where this worker's own package of
    public tokenizers has the file."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))


_ENCODERS: dict = {}


def _encoder(*paths: str) -> Encoder:
    """One per Python worker; what it remembers is dropped at a task's end."""
    if paths not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[paths] = Encoder(*map(_resolved, paths))
    return _ENCODERS[paths]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Packer:
    """Places the examples of one task. ``place`` and ``finish`` return pieces
    (example, start, length, sequence, offset)."""

    def __init__(self, tokens: int = TOKENS, segments: int = SEGMENTS, loss: int = LOSS, pool: int = POOL):
        self.limits = np.array([tokens, segments, loss], float)
        self.pool = pool
        self.size = np.zeros(pool + 1)  # tokens left of each open example; 0: a free place
        self.bear = np.zeros(pool + 1)  # its loss-bearing ones
        self.done = np.zeros(pool + 1, np.int64)  # its tokens placed so far
        self.key = np.zeros(pool + 1, np.int64)
        self.upto: list[np.ndarray | None] = [None] * (pool + 1)  # marked tokens before each token, if it has a mask
        self.open = 0
        self.sequence = 0
        self.left, self.target = self.limits.copy(), self.limits[0]
        self.out: list[tuple[int, int, int, int, int]] = []

    @staticmethod
    def _loss(start: int, n: int, upto: np.ndarray | None) -> int:
        """Loss-bearing tokens of a piece: the marked ones but its first, which nothing precedes."""
        return n - 1 if upto is None else int(upto[start + n] - upto[start + 1])

    def _put(self, at: int, n: int) -> None:
        start = int(self.done[at])
        self.out.append((int(self.key[at]), start, n, self.sequence, int(self.target - self.left[0])))
        self.left -= (n, 1, self._loss(start, n, self.upto[at]))
        self.done[at] += n
        self.size[at] -= n
        if self.size[at]:
            self.bear[at] = self._loss(start + n, int(self.size[at]), self.upto[at])
        else:
            self.open -= 1
            self.upto[at] = None
        if self.left.min() <= 0:  # a limit is reached
            self.sequence += 1
            self.left, self.target = self.limits.copy(), self.limits[0]

    def _room(self, at: int) -> int:
        """Tokens of an open example up to the first limit."""
        if self.upto[at] is None:
            return int(min(self.left[0], self.left[2] + 1))
        upto, start = self.upto[at], int(self.done[at])
        end = int(np.searchsorted(upto, upto[start + 1] + self.left[2], side="right")) - 1
        return int(min(self.left[0], end - start))

    def _step(self) -> None:
        """One placement: the best that fits, or else a cut that closes the gap."""
        live = np.flatnonzero(self.size)
        size, bear = self.size[live], self.bear[live]
        share = self.left / self.limits
        score = size / self.limits[0] * share[0] + share[1] / self.limits[1] + bear / self.limits[2] * share[2]
        fits = (size <= self.left[0]) & (bear <= self.left[2])
        if fits.any():
            best = live[np.where(fits, score, -1.0).argmax()]
            self._put(best, int(self.size[best]))
        else:
            best = live[score.argmax()]
            self._put(best, self._room(best))

    def place(self, key: int, n: int, upto: np.ndarray | None = None) -> None:
        """An example of n tokens; ``upto`` (n + 1 numbers): the marked ones before each token and in all."""
        free = int(np.flatnonzero(self.size == 0)[0])
        self.size[free], self.done[free], self.key[free] = n, 0, key
        self.bear[free], self.upto[free] = self._loss(0, n, upto), upto
        self.open += 1
        while self.open > self.pool:
            self._step()

    def finish(self) -> None:
        """Places what is open. What doesn't fill a sequence any more goes to
        sequences of the powers of two that it is the sum of."""
        while self.open:
            rest = int(self.size.sum())
            if self.left[0] == self.limits[0] and rest < self.limits[0]:
                self.target = self.left[0] = 1 << (rest.bit_length() - 1)
            self._step()


def _marked(mask: list | None, n: int) -> np.ndarray | None:
    """Marked tokens before each of n tokens and in all; tokens beyond the mask are marked."""
    if mask is None:
        return None
    upto = np.zeros(n + 1, np.int32)
    marks = np.ones(n, bool)
    marks[:len(mask)] = [bool(m) for m in mask[:n]]
    np.cumsum(marks, out=upto[1:])
    return upto


def pack(docs: DataFrame, json_path: str, ranks_path: str, id_col: str = "doc_id", text: str = "text",
         limits: tuple[int, int, int] | None = None, loss: str | None = None) -> DataFrame:
    """A row per piece: the document's id, ``start`` (its ids before the piece),
    ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence),
    ``loss_tokens`` and ``ids`` (the piece's token ids).

    loss: a column with a mask of each example, an array with an entry (boolean
    or number) per token: true or not 0 where the token bears loss. A null entry
    is false, a null mask and tokens beyond its end (such as the end token) are true."""
    limits = limits or (TOKENS, SEGMENTS, MASKED_LOSS if loss else LOSS)
    kind = docs.schema[id_col].dataType.simpleString()

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        packer = Packer(*limits)
        first = TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}  # open examples
        number = 0

        def rows() -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(9)]
            for key, start, n, seq, offset in packer.out:
                name, ids, upto = held[key]
                part = ids[start:start + n]
                for col, v in zip(cols, (name, start, n, zlib.crc32(part.tobytes()), len(ids), first + seq, offset,
                                         packer._loss(start, n, upto), part.view(np.int32)), strict=True):
                    col.append(v)
                if start + n == len(ids):
                    del held[key]
            packer.out.clear()
            arrays = [pa.array(cols[0], type=types[0]), *[pa.array(c, pa.int64()) for c in cols[1:8]],
                      pa.array(cols[8], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(arrays, names=["id", "start", "length", "ids_crc32", "doc_tokens",
                                                             "sequence_id", "offset", "loss_tokens", "ids"])

        types = [pa.int64()]
        for b in batches:
            types[0] = b.column(0).type
            for row in zip(*b.columns, strict=True):  # one text at a time
                name, ids = row[0].as_py(), encode(row[1].as_py() or "")
                upto = _marked(row[2].as_py(), len(ids)) if loss else None
                held[number] = (name, ids, upto)
                packer.place(number, len(ids), upto)
                number += 1
                if len(packer.out) >= 2000:
                    yield rows()
        packer.finish()
        if packer.out:
            yield rows()
        encode.pieces.clear()  # the worker lives on

    read = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), *([F.col(f"`{loss}`").alias("loss")] if loss else [])]
    found = with_arrow(docs.select(*read), go,
                       f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                       "`offset` long, loss_tokens long, ids array<int>")
    return found.withColumnRenamed("id", id_col)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op2_packing(spark, sf_dir):
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    found = pack(table(spark, sf_dir, "documents"), *vocabulary())
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
