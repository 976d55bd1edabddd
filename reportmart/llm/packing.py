"""Packing of examples into sequences as vector bin packing.

Every sequence has three limits at once: tokens, segments, and tokens that bear
loss. A task reads its examples as a stream and keeps a bounded pool of pieces
that still wait. Into the open sequence goes, again and again, the piece that fits
and whose demand has the largest dot product with the room left, both measured in
parts of the limits. When nothing fits, a piece is cut to fill the room, and the
rest of it stays in the pool. At the end of a task the last tokens go to sequences
whose lengths are powers of two, which need no padding.

Nothing is shuffled, and a sequence never spans two tasks, so a lost executor
costs only the tasks it ran.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import rows_of, text_of
from .words import (
    COMMON,
    PATTERN,
    Kept,
    byte_letters,
    byte_level_spec,
    irregular,
    merges_of,
    slices,
    units,
)

PIECE = pa.schema(
    [
        ("id", pa.string()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("crc", pa.int64()),
        ("total", pa.int64()),
        ("loss", pa.int64()),
        ("sequence", pa.int64()),
        ("at", pa.int64()),
        ("ids", pa.binary()),
    ]
)


class Encoder:
    """Identifiers of texts, as little-endian unsigned 32-bit numbers, as the ``tokenizers``
    library gives them. Short units of plain byte-level vocabularies go to ``tiktoken`` with
    the merges of the same file, which takes a third of the time, and a unit's identifiers
    are kept for its next occurrence."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.quick = quick_encoding(path)
        self.kept = Kept(self._unit)
        self.after_space = Kept(lambda word: self._unit(" " + word))

    def _ids(self, text: str) -> bytes:
        found = self.library.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        return array("I", self.quick.encode_ordinary(unit)).tobytes()

    def _part(self, text: str) -> bytes:
        if irregular(text):
            return b"".join(map(self.kept.__getitem__, units(text)))
        head, *rest = text.split(" ")
        rest = b"".join(map(self.after_space.__getitem__, rest))
        return self.kept[head] + rest if head else rest

    def ids(self, text: str) -> bytes:
        if not self.quick or COMMON.search(text) or any(s in text for s in self.special):
            return self._ids(text)
        return b"".join([self._part(part) for part in slices(text)])


def quick_encoding(path: str):
    """The vocabulary for ``tiktoken``; None where identifiers are not in the order of the
    merges, or the vocabulary is of another kind."""
    import tiktoken

    spec = byte_level_spec(path)
    if spec is None:
        return None
    vocabulary = spec["model"]["vocab"]
    order = [vocabulary[a + b] for a, b in merges_of(spec)]
    if order != sorted(set(order)):
        return None
    byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """Packs pieces of examples into sequences; see the module."""

    def __init__(
        self,
        emit: Callable[..., None],
        *,
        tokens: int,
        segments: int,
        loss: int,
        pool: int,
        first_sequence: int = 0,
    ) -> None:
        if min(tokens, segments, loss, pool) < 1:
            raise ValueError("limits and pool must be at least 1")
        self.emit, self.limits = emit, np.array([tokens, segments, loss], float)
        self.tokens, self.sequence = tokens, first_sequence
        # A piece: row id, its identifiers, number of the first of them in the row,
        # number of the row's first one with loss, number of all of the row.
        self.pieces: list[tuple | None] = [None] * pool
        self.demand = np.zeros((pool, 3))
        self.free = list(range(pool))

    def add(self, row_id: str | None, ids: bytes, loss_from: int = 0) -> None:
        """An example; its tokens before ``loss_from`` bear no loss."""
        whole = len(ids) // 4
        for start in range(0, whole, self.tokens):
            part = ids[4 * start : 4 * (start + self.tokens)]
            while not self.free:
                self._fill(self.tokens)
            self._set(self.free.pop(), (row_id, part, start, loss_from, whole))

    def finish(self) -> None:
        """Use up the pool. What fills no whole sequence goes to sequences whose
        lengths are powers of two."""
        while left := int(self.demand[:, 0].sum()):
            self._fill(self.tokens if left >= self.tokens else 1 << (left.bit_length() - 1))

    def _set(self, slot: int, piece: tuple) -> None:
        _, part, start, loss_from, _ = piece
        n = len(part) // 4
        self.pieces[slot] = piece
        self.demand[slot] = n, 1, n - min(n, max(0, loss_from - start))

    def _fill(self, tokens: int) -> None:
        """Make one sequence of at most ``tokens`` tokens."""
        room = self.limits.copy()
        room[0] = tokens
        at = 0
        while room[0] and room[1]:
            demand = self.demand
            there = demand[:, 1] > 0
            fits = there & (demand <= room).all(axis=1)
            if fits.any():
                weight = (demand / self.limits) @ (room / self.limits)
                slot = int(np.argmax(np.where(fits, weight, -1)))
                take = int(demand[slot, 0])
            else:  # cut the piece of which most tokens fit
                without_loss = demand[:, 0] - demand[:, 2]
                part = np.minimum(np.minimum(demand[:, 0], without_loss + room[2]), room[0])
                slot = int(np.argmax(np.where(there, part, 0)))
                take = int(part[slot]) if there[slot] else 0
            if not take:
                break
            row_id, ids, start, loss_from, whole = self.pieces[slot]
            loss = take - min(take, max(0, loss_from - start))
            self.emit(row_id, ids[: 4 * take], start, whole, loss, self.sequence, at)
            at += take
            room -= take, 1, loss
            if 4 * take < len(ids):
                self._set(slot, (row_id, ids[4 * take :], start + take, loss_from, whole))
            else:
                self.pieces[slot] = None
                self.demand[slot] = 0
                self.free.append(slot)
        self.sequence += 1


def pack(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end_id: int | None = 1,
    tokens: int = 2048,
    segments: int = 256,
    loss_tokens: int | None = None,
    pool: int = 512,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all rows, each with its place in a sequence.

    A row's identifiers are those of its prompt, which bear no loss, then those of its
    text, then ``end_id``. Result: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``loss_tokens``, ``sequence_id``, ``offset`` and, with ``keep_ids``,
    ``ids``. Every identifier lies in exactly one piece.

    Null text or prompt counts as empty; a row without identifiers has no piece. Rows
    that repeat an id are separate examples; a null id stays null; other columns are
    not read. An empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType
    prompt = text_of(docs, prompt_col) if prompt_col else F.lit("")
    rows = docs.select(
        docs[id_col].cast("string").alias("id"),
        prompt.alias("p"),
        text_of(docs, text_col).alias("t"),
    )
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    loss_limit = tokens if loss_tokens is None else loss_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def emit(row_id, ids, start, whole, loss, sequence, at) -> None:
            place = (whole, loss, sequence, at, ids if keep_ids else None)
            found.append((row_id, start, len(ids) // 4, zlib.crc32(ids), *place))

        def batch() -> pa.RecordBatch:
            columns = zip(*found) if found else ([] for _ in PIECE)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, PIECE)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=PIECE)

        packer = Packer(
            emit,
            tokens=tokens,
            segments=segments,
            loss=loss_limit,
            pool=pool,
            first_sequence=TaskContext.get().partitionId() << 33,
        )
        encode = encoder(path).ids
        for row_id, prompt, text in rows_of(batches):
            before = encode(prompt)
            packer.add(row_id, before + encode(text) + end, len(before) // 4)
            if len(found) >= 4096:
                yield batch()
        packer.finish()
        yield batch()

    packed = rows.mapInArrow(
        run,
        "id string, start long, length long, crc long, total long, loss long, "
        "sequence long, at long, ids binary",
    )
    columns = [
        F.col("id").cast(id_type).alias(id_col),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"),
        F.col("loss").alias("loss_tokens"),
        F.col("sequence").alias("sequence_id"),
        F.col("at").alias("offset"),
    ]
    return packed.select(*columns, *(["ids"] if keep_ids else []))
