"""Repeated byte strings, by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document of a smaller
id. Such a window is identified by its anchor: of the runs of ``GRAM`` bytes in it the one
with the least hash, the first of several. Windows side by side mostly share an anchor, so
only the suffixes at anchors are sorted, a ninth of all; each carries the bytes before the
anchor that its windows reach back to. Equal windows have equal anchors at equal offsets.

1. Texts are cut into chunks of a few megabytes, written once in a bucketed table that the
   later steps read without a shuffle. A longer document is cut into overlapping parts.
2. Each chunk sends the sorted hashes of its anchors, coded by differences. What several
   documents may have is answered with a bit; only those anchors go on. The answer can only
   name too many (equal hashes), never too few.
3. Each chunk sorts its suffixes. Equal ones are combined first: the least document of a
   chunk stands for all, so a passage that a third of the documents share travels once for
   each chunk. A sorted run is dealt by the first bytes of its suffixes and front-coded: of
   each suffix the length of the prefix that it shares with the one before, and the rest.
4. The runs of a shard are merged by a tree of losers. Each loser keeps the length of the
   prefix that it shares with the winner, so known prefixes are not compared again. The
   shared lengths of the merged order give the classes of equal bytes after the anchor, for
   any number of bytes; the same for the bytes before it; a window is a pair of classes.
5. Windows that are found go back to their chunk, which cuts them out of the whole texts.

An anchor with more than ``HOT`` different surroundings (a line that many documents have)
would bring them all into one shard. Its windows are sent one by one, as suffixes of their
own, dealt by all their bytes. Every way compares bytes; hashes only say where to compare.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import new_path, stage
from .common import rows_of, text_of

LENGTH = 50
GRAM = 34
REACH = LENGTH - GRAM
CHUNK = 4 << 20
HOT = 10_000
#: Bytes of text for each shard of hashes and of suffixes.
HASH_SHARD, SUFFIX_SHARD = 64 << 20, 16 << 20
POSITION = 23
BLOCK = 1 << 14
LAST = np.iinfo(np.int64).max
CODES = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)
FACTOR = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight side by side."""
    parts = [np.array([len(arrays)] + [len(a) for a in arrays], np.int64).tobytes()]
    parts += [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpacked(blob: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(data, np.int64, len(types), 8)
    at, found = 8 * (len(types) + 1), []
    for n, kind in zip(sizes.tolist(), types):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return found


class Anchors(NamedTuple):
    """Where anchors are, the first and last window of each, and the hash of its run."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray
    around: np.ndarray


def hashes_of(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``GRAM`` bytes, and of each window the place of its least one."""
    factors = [FACTOR]
    sums = [CODES[body]]
    while 2 << (len(sums) - 1) <= GRAM:
        half, h = 1 << (len(sums) - 1), sums[-1]
        sums.append(h[:-half] * np.uint64(factors[-1]) + h[half:])
        factors.append(factors[-1] ** 2 % (1 << 64))
    runs, width = None, 0
    for k in reversed(range(len(sums))):
        if GRAM >> k & 1:
            n = len(body) - (width + (1 << k)) + 1
            tail = sums[k][width : width + n]
            runs = tail if runs is None else runs[:n] * np.uint64(factors[k]) + tail
            width += 1 << k
    position = np.uint64((1 << POSITION) - 1)
    least = mixed(runs, 0xBF58476D1CE4E5B9) & ~position | np.arange(len(runs), dtype=np.uint64)
    width = 1
    while width < REACH + 1:
        step = min(width, REACH + 1 - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return runs, (least & position).astype(np.int32)


def anchors(body: np.ndarray, sizes: np.ndarray, owned: np.ndarray) -> Anchors:
    """The anchors of documents that lie side by side in ``body``. Windows start at the
    first ``owned`` bytes of each document and end within it."""
    n_windows = np.maximum(0, np.minimum(owned, sizes - LENGTH + 1))
    if not n_windows.sum():
        none, no_hash = np.empty(0, np.int64), np.empty(0, np.uint64)
        return Anchors(none, none, none, no_hash, no_hash)
    runs = np.empty(len(body) - GRAM + 1, np.uint64)
    least = np.empty(len(body) - LENGTH + 1, np.int32)
    for at in range(0, len(least), BLOCK):  # as much as the cache of a core holds
        here, place = hashes_of(body[at : at + BLOCK + LENGTH - 1])
        runs[at : at + len(here)] = here
        least[at : at + len(place)] = place + at
    starts = np.cumsum(sizes) - sizes - (np.cumsum(n_windows) - n_windows)
    windows = np.arange(n_windows.sum()) + np.repeat(starts, n_windows)
    of_window = least[windows]
    starts = np.flatnonzero(np.concatenate([[True], of_window[1:] != of_window[:-1]]))
    ends = np.concatenate([starts[1:], [len(windows)]]) - 1
    at = of_window[starts].astype(np.int64)
    before, after = np.maximum(at - REACH, 0), np.minimum(at + REACH, len(runs) - 1)
    around = runs[before] * np.uint64(FACTOR) ^ runs[after]
    return Anchors(at, windows[starts], windows[ends], mixed(runs[at], 0x94D049BB133111EB), around)


def chunks_of(size: int):
    """A function for ``mapInArrow``: (id, text) to chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        n, row, held = 0, 0, []
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64())]
        kinds += [pa.list_(pa.int64())] * 4 + [pa.binary()]

        def chunk() -> pa.RecordBatch:
            nonlocal n, held
            ids, rows, starts, sizes, owned, bodies = zip(*held)
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(bodies))
            n, held = n + 1, []
            values = [slot, slot << 32 | n, ids, rows, starts, sizes, owned, body]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], names=CHUNK_NAMES
            )

        weight = 0
        for doc_id, text in rows_of(batches):
            data = text.encode()
            for start in range(0, max(1, len(data)), size):
                part = data[start : start + size + LENGTH - 1]
                if held and weight + len(part) > size:
                    yield chunk()
                    weight = 0
                own = min(size, len(data) - start)
                held.append((doc_id, row, start, len(part), own, part))
                weight += len(part) + 64
            row += 1
        if held:
            yield chunk()

    return run


CHUNK_NAMES = ["slot", "chunk", "ids", "rows", "starts", "sizes", "owned", "body"]
CHUNK_SCHEMA = (
    "slot int, chunk long, ids array<long>, rows array<long>, starts array<long>, "
    "sizes array<long>, owned array<long>, body binary"
)


def chunk_table(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """The chunks, in a table that is bucketed by the task that wrote them."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long"), text_of(docs, text_col))
    made = rows.mapInArrow(chunks_of(size), CHUNK_SCHEMA)
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = made.write.format("parquet").bucketBy(buckets, "slot")
    # Small row groups: a reader holds a whole one.
    writer = writer.option("parquet.block.size", 8 << 20).option("compression", "none")
    writer.option("path", new_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def bytes_of(body: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)


def batch_of(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def hash_sets(found: Anchors, owner: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and of each the number of its surroundings, at least
    two if several documents have it."""
    low = np.uint64(64 - bits)
    rank = found.hash >> low << low | found.around >> np.uint64(bits)
    order = np.argsort(rank)
    rank, owner = rank[order], owner[order]
    other = np.ones(len(rank), bool)
    other[1:] = rank[1:] != rank[:-1]
    hashes = rank >> low
    new = other.copy()
    new[1:] = hashes[1:] != hashes[:-1]
    starts = np.flatnonzero(new)
    if not len(starts):
        return hashes, np.empty(0, np.uint16)
    weights = np.add.reduceat(other.astype(np.int64), starts)
    several = np.minimum.reduceat(owner, starts) < np.maximum.reduceat(owner, starts)
    weights = np.minimum(np.maximum(weights, 1 + several), 65535)
    return hashes[starts], weights.astype(np.uint16)


def send_hashes(bits: int, shard_bits: int):
    names = ["shard", "slot", "chunk", "hashes"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    low = bits - shard_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, chunk, sizes, owned, body in rows_of(batches, 1):
            sizes, owned = np.array(sizes), np.array(owned)
            found = anchors(bytes_of(body), sizes, owned)
            owner = np.searchsorted(np.cumsum(sizes), found.at, "right")
            hashes, weights = hash_sets(found, owner, bits)
            shards = (hashes >> np.uint64(low)).astype(np.int64)
            rows = []
            for shard in np.unique(shards).tolist():
                part = slice(*np.searchsorted(shards, [shard, shard + 1]))
                steps = np.diff(hashes[part] & np.uint64((1 << low) - 1), prepend=np.uint64(0))
                rows.append((shard, slot, chunk, packed(steps, weights[part])))
            yield batch_of(names, kinds, rows)

    return run


def answer_hashes(hot: int):
    names = ["slot", "chunk", "shard", "flags"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]

    def answers(shard: int, sent: list[tuple]) -> Iterator[pa.RecordBatch]:
        steps, weights = zip(*(unpacked(blob, np.uint64, np.uint16) for *_, blob in sent))
        counts = [len(s) for s in steps]
        hashes = np.concatenate([np.cumsum(s) for s in steps])
        weights = np.concatenate(weights).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        total = np.add.reduceat(weights[order], starts)
        flags = np.empty(len(hashes), np.uint8)
        flags[order] = np.repeat((total > 1) + (total > hot), np.diff(starts, append=len(ranked)))
        stops = np.cumsum(counts)
        rows = []
        for (slot, chunk, _), n, stop in zip(sent, counts, stops.tolist()):
            rows.append((slot, chunk, shard, packed(flags[stop - n : stop])))
        yield batch_of(names, kinds, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sent = None, []
        for shard, slot, chunk, blob in rows_of(batches, 16):
            if shard != at and sent:
                yield from answers(at, sent)
                sent = []
            at = shard
            sent.append((slot, chunk, blob))
        if sent:
            yield from answers(at, sent)

    return run


class Suffixes(NamedTuple):
    """Suffixes of at most ``LENGTH`` bytes, filled up with zeros, and what is before them.
    Windows start ``low`` to ``high`` bytes before the suffix."""

    key: np.ndarray
    before: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray
    shard: np.ndarray
    single: np.ndarray

    def take(self, order: np.ndarray) -> Suffixes:
        return Suffixes(*(column[order] for column in self))


def bytes_at(body: np.ndarray, start: np.ndarray, n: np.ndarray, width: int, step: int) -> np.ndarray:
    """``n`` bytes from each ``start`` on, forwards or backwards, filled up with zeros."""
    found = np.zeros((len(start), width), np.uint8)
    for at in range(width):
        within = n > at
        found[within, at] = body[start[within] + step * at]
    return found


def suffixes_of(body: np.ndarray, found: Anchors, docs: np.ndarray, flags: np.ndarray, shards: int):
    """The suffixes of a chunk: at the anchors that are flagged, and of the windows of hot ones."""
    cold, hot = np.flatnonzero(flags == 1), np.flatnonzero(flags == 2)
    n_windows = found.last[hot] - found.first[hot] + 1
    windows = np.repeat(found.first[hot], n_windows)
    windows += np.arange(len(windows)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = np.concatenate([found.at[cold], windows])
    none = np.zeros(len(windows), np.int64)
    low = np.concatenate([found.at[cold] - found.last[cold], none])
    high = np.concatenate([found.at[cold] - found.first[cold], none])
    key = bytes_at(body, at, LENGTH - low, LENGTH, 1)
    before = bytes_at(body, at - 1, high, REACH, -1)
    powers = np.cumprod(np.full(LENGTH, FACTOR, np.uint64))
    whole = (key[len(cold) :].astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)
    dealt = np.concatenate([found.hash[cold], mixed(whole, 0xBF58476D1CE4E5B9)])
    shard = (mixed(dealt, FACTOR) % np.uint64(shards)).astype(np.int64)
    doc = np.concatenate([docs[cold], np.repeat(docs[hot], n_windows)])
    single = np.arange(len(at)) >= len(cold)
    return Suffixes(key, before, at, low, high, doc, shard, single)


def words(rows: np.ndarray) -> list[np.ndarray]:
    """Columns of whole numbers that sort like the rows of bytes."""
    width = -rows.shape[1] % 8
    filled = np.concatenate([rows, np.zeros((len(rows), width), np.uint8)], axis=1)
    return list(np.ascontiguousarray(filled).view(">u8").astype(np.uint64).T)


def shared(rows: np.ndarray) -> np.ndarray:
    """The length of the prefix that each row shares with the one before it."""
    found = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 1 << 16):
        part = rows[at - 1 : at + (1 << 16)]
        differs = part[1:] != part[:-1]
        first = differs.argmax(axis=1)
        found[at : at + (1 << 16)] = np.where(differs.any(axis=1), first, rows.shape[1])
    return found


def combined(found: Suffixes) -> tuple[Suffixes, Suffixes]:
    """Sorted suffixes without those that a smaller document of the chunk has too, and
    the latter."""
    if not len(found.at):
        return found, found
    columns = [found.doc, found.low, found.high, *reversed(words(found.before))]
    columns += [*reversed(words(found.key)), found.single, found.shard]
    order = np.lexsort(columns)
    found = found.take(order)
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in columns[1:]:
        ranked = column[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    first = np.repeat(found.doc[starts], np.diff(starts, append=len(order)))
    later = found.doc > first
    return found.take(~later), found.take(later)


def masks(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A bit for each offset from ``low`` to ``high``."""
    return ((2 << high) - (1 << low)).astype(np.uint32)


RUN_NAMES = ["shard", "single", "slot", "chunk", "run", "at", "gone"]
RUN_KINDS = [pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
RUN_SCHEMA = "shard int, single boolean, slot int, chunk long, run binary, at binary, gone binary"
FRONT_CODED = (np.uint8, np.uint8, np.uint8, np.uint8, np.uint8, np.int64, np.int32)


def front_coded(run: Suffixes) -> bytes:
    share = shared(run.key)
    size = LENGTH - run.low
    place = np.arange(LENGTH)
    rest = run.key[(place >= share[:, None]) & (place < size[:, None])]
    left = run.before[np.arange(REACH) < run.high[:, None]]
    small = (share.astype(np.uint8), run.low.astype(np.uint8), run.high.astype(np.uint8))
    return packed(*small, rest, left, run.doc, run.at.astype(np.int32))


def send_runs(bits: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, chunk, ids, sizes, owned, body, answers in rows_of(batches, 1):
            sizes, owned, body = np.array(sizes), np.array(owned), bytes_of(body)
            found = anchors(body, sizes, owned)
            owner = np.searchsorted(np.cumsum(sizes), found.at, "right")
            of_anchor = found.hash >> np.uint64(64 - bits)
            _, of_anchor = np.unique(of_anchor, return_inverse=True)
            parts = sorted((a["shard"], a["flags"]) for a in answers or [])
            flags = np.concatenate([np.empty(0, np.uint8)] + [unpacked(f, np.uint8)[0] for _, f in parts])
            flags = flags[of_anchor]
            docs = np.array([LAST if i is None else i for i in ids], np.int64)[owner]
            sent, gone = combined(suffixes_of(body, found, docs, flags, shards))
            rows = []
            if len(gone.at):
                at, bit = packed(gone.at.astype(np.int32)), packed(masks(gone.low, gone.high))
                rows.append((chunk % shards, False, slot, chunk, None, at, bit))
            group = sent.shard * 2 + sent.single
            cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
            for start, stop in zip(cuts, [*cuts[1:], len(group)]) if len(group) else ():
                part = sent.take(slice(start, stop))
                where = (int(part.shard[0]), bool(part.single[0]), slot, chunk)
                rows.append((*where, front_coded(part), None, None))
            yield batch_of(RUN_NAMES, RUN_KINDS, rows)

    return run


def decoded(share: list[int], low: list[int], rest: bytes) -> list[bytes]:
    """The suffixes of a front-coded run."""
    found, key, at = [], b"", 0
    for common, lacks in zip(share, low):
        n = max(0, LENGTH - lacks - common)
        key = (key[:common] + rest[at : at + n]).ljust(LENGTH, b"\0")
        at += n
        found.append(key)
    return found


def merge(runs: list[list[bytes]], shares: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merges sorted runs by a tree of losers: the run of each next key, and the length of
    the prefix that it shares with the key before it. ``shares`` has that within each run.

    All keys in the tree know what they share with the last winner: the one that shares
    more is less, and only of equals are bytes compared, from there on. A run that has
    ended shares -1."""
    size = 1
    while size < len(runs):
        size *= 2
    heads = [run[0] if run else b"" for run in runs]
    at = [0] * len(runs)
    loser, knows = [0] * size, [-1] * size

    def play(node: int) -> tuple[int, int]:
        """The winner among the leaves below ``node``, and what it shares with nothing."""
        if node >= size:
            run = node - size
            return (run, 0) if run < len(runs) and runs[run] else (run, -1)
        (a, share_a), (b, share_b) = play(2 * node), play(2 * node + 1)
        if share_a < share_b:
            a, share_a, b, share_b = b, share_b, a, share_a
        elif share_a == share_b == 0:
            if heads[b] < heads[a]:
                a, b = b, a
            differs = int.from_bytes(heads[a]) ^ int.from_bytes(heads[b])
            share_b = LENGTH - (differs.bit_length() + 7) // 8
        loser[node], knows[node] = b, share_b
        return a, share_a

    winner, share = play(1)
    order, common = [], []
    while share >= 0:
        order.append(winner)
        common.append(share)
        at[winner] += 1
        if at[winner] < len(runs[winner]):
            heads[winner] = runs[winner][at[winner]]
            share = shares[winner][at[winner]]
        else:
            share = -1
        node = (winner + size) >> 1
        while node:
            known = knows[node]
            if known > share:
                loser[node], winner = winner, loser[node]
                knows[node], share = share, known
            elif known == share >= 0:
                mine, other = heads[winner][share:], heads[loser[node]][share:]
                differs = int.from_bytes(mine) ^ int.from_bytes(other)
                knows[node] = LENGTH - (differs.bit_length() + 7) // 8
                if other < mine:
                    loser[node], winner = winner, loser[node]
            node >>= 1
    return order, common


def repeated(share: np.ndarray, run: Suffixes, offsets: range) -> np.ndarray:
    """Of merged suffixes, a bit for each window that a smaller document has too."""
    found = np.zeros(len(share), np.uint32)
    by_left = np.lexsort(list(reversed(words(run.before))))
    share_left = shared(run.before[by_left])
    left = np.empty(len(share), np.int64)
    for offset in offsets:
        rows = np.flatnonzero((run.low <= offset) & (offset <= run.high))
        right = np.cumsum(share < LENGTH - offset)[rows]
        near = np.zeros(len(rows) + 1, bool)
        near[1:-1] = right[1:] == right[:-1]
        several = near[1:] | near[:-1]
        rows, right = rows[several], right[several]
        if not len(rows):
            continue
        left[by_left] = np.cumsum(share_left < offset)
        window = right * (len(share) + 1) + left[rows]
        order = np.argsort(window, kind="stable")
        rows, window = rows[order], window[order]
        starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        least = np.minimum.reduceat(run.doc[rows], starts)
        later = run.doc[rows] > np.repeat(least, np.diff(starts, append=len(rows)))
        found[rows[later]] |= np.uint32(1 << offset)
    return found


REPLY_NAMES = ["slot", "chunk", "at", "gone"]
REPLY_KINDS = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def replies(single: bool, sent: list[tuple]) -> pa.RecordBatch:
        keys, shares, columns = [], [], []
        for _, _, blob in sent:
            share, low, high, rest, left, doc, at = unpacked(blob, *FRONT_CODED)
            keys.append(decoded(share.tolist(), low.tolist(), rest.tobytes()))
            shares.append(share.tolist())
            before = np.zeros((len(high), REACH), np.uint8)
            before[np.arange(REACH) < high[:, None]] = left
            columns.append((before, at, low.astype(np.int64), high.astype(np.int64), doc))
        order, common = merge(keys, shares)
        del keys, shares
        # Of the runs laid end to end: which merged row each row is, and the reverse.
        back = np.argsort(np.array(order, np.int64), kind="stable")
        place = np.empty(len(order), np.int64)
        place[back] = np.arange(len(order))
        before, at, low, high, doc = (np.concatenate(c) for c in zip(*columns))
        none = np.empty((len(order), 0), np.uint8)
        merged = Suffixes(none, before, at, low, high, doc, at, at).take(place)
        offsets = range(1) if single else range(REACH + 1)
        gone = repeated(np.array(common, np.int64), merged, offsets)[back]
        rows, start = [], 0
        for (slot, chunk, _), (_, at, *_) in zip(sent, columns):
            part = gone[start : start + len(at)]
            start += len(at)
            if part.any():
                rows.append((slot, chunk, packed(at[part > 0]), packed(part[part > 0])))
        return batch_of(REPLY_NAMES, REPLY_KINDS, rows)

    now, sent = None, []
    for shard, single, slot, chunk, run, at, gone in rows_of(batches, 16):
        if run is None:
            yield batch_of(REPLY_NAMES, REPLY_KINDS, [(slot, chunk, at, gone)])
            continue
        if now != (shard, single) and sent:
            yield replies(now[1], sent)
            sent = []
        now = shard, single
        sent.append((slot, chunk, run))
    if sent:
        yield replies(now[1], sent)


FOUND_NAMES = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "slot", "row", "start", "part", "cut", "reach"]
FOUND_KINDS = [pa.int64()] * 4 + [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
FOUND_SCHEMA = (
    "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "slot int, row long, start long, part binary, cut binary, reach long"
)


def spans(cut: np.ndarray) -> int:
    return int(cut[:1].sum() + (cut[1:] > cut[:-1]).sum())


def cut_out(size: int):
    """Results of whole documents, and of longer ones the parts and what is cut of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, _, ids, rows, starts, sizes, owned, body, replies in rows_of(batches, 1):
            body = bytes_of(body)
            windows = np.zeros(len(body) + LENGTH, np.int8)
            for reply in replies or []:
                (at,), (gone,) = unpacked(reply["at"], np.int32), unpacked(reply["gone"], np.uint32)
                for offset in range(REACH + 1):
                    windows[at[gone >> np.uint32(offset) & np.uint32(1) > 0] - offset] = 1
            edges = windows.copy()
            edges[LENGTH:] -= windows[:-LENGTH]
            cut = np.cumsum(edges, dtype=np.int32)[: len(body)] > 0
            found, at = [], 0
            for doc_id, row, start, n, own in zip(ids, rows, starts, sizes, owned):
                here, gone = body[at : at + n], cut[at : at + n]
                if start or own == size and n > own:
                    last = np.flatnonzero(windows[at : at + own])
                    reach = max(0, int(last[-1]) + LENGTH - own) if len(last) else 0
                    bits = np.packbits(gone[:own]).tobytes()
                    known = (doc_id, None, None, None, None)
                    found.append((*known, slot, row, start, here[:own].tobytes(), bits, reach))
                else:
                    digest = hashlib.sha256(here[~gone].tobytes()).hexdigest()
                    known = (doc_id, n, int(gone.sum()), spans(gone), digest)
                    found.append((*known, slot, row, start, None, None, None))
                at += n
            yield batch_of(FOUND_NAMES, FOUND_KINDS, found)

    return run


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of documents from their parts, in order: one part at a time."""

    def result() -> pa.RecordBatch:
        row = (doc_id, n_bytes, n_removed, n_spans, digest.hexdigest())
        return batch_of(FOUND_NAMES[:5], FOUND_KINDS[:5], [row])

    now = None
    for doc_id_, slot, row, _, part, bits, reach_ in rows_of(batches, 1):
        if now != (slot, row):
            if now:
                yield result()
            now, doc_id = (slot, row), doc_id_
            n_bytes = n_removed = n_spans = reach = 0
            digest, open_span = hashlib.sha256(), False
        part = np.frombuffer(part, np.uint8)
        cut = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(part)).astype(bool)
        cut[:reach] = True
        digest.update(part[~cut].tobytes())
        n_bytes += len(part)
        n_removed += int(cut.sum())
        n_spans += spans(cut) - int(open_span and cut[:1].any())
        open_span, reach = bool(cut[-1]), max(reach_, reach - len(part))
    if now:
        yield result()


def with_replies(chunks: DataFrame, replies: DataFrame, names: list[str]) -> DataFrame:
    """The chunks with the list of their replies. Tables meet by slot, which the chunks are
    bucketed by, so only the replies are shuffled."""
    there = replies.groupBy(F.col("slot").alias("to"), "chunk").agg(
        F.collect_list(F.struct(*names)).alias("replies")
    )
    there = there.withColumnRenamed("chunk", "to_chunk").hint("shuffle_hash")
    same = (chunks["slot"] == there["to"]) & (chunks["chunk"] - there["to_chunk"] == 0)
    return chunks.join(there, same, "left").drop("to", "to_chunk")


def drop_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    hot: int = HOT,
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row:
    what stays of its text, as UTF-8, without the bytes under a string of ``LENGTH`` bytes
    that also starts in a row of smaller id.

    Ids are whole numbers. A null id is greater than any other, so nothing goes because of
    it; rows of one id, equal or not, do not cut each other. A null text is empty; empty
    texts and those shorter than ``LENGTH`` stay whole. Texts longer than ``chunk`` bytes
    are worked on in parts, with the same result. An empty table gives an empty result, and
    other columns of ``docs`` are not read. ``chunk`` and ``hot`` change the work only."""
    if not LENGTH < chunk <= 1 << (POSITION - 1):
        raise ValueError(f"a chunk has more than {LENGTH} and at most {1 << (POSITION - 1)} bytes")
    chunks = chunk_table(docs, id_col, text_col, chunk)
    length = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    total = chunks.agg(F.sum(length)).first()[0] or 0
    # Two hashes of different runs meet for one run in about a hundred.
    bits = min(48, max(16, math.ceil(math.log2(total + 1)) + 4))
    shard_bits = max(0, math.ceil(math.log2(max(1, total / HASH_SHARD))))
    shards = max(1, total // SUFFIX_SHARD)

    spread = max(1, min(1 << shard_bits, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sent = chunks.select("slot", "chunk", "sizes", "owned", "body").mapInArrow(
        send_hashes(bits, shard_bits), "shard int, slot int, chunk long, hashes binary"
    )
    sent = sent.repartition(spread, "shard").sortWithinPartitions("shard")
    answers = sent.mapInArrow(answer_hashes(hot), "slot int, chunk long, shard int, flags binary")
    answers = stage(answers, "suffix-answers")

    asked = with_replies(chunks, answers, ["shard", "flags"])
    asked = asked.select("slot", "chunk", "ids", "sizes", "owned", "body", "replies")
    runs = asked.mapInArrow(send_runs(bits, shards), RUN_SCHEMA)
    runs = runs.repartition(int(shards), "shard").sortWithinPartitions("shard", "single")
    replies = runs.mapInArrow(merge_runs, "slot int, chunk long, at binary, gone binary")
    replies = stage(replies, "suffix-replies")

    asked = with_replies(chunks, replies, ["at", "gone"]).select(*CHUNK_NAMES, "replies")
    found = stage(asked.mapInArrow(cut_out(chunk), FOUND_SCHEMA), "suffix-results")
    parts = found.where("part is not null").select("id", "slot", "row", "start", "part", "cut", "reach")
    parts = parts.repartition("slot", "row").sortWithinPartitions("slot", "row", "start")
    names = FOUND_NAMES[:5]
    whole = found.where("part is null").select(names)
    joined = parts.mapInArrow(
        chained, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return whole.unionByName(joined).withColumnRenamed("id", id_col)
