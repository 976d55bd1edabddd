"""Near duplicates by SimHash, found with keys of the binary Golay code.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits, the last filled up
with zeros. The Golay code [23, 12] is perfect: every 23-bit word is within three bits
of exactly one codeword, so each word decodes to one of 4096 indices. The keys of a
segment are the index of the word itself and, if its number of ones is odd, also those
of the words one bit away. Of two segments that differ in one bit one is odd, and it
has the other's index among its keys; equal segments have equal keys. A word three
bits from its codeword gives six keys, any other word one.

Of two fingerprints that differ in at most three bits, either two segments are equal but
for at most one bit of one of them, or all three segments differ in one bit each. The keys
are therefore, for each ordered pair of segments, the first word as it is with a key of the
second (35 bits), and a key of all three segments (36 bits). Every link shares one of them,
so the search misses none, and texts that are not alike hardly ever do.

Only keys that several fingerprints have go on. The fingerprints of a key are dealt
into blocks of about ``BLOCK``, and each pair of blocks is one row, so a key with very
many fingerprints is spread over many tasks. Candidates are verified by counting
differing bits; of the links in a pair of blocks only a spanning forest is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .common import ascii_lower, by_row, text_of, without
from .components import components
from .exact_dedup import sha256

SEED = 42
MAX_BITS = 3
BLOCK = 1024
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))
#: Fixed value: a generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
PART = 1 << 20


def word_parts(data: bytes, width: int = 3) -> Iterator[list[bytes]]:
    """The words of ``data`` in parts of about a megabyte; each part repeats the last
    words before it, so that every run of ``width`` words lies in one part."""
    at, carry = 0, []
    while at < len(data):
        stop = at + PART
        while stop < len(data) and data[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        words = carry + data[at:stop].split()
        yield words
        at, carry = stop, words[1 - width :]


def fingerprint(text: str) -> int:
    """SimHash over the XXH64 hashes of all runs of three words; see ``fingerprints``."""
    # bytes.lower() and bytes.split() know ASCII only, as wanted.
    data = text.encode("utf-8").lower()
    ones = np.zeros(64, np.int64)
    n = 0
    words: list[bytes] = []
    for words in word_parts(data):
        if len(words) < 3:
            continue
        shingles = (b"%b %b %b" % run for run in zip(words, words[1:], words[2:]))
        n += add_bits(ones, [xxhash.xxh64_intdigest(s, SEED) for s in shingles])
    if not n and words:
        n = add_bits(ones, [xxhash.xxh64_intdigest(b" ".join(words), SEED)])
    bits = 2 * ones > n
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def add_bits(ones: np.ndarray, hashes: list[int]) -> int:
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(hashes)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` of every row: the fingerprint's 64 bits as a signed long.

    A-Z are lowered, words end at ASCII white space, and each run of three words counts
    as often as it occurs. A text of fewer words has one shingle of all of them; a text
    without words, or null, has fingerprint zero. Very long texts are read in parts."""
    id_type = docs.schema[id_col].dataType
    rows = docs.select(docs[id_col].cast("string").alias("id"), text_of(docs, text_col).alias("t"))

    def of_row(row_id: str | None, text: str) -> list[tuple]:
        fp = fingerprint(text)
        return [(row_id, fp - (fp >> 63 << 64))]

    schema = pa.schema([("id", pa.string()), ("fp", pa.int64())])
    found = rows.mapInArrow(by_row(of_row, schema), "id string, fp long")
    return found.select(F.col("id").cast(id_type).alias(id_col), "fp")


@cache
def golay_indices() -> np.ndarray:
    """The index of the nearest codeword, for every 23-bit word."""
    bit = 1 << np.arange(23)
    codewords = np.zeros(1, np.int64)
    for k in range(12):  # all sums of shifted generators, in the order of the messages
        codewords = np.concatenate([codewords, codewords ^ (GENERATOR << k)])
    errors = [np.zeros(1, np.int64), bit]
    two = np.bitwise_or.outer(bit, bit)[np.triu_indices(23, 1)]
    three = np.unique(np.bitwise_or.outer(two, bit).ravel())
    errors += [two, three[np.bitwise_count(three) == 3]]
    table = np.empty(1 << 23, np.uint16)
    for error in np.concatenate(errors):
        table[codewords ^ error] = np.arange(4096)
    return table


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of 23-bit words; a word has each key once."""
    table = golay_indices()
    odd = np.flatnonzero(np.bitwise_count(words) & 1)
    near = words[odd, None] ^ np.concatenate([[0], 1 << np.arange(23)])
    found = np.sort(table[near], axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    even = np.flatnonzero(~np.bitwise_count(words) & 1)
    rows = np.concatenate([even, np.repeat(odd, first.sum(axis=1))])
    keys = np.concatenate([table[words[even]], found[first]])
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order].astype(np.int64)


def link_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of fingerprints (uint64); a fingerprint has each key once."""
    words, per_segment = [], []
    for start, width in SEGMENTS:
        words.append((fps >> np.uint64(start)).astype(np.int64) & ((1 << width) - 1))
        rows, keys = segment_keys(words[-1])
        starts = np.searchsorted(rows, np.arange(len(fps) + 1))
        per_segment.append((keys, starts[:-1], np.diff(starts)))
    all_rows, all_keys = [], []
    for number, (exact, near) in enumerate(PAIRS):
        keys, _, n = per_segment[near]
        rows = np.repeat(np.arange(len(fps)), n)
        all_rows.append(rows)
        all_keys.append(number << 36 | words[exact][rows] << 12 | keys)
    n = per_segment[0][2] * per_segment[1][2] * per_segment[2][2]
    rows = np.repeat(np.arange(len(fps)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    together = np.full(len(rows), len(PAIRS), np.int64)
    for keys, start, n in per_segment:
        together = together << 12 | keys[start[rows] + at % n[rows]]
        at //= n[rows]
    return np.concatenate([*all_rows, rows]), np.concatenate([*all_keys, together])


def keys_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            fps = whole.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
            rows, keys = link_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])


def forest(a: np.ndarray, b: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between ``a`` and ``b``, and within ``a`` if
    ``b`` is empty."""
    nodes = np.concatenate([a, b]).astype(np.int64).view(np.uint64)
    n, n_a = len(nodes), len(a)
    if n == 2:
        if int(nodes[0] ^ nodes[1]).bit_count() <= bits:
            yield 0, 1
        return
    linked = np.zeros((n, n), bool)
    left, right = (slice(0, n_a), slice(n_a, n)) if len(b) else (slice(0, n),) * 2
    for at in range(left.start, left.stop, 256):
        rows = slice(at, min(at + 256, left.stop))
        near = np.bitwise_count(nodes[rows, None] ^ nodes[None, right]) <= bits
        linked[rows, right] = near
        linked[right, rows] = near.T
    waiting = linked.any(axis=1)
    while waiting.any():
        front = np.array([np.argmax(waiting)])
        waiting[front] = False
        while len(front):
            ahead = linked[front]
            new = np.flatnonzero(ahead.any(axis=0) & waiting)
            yield from zip(front[ahead[:, new].argmax(axis=0)].tolist(), new.tolist())
            waiting[new] = False
            front = new


def links_of_blocks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 16384):
                part = whole.slice(at, 16384)
                found = [*block_links(part.column(0), part.column(1), bits)]
                a, b = (np.concatenate(side) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def block_links(
    left: pa.ListArray, right: pa.ListArray, bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of all rows: rows of two fingerprints at once, others one by one."""
    n_left = np.asarray(left.value_lengths())
    n_right = np.asarray(right.value_lengths())
    values = left.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    others = right.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(n_left) - n_left
    other_start = np.cumsum(n_right) - n_right
    two = (n_left == 2) & (n_right == 0)
    a, b = values[start[two]], values[start[two] + 1]
    near = np.bitwise_count((a ^ b).view(np.uint64)) <= bits
    yield a[near], b[near]
    for row in np.flatnonzero(~two & (n_left + n_right > 1)):
        x = values[start[row] : start[row] + n_left[row]]
        y = others[other_start[row] : other_start[row] + n_right[row]]
        pairs = list(forest(x, y, bits))
        if pairs:
            nodes = np.concatenate([x, y])
            at = np.array(pairs)
            yield nodes[at[:, 0]], nodes[at[:, 1]]


def links(distinct: DataFrame, *, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints ``fp`` that connect all those
    that differ in at most ``bits`` bits, in however many steps."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"keys of this code find up to {MAX_BITS} differing bits, not {bits}")
    keyed = distinct.select("fp").mapInArrow(keys_of_batches, "key long, fp long")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    # The planner takes keys to be as few as the fingerprints they come from, which have dozens
    # each: told so, it joins them by shuffle at every size and sends none to the driver.
    rows = keyed.join(shared.hint("merge"), "key").select("key", "fp", blocks.alias("blocks"))
    # The fingerprints of most keys are one block.
    none = F.array().cast("array<long>").alias("right")
    single = rows.where("blocks = 1").groupBy("key").agg(F.collect_list("fp").alias("left"))
    single = single.select("left", none)
    rows = rows.where("blocks > 1").withColumn("own", F.pmod(F.hash("fp"), F.col("blocks")))
    # A block meets every other one: the one of lower number is on the left.
    rows = rows.select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    on_left = F.col("own") <= F.col("other")
    pairs = rows.groupBy(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    ).agg(
        F.collect_list(F.when(on_left, F.col("fp"))).alias("left"),
        F.collect_list(F.when(~on_left, F.col("fp"))).alias("right"),
    )
    pairs = single.unionByName(pairs.select("left", "right"))
    return pairs.select("left", "right").mapInArrow(links_of_blocks(bits), "a long, b long")


def with_roots(classes: DataFrame, bits: int, block: int) -> DataFrame:
    """``classes`` of distinct fingerprints with the ``root`` of their component."""
    roots = components(links(classes, bits=bits, block=block))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left")
    return rooted.select(*classes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` of every row: the least id that is reached
    over links of at most ``bits`` differing bits.

    Texts with equal fingerprints are linked, also those without words. Rows that repeat
    an id stay apart as rows; a null id is reached only where all ids are null. An empty
    table gives an empty result."""
    found = stage(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    found = found.withColumnRenamed(id_col, "id")
    classes = found.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = with_roots(stage(classes, "fingerprint-classes"), bits, block)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return found.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their group, with all columns. Groups
    are those of ``near_duplicates``; texts without words are one group.

    A row is known by its id and its text, so other texts of the same id, or of no id,
    stay. A null id is greater than any other; of texts of one id that are linked the one
    with the least digest stays. Rows that agree in id and text stay or go together. Very
    long texts are read in parts; an empty table stays empty."""
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].cast("string"), sha256(ascii_lower(text)), text)

    def of_row(row_id: str | None, digest: str, text: str) -> list[tuple]:
        fp = fingerprint(text)
        return [(row_id, digest, fp - (fp >> 63 << 64))]

    schema = pa.schema([("id", pa.string()), ("digest", pa.string()), ("fp", pa.int64())])
    rows = rows.mapInArrow(by_row(of_row, schema), "id string, digest string, fp long")
    rows = rows.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
    rows = stage(rows, "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest"))
    classes = stage(rows.groupBy("fp").agg(first.alias("first")), "fingerprint-classes")
    rooted = with_roots(classes, bits, block)
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"))
    kept = rooted.join(kept, "root").select("fp", "kept")
    stays = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("digest") == F.col("kept.digest"))
    others = rows.join(kept, "fp").where(~stays)
    dropped = stage(others.select("id", "digest").distinct(), "near-copies")
    digest = sha256(ascii_lower(text))
    return without(docs, dropped, {"id": docs[id_col], "digest": digest})
