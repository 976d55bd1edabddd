"""Chat formatting over a prefix tree of conversations.

A turn is written as ``### role: text</turn>`` and a line end. Inside roles and texts every
backslash, ``#`` and ``<`` gets a backslash before it, inside roles also every colon. So no
text can hold what opens or closes a turn, and the written form reads back exactly.

Conversations that begin with the same turns share them: a node of the tree is a turn
together with all turns before it, and its id is a digest chained over them. A node's
tokens are stored once, in depth-first order of its tree. The path of a conversation is
the array of its node ids; sorted by path, each conversation owns the nodes that no
earlier one has, and these follow each other. So the place of a node in its tree comes
from one running sum over the sorted paths, the position ids of its tokens go on from
those of its parent, and it attends to the intervals in which its ancestors lie; intervals
that touch are one, so a conversation without branches needs one, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.staging import stage
from .common import by_row, rows_of, text_of
from .packing import encoder

#: The template, and the characters that are escaped inside it.
OPEN, CLOSE, AFTER_ROLE = "### ", "</turn>\n", ": "
IN_TEXT = r"[\\#<]"
IN_ROLE = r"[\\#<:]"
ASSISTANT = "assistant"


def escape(text: Column, control: str) -> Column:
    return F.regexp_replace(text, f"({control})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation, which come in order, and chain their
    digests. Only the last digest is kept, however long a conversation is."""
    schema = pa.schema(
        [
            ("conv", pa.string()),
            ("depth", pa.int64()),
            ("node", pa.binary()),
            ("parent", pa.binary()),
            ("formatted", pa.string()),
            ("text_at", pa.int32()),
            ("loss", pa.bool_()),
        ]
    )
    last: list = [None, 0, b""]

    def of_row(conv, formatted, text_at, loss) -> list[tuple]:
        if conv != last[0]:
            last[:] = [conv, 0, b""]
        parent = last[2]
        text = formatted.encode("utf-8")
        node = hashlib.sha256(parent + b"\x01" * loss + b"\x00" + text).digest()[:16]
        last[1:] = [last[1] + 1, node]
        return [(conv, last[1], node, parent or None, formatted, text_at, loss)]

    yield from by_row(of_row, schema)(batches)


def turns(
    conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """Each row as a formatted turn with its node and the node before it."""
    role = escape(text_of(conversations, role_col), IN_ROLE)
    head = F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE))
    formatted = F.concat(head, escape(text_of(conversations, text_col), IN_TEXT), F.lit(CLOSE))
    rows = conversations.select(
        F.coalesce(conversations[conv_col].cast("string"), F.lit("")).alias("conv"),
        conversations[turn_col].alias("turn"),
        formatted.alias("formatted"),
        F.length(head).alias("text_at"),
        F.coalesce(conversations[role_col] == ASSISTANT, F.lit(False)).alias("loss"),
    )
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "formatted")
    return ordered.select("conv", "formatted", "text_at", "loss").mapInArrow(
        chained,
        "conv string, depth long, node binary, parent binary, formatted string, "
        "text_at int, loss boolean",
    )


class PrefixTree:
    """``nodes``: one row for each node, with ``node``, ``parent``, ``tree``, ``depth``,
    ``formatted``, the characters of it that bear loss as ``loss_start`` and ``loss_end``,
    ``ids``, ``start`` and ``end`` in the tree's tokens, the ``position`` of its first token,
    and the ``attends`` intervals of its ancestors, each from ``start`` to ``end``; the node
    also attends to its own tokens before each one. ``paths``: ``conv``, ``depth`` and
    ``node`` of each turn.

    Rows are ordered by turn; ties by their written form. A null text or role counts as
    empty; rows without a conversation id form one conversation. Other columns are not
    read. A table without rows gives an empty tree."""

    def __init__(
        self,
        conversations: DataFrame,
        path: str,
        *,
        conv_col: str = "conv_id",
        turn_col: str = "turn",
        role_col: str = "role",
        text_col: str = "text",
    ) -> None:
        said = stage(turns(conversations, conv_col, turn_col, role_col, text_col), "turns")
        self.paths = said.select("conv", "depth", "node")
        distinct = said.groupBy("node").agg(
            F.any_value("parent").alias("parent"),
            F.any_value("depth").alias("depth"),
            F.any_value("formatted").alias("formatted"),
            F.any_value("text_at").alias("text_at"),
            F.any_value("loss").alias("loss"),
        )
        encoded = stage(encode_nodes(distinct, path), "encoded-nodes")
        lengths = encoded.select("node", "tokens")
        ordered = ordered_paths(self.paths)
        places = stage(place_nodes(ordered, lengths), "node-places")
        text_end = F.length("formatted") - len(CLOSE)
        self.nodes = encoded.join(places, "node").select(
            "node",
            "parent",
            "tree",
            "depth",
            "formatted",
            F.when(F.col("loss"), F.col("text_at")).otherwise(0).alias("loss_start"),
            F.when(F.col("loss"), text_end).otherwise(0).alias("loss_end"),
            "ids",
            "start",
            (F.col("start") + F.col("tokens")).alias("end"),
            "position",
            "attends",
        )


def encode_nodes(nodes: DataFrame, path: str) -> DataFrame:
    """``nodes`` with ``ids``, as little-endian 32-bit numbers, and their number ``tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                ids = [encode(t) for t in part.column("formatted").to_pylist()]
                columns = [*part.columns, pa.array(ids, pa.binary())]
                columns.append(pa.array([len(i) // 4 for i in ids], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "ids", "tokens"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{fields}, ids binary, tokens long")


def ordered_paths(paths: DataFrame) -> DataFrame:
    """The distinct paths, numbered in depth-first order by ``part`` and ``rank``: a range
    of paths and the place in it."""
    whole = paths.groupBy("conv").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda s: s["node"]
        ).alias("path")
    )
    ranged = whole.select("path").distinct().repartitionByRange("path")
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "paths")
    order = W.partitionBy("part").orderBy("path")
    return stage(ranged.withColumn("rank", F.row_number().over(order)), "ordered-paths")


def place_nodes(ordered: DataFrame, lengths: DataFrame) -> DataFrame:
    """``tree``, ``start``, ``position`` and ``attends`` of every ``node``."""
    steps = ordered.select("part", "rank", F.posexplode("path").alias("at", "node"))
    # A node belongs to the first path that has it, and comes after that path's own
    # nodes above it.
    owners = steps.groupBy("node").agg(
        F.min(F.struct("part", "rank")).alias("owner"), F.any_value("at").alias("at")
    )
    owned = owners.join(lengths, "node").select("node", "owner.*", "at", "tokens")
    blocks = owned.groupBy("part", "rank").agg(F.sum("tokens").alias("tokens"))
    per_part = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    # One row for each range of paths, whatever their number.
    before_part = F.sum("tokens").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    )
    per_part = per_part.select("part", F.coalesce(before_part, F.lit(0)).alias("before"))
    within = F.sum("tokens").over(
        W.partitionBy("part").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    )
    blocks = blocks.withColumn("within", F.coalesce(within, F.lit(0))).join(per_part, "part")
    blocks = blocks.select("part", "rank", (F.col("before") + F.col("within")).alias("block"))
    own = W.partitionBy("part", "rank").orderBy("at")
    inside = F.coalesce(
        F.sum("tokens").over(own.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    placed = owned.withColumn("inside", inside).join(blocks, ["part", "rank"])
    placed = placed.select(
        "node", "part", "rank", "at", "tokens", (F.col("block") + F.col("inside")).alias("start")
    )
    placed = stage(placed, "placed-nodes")
    # The owner of a path's last own node needs the places of all nodes above it.
    owning = placed.select("part", "rank").distinct()
    above = (
        steps.join(owning, ["part", "rank"])
        .join(placed.select("node", "start", "tokens"), "node")
        .groupBy("part", "rank")
        .agg(F.array_sort(F.collect_list(F.struct("at", "node", "start", "tokens"))).alias("path"))
    )
    schema = pa.schema(
        [
            ("node", pa.binary()),
            ("tree", pa.binary()),
            ("start", pa.int64()),
            ("position", pa.int64()),
            ("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )

    first_own = placed.groupBy("part", "rank").agg(F.min("at").alias("first"))
    rows = above.join(first_own, ["part", "rank"]).select("path", "first")

    def of_row(path, first) -> Iterator[tuple]:
        root, origin = path[0]["node"], path[0]["start"]
        position = 0
        spans: list[dict] = []
        for step in path:
            start = step["start"] - origin
            if step["at"] >= first:
                yield step["node"], root, start, position, [dict(s) for s in spans]
            position += step["tokens"]
            if spans and spans[-1]["end"] == start:
                spans[-1]["end"] += step["tokens"]
            else:
                spans.append({"start": start, "end": start + step["tokens"]})

    return rows.mapInArrow(
        by_row(of_row, schema),
        "node binary, tree binary, start long, position long, "
        "attends array<struct<start:long,end:long>>",
    )


def read_back(tree: PrefixTree) -> DataFrame:
    """What each conversation says, taken from the nodes: ``conv``, ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars``."""
    read = tree.paths.join(tree.nodes.select("node", "formatted", "loss_start", "loss_end"), "node")
    # The first colon that no backslash escapes ends the role.
    role = F.regexp_extract("formatted", r"(?s)^### ((?:[^\\:]++|\\.)*+): ", 1)
    text_at = F.length(F.lit(OPEN)) + F.length(role) + F.length(F.lit(AFTER_ROLE))
    body = F.col("formatted").substr(
        text_at + 1, F.length("formatted") - text_at - len(CLOSE)
    )
    loss = F.col("formatted").substr(
        F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")
    )
    rows = read.select(
        "conv",
        "depth",
        unescape(role).alias("role"),
        unescape(body).alias("text"),
        unescape(loss).alias("loss"),
        F.length("formatted").alias("chars"),
    )
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        found: list[tuple] = []
        state: list = []

        def close() -> None:
            if state:
                conv, n, said, loss_chars, loss, chars = state
                found.append((conv, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def batch() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*found) if found else ([] for _ in types)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for conv, _, role, text, loss, chars in rows_of(batches):
            if not state or state[0] != conv:
                close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if len(found) >= 4096:
                    yield batch()
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(loss)
            state[4].update(loss.encode())
            state[5] += chars
        close()
        yield batch()

    return ordered.mapInArrow(
        run,
        "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
