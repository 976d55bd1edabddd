"""SentencePiece encoding and decoding with a max-plus parallel scan.

The best segmentation of a text is the path of largest score through the lattice of the
vocabulary's pieces. A giant text is cut into chunks of ``CHUNK`` characters. At a boundary
the path is in one of few states: the number of characters by which a piece that began
before the boundary reaches beyond it. So a chunk is a matrix of largest scores from each
entry state to each exit state, and the matrices of neighbouring chunks combine by the
max-plus product, which is associative. The scan has two levels: the chunks of a group are
combined, groups side by side; the path of best states is found over the groups of a text,
then inside each group, and then each chunk is traced back by itself.

No piece holds a space after another character, so every path has a node before a space
that follows another character. Between two such places the best path does not depend on
the rest: it is computed once for each word and kept. The words of several texts that are
not kept yet are searched side by side: all of them step from one place to the next.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .common import by_row, text_of
from .words import Kept

CHUNK = 1 << 15
GROUP = 128
SPACE = "▁"
NEVER = -np.inf
#: Fixed value: an unknown character scores this much below the least piece.
UNKNOWN_PENALTY = 10.0
#: Texts that are encoded together.
TEXTS = 64


class Pieces:
    """The pieces of a ``.model`` file as a lattice."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [
            i
            for i in every
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.names = [model.id_to_piece(i) for i in every]
        self.scores = {self.names[i]: (float(model.get_score(i)), i) for i in plain}
        self.bytes = {int(self.names[i][1:-1], 16): i for i in every if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown_id = model.unk_id()
        self.unknown = min(score for score, _ in self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores))
        # The score of each piece, and that there is none for what only begins one.
        self.begun = {p[:n]: NEVER for p in self.scores for n in range(1, len(p) + 1)}
        self.begun.update((p, score) for p, (score, _) in self.scores.items())
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in self.scores)
        self.word = Kept(self._whole)
        # The same as a trie over arrays: node 0 is the root, and the child of a node by a
        # character is where their joint key stands in ``edges``.
        node = {prefix: at for at, prefix in enumerate(self.begun, 1)} | {"": 0}
        edge = np.array([node[p[:-1]] << 21 | ord(p[-1]) for p in self.begun], np.int64)
        order = np.argsort(edge)
        self.edges, self.children = edge[order], order + 1
        self.node_score = np.array([NEVER, *self.begun.values()])
        self.node_id = np.array([-1, *(self.scores.get(p, (0, -1))[1] for p in self.begun)])

    @staticmethod
    def normalise(text: str) -> str:
        """Spaces become visible, and a text that is not empty begins with one."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def unknown_ids(self, char: str) -> list[int]:
        if len(self.bytes) < 256:
            return [self.unknown_id]
        return [self.bytes[b] for b in char.encode("utf-8")]

    def forward(self, text: str, start: int, stop: int) -> tuple[dict[int, float], dict[int, int]]:
        """Largest scores of paths from ``start`` to each place up to ``stop``, and to places
        that a piece from before ``stop`` reaches; with the last place before each."""
        best = {start: 0.0}
        back: dict[int, int] = {}
        begun, longest, end = self.begun, self.longest, len(text)
        for at in range(start, stop):
            now = best.get(at)
            if now is None:
                continue
            for to in range(at + 1, min(at + longest, end) + 1):
                score = begun.get(text[at:to])
                if score is None:
                    break  # no piece begins like this
                total = now + score
                if total > best.get(to, NEVER):
                    best[to], back[to] = total, at
            if text[at] not in self.scores and now + self.unknown > best.get(at + 1, NEVER):
                best[at + 1], back[at + 1] = now + self.unknown, at
        return best, back

    def trace(self, text: str, back: dict[int, int] | list[int], start: int, stop: int) -> list[int]:
        """Identifiers of the path that ends at ``stop``."""
        parts = []
        while stop > start:
            before = back[stop]
            found = self.scores.get(text[before:stop])
            parts.append([found[1]] if found else self.unknown_ids(text[before:stop]))
            stop = before
        return [i for part in reversed(parts) for i in part]

    def _whole(self, word: str) -> tuple[float, bytes]:
        """Score and identifiers of a word, as little-endian 32-bit numbers: ``forward`` and
        ``trace`` over lists, as each place inside a word is reached."""
        score_of, single, n = self.begun.get, self.scores, len(word)
        best = [0.0] + [NEVER] * n
        back = [0] * (n + 1)
        for at in range(n):
            now, to = best[at], at + 1
            while to <= n:
                score = score_of(word[at:to])
                if score is None:
                    break
                if now + score > best[to]:
                    best[to], back[to] = now + score, at
                to += 1
            if now + self.unknown > best[at + 1] and word[at] not in single:
                best[at + 1], back[at + 1] = now + self.unknown, at
        return best[n], np.array(self.trace(word, back, 0, n), "<i4").tobytes()

    def learn(self, words: Iterable[str]) -> None:
        """Keep score and identifiers of all ``words``."""
        self.word.fill(set(words), self._side_by_side)

    def _lattice(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, length, score and identifier of every piece in ``chars``, where ``left`` is
        the number of characters up to the end of the word. An unknown character is a piece
        whose identifier is -1 less its code point."""
        at, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        known = np.zeros(len(chars), bool)
        found = []
        for size in range(1, self.longest + 1):
            inside = left[at] >= size
            at, node = at[inside], node[inside]
            key = node << 21 | chars[at + size - 1]
            where = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            begun = self.edges[where] == key
            at, node = at[begun], self.children[where[begun]]
            score = self.node_score[node]
            piece = score > NEVER
            if size == 1:
                known[at[piece]] = True
            found.append((at[piece], np.full(piece.sum(), size), score[piece], self.node_id[node[piece]]))
        lost = np.flatnonzero(~known)
        found.append((lost, np.ones_like(lost), np.full(len(lost), self.unknown), -1 - chars[lost]))
        return tuple(map(np.concatenate, zip(*found)))

    def _side_by_side(self, words: list[str]) -> Iterator[tuple[float, bytes]]:
        """``_whole`` of each word."""
        sizes = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(chars)) - begin[word]
        start, size, score, name = self._lattice(chars, sizes[word] - place)
        # A word has one node more than characters.
        origin, node = begin + np.arange(len(words)), start + word[start]
        order = np.argsort(place[start], kind="stable")
        stops = np.cumsum(np.bincount(place[start]))
        best = np.full(len(chars) + len(words), NEVER)
        back, via = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
        best[origin] = 0.0
        for step in np.split(order, stops[:-1]):
            # Pieces that begin at the same place of a word end at different ones.
            to, total = node[step] + size[step], best[node[step]] + score[step]
            better = total > best[to]
            step, to = step[better], to[better]
            best[to], back[to], via[to] = total[better], node[step], name[step]
        now, owner = origin + sizes, np.arange(len(words))
        scores = best[now].tolist()
        names, owners = [], []
        while len(now):
            names.append(via[now])
            owners.append(owner)
            now = back[now]
            going = now > origin[owner]
            now, owner = now[going], owner[going]
        owner, name = np.concatenate(owners[::-1]), np.concatenate(names[::-1])
        order = np.argsort(owner, kind="stable")
        name, owner = name[order], owner[order]
        # Unknown characters give way to the identifiers of their bytes.
        lost = np.flatnonzero(name < 0)
        if len(lost):
            instead = [self.unknown_ids(chr(-1 - n)) for n in name[lost].tolist()]
            times = np.ones(len(name), np.int64)
            times[lost] = [len(ids) for ids in instead]
            name, owner = np.repeat(name, times), np.repeat(owner, times)
            name[name < 0] = [i for ids in instead for i in ids]
        ends = (4 * np.cumsum(np.bincount(owner))).tolist()
        data = name.astype("<i4").tobytes()
        return zip(scores, [data[a:b] for a, b in zip([0, *ends], ends)])

    def cuts(self, text: str) -> list[int]:
        """Places inside a text that every path has."""
        if not self.by_words:
            return []
        return [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", text)]

    def words(self, text: str) -> list[str]:
        if not self.by_words:
            return [text] if text else []
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Identifiers of normalised texts that are no chunks of larger ones."""
        words = [self.words(text) for text in texts]
        self.learn(chain.from_iterable(words))
        return [np.frombuffer(b"".join([self.word[w][1] for w in own]), "<i4") for own in words]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def matrix(self, text: str, length: int) -> np.ndarray:
        """Largest scores from each entry state to each exit state of a chunk: the first
        ``length`` characters of ``text``, which goes on as far as a piece may reach."""
        cuts = [c for c in self.cuts(text) if c <= length]
        first, last = (cuts[0], cuts[-1]) if cuts else (length, 0)
        inner = self.words(text[first:last]) if cuts else []
        self.learn(inner)
        between = sum(self.word[w][0] for w in inner)
        tail = self._exits(text, last, length) if cuts else None
        rows = []
        for entry in range(self.longest):
            if entry > (first if cuts else length):
                rows.append([NEVER] * self.longest)  # no piece reaches so far
            elif cuts:
                best, _ = self.forward(text[:first], entry, first)
                head = best[first]
                rows.append([head + between + exit_ for exit_ in tail])
            else:
                rows.append(self._exits(text, entry, length))
        return np.array(rows)

    def _exits(self, text: str, start: int, length: int) -> list[float]:
        best, _ = self.forward(text, start, length)
        return [best.get(length + j, NEVER) for j in range(self.longest)]

    def path(self, text: str, length: int, entry: int, leave: int) -> list[int]:
        """Identifiers of the pieces that begin in a chunk, between two states."""
        if entry >= length:
            return []
        cuts = [c for c in self.cuts(text) if c <= length]
        stop = length + leave
        if not cuts:
            _, back = self.forward(text, entry, length)
            return self.trace(text, back, entry, stop)
        first, last = cuts[0], cuts[-1]
        _, back = self.forward(text[:first], entry, first)
        head = self.trace(text[:first], back, entry, first)
        middle = self.encode(text[first:last])
        _, back = self.forward(text, last, length)
        return head + middle + self.trace(text, back, last, stop)

    def decode(self, ids: list[int]) -> str:
        """The normalised text of identifiers."""
        parts: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(self.names[i])
        return "".join(parts) + raw.decode("utf-8", "replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def best_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states at all boundaries of the best path, the first and last of them given."""
    reach = [np.where(np.arange(len(matrices[0])) == entry, 0.0, NEVER)]
    for matrix in matrices[:-1]:
        reach.append((reach[-1][:, None] + matrix).max(axis=0))
    states = [leave]
    for before, matrix in zip(reversed(reach), reversed(matrices)):
        states.append(int(np.argmax(before + matrix[:, states[-1]])))
    return states[::-1]


def matrix_of(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data, np.float64)
    return flat.reshape(int(len(flat) ** 0.5), -1)


def encode(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    group: int = GROUP,
) -> DataFrame:
    """Identifiers of every row by chunk: ``id_col``, ``row`` (a number for each row of the
    table), ``chunk``, ``n_chunks``, the normalised text's characters in it as ``chars``, the
    place of the first character that its pieces cover as ``entry``, and ``ids``.

    Null text counts as empty and has one chunk without identifiers. Rows that repeat an id,
    or have none, are rows of their own; other columns are not read. An empty table gives an
    empty result."""
    if chunk < 32:
        raise ValueError("a chunk must be longer than a piece")
    id_type = docs.schema[id_col].dataType
    rows = docs.select(docs[id_col].cast("string").alias("id"), text_of(docs, text_col).alias("t"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    columns = "id string, row long, chunk long, n_chunks long, chars long, entry int, ids array<int>"
    result = pa.schema(
        [
            ("id", pa.string()),
            ("row", pa.int64()),
            ("chunk", pa.int64()),
            ("n_chunks", pa.int64()),
            ("chars", pa.int64()),
            ("entry", pa.int32()),
            ("ids", pa.list_(pa.int32())),
        ]
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                row_ids, texts, numbers = (c.to_pylist() for c in batch.slice(at, TEXTS).columns)
                texts = [Pieces.normalise(text) for text in texts]
                n, ids = len(texts), pieces(path).encode_all(texts)
                columns = [row_ids, numbers, [0] * n, [1] * n, list(map(len, texts)), [0] * n, ids]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, result)]
                yield pa.RecordBatch.from_arrays(arrays, schema=result)

    # A normalised text is one character longer.
    giant = F.length("t") >= chunk
    small = rows.where(~giant).mapInArrow(whole, columns)

    cut_schema = pa.schema(
        [
            ("id", pa.string()),
            ("row", pa.int64()),
            ("chunk", pa.int64()),
            ("n_chunks", pa.int64()),
            ("chars", pa.int64()),
            ("text", pa.string()),
        ]
    )

    def cut(row_id, text, row) -> Iterator[tuple]:
        text = Pieces.normalise(text)
        n = -(-len(text) // chunk)
        reach = pieces(path).longest - 1
        for number in range(n):
            at = number * chunk
            size = min(chunk, len(text) - at)
            yield row_id, row, number, n, size, text[at : at + size + reach]

    chunks = rows.where(giant).mapInArrow(
        by_row(cut, cut_schema, rows=64),
        "id string, row long, chunk long, n_chunks long, chars long, text string",
    )
    chunks = stage(chunks, "chunks")

    def measure(row, number, chars, text) -> list[tuple]:
        return [(row, number, pieces(path).matrix(text, chars).tobytes())]

    measured_schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("m", pa.binary())])
    # Chunks are dealt evenly: the rows of one text need not stay together.
    measured = chunks.select("row", "chunk", "chars", "text").repartition("row", "chunk")
    measured = measured.mapInArrow(
        by_row(measure, measured_schema, rows=256), "row long, chunk long, m binary"
    )
    number = F.floor(F.col("chunk") / group).cast("long")
    measured = stage(measured.withColumn("part", number), "chunk-matrices")

    def combined(part: pd.DataFrame) -> pd.DataFrame:
        total = None
        for data in part.sort_values("chunk")["m"]:
            matrix = matrix_of(data)
            total = matrix if total is None else combine(total, matrix)
        first = part.iloc[0]
        return pd.DataFrame({"row": [first["row"]], "part": [first["part"]], "m": [total.tobytes()]})

    groups = measured.groupBy("row", "part").applyInPandas(
        combined, "row long, part long, m binary"
    )

    def over_groups(text: pd.DataFrame) -> pd.DataFrame:
        text = text.sort_values("part")
        states = best_states([matrix_of(m) for m in text["m"]], 0, 0)
        return pd.DataFrame(
            {"row": text["row"], "part": text["part"], "entry": states[:-1], "leave": states[1:]}
        )

    bounds = groups.groupBy("row").applyInPandas(
        over_groups, "row long, part long, entry int, leave int"
    )

    def over_chunks(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        matrices = [matrix_of(m) for m in part["m"]]
        states = best_states(matrices, int(part["entry"].iloc[0]), int(part["leave"].iloc[0]))
        return pd.DataFrame(
            {"row": part["row"], "chunk": part["chunk"], "entry": states[:-1], "leave": states[1:]}
        )

    states = (
        measured.join(bounds, ["row", "part"])
        .groupBy("row", "part")
        .applyInPandas(over_chunks, "row long, chunk long, entry int, leave int")
    )

    def trace(row_id, row, number, n, chars, text, entry, leave) -> list[tuple]:
        ids = pieces(path).path(text, chars, entry, leave)
        return [(row_id, row, number, n, chars, entry, ids)]

    traced = chunks.join(states, ["row", "chunk"]).select(
        "id", "row", "chunk", "n_chunks", "chars", "text", "entry", "leave"
    )
    large = traced.mapInArrow(by_row(trace, result, rows=64), columns)
    found = small.union(large)
    return found.select(F.col("id").cast(id_type).alias(id_col), "row", "chunk", "n_chunks", "chars", "entry", "ids")


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """The text of each chunk of ``encode`` from its identifiers: ``id_col``, ``row``, ``chunk``,
    ``n_chunks``, ``text``, and the number and CRC-32 of the identifiers as ``n_tokens`` and
    ``ids_crc32``. The texts of a row, joined in order, are what the row's text decodes to."""
    id_type = encoded.schema[id_col].dataType
    rows = encoded.select(
        F.col(id_col).cast("string").alias("id"), "row", "chunk", "n_chunks", "ids"
    )

    def of_row(row_id, row, number, n, ids) -> list[tuple]:
        text = pieces(path).decode(ids.tolist()).replace(SPACE, " ")
        text = text.removeprefix(" ") if number == 0 else text
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return [(row_id, row, number, n, text, len(ids), crc)]

    numbers = ("row", "chunk", "n_chunks", "n_tokens", "ids_crc32")
    types = {"id": pa.string(), "text": pa.string()} | dict.fromkeys(numbers, pa.int64())
    order = ["id", "row", "chunk", "n_chunks", "text", "n_tokens", "ids_crc32"]
    schema = pa.schema([(name, types[name]) for name in order])
    found = rows.mapInArrow(
        by_row(of_row, schema, arrays=True),
        "id string, row long, chunk long, n_chunks long, text string, n_tokens long, "
        "ids_crc32 long",
    )
    return found.select(F.col("id").cast(id_type).alias(id_col), *order[1:])
