"""Token counts by byte-pair merging with a heap and a linked list.

Only the number of merges matters: a pre-token of n bytes that is merged m times
has n - m tokens, so no identifier is ever looked up. The adjacent pair of the
lowest rank is popped from a heap, its two links become one, and the pairs that
this makes are pushed; entries that a merge made stale are skipped. A pre-token
of n bytes takes n log n steps, however long it is.
"""

from __future__ import annotations

import heapq
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import by_row, text_of
from .words import (
    COMMON,
    PRETOKEN,
    Kept,
    byte_letters,
    byte_level_spec,
    merges_of,
    slices,
    units,
)


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of symbols left when all pairs in ``ranks`` are merged, the lowest rank
    first and the leftmost among equals."""
    last = len(symbols)
    if last < 2:
        return last
    following = list(range(1, last + 1))
    before = list(range(-1, last - 1))
    heap = [
        (ranks[pair], at) for at, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks
    ]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, left = heapq.heappop(heap)
        right = following[left]
        if right >= last or not symbols[left]:
            continue
        if ranks.get((symbols[left], symbols[right])) != rank:
            continue
        symbols[left] += symbols[right]
        symbols[right] = ""
        merges += 1
        after = following[left] = following[right]
        if after < last:
            before[after] = left
            rank = ranks.get((symbols[left], symbols[after]))
            if rank is not None:
                heapq.heappush(heap, (rank, left))
        previous = before[left]
        if previous >= 0:
            rank = ranks.get((symbols[previous], symbols[left]))
            if rank is not None:
                heapq.heappush(heap, (rank, previous))
    return last - merges


class TokenCounter:
    """Counts tokens of texts for a byte-level vocabulary in a ``.json`` file.

    Characters whose class may depend on the version of Unicode are left to the
    pre-tokenizer of the file's own library; merging stays the same."""

    def __init__(self, path: str) -> None:
        spec = byte_level_spec(path)
        if spec is None:
            raise ValueError(f"{path} is no plain byte-level byte-pair vocabulary")
        self.ranks = {pair: rank for rank, pair in enumerate(merges_of(spec))}
        self.letters = byte_letters()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.of_pretoken = Kept(self._merged)
        self.of_unit = Kept(lambda u: sum(map(self.of_pretoken.__getitem__, PRETOKEN.findall(u))))
        self.path = path
        self.library = None

    def _merged(self, pretoken: str) -> int:
        return self._merge_letters([self.letters[b] for b in pretoken.encode("utf-8")])

    def _merge_letters(self, letters: list[str]) -> int:
        return count_after_merges(letters, self.ranks)

    def _plain(self, text: str) -> int:
        if COMMON.search(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path).pre_tokenizer
            # Parts come back in the letters that stand for bytes.
            parts = self.library.pre_tokenize_str(text)
            return sum(self._merge_letters(list(part)) for part, _ in parts)
        return sum(map(self.of_unit.__getitem__, units(text)))

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(self._plain(s) for part in parts for s in slices(part))


@cache
def counter(path: str) -> TokenCounter:
    """One counter for all tasks of a Python worker."""
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    Null text counts as empty and has no tokens. Rows that repeat an id are counted
    one by one; a null id stays null; other columns are not read. An empty table
    gives an empty result. Nothing is shuffled."""
    id_type = docs.schema[id_col].dataType
    rows = docs.select(docs[id_col].cast("string").alias("id"), text_of(docs, text_col).alias("t"))

    def of_row(row_id: str | None, text: str) -> list[tuple]:
        n = counter(path).count(text)
        return [(row_id, len(text.encode("utf-8")), n, n > limit)]

    schema = pa.schema(
        [("id", pa.string()), ("b", pa.int64()), ("n", pa.int64()), ("over", pa.bool_())]
    )
    counted = rows.mapInArrow(by_row(of_row, schema), "id string, b long, n long, over boolean")
    return counted.select(
        F.col("id").cast(id_type).alias(id_col),
        F.col("b").alias("n_bytes"),
        F.col("n").alias("n_tokens"),
        F.col("over").alias("over_limit"),
    )
