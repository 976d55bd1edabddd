"""Cutting of text where byte-level byte-pair encoding may be cut.

The pre-tokenizer of such vocabularies never joins what stands before a space
with what stands after it, if the next character is no white space. So a text is
cut there into short units, and whatever is computed for a unit is kept and used
again for its next occurrence.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import regex

#: White space of Unicode, and the pre-tokenizer's pattern over it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: Fixed value: the same pattern in the form that the libraries take.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CUT = regex.compile(rf" (?=[^{WHITE}])")
#: Letters and digits beyond this may differ between versions of Unicode.
COMMON = regex.compile("[^\\x00-\\u024f]")
#: Values of longer keys are not kept, and so many are computed at once.
LONGEST_KEPT, ABREAST = 64, 8192
AFTER_SPACE = [" " + c for c in "\t\n\x0b\x0c\r \x85\xa0"]


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before a space that is
    followed by something else than white space."""
    at = 0
    while len(text) - at > size:
        found = CUT.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def irregular(text: str) -> bool:
    """Whether white space or the end follows a space, in a text of common characters."""
    return text[-1:] == " " or any(pair in text for pair in AFTER_SPACE)


def units(text: str) -> list[str]:
    """Parts of ``text`` that can be encoded one by one."""
    if not text:
        return []
    if irregular(text):
        return PRETOKEN.findall(text)
    head, *rest = text.split(" ")
    return [head, *[" " + word for word in rest]] if head else [" " + word for word in rest]


class Kept(dict):
    """Values of ``compute`` by key. When it holds half of ``limit`` values they grow old,
    and older ones go; an old value that is asked for again is young again. So memory
    stays bounded whatever the vocabulary, and frequent keys stay."""

    def __init__(self, compute: Callable[[str], Any], limit: int = 250_000) -> None:
        super().__init__()
        self.compute, self.half = compute, limit // 2
        self.old: dict[str, Any] = {}

    def __missing__(self, key: str) -> Any:
        self.age()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()

    def fill(self, keys: Iterable[str], compute_all: Callable[[list[str]], Iterable]) -> None:
        """Compute the values of those ``keys`` at once that it would keep and does not hold."""
        old = self.old
        missing = [k for k in keys if k not in self and k not in old and len(k) <= LONGEST_KEPT]
        for at in range(0, len(missing), ABREAST):
            self.age()
            part = missing[at : at + ABREAST]
            self.update(zip(part, compute_all(part)))


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself
    where it is printable in Latin-1, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    stand_in = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [stand_in[b] for b in range(256)]


def byte_level_spec(path: str) -> dict | None:
    """What the ``.json`` file of a plain byte-level byte-pair vocabulary says; None if it
    is of another kind."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre["use_regex"]
        and not pre["add_prefix_space"]
        and not spec["normalizer"]
        and not model.get("ignore_merges")
        and not any(t["normalized"] or t["single_word"] for t in spec["added_tokens"])
    )
    return spec if plain else None


def merges_of(spec: dict) -> list[tuple[str, str]]:
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
