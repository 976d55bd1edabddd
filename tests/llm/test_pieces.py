"""Chunked encoding against one pass over the whole text, and round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from reportmart.llm import pieces as p

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return p.pieces(PATH)


def score(lattice, ids, text):
    total, at = 0.0, 0
    for i in ids:
        name = lattice.names[i]
        if i in lattice.byte_of:
            continue
        total += lattice.scores[name][0]
        at += len(name)
    # Unknown characters are what the pieces do not cover.
    return total + lattice.unknown * (len(text) - at)


def best(lattice, text):
    """The largest score over one pass, without words or chunks."""
    reach = [0.0] + [-np.inf] * len(text)
    for at in range(len(text)):
        for to in range(at + 1, min(len(text), at + lattice.longest) + 1):
            found = lattice.scores.get(text[at:to])
            if found:
                reach[to] = max(reach[to], reach[at] + found[0])
        if text[at] not in lattice.scores:
            reach[at + 1] = max(reach[at + 1], reach[at] + lattice.unknown)
    return reach[-1]


def random_text(seed, n):
    rng = random.Random(seed)
    parts = ["the ", " ", "characteristics", "recommend", "é", "漢", "😀", "\n", "ing", "=" * 9, "x", "\t"]
    return "".join(rng.choices(parts, k=n))


def test_normalises_like_the_library():
    library = SentencePieceProcessor(model_file=PATH)
    for text in ["", "a", " a", "a  b ", "\n", "é\tb"]:
        assert p.Pieces.normalise(text) == library.normalize(text)


@pytest.mark.parametrize("seed", range(20))
def test_whole_texts(lattice, seed):
    text = p.Pieces.normalise(random_text(seed, 60))
    ids = lattice.encode(text)
    assert lattice.decode(ids) == text
    assert score(lattice, ids, text) == best(lattice, text)


@pytest.mark.parametrize("chunk", [32, 33, 64, 100])
@pytest.mark.parametrize("kind", ["words", "no space", "spaces"])
def test_chunks_scan_to_the_best_path(lattice, chunk, kind):
    text = p.Pieces.normalise(random_text(7, 150))
    if kind == "no space":
        text = text.replace("▁", "") * 2
    elif kind == "spaces":
        text = "▁" * 333
    n = -(-len(text) // chunk)
    parts = [text[i * chunk : (i + 1) * chunk + lattice.longest - 1] for i in range(n)]
    sizes = [min(chunk, len(text) - i * chunk) for i in range(n)]
    matrices = [lattice.matrix(t, s) for t, s in zip(parts, sizes)]
    total = matrices[0]
    for matrix in matrices[1:]:
        total = p.combine(total, matrix)
    assert total[0, 0] == best(lattice, text)
    left = p.combine(p.combine(matrices[0], matrices[1]), matrices[2])
    right = p.combine(matrices[0], p.combine(matrices[1], matrices[2]))
    assert (left == right).all()
    states = p.best_states(matrices, 0, 0)
    ids = []
    for part, size, entry, leave in zip(parts, sizes, states, states[1:]):
        ids += lattice.path(part, size, entry, leave)
    assert lattice.decode(ids) == text
    assert score(lattice, ids, text) == best(lattice, text)


@pytest.mark.parametrize("group", [128, 3])
def test_tables_round_trip(clashing, group):
    rows = [(i, random_text(i, 5 * i)) for i in range(30)]
    rows += [(100, None), (101, ""), (102, " "), (None, "x y"), (5, rows[5][1])]
    rows += [(103, random_text(1, 3000)), (104, "nospace" * 700), (105, " " * 500), (106, "漢" * 300)]
    encoded = p.encode(clashing(rows), PATH, chunk=128, group=group)
    found = {}
    for r in p.decode(encoded, PATH).collect():
        found.setdefault((r.doc_id, r.row), []).append((r.chunk, r.n_chunks, r.text, r.n_tokens))
    assert len(found) == len(rows)
    texts = []
    for (doc, _), parts in found.items():
        parts.sort()
        assert [c for c, *_ in parts] == list(range(parts[0][1]))
        texts.append((doc, "".join(t for _, _, t, _ in parts)))
    assert sorted(texts, key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    lattice = p.pieces(PATH)
    by_row = {}
    for r in encoded.collect():
        by_row.setdefault((r.doc_id, r.row), []).append((r.chunk, r.ids))
    want = dict(rows)
    for (doc, _), parts in by_row.items():
        text = p.Pieces.normalise(want[doc] or "")
        ids = [i for _, some in sorted(parts) for i in some]
        assert score(lattice, ids, text) == best(lattice, text)


def test_empty(clashing):
    assert p.encode(clashing([]), PATH).collect() == []
