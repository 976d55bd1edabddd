"""Packing: every identifier lies in one piece, and every limit holds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reportmart.llm.packing import Packer, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, whole, tokens, segments, loss):
    """``pieces``: (id, start, ids, loss, sequence, offset); ``whole``: ids by row."""
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for row, start, ids, lost, sequence, at in pieces:
        by_row[row].append((start, ids))
        by_sequence[sequence].append((at, len(ids) // 4, lost))
    assert {r: b"".join(i for _, i in sorted(ps)) for r, ps in by_row.items()} == {
        r: i for r, i in whole.items() if i
    }
    for row, ps in by_row.items():
        at = 0
        for start, ids in sorted(ps):
            assert start == at
            at += len(ids) // 4
    padding = 0
    for ps in by_sequence.values():
        total = 0
        for at, n, _ in sorted(ps):
            assert at == total and n
            total += n
        assert total <= tokens and len(ps) <= segments and sum(p[2] for p in ps) <= loss
        padding += 0 if total & (total - 1) == 0 else tokens - total
    return padding, sum(len(i) // 4 for i in whole.values())


@pytest.mark.parametrize("tokens, segments, loss", [(64, 8, 64), (64, 100, 20), (50, 3, 50), (16, 1, 5)])
def test_limits_hold(tokens, segments, loss):
    rng = random.Random(1)
    pieces = []
    packer = Packer(
        lambda row, ids, start, whole, lost, sequence, at: pieces.append(
            (row, start, ids, lost, sequence, at)
        ),
        tokens=tokens,
        segments=segments,
        loss=loss,
        pool=16,
    )
    whole = {}
    for row in range(300):
        n = rng.choice([0, 1, 2, 5, 17, 64, 65, 300])
        whole[row] = np.arange(n, dtype="<u4").tobytes()
        packer.add(row, whole[row], rng.randint(0, n))
    packer.finish()
    padding, total = check(pieces, whole, tokens, segments, loss)
    if (segments, loss) == (100, tokens):
        assert padding == 0


def test_a_table(clashing):
    library = Tokenizer.from_file(PATH)
    rows = [(i, "some words " * (37 * i % 400)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "long text, " * 20_000)]
    found = pack(clashing(rows), PATH, tokens=256).collect()
    whole = {
        i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        for i, t in rows
    }
    pieces = [(r.doc_id, r.start, bytes(r.ids), r.loss_tokens, r.sequence_id, r.offset) for r in found]
    padding, _ = check(pieces, whole, 256, 256, 256)
    assert padding == 0
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 for r in found)
    assert all(r.doc_tokens == len(whole[r.doc_id]) // 4 for r in found)
    assert pack(clashing([]), PATH).collect() == []


def test_prompts_bear_no_loss(documents):
    docs = documents([(1, "answer one"), (None, "x"), (1, "answer one")])
    found = pack(docs, PATH, prompt_col="lang", loss_tokens=3, tokens=8).collect()
    assert sum(r.loss_tokens for r in found) == sum(r.length for r in found) - 3
    assert {r.doc_id for r in found} == {1, None}
    by_sequence = defaultdict(int)
    for r in found:
        by_sequence[r.sequence_id] += r.loss_tokens
    assert max(by_sequence.values()) <= 3
