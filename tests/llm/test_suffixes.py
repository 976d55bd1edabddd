"""Removal of repeated strings, against a plain search."""

import hashlib
import random

import numpy as np
import pytest

from reportmart.llm import suffixes

LENGTH = suffixes.LENGTH


def brute(rows):
    """(id, text) to (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    order = lambda i: (i is None, i or 0)
    least = {}
    for i, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - LENGTH + 1):
            window = data[at : at + LENGTH]
            least[window] = min(least.get(window, order(i)), order(i))
    found = []
    for i, text in rows:
        data = (text or "").encode()
        cut = [False] * len(data)
        for at in range(len(data) - LENGTH + 1):
            if least[data[at : at + LENGTH]] < order(i):
                cut[at : at + LENGTH] = [True] * LENGTH
        kept = bytes(b for b, c in zip(data, cut) if not c)
        starts = sum(c and not (at and cut[at - 1]) for at, c in enumerate(cut))
        found.append((i, len(data), sum(cut), starts, hashlib.sha256(kept).hexdigest()))
    return found


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def random_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (5, 8, 12, 30, 60)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng.randint(0, 9))]
        rows.append((rng.randint(0, 40) if rng.random() < 0.9 else None, " ".join(parts)))
    rows += [rows[3], rows[3], (99, rows[5][1]), (100, rows[5][1] + "x"), (101, None), (102, "")]
    rows += [(i, "a" * n) for i, n in ((7, 49), (8, 50), (9, 51), (10, 300), (11, 80))]
    rows += [(i, "ab\0" * n) for i, n in ((12, 20), (13, 40))] + [(14, "\0" * 70), (15, "\0" * 60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk, hot", [(suffixes.CHUNK, suffixes.HOT), (200, 10_000), (333, 2), (4096, 0)])
def test_against_plain_search(spark, chunk, hot):
    rows = random_rows(chunk + hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffixes.drop_repeats(df, chunk=chunk, hot=hot).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def test_long_text_in_parts(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, long[1000:1100]), (2, long), (3, long[:2500] + "|" + long[2400:]), (4, "x" + long[1990:2045])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffixes.drop_repeats(df, chunk=500).collect()
    assert in_order(map(tuple, found)) == in_order(brute(rows))


def test_empty_table_and_other_columns(spark, documents, clashing):
    assert suffixes.drop_repeats(documents([])).collect() == []
    rows = [(1, "one passage that is longer than fifty bytes, for certain"), (2, None)]
    rows += [(3, "before " + rows[0][1])]
    assert in_order(map(tuple, suffixes.drop_repeats(clashing(rows)).collect())) == in_order(brute(rows))


def test_chunk_bounds(documents):
    with pytest.raises(ValueError):
        suffixes.drop_repeats(documents(["a"]), chunk=LENGTH)


@pytest.mark.parametrize("n_runs", [1, 2, 3, 7, 16])
def test_merge_knows_shared_prefixes(n_runs):
    rng = random.Random(n_runs)
    runs = []
    for _ in range(n_runs):
        run = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, LENGTH))) for _ in range(rng.randint(0, 40))]
        runs.append(sorted(key.ljust(LENGTH, b"\0") for key in run + run[:5]))
    rows = [np.frombuffer(b"".join(run), np.uint8).reshape(-1, LENGTH) for run in runs]
    order, share = suffixes.merge(runs, [suffixes.shared(r).tolist() for r in rows])
    heads = [iter(run) for run in runs]
    merged = [next(heads[r]) for r in order]
    assert merged == sorted(key for run in runs for key in run)
    if merged:
        assert share == suffixes.shared(np.frombuffer(b"".join(merged), np.uint8).reshape(-1, LENGTH)).tolist()


def test_front_coding_round_trip():
    rng = np.random.default_rng(2)
    body = rng.integers(97, 99, 3000, dtype=np.uint8)
    found = suffixes.anchors(body, np.array([1700, 1300]), np.array([1700, 1300]))
    docs = np.searchsorted([1700, 3000], found.at, "right")
    all_of = suffixes.suffixes_of(body, found, docs, np.ones(len(found.at), np.uint8), 1)
    run, _ = suffixes.combined(all_of)
    share, low, high, rest, left, doc, at = suffixes.unpacked(suffixes.front_coded(run), *suffixes.FRONT_CODED)
    assert suffixes.decoded(share.tolist(), low.tolist(), rest.tobytes()) == [k.tobytes() for k in run.key]
    assert at.tolist() == run.at.tolist() and doc.tolist() == run.doc.tolist()
