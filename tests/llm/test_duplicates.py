"""Exact and near duplicates, against brute force."""

import hashlib
import random
import string

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reportmart.llm import exact_dedup, simhash
from reportmart.llm.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def groups_of(rows):
    found = []
    texts = {}
    for i, t in rows:
        texts.setdefault((t or "").translate(LOWER), []).append(i)
    for text, ids in texts.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, sha, keep, len(ids), i == keep) for i in ids]
    return sorted(found, key=str)


ROWS = [
    *[(i, "A hot text") for i in range(50)],
    (60, "a HOT text"),
    (61, "É"),
    (62, "é"),
    (63, None),
    (64, ""),
    (65, None),
    (None, "no id"),
    (None, "No id"),
    (66, "no id "),
    (67, "long " * 50_000),
    (68, "Long " * 50_000),
    (69, "twice"),
    (69, "twice"),
    (69, "other text"),
]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
def test_groups(clashing, monkeypatch, digest):
    """Also with digests that collide, and with every group hot."""
    for share in (1000, 10**9):
        monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
        found = exact_dedup.exact_groups(clashing(ROWS), digest=digest).collect()
        got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found]
        assert sorted(got, key=str) == sorted(((w[0], *w[2:]) for w in groups_of(ROWS)), key=str)


def test_digests_and_empty(documents):
    found = exact_dedup.exact_groups(documents(ROWS)).collect()
    assert sorted(map(tuple, found), key=str) == groups_of(ROWS)
    assert exact_dedup.exact_groups(documents([])).collect() == []
    assert exact_dedup.deduplicate(documents([])).collect() == []


def test_deduplicate_keeps_columns(clashing):
    docs = clashing(ROWS)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    want = sorted({(i, sha) for i, sha, _, _, k in groups_of(ROWS) if k}, key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [i for i, _ in want]


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    """The least id reachable, from (id, fingerprint)."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j][1]).bit_count() <= bits:
                parent[root(i)] = root(j)
    members = {}
    for i, (doc, _) in enumerate(fps):
        members.setdefault(root(i), []).append(doc)
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return [least[root(i)] for i in range(len(fps))]


@pytest.mark.parametrize("part", [1 << 20, 7])
def test_fingerprints(monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(2)
    texts = ["", " ", "one", "One TWO", "a b c", "É a\tb\x0bc\r\nd", "x\x1cy z\x85 q", "w " * 700]
    texts += [" ".join(rng.choices(["aa", "bé", "C", "dd d"], k=n)) for n in range(3, 60)]
    for text in texts:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_nearest_codeword_table():
    table = simhash.golay_indices()
    assert np.bincount(table, minlength=4096).tolist() == [2048] * 4096


def test_every_link_shares_a_key():
    rng = random.Random(3)
    for _ in range(4000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        rows, keys = simhash.link_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])
        assert len(set(keys[rows == 0])) == (rows == 0).sum() <= 6 * 6 + 6**3


@pytest.mark.parametrize("block", [1024, 5])
def test_links_connect_what_brute_force_does(spark, block):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for centre in list(fps)[:5]:  # dense groups, many pairs in each
        for _ in range(60):
            near = centre
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << bit
            fps.add(near)
    signed = [f - (f >> 63 << 64) for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.links(distinct, block=block)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in found.collect())
    roots = {r.node: r.root for r in components(found).collect()}
    want = brute_components([(f, f & (2**64 - 1)) for f in signed])
    assert [roots.get(f, f) for f in signed] == want


def test_keys_are_never_broadcast(spark):
    """Fingerprints of a few megabytes have hundreds of megabytes of keys."""
    found = simhash.links(spark.range(1, 3).withColumnRenamed("id", "fp"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {tuple(sorted(r)) for r in found.collect()} == {(1, 2)}


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1002, 1001), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 301)} | {1001: 1000, 1002: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates(clashing):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    rows = []
    for group in range(12):
        text = rng.choices(words, k=250)
        for _ in range(6):
            copy = list(text)
            copy[rng.randrange(250)] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(500, None), (501, " "), (502, ""), (None, rows[0][1]), (3, rows[3][1]), (600, "a b")]
    found = simhash.near_duplicates(clashing(rows)).collect()
    fps = [(i, brute_fingerprint(t or "")) for i, t in rows]
    want = [
        (i, fp - (fp >> 63 << 64), c) for (i, fp), c in zip(fps, brute_components(fps))
    ]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(clashing([])).collect() == []


def test_one_of_each(clashing):
    docs = clashing([(4, "a b c d"), (2, "A b c d"), (7, None), (9, ""), (8, "e f g h")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 8]


def near_copies(rng, n):
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    texts = []
    for _ in range(n):
        text = rng.choices(words, k=rng.randint(100, 400))
        for changes in range(5):
            copy = list(text)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 3])
def test_one_of_each_by_brute_force(documents, block):
    rng = random.Random(6)
    texts = [*near_copies(rng, 30), "long " * 300_000, "Long " * 300_000, "", None, " "]
    kept = simhash.one_of_each(documents(texts), block=block)
    fps = [(i, brute_fingerprint(t or "")) for i, t in enumerate(texts)]
    want = set(brute_components(fps))
    assert {r.doc_id for r in kept.collect()} == want and len(want) < len(texts) - 4


def test_one_of_each_of_repeated_rows_and_none(documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (3, "e f g h i")]
    kept = simhash.one_of_each(documents(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [rows[0], rows[0], rows[3]]
    assert simhash.one_of_each(documents([])).collect() == []


def test_deduplicate_keeps_one_of_repeated_rows(clashing):
    rows = [(5, "Same"), (5, "same"), (5, "same"), (4, "same"), (None, "x"), (None, "X"), (7, None), (7, "")]
    kept = exact_dedup.deduplicate(clashing(rows)).collect()
    assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept), key=str) == [
        (5, "same"), (7, ""), (None, "x")
    ]


def test_one_of_each_matches_id_and_text(clashing):
    """Rows without an id, and one id with several texts, go only by their own text."""
    base = " ".join(f"w{i}" for i in range(100))
    rows = [
        (3, base),
        (5, base.upper()),
        (5, "quite another text of the same id"),
        (None, base.title()),
        (None, "one text without an id"),
        (None, "a second text that has no id"),
        (9, "first of nine words that are here\ttoo"),
        (9, "first of nine words that are here too"),
    ]
    fps = [brute_fingerprint(t) for _, t in rows]
    assert len(set(fps)) == 5
    kept = simhash.one_of_each(clashing(rows)).collect()
    found = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    nine = min(rows[6:], key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())
    assert found == sorted([rows[0], rows[2], rows[4], rows[5], nine], key=str)
