"""The prefix tree against plain formatting of each conversation."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reportmart.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, node string, depth long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)


def written(role, text):
    def escape(s, more=""):
        return "".join("\\" + c if c in "\\#<" + more else c for c in s or "")

    return f"### {escape(role, ':')}: {escape(text)}</turn>\n"


def expected(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, written(role, text), role or "", text or ""))
    found = []
    for conv, said in by_conv.items():
        said.sort()
        turns = "".join(f"{r}\n{t}\n" for _, _, r, t in said)
        loss = "".join(t for _, _, r, t in said if r == "assistant")
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (turns, loss)]
        chars = sum(len(w) for _, w, _, _ in said)
        found.append(("" if conv is None else str(conv), len(said), sha[0], len(loss), sha[1], chars))
    return sorted(found)


ROWS = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "hi </turn>\n### user: x"),
    (2, 1, "assistant", "hi </turn>\n### user: x"),
    (2, 0, "user", "hello"),
    (3, 0, "user", "hello"),
    (3, 1, "assistant", "else"),
    (3, 2, "user", "\\"),
    (4, 0, "user", "hello"),
    (5, 0, "a: b\\", "#### <\\<"),
    (5, 1, None, None),
    (5, 1, None, None),
    (6, 0, "", ""),
    (7, 0, "assistant", ""),
    (7, 1, "assistant", "long é漢 " * 20_000),
    (None, 0, "user", "hello"),
    (None, 1, "assistant", "no id"),
    (8, None, "user", "\n"),
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def many():
    rng = random.Random(3)
    rows = []
    for conv in range(80):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d"])))
    return rows


@pytest.mark.parametrize("rows", [ROWS, many()])
def test_reads_back(spark, rows):
    tree = chat.PrefixTree(table(spark, rows), PATH)
    found = sorted(tuple(r) for r in chat.read_back(tree).collect())
    assert found == expected(rows)


@pytest.mark.parametrize("rows", [ROWS, many()])
def test_tree(spark, rows):
    tree = chat.PrefixTree(table(spark, rows), PATH)
    nodes = {bytes(n.node): n for n in tree.nodes.collect()}
    library = Tokenizer.from_file(PATH)
    paths = {}
    for conv, turn, role, text in rows:
        paths.setdefault(conv, []).append((-1 if turn is None else turn, written(role, text)))
    prefixes = {tuple(w for _, w in sorted(p)[: n + 1]) for p in paths.values() for n in range(len(p))}
    assert len(nodes) == len(prefixes)  # shared turns are there once
    trees = {}
    for node in nodes.values():
        n = node.end - node.start
        assert len(node.ids) == 4 * n == 4 * len(library.encode(node.formatted).ids)
        trees.setdefault(bytes(node.tree), []).append((node.start, node.end, node))
        lineage = []
        at = node
        while at.parent is not None:
            at = nodes[bytes(at.parent)]
            lineage.append(at)
        assert node.depth == len(lineage) + 1 and bytes(at.node) == bytes(node.tree)
        assert node.position == sum(a.end - a.start for a in lineage)
        attended = sorted(p for a in node.attends for p in range(a.start, a.end))
        assert attended == sorted(p for a in lineage for p in range(a.start, a.end))
        assert all(a.end < b.start for a, b in zip(node.attends, node.attends[1:]))
        if node.parent is not None:  # depth-first: the parent's subtree is one interval
            parent = nodes[bytes(node.parent)]
            assert parent.end <= node.start
    for members in trees.values():
        members.sort(key=lambda m: m[0])
        assert members[0][0] == 0
        assert all(a[1] == b[0] for a, b in zip(members, members[1:]))
        open_nodes = []
        for _, _, node in members:
            parent = None if node.parent is None else bytes(node.parent)
            while open_nodes and open_nodes[-1] != parent:
                open_nodes.pop()
            assert (not open_nodes and parent is None) or open_nodes[-1] == parent
            open_nodes.append(bytes(node.node))


def test_empty(spark):
    tree = chat.PrefixTree(table(spark, []), PATH)
    assert tree.nodes.collect() == [] and chat.read_back(tree).collect() == []
