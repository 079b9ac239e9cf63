"""Nodes, totals and ends against a plain trie."""

import hashlib
import re
import zlib

import pytest

from clausewise.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, pos int, depth string"


def brute(rows):
    """Node rows as op11 returns them, from (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [x[1:] for x in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return trie(built)


def trie(built):
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        children = [x for x in members if len(x) == len(node) + 1 and x[: len(node)] == node]
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        saved = sum((len(members[x]) - 1) * words(x) for x in below)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out, key=str)


def mine(spark, rows, bits):
    frame = spark.createDataFrame([(*r, "mine", 9, "x") for r in rows], SCHEMA)
    turns, convs = prefix_trie.rebuild(prefix_trie.number_turns(frame))
    nodes, ends = prefix_trie.prefix_trie(turns, convs, bits)
    hashed = {bytes(r.node): r.ends_sha256 for r in prefix_trie.hash_members(ends).collect()}
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return sorted(((*(r[x] for x in names), hashed.get(bytes(r.node), prefix_trie.EMPTY)) for r in nodes.collect()), key=str)


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
def test_same_nodes(spark, bits):
    rows = []
    for c in range(60):  # common beginnings, copies, and branches at every depth
        for t in range(c * 7 % 11 + 1):
            rows.append((c, t, "user" if t % 2 else "assistant", f"word {t} same" if t < c % 9 else f"own {c % 4} {t}"))
    rows += [(100 + c, t, "user", f"long {t} x" if t < 13 + c else f"{c}") for c in range(5) for t in range(23)]
    rows += [(7000, None, None, None), (7000, None, None, None), (7000, 4, "", ""), (None, 1, "user", "left out"), (-21, 0, "u", "ü\tx\x0by")]
    rows += [(2**41, 3, "user", "z " * 20000), (2**41 + 1, 5, "a", "tie"), (2**41 + 1, 5, "a", "eit"), (2**41 + 1, 5, "b", "tie")]
    assert mine(spark, rows, bits) == brute(rows)


def test_turnless(spark):
    rows = [(3, 0, "u", "one"), (9, 0, "u", "one"), (21, 0, "a", "b")]  # with heads of absent conversations
    got = mine(spark, rows, 2)
    assert got == brute(rows) and len(brute(rows)[0][-1]) == 64
    assert any(r[1] == 0 and r[7] != prefix_trie.EMPTY for r in got)


def test_empty(spark):
    assert mine(spark, [], 4) == []
    assert mine(spark, [(None, 0, "u", "x")], 4) == []


def test_hash_of_many_pieces(spark):
    ids = list(range(-5, 3 * prefix_trie.PIECE, 2))
    ends = spark.createDataFrame([(b"n", i) for i in ids] + [(b"m", 4)], "node binary, conv_id long")
    got = {bytes(r.node): r.ends_sha256 for r in prefix_trie.hash_members(ends).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"m": hashlib.sha256(b"4").hexdigest()}
