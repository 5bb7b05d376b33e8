"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from tidewatch.llm import conversations
from tidewatch.llm.shared import table

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, words string, a long"


def plain(rows, every=None):
    """rows: (conv_id, turn, role, text) with distinct turns in each conversation."""
    own = defaultdict(list)
    for c, t, role, text in sorted(((c, -1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c is not None)):
        own[c].append((role, text))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if every else 0
        whole[c] = (own.get(c - c % every, [])[:h] + turns[h:]) if every else turns
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, all_of in members.items():
        words = len(re.findall("[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(all_of) - 1) * words
            leaves[node[:d]] += node not in children
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, m in members.items())


def found(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA).repartition(parts)


def test_driver_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    mine = conversations.op12_conversations(spark, SMALL)
    assert found(mine) == plain(rows, 20)
    assert dict(mine.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in mine.columns}


def test_shared_starts_copies_and_odd_rows(spark):
    rows = []
    for c in range(60):
        rows += [(c, t, "user" if t % 2 else None, f"word {'same' if t < c % 5 else c} \t{t}") for t in range(c % 7)]
    rows += [(70 + c, t, "user", "all the same") for c in range(30) for t in range(3)]
    rows += [(200, None, "user", "first"), (200, 5, "user", None), (200, 3, "", "second\x0bthird"), (None, 1, "user", "nobody's")]
    rows += [(300 + c, t, "u", "x" * 5000) for c in range(3) for t in range(2)]
    for every in (None, 20):
        assert found(conversations.prefix_trie(frame(spark, rows), every)) == plain(rows, every)


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 5)
    monkeypatch.setattr(conversations, "TREE_PIECES", 7)
    monkeypatch.setattr(conversations, "TEXT", 10)
    rows = [(c, t, "u", f"{t * 7 % 11} {'z ' * (c if t > 20 else 0)}") for c in range(1, 5) for t in range(23 + 5 * c)]
    rows += [(100 + c, t, "u", f"{t * 7 % 11} ") for c in range(12) for t in range(13)]
    for every in (None, 20):
        assert found(conversations.prefix_trie(frame(spark, rows), every)) == plain(rows, every)


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "u", "a")] * 3 + [(2, 0, "u", "a"), (2, 1, "u", "a")]
    assert found(conversations.prefix_trie(frame(spark, rows))) == plain([(1, t, "u", "a") for t in range(3)] + [(2, t, "u", "a") for t in range(2)])


def test_conversations_without_turns(spark):
    """h turns are cut off while the conversation to take them from is not there."""
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, "u", "a"), (short, 1, "u", "b")]
    assert found(conversations.prefix_trie(frame(spark, rows), 20)) == plain(rows, 20) == [
        (short, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_empty(spark):
    assert conversations.prefix_trie(frame(spark, [], 1), 20).collect() == []


@pytest.mark.parametrize("n", [3, 4, 5, 16, 17, 48, 49, 256])
def test_layouts_grow(n):
    tree = conversations.RadixTree()
    place = bytes(16)
    keys = [bytes([k, 1, 2]) + bytes(13) for k in range(n)]
    for k, key in enumerate(keys):
        tree.add(place + key, (1, k, 0, 0, 0))
        tree.add(place + key + key, (1, k + 1000, 0, 0, 0))
    got = tree.nodes({key: 1 for key in keys})
    assert sorted(x[1] for x in got) == sorted(keys * 2) and {x[2] for x in got} == {1, 2}
    inner = tree.root.child(0)
    while inner.prefix == b"" and inner.layout == 4 and len(inner.below) == 1:
        inner = inner.below[0]
    assert inner.layout == min(x for x in (4, 16, 48, 256) if x >= n)
    assert sorted(b for b, _ in inner.children()) == list(range(n))
