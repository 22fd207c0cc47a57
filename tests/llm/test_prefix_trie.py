"""The prefix trie against a plain one, over many shard counts and with tiny queues."""

import hashlib
import random
import zlib

import pytest

from chronofeat.llm import prefix_trie as trie
from chronofeat.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(table, graft=True):
    own = {}
    for conv, turn, role, text in table:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [(r.decode(), t.decode()) for _, _, r, t in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if graft else 0
        built[c] = tuple((turns.get(c - c % 100, [])[:h] if graft else []) + rows[h:])
    members, ends = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        saved[node] = saved.get(node, 0) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        leaves[node] = leaves.get(node, 0) or 1
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), children.get(node, 0), leaves[node],
                   saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
                  for node, m in members.items())


def result(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in df.collect())


def some(seed, convs, turns, words):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), f"w{rng.randrange(words)}" * rng.randrange(3))
            for c in rng.sample(range(convs * 3), convs) for t in range(rng.randrange(1, turns))]


@pytest.mark.parametrize("shards, limit", [(1, 2), (3, 5), (17, 3), (64, 100_000)])
def test_any_shards_give_the_same_trie(frame, shards, limit):
    table = some(shards, 150, 8, 2)
    assert result(trie.prefix_trie(trie.grafted(frame(SCHEMA, table)), shards, limit)) == brute(table)


def test_one_turn_shared_by_most_and_deep_conversations(frame):
    rng = random.Random(5)
    table = []
    for c in range(90):
        deep = rng.choice([3, 4, 45, 60])
        kind = rng.randrange(3)
        table += [(c * 7, t, "user", "same" if t == 0 or kind == 0 or t < 40 and kind == 1 else f"x{rng.randrange(3)}")
                  for t in range(deep)]
    df = frame(SCHEMA, table)
    for shards in (1, 9, 40):
        assert result(trie.prefix_trie(trie.grafted(df), shards, 7)) == brute(table)
        assert result(trie.prefix_trie(trie.ungrafted(df), shards, 7)) == brute(table, graft=False)


def test_one_conversation_repeated(frame):
    table = [(c, t, "user", f"turn {t}") for c in range(0, 13_000, 100) for t in range(4)]
    assert result(trie.prefix_trie(trie.ungrafted(frame(SCHEMA, table)), 6)) == brute(table, graft=False)


ODD = [(0, None, "user", None), (0, 3, None, "b"), (0, 3, None, "b"), (0, 3, "a", "z" * 200_000), (1, 1, "user", ""),
       (2, 5, None, None), (None, 0, "user", "lost"), (None, None, None, None), (105, 0, "user", "no leader"),
       (-1, 0, "user", "below"), (-100, 0, "user", "leads"), (-100, 1, "user", "on"), (7, 0, "user", "one turn"),
       (-(1 << 63), 0, "user", "least"), ((1 << 63) - 1, 0, "user", "most")]


def test_odd_rows(frame):
    df = frame(SCHEMA, ODD)
    assert result(trie.prefix_trie(trie.grafted(df), 4)) == brute(ODD)
    clash = df.selectExpr("*", "1 AS node", "'x' AS leader", "2 AS depth", "3 AS path", "4 AS parent", "5 AS tokens")
    assert result(trie.prefix_trie(trie.grafted(clash), 4)) == brute(ODD)


def test_empty_table(frame):
    assert trie.prefix_trie(trie.grafted(frame(SCHEMA))).collect() == []


def test_query_follows_the_contract(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert result(op13_prefix_trie(spark, sf_dir)) == brute(table)


def test_queue_spills_and_keeps_order():
    rng = random.Random(2)
    entries = [(-rng.randrange(5), bytes([rng.randrange(9)]) * 16, 1, rng.randrange(9), rng.randrange(9))
               for _ in range(500)]
    queue = trie.SpillingQueue(16)
    for e in entries:
        queue.push(e)
    assert len(queue.runs) > 20
    for key in sorted({e[:2] for e in entries}):
        same = [e for e in entries if e[:2] == key]
        assert queue.pop_for(*key) == tuple(sum(e[k] for e in same) for k in (2, 3, 4))
    with pytest.raises(ValueError):
        queue.push((-9, ROOT_NAME, 1, 1, 1))
        queue.pop_for(-8, ROOT_NAME)


ROOT_NAME = trie.ROOT


def test_open_nodes_are_bounded_by_the_cuts(frame):
    cuts = [bytes([c]) * 8 * n for c, n in ((3, 1), (5, 32), (9, 2))]
    paths = {cut[:8 * d] for cut in cuts for d in range(33)}
    opened = [p for p in paths if trie.place(cuts, p, len(p) // 8)[1]]
    assert len(opened) <= 32 * len(cuts) and b"" in opened
    assert trie.place(cuts, b"\x05" * 256, 40) == (2, False, False)
    assert trie.place(cuts, b"\x05" * 8, 1) == (1, True, True)
