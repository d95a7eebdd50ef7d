"""Trie nodes against a direct computation over all prefixes, and the double array against a dict."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from oracle import compare, connect
from skytrace.llm import prefix_trie
from skytrace.llm.queries import ORACLES, QUERIES


def _direct(rows):
    """Nodes of rebuilt conversations, prefix by prefix."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == p)
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(p), parent, len(convs), children[p], leaves[p], saved[p], digest))
    return sorted(map(str, out))


def _trie(spark, rows, **options):
    schema = "conv_id long, turn long, role string, text string, depth int, `n` int, p0 string"
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema)
    turns, convs = prefix_trie.turns_of(table)
    turns, convs = prefix_trie.with_shared_openings(turns, convs)
    return sorted(str(tuple(r)) for r in prefix_trie.prefix_trie(turns, convs, **options).collect())


def _random_rows(seed, convs, texts, turns):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-convs, 2 * convs), convs):
        opening = rng.random() < 0.4
        for t in range(rng.randint(1, turns)):
            said = "start" if opening and t < 2 else rng.choice(texts)
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "bot", None]), said))
    return rows


AWKWARD = [None, "", "a", "b", "é\n", "x" * 3000]


@pytest.mark.parametrize("shard_turns", [prefix_trie.SHARD_TURNS, 40, 1])
def test_nodes_equal_the_direct_ones(spark, shard_turns):
    rows = _random_rows(3, 120, AWKWARD, 9)
    rows += [(None, 1, "user", "lost"), (7, 1, "user", "again"), (7, 1, "user", "again")]
    assert _trie(spark, rows, shard_turns=shard_turns) == _direct(rows)


def test_deep_conversations_in_layers(spark):
    rng = random.Random(8)
    rows = []
    for c in range(0, 60, 5):
        stop = rng.randint(0, 40)
        for t in range(rng.randint(1, 45)):
            rows.append((c, t, "user", f"{min(t, stop)} {c if t >= stop else 0}"))
    for shard_turns in (1 << 16, 9):
        assert _trie(spark, rows, shard_turns=shard_turns, layer_turns=4) == _direct(rows)


def test_many_equal_conversations_and_one_of_a_third_of_all_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 7)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(100) for t in range(3)]
    rows += [(1001 * 5, t, "user", f"turn {t}") for t in range(200)]
    assert _trie(spark, rows, layer_turns=64) == _direct(rows)


def test_nothing(spark):
    assert _trie(spark, []) == []
    assert _trie(spark, [(None, 1, "user", "x")]) == []


def test_only_turnless_conversations(spark):
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4) if zlib.crc32(str(c).encode()) % 9 >= 1]
    assert rows
    assert _trie(spark, rows) == _direct(rows)


def test_double_array_leads_where_a_dict_does():
    rng = np.random.default_rng(5)
    trie, expected = prefix_trie.DoubleArray(3), {}
    level = np.arange(3)
    for _ in range(6):
        parents, turns = [], []
        for s in level.tolist():
            own = rng.choice(300, rng.choice([0, 1, 1, 2, 5, 100]), replace=False)
            parents += [s] * len(own)
            turns += own.tolist()
        if not parents:
            break
        states = trie.add(np.array(parents), np.array(turns))
        expected |= dict(zip(zip(parents, turns, strict=True), states.tolist(), strict=True))
        level = rng.choice(states, min(len(states), 40), replace=False)
    assert len(set(expected.values())) == len(expected)
    for (s, t), state in expected.items():
        assert trie.step(np.array([s]), np.array([t])).tolist() == [state]
        assert trie.check[state] == s


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_equals_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    name = "op13_conversation_trie"
    assert compare(spark, connect(folder), folder, QUERIES[name], ORACLES[name]) is None
