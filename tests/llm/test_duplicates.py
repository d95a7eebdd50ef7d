"""Near-duplicates and repeated strings against direct loops."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from awkward import AWKWARD, documents
from skytrace.llm import simhash, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _least_reachable(nodes, near):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if near(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n in nodes}


def test_fingerprints():
    for text in AWKWARD:
        if text is None or len(text) < 20_000:
            assert simhash.fingerprint(text) == _fingerprint(text)


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    assert all(30 < m.bit_count() < 40 for m in masks)
    for a in range(64):
        for b in range(a + 1, 64):
            assert any(not m & (1 << a | 1 << b) for m in masks)


def _near_prints(seed, n):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(prints) < n:
        prints.append(rng.choice(prints) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))))
    return sorted({p - (1 << 64) if p >> 63 else p for p in prints})


@pytest.mark.parametrize("direct", [32, 2])
def test_links_join_what_brute_force_joins(spark, monkeypatch, direct):
    from skytrace.operators.graph import connected_components

    monkeypatch.setattr(simhash, "DIRECT", direct)
    prints = _near_prints(3, 400)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.links(frame, 2)
    mask = (1 << 64) - 1
    within = [(r["src"], r["dst"]) for r in links.collect()]
    assert len(within) < 8 * len(prints)
    groups = {r["node"]: r["component"] for r in connected_components(links).collect()}
    expected = _least_reachable(prints, lambda a, b: ((a ^ b) & mask).bit_count() <= 2)
    assert {p: groups.get(p, p) for p in prints} == expected


def test_components_of_awkward_documents(spark):
    base = " ".join(f"token{i}" for i in range(400))
    near = [base.replace(f"token{i} ", f"other{i} ") for i in (5, 50, 200)]
    rows = list(enumerate([t for t in AWKWARD if t is None or len(t) < 20_000] + [base, *near, base]))
    rows += [(None, base), (3, "a row of the same id")]
    got = simhash.simhash_components(documents(spark, rows)).collect()
    prints = [(i, _fingerprint(t)) for i, t in rows]
    roots = _least_reachable(
        {p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= 2
    )
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    expected = sorted(
        (str(i), f"{p:016x}", str(least.get(roots[p]))) for i, p in prints
    )
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == expected


def test_dedup_keeps_one_row_of_each_group(spark):
    rows = [(4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (7, "e f g h")]
    rows += [(9, None), (8, ""), (None, "only row without an id")]
    frame = documents(spark, rows)
    kept = simhash.simhash_dedup(frame)
    assert kept.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(2, "a b c d"), (7, "e f g h"), (8, ""), (None, "only row without an id")], key=str
    )
    assert simhash.simhash_dedup(documents(spark, [])).count() == 0
    assert simhash.simhash_components(documents(spark, [])).count() == 0


def test_dedup_reduces_copies_before_the_shuffle(spark):
    rows = [(5, "one and the same text")] * 300 + [(None, "no id here")] * 200
    rows += [(100 + i, f"text number {i} of its own kind {i * 7919}") for i in range(100)]
    deduped = simhash.simhash_dedup(documents(spark, rows))
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_first" in plan
    kept = [r["doc_id"] for r in deduped.collect()]
    assert kept.count(5) == kept.count(None) == 1
    assert len(kept) == len(set(kept))


def _without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    rows = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(d) else 0
        rows.append((len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def _spliced(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "ß…"]
    base = [" ".join(rng.choices(words, k=rng.choice((5, 50, 300, 900)))) for _ in range(25)]
    texts = list(base)
    for _ in range(50):
        text, kind = rng.choice(base), rng.random()
        if kind < 0.3:
            texts.append(text)
        elif kind < 0.7:
            own = text.split(" ")
            for _ in range(rng.randint(1, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
        else:
            at = rng.randrange(len(text))
            part = text[at : at + rng.randint(300, 700)]
            texts.append(rng.choice(base)[: rng.randint(0, 2000)] + part + rng.choice(base)[:300])
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    texts = _spliced(seed) + AWKWARD + ["x" * 400, "y" * 399, "z" * 400]
    frame = documents(spark, list(enumerate(texts)))
    got = suffixes.without_repeats(frame, kept="kept_", n_spans="n_spans").collect()
    own = {
        r["doc_id"]: (len(r["kept_"]), r["n_spans"], hashlib.sha256(r["kept_"]).hexdigest())
        for r in got
    }
    assert [own[i] for i in range(len(texts))] == _without_repeats(texts, 400)


def test_blocks_cover_every_start_once(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    offsets = np.cumsum([0, 10, 400, 0, 399, 1500, 450, 401, 3000])
    seen = Counter()
    for low, high, starts, rows in suffixes._blocks(offsets, 400):
        for at, row in zip(starts.tolist(), rows.tolist(), strict=True):
            assert offsets[row] <= low + at <= low + at + 400 <= min(high, offsets[row + 1])
            seen[low + at] += 1
    starts = {i for a, b in zip(offsets, offsets[1:], strict=False) for i in range(a, b - 399)}
    assert set(seen) == starts
    assert set(seen.values()) == {1}


def test_runs_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    whole = {}
    for anchor, _, s, e in zip(
        *suffixes.runs(data, np.arange(2601), 400), strict=True
    ):
        for i in range(s, e + 1):
            whole[i] = anchor
    assert sorted(whole) == list(range(2601))
    assert all(whole[100 + i] == whole[2000 + i] for i in range(201))
    for low, high, starts, rows in suffixes._blocks(np.array([0, 3000]), 400):
        assert (low, high, len(starts), set(rows)) == (0, 3000, 2601, {0})


def test_a_hot_text_or_passage_is_split_over_tasks(spark, monkeypatch):
    """Joins of many copies, and of a passage that many texts hold, are open to AQE."""
    rng = random.Random(5)
    copied, passage = (" ".join(f"{c}{rng.random()}" for _ in range(60)) for c in "cp")
    texts = [copied + passage] * 500
    texts += [f"{rng.random()} {rng.random()} {passage} {rng.random()}" for _ in range(500)]
    texts += [" ".join(f"o{rng.random()}" for _ in range(30)) for _ in range(200)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    plans = {}

    def final(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    def watched(df, name):
        plans.setdefault(name, final(df))
        return kept(df, name)

    kept = suffixes.stored
    monkeypatch.setattr(suffixes, "stored", watched)
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = documents(spark, list(enumerate(texts))).repartition(24)
        cut = suffixes.without_repeats(frame, kept="kept_", n_spans="n_spans")
        plans["rows"] = final(cut)
        own = {r["doc_id"]: (len(r["kept_"]), r["n_spans"]) for r in cut.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = _without_repeats(texts, 400)
    assert [own[i] for i in range(len(texts))] == [row[:2] for row in expected]
    joins = {"suffix-shared": 1, "suffix-judged": 2, "suffix-contexts": 1, "rows": 1}
    assert {name: plans[name].count("skew=true") for name in joins} == joins


def test_suffix_dedup_returns_the_columns(spark):
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [(1, f"begin {passage} end"), (2, f"other start {passage} other end"), (3, None)]
    rows += [(4, "short"), (5, "é" * 300 + "tail one"), (6, "é" * 300 + "tail two")]
    frame = documents(spark, rows).selectExpr("*", "CAST(-1 AS BIGINT) AS n_chars")
    got = suffixes.suffix_dedup(frame)
    assert got.columns == frame.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert texts[1] == ("begin end", 9) or texts[1][0].replace(" ", "") == "beginend"
    assert passage not in texts[2][0]
    assert texts[3] == (None, None)
    assert texts[4] == ("short", 5)
    assert (texts[5][0], texts[6][0]) == ("one", "two")
    assert suffixes.suffix_dedup(documents(spark, [])).count() == 0
