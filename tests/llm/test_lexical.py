"""Ranked search against scores of all documents, and against SQL."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from awkward import AWKWARD, documents
from oracle import compare, connect
from skytrace.llm import lexical
from skytrace.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _direct(docs, items, k):
    """All scores of all documents, sorted."""
    words = [(i, _words(t)) for i, t in docs]
    counted = [(i, len(w), Counter(w)) for i, w in words if w]
    documents, total = len(counted), sum(n for _, n, _ in counted)
    holding = Counter(t for _, _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, n, c in counted:
            m, score = 10 + (90 * n * documents) // total, 0
            for t in set(_words(text)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else i, -score))
    return sorted(out, key=str)


def _found(spark, docs, items, **options):
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    rows = lexical.search(documents(spark, docs), asked, **options).collect()
    return sorted(map(tuple, rows), key=str)


def _some(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)] + ["É", "Über", "B2b"]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(n)]


ITEMS = [(0, "w1 w2 w3, W1"), (1, None), (2, ""), (3, "w7 w9 w11 w900 é ÜBER b2B"), (3, "nothing there")]


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("shard", [7, 8192])
def test_ranks_equal_the_direct_ones(spark, k, shard):
    docs = _some(5, 400)
    docs += [(i + 1000, t) for i, t in docs[:50]] + [(7, docs[7][1]), (None, docs[7][1])]
    items = ITEMS + [(i + 10, t) for i, t in docs[40:60]]
    assert _found(spark, docs, items, k=k, shard_documents=shard) == _direct(docs, items, k)


def test_awkward_documents(spark):
    docs = list(enumerate(AWKWARD)) + [(None, "one two"), (3, "three one")]
    items = [(1, "one two three"), (2, "TWIN orre w5 w6 é 你好 🙂"), (3, AWKWARD[11])]
    assert _found(spark, docs, items) == _direct(docs, items, 10)


def test_a_third_of_all_rows_is_equal(spark):
    docs = [(i, "same old words") for i in range(200)] + [(i + 500, t) for i, t in _some(9, 400)]
    items = [(1, "same words w3"), (2, "old")]
    assert _found(spark, docs, items) == _direct(docs, items, 10)


def test_queries_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PASS_TERMS", 4)
    docs = _some(6, 60)
    assert _found(spark, docs, ITEMS) == _direct(docs, ITEMS, 10)


def test_nothing(spark):
    assert _found(spark, [], ITEMS) == []
    assert _found(spark, [(1, "w1")], []) == []
    assert _found(spark, [(1, None), (2, " ,")], ITEMS) == []


@pytest.mark.parametrize("seed", range(30))
def test_any_step_gives_all_that_tie_with_the_best(seed):
    rng = np.random.default_rng(seed)
    n, terms, k = 300, 8, int(rng.integers(1, 12))
    held = rng.random((terms, n)) < rng.random((terms, 1))
    term, doc = np.nonzero(held)
    tf = rng.integers(1, 4, len(doc))
    m = rng.choice([20, 40, 300], n)
    weights = rng.integers(0, 5, terms) * 100
    shard = lexical.Shard(m, doc, term, tf, weights)
    scores = np.zeros(n, np.int64)
    np.add.at(scores, doc, lexical._impacts(weights[term], tf, m[doc]))
    bar = max(1, int(np.sort(scores)[-k]))
    docs, found, _ = shard.best(np.arange(terms), k, 1, int(rng.integers(1, 9)))
    assert sorted(docs.tolist()) == np.flatnonzero(scores >= bar).tolist()
    assert found.tolist() == scores[docs].tolist()


def test_reading_stops_before_the_lists_end():
    """One document with all terms, few times among many: its lists need not be read whole."""
    rng = np.random.default_rng(3)
    n = 8000
    lists = [rng.choice(n, 4000, replace=False) for _ in range(6)]
    doc = np.concatenate([*lists, np.zeros(6, np.int64)])
    term = np.concatenate([np.repeat(np.arange(6), 4000), np.arange(6)])
    doc, term = np.unique(np.stack([doc, term]), axis=1)
    tf = np.where(doc == 0, 9, 1)
    m = np.where(np.arange(n) == 0, 12, rng.integers(80, 300, n))
    shard = lexical.Shard(m, doc, term, tf, np.full(6, 700))
    docs, scores, read = shard.best(np.arange(6), 1)
    assert docs.tolist() == [0]
    assert scores.tolist() == [6 * 700 * ((9 * 10**9) // (9000 + 8 * 12))]
    assert read < len(doc) / 4


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_equals_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    name = "op11_lexical_search"
    assert compare(spark, connect(folder), folder, QUERIES[name], ORACLES[name]) is None
