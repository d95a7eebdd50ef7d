"""Re-Pair files against the ids that went in, whole and in part."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from awkward import AWKWARD, documents
from skytrace.llm import grammar
from skytrace.llm.common import scratch
from skytrace.llm.queries import QUERIES

PATTERN = public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def _library_ids(texts):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return [e.ids + [2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@given(st.lists(st.integers(0, 5), max_size=300), st.integers(1, 6), st.data())
@settings(max_examples=300, deadline=None)
def test_blocks_give_their_ids_back(ids, times, data):
    ids = np.array(ids * times, np.uint32)
    block = grammar.compress(ids)
    assert grammar.expand(block).tolist() == ids.tolist()
    start = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(start, len(ids)))
    assert grammar.expand_slice(block, start, stop).tolist() == ids[start:stop].tolist()


@pytest.mark.parametrize("ids", [[7] * 4097, [1, 2] * 999 + [1], [*range(70_000)] * 5])
def test_runs_long_repeats_and_many_symbols(ids):
    block = grammar.compress(np.array(ids, np.uint32))
    assert grammar.expand(block).tolist() == ids
    assert len(block["symbols"]) < 4 * len(ids) / 2


def test_rules_stand_for_frequent_pairs():
    rng = random.Random(4)
    ids = np.array([rng.choice([1, 2, 2, 3, 3, 3]) for _ in range(5000)], np.uint32)
    block = grammar.compress(ids)
    terminals, rules, lengths, symbols = grammar._arrays(block)
    assert sum(block["rounds"]) == len(rules) > 5
    used = np.bincount(np.concatenate([rules.ravel(), symbols]), minlength=len(lengths))
    assert used[terminals:].min() >= 1
    assert (lengths[terminals:] == lengths[rules].sum(1)).all()
    first = np.arange(len(rules)) + terminals
    assert (rules < first[:, None]).all()  # a rule is made of ids and earlier rules


def _expected(rows):
    ids = _library_ids([t for _, t in rows])
    return [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(rows, ids, strict=True)]


@pytest.mark.parametrize("shard_ids", [grammar.SHARD_IDS, 700])
def test_awkward_documents_come_back_in_order(spark, shard_ids):
    rows = list(enumerate(AWKWARD)) + [(None, None), (None, "nothing"), (3, "three"), (3, "three")]
    path = scratch(spark, "grammar-test")
    grammar.write(documents(spark, rows), path, JSON, PATTERN, shard_ids=shard_ids)
    files = grammar.read_shards(spark, path)
    found = grammar.documents_of(files, keep_ids=True).orderBy("start").collect()
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in found) == sorted(
        (i is not None, i or 0, n, crc) for i, n, crc in _expected(rows)
    )
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()
    whole = np.frombuffer(b"".join(bytes(r["ids"]) for r in found), "<u4")
    asked = [(0, 5), (10, 10), (len(whole) - 3, len(whole) + 9), (100, 30_000), (len(whole), len(whole) + 1)]
    got = grammar.ids_between(files, spark.createDataFrame(asked, "start long, stop long")).collect()
    assert {(r["start"], r["stop"]): bytes(r["ids"]) for r in got} == {
        (a, b): whole[a:b].tobytes() for a, b in asked
    }


def test_empty_table(spark):
    path = scratch(spark, "grammar-empty")
    grammar.write(documents(spark, []), path, JSON, PATTERN)
    files = grammar.read_shards(spark, path)
    assert grammar.documents_of(files).count() == 0
    asked = spark.createDataFrame([(0, 3)], "start long, stop long")
    assert bytes(grammar.ids_between(files, asked).first()["ids"]) == b""


def test_registered_query_equals_the_library(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    expected = _expected([(r["doc_id"], r["text"]) for r in texts])
    starts = np.cumsum([0, *(n for _, n, _ in expected)])[:-1].tolist()
    found = QUERIES["op12_token_grammar"](spark, SF).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found] == expected
    assert [r["start"] for r in found] == starts
