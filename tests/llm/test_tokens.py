"""Byte-level BPE, unigram counts and packing against the libraries and direct loops."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from awkward import AWKWARD, documents
from skytrace.llm import bpe, packing, unigram

PATTERN = public_tokenizers.PATTERN
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _tiktoken():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _tokenizers():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_encoding_equals_the_library_and_decodes_back(spark):
    library = _tiktoken()
    rows = documents(spark).select(
        "doc_id", "text", bpe.encode(RANKS, PATTERN)("text").alias("ids")
    )
    rows = rows.withColumn("bytes", bpe.decode(RANKS, PATTERN)("ids")).collect()
    assert len(rows) == len(AWKWARD)
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == library.encode_ordinary(row["text"] or "")
        assert bytes(row["bytes"]) == (row["text"] or "").encode()


@given(st.text(alphabet=" \t\n\x0b\x1c\x85\xa0 'staé1_🙂", max_size=120), st.integers(1, 20))
@settings(max_examples=400, deadline=None)
def test_cuts_are_safe(text, size):
    library = _tiktoken_cached()
    parts = bpe.cut_safely(text, size)
    assert "".join(parts) == text
    joined = [i for part in parts for i in library.encode_ordinary(part)]
    assert joined == library.encode_ordinary(text)


_CACHE = []


def _tiktoken_cached():
    if not _CACHE:
        _CACHE.append(_tiktoken())
    return _CACHE[0]


def test_json_ids_equal_the_tokenizers_library():
    rng = random.Random(4)
    letters = "etaoinshrdlu ETA'\n\t.,!?0123é ßñ你🙂|*#<>"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 200))) for _ in range(1500)]
    texts += [t for t in AWKWARD if t] + ["<|endoftext|> a<|endoftext|>"]
    encoder = bpe.tokenizer_file(JSON, PATTERN)
    for text, own in zip(
        texts, _tokenizers().encode_batch(texts, add_special_tokens=False), strict=True
    ):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == own.ids


def test_unigram_counts_equal_the_library(spark):
    vocabulary = [(piece, float(score)) for piece, score in unigram.vocabulary_file(PIECES)]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))

    def expected(text):
        if not text:
            return 0
        return len(library.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids)

    rows = documents(spark).select("text", unigram.token_counts(PIECES)("text").alias("c"))
    for row in rows.collect():
        assert row["c"]["n_tokens"] == expected(row["text"])
    rng = random.Random(1)
    counter = unigram.counter(PIECES)
    for _ in range(2000):
        text = "".join(rng.choices(" ab<s>\n\t▁éß你🙂0x the", k=rng.randint(0, 60)))
        assert counter.count(text)[0] == expected(text)


def test_unigram_ties_keep_the_piece_that_starts_first():
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0)]
    vocabulary += [(f"<0x{i:02X}>", -50.0) for i in range(256)]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    counter = unigram.UnigramCounter(vocabulary)
    for n in range(1, 12):
        ids = library.encode("▁" + "a" * n, add_special_tokens=False).ids
        assert counter.count("a" * n)[0] == len(ids)


def _check_packing(rows, texts, capacity=2048):
    """Every id of every document is in one place, and sequences are gapless."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row["doc_id"]].append(row)
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
    tokenizer = _tokenizers()
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == capacity for r in own[1:])
        at = 0
        for row in own:
            part = np.array(ids[at : at + row["length"]], "<u4").tobytes()
            assert (row["start"], row["ids_crc32"]) == (at, zlib.crc32(part))
            at += row["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_places_every_piece_once(spark):
    texts = dict(enumerate(AWKWARD)) | {1000 + i: "word " * i for i in range(150)}
    frame = documents(spark, list(texts.items()))
    rows = packing.pack(frame, JSON, PATTERN).collect()
    n = _check_packing(rows, texts)
    assert n <= sum(r["length"] for r in rows) / 2048 * 1.05 + 1


def test_packing_counts_repeated_rows_and_keeps_ids(spark):
    frame = documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)])
    rows = packing.pack(frame, JSON, PATTERN, keep_ids=True).collect()
    assert sorted((r["doc_id"] is None, r["length"]) for r in rows) == [
        (False, 3),
        (False, 3),
        (True, 1),
        (True, 2),
    ]
    assert sorted(r["offset"] for r in rows) == [0, 3, 6, 8]
    assert {len(r["ids"]) // 4 == r["length"] for r in rows} == {True}


def test_packing_an_empty_table(spark):
    assert packing.pack(documents(spark, []), JSON, PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fillings_use_each_document_once_and_waste_little(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 100, 2048))
    counts = [0] + [rng.choice((0, 0, 1, 2, 7, 300)) for _ in range(capacity)]
    used, sequences = Counter(), 0
    for filling, times in packing.fillings(counts, capacity):
        assert sum(length * n for length, n in filling.items()) <= capacity
        for length, n in filling.items():
            used[length] += n * times
        sequences += times
    assert all(used[i] == n for i, n in enumerate(counts))
    total = sum(i * n for i, n in enumerate(counts))
    # First-fit decreasing, as a bound that the plan must not fall behind.
    room: list[int] = []
    for length in sorted((i for i, n in enumerate(counts) for _ in range(n)), reverse=True):
        for i, gap in enumerate(room):
            if gap >= length:
                room[i] -= length
                break
        else:
            room.append(capacity - length)
    assert total / capacity <= sequences <= len(room) * 1.02 + 1


def test_two_documents_replace_a_loose_one():
    counts = [0] * 11
    for length in (6, 3, 2, 2):
        counts[length] += 1
    # Greedy fills 6 + 3 and leaves a gap of 1; two of 2 instead of the 3 fill it to the brim.
    filling, times = next(iter(packing.fillings(counts, 10)))
    assert (dict(filling), times) == ({6: 1, 2: 2}, 1)


def test_digests_of_the_registered_query(spark):
    from skytrace.llm.queries import QUERIES

    library = _tiktoken()
    sf_dir = "/root/testdata/sf0.001"
    texts = {
        r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    rows = QUERIES["op4_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark):
    nothing = documents(spark, [])
    for column in (bpe.encode(RANKS, PATTERN), bpe.round_trip(RANKS, PATTERN), unigram.token_counts(PIECES)):
        assert nothing.select("doc_id", column("text").alias("x")).collect() == []
