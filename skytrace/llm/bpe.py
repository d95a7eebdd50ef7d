"""Byte-level BPE: text to ids with tiktoken over a local rank file, and ids back to bytes.

Ids travel as one binary value a text, little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

#: Longer texts are cut into pieces of about this many characters before they are encoded.
PIECE = 32_768
# A word pattern in which no match reaches across the start of white space that follows something
# else may be cut there. U+001C to U+001F are white space for Python alone, so not cut at.
_SAFE = re.compile(r"(?<=\S)(?=[^\S\x1c-\x1f])(?<![\x1c-\x1f])")


def cut_safely(text: str, size: int = PIECE) -> list[str]:
    """Pieces of at least ``size`` characters, the last one excepted, whose ids can be joined."""
    pieces, start = [], 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found or found.start() >= len(text):
            break
        pieces.append(text[start : found.start()])
        start = found.start()
    pieces.append(text[start:])
    return pieces


class Encoder:
    """A vocabulary of byte strings by rank, and the pattern of the words it is applied to."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._coding = tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str | None) -> bytes:
        ids = array("I")
        for piece in cut_safely(text or ""):
            ids.extend(self._coding.encode_ordinary(piece))
        return np.frombuffer(ids, np.uint32).astype("<u4", copy=False).tobytes() if ids else b""

    def decode(self, ids: bytes | None) -> bytes:
        return self._coding.decode_bytes(np.frombuffer(ids or b"", "<u4").tolist())


@lru_cache(maxsize=4)
def rank_file(path: str, pattern: str) -> Encoder:
    """The encoder of a ``.tiktoken`` file: a base64 byte string and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Encoder({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def _visible_bytes() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as they are, others from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def tokenizer_file(path: str, pattern: str) -> Encoder:
    """The encoder with the ids that the ``tokenizers`` library gives for a byte-level BPE file.

    The file's own vocabulary is run by tiktoken, which is five times as fast. That gives the same
    ids where merges come in the order of their ids and nothing else changes the text; other files
    are refused. Special tokens' strings in a text are ordinary text.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"]
    special = {t["content"] for t in spec["added_tokens"]}
    as_byte = _visible_bytes()
    ranks = {
        bytes(as_byte[c] for c in token): i
        for token, i in model["vocab"].items()
        if token not in special
    }
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merged = [ranks[bytes(as_byte[c] for c in "".join(pair))] for pair in pairs]
    if (
        spec["normalizer"] is not None
        or split != split | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        or merged != list(range(256, 256 + len(merged)))
    ):
        raise ValueError(f"{path} is not a plain byte-level BPE with merges in the order of ids")
    return Encoder(ranks, pattern)


def encode(path: str, pattern: str):
    """A column function: the ids of a whole text as binary; NULL and empty texts have none."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        encoder = rank_file(path, pattern)
        return pa.array([encoder.encode(t) for t in texts.to_pylist()], pa.binary())

    return run


def decode(path: str, pattern: str):
    """A column function: the bytes that ids stand for, which need not be valid UTF-8."""

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        encoder = rank_file(path, pattern)
        return pa.array([encoder.decode(i) for i in ids.to_pylist()], pa.binary())

    return run


def round_trip(path: str, pattern: str):
    """A column function: ``struct(ids, bytes)``, the ids of a text and what they decode to.

    Used together, ``decode(encode(text))`` beside ``encode(text)`` would encode twice.
    """

    @F.arrow_udf("struct<ids: binary, bytes: binary>")
    def run(texts: pa.Array) -> pa.Array:
        encoder = rank_file(path, pattern)
        ids = [encoder.encode(t) for t in texts.to_pylist()]
        both = [pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.binary())]
        return pa.StructArray.from_arrays(both, ["ids", "bytes"])

    return run
