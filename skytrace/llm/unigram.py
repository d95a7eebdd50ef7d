"""Count-only Viterbi over a unigram vocabulary.

Aho-Corasick lists every piece that ends at a character; dynamic programming keeps the best score
up to there with its number of pieces, no path. Ties go as in the ``tokenizers`` library's Unigram
model: of equal scores the piece that starts first stays. Scores are added in double precision;
those of a BPE-ordered vocabulary are whole numbers, so that the sums are exact.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores this below the worst piece
#: Counts of parts of a text that a task remembers before it starts anew.
REMEMBERED = 400_000


class UnigramCounter:
    """Pieces with scores; characters without a piece count as their bytes (byte fallback)."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        if any(SPACE in piece.lstrip(SPACE) for piece, _ in vocabulary):
            raise ValueError("a piece holds a space after other characters")
        self._pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self._pieces.add_word(piece, (len(piece), score))
        self._pieces.make_automaton()
        self._single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self._unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self._known: dict[str, tuple[int, float]] = {}
        if SPACE not in self._single:
            raise ValueError("the vocabulary has no piece for a space")

    def _part(self, part: str) -> tuple[int, float]:
        size = len(part)
        best: list[float | None] = [0.0] + [None] * size
        pieces = [0] * (size + 1)
        matches = self._pieces.iter(part)
        match = next(matches, None)
        for end in range(1, size + 1):
            top, count = None, 0
            while match is not None and match[0] < end:  # the longest piece comes first
                length, score = match[1]
                score += best[end - length]
                if top is None or score > top:
                    top, count = score, pieces[end - length] + 1
                match = next(matches, None)
            char = part[end - 1]
            if char not in self._single:
                score = best[end - 1] + self._unknown
                if top is None or score > top:
                    width = len(char.encode("utf-8", "surrogatepass"))
                    top, count = score, pieces[end - 1] + width
            best[end], pieces[end] = top, count
        return pieces[size], best[size]

    def count(self, text: str | None) -> tuple[int, float]:
        """``(pieces, score)`` of a text after a space is set before it; (0, 0.0) if it is empty.

        No piece reaches across the start of a run of spaces, so the parts between are independent.
        """
        if not text:
            return 0, 0.0
        known, pieces, total = self._known, 0, 0.0
        for part in _parts(SPACE + text.replace(" ", SPACE)):
            found = known.get(part)
            if found is None:
                found = self._part(part)
                if len(part) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            pieces += found[0]
            total += found[1]
        return pieces, total


_parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall


@lru_cache(maxsize=2)
def vocabulary_file(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a sentencepiece model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in ids)


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(list(vocabulary_file(path)))


def token_counts(path: str):
    """A column function: ``struct(n_tokens, score)`` of a whole text; (0, 0.0) for NULL or empty."""
    shape = pa.struct([("n_tokens", pa.int64()), ("score", pa.float64())])

    @F.arrow_udf("struct<n_tokens: bigint, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        count = counter(path).count
        rows = [count(t) for t in texts.to_pylist()]
        return pa.array([{"n_tokens": n, "score": s} for n, s in rows], shape)

    return run
