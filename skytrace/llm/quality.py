"""Quality by compression: how much better does a dictionary of good text fit than one of bad?

Two zstandard dictionaries are built from labelled good and bad texts. A text is compressed with
each; the normalised difference of the two sizes, with the sizes themselves, goes through a
logistic curve fitted on other labelled texts, so that the score is a probability.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import column, fresh, labelled_sample, logistic

LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; about twice ``dictionary_bytes`` large, whatever the input."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...] = ()
    spread: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    prior: float = 0.5

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        x = (_features(texts, self.good, self.bad) - self.centre) / self.spread
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def _dictionary(texts: list[str], size: int) -> bytes:
    samples = [t.encode() for t in texts if t]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[-size:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    bare = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, **bare)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **bare)


def _features(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    sizes = np.empty((len(texts), 4))
    by_good, by_bad, plain = (_compressor(d).compress for d in (good, bad, b""))
    for i, text in enumerate(texts):
        data = (text or "").encode()
        sizes[i] = len(by_good(data)), len(by_bad(data)), len(plain(data)), len(data) + 1
    g, b, p, n = sizes.T
    x = np.stack(
        [(b - g) / np.maximum(b, g), g / n, b / n, p / n, np.log(n), (b - g) / n], axis=1
    )
    return np.hstack([x, x * x, x[:, :1] * x[:, 1:]])


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_class: int = 1500,
    max_chars: int = 20_000,
    dictionary_bytes: int = 65_536,
) -> QualityModel:
    """Fit on at most ``rows_per_class`` labelled texts of each class, none over ``max_chars``.

    Every other text goes into a dictionary, the rest into the calibration; classes are weighted by
    their share among all ``labels`` given. Without texts of both classes (empty tables, too few
    rows) every score is the share of good labels, 0.5 without labels.
    """
    sample, totals = labelled_sample(
        documents,
        labels,
        label,
        id_col=id_col,
        text_col=text_col,
        rows_per_class=rows_per_class,
        max_chars=max_chars,
    )
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    good, bad = ([t for t, y in sample if y == k] for k in (1, 0))
    if min(len(good), len(bad)) < 4:
        return QualityModel(b"", b"", prior=prior)
    dictionaries = (_dictionary(x[::2], dictionary_bytes) for x in (good, bad))
    model = QualityModel(*dictionaries, prior=prior)
    held = [good[1::2], bad[1::2]]
    y = np.repeat([1.0, 0.0], [len(held[0]), len(held[1])])
    weight = np.where(y == 1, prior / len(held[0]), (1 - prior) / len(held[1])) * len(y)
    x = _features(held[0] + held[1], model.good, model.bad)
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    beta = logistic((x - centre) / spread, y, weight, ridge=1e-4)
    return QualityModel(
        model.good, model.bad, tuple(centre), tuple(spread), tuple(map(float, beta)), prior
    )


def quality_score(model: QualityModel):
    """A column function: probability that a text is good. NULL counts as the empty text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts.to_pylist()), pa.float64())

    return score


def quality_filter(
    documents: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The rows whose score reaches ``threshold``, with the columns of ``documents`` unchanged.

    Each row is judged by itself: repeated rows all stay or all go, NULL and empty texts are scored
    like any other, an empty table stays empty.
    """
    name = fresh(documents, "score")
    scored = documents.withColumn(name, quality_score(model)(column(documents, text_col)))
    return scored.filter(F.col(name) >= threshold).drop(name)
