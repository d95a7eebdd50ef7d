"""Helpers that several operators of this package share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.operators.lineage import ensure_checkpoint_dir, stored

__all__ = ["column", "fold", "fresh", "labelled_sample", "logistic", "read", "scratch", "stored", "utf8"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of checkpoints, which every executor reaches."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Python workers get batches of about this size, so that a task holds little beside its own state.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit what goes to a Python worker at once, by Spark's own setting; a longer row goes alone."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("-1", "67108864b", "64MB"):  # unless the user has set it
        spark.conf.set(name, f"{BATCH_BYTES}b")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return df[f"`{name}`"]


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; NULL for a NULL id."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without copying, and its row offsets; NULL counts as empty."""
    if values.null_count:
        values = values.fill_null("")
    large = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[values.offset : values.offset + len(values) + 1].astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression, by Newton's method.

    A step is halved until it lowers the penalised loss as its slope promises, so the loss falls to
    its one minimum from anywhere. An error is raised if the gradient there is not next to nothing.
    """
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = ridge * weight.sum() * np.eye(design.shape[1])
    penalty[0, 0] = 0.0

    def loss(beta: np.ndarray) -> float:
        z = design @ beta
        return float(weight @ (np.logaddexp(0.0, z) - y * z) + beta @ penalty @ beta / 2)

    beta = np.zeros(design.shape[1])
    now = loss(beta)
    for _ in range(500):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -700, 700)))
        slope = design.T @ (weight * (p - y)) + penalty @ beta
        if np.abs(slope).max() <= 1e-9 * weight.sum():
            return beta
        curve = weight * p * (1.0 - p) + 1e-9
        step = np.linalg.solve(design.T @ (design * curve[:, None]) + penalty, slope)
        size = 1.0
        while (then := loss(beta - size * step)) > now - 1e-4 * size * (slope @ step) and size > 1e-12:
            size /= 2
        if not then < now:  # as low as doubles can tell, or not a number
            break
        beta, now = beta - size * step, then
    if not np.abs(slope).max() <= 1e-5 * weight.sum():
        raise ArithmeticError("the logistic regression did not converge")
    return beta


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    id_col: str,
    text_col: str,
    rows_per_class: int,
    max_chars: int,
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """``(texts with labels, number of labelled documents by class)`` for fitting a model.

    Per class, ``rows_per_class`` labelled ids of least hash; of their documents those of at most
    ``max_chars`` characters. So at most ``2 * rows_per_class`` short texts reach the driver. Ids
    with contradicting labels count as their smaller label; a repeated document counts once.
    """
    marked = (
        labels.select(column(labels, id_col).alias("id"), column(labels, label).alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("id")
        .agg(F.min("y").cast("int").alias("y"))
    )
    totals = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    picked = [
        marked.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        for y in (0, 1)
    ]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * rows_per_class rows at most
    rows = (
        documents.select(
            column(documents, id_col).alias("id"), column(documents, text_col).alias("text")
        )
        .filter(F.char_length("text") <= max_chars)
        .join(chosen, "id")
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.first("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(2 * rows_per_class)
        .collect()
    )
    return [(r["text"], r["y"]) for r in rows], totals
