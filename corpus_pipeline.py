"""From raw documents to training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skytrace.llm import packing, quality, simhash, suffixes, toxicity
from skytrace.llm.common import read, small_batches, stored
from skytrace.llm.queries import fitted_quality, fitted_toxicity


#: Bytes of the strings that the suffix stage takes out. Passages of 50 words and more are to go; of the
#: stretches of 51 words in the test documents some 98 in 100 are longer than this.
PASSAGE_BYTES = 256


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier calls good.

    Each row is judged by its whole text alone, so repeated rows stay or go together; NULL and empty
    texts are scored like any other; columns stay as they are. This holds for the next stage, too.
    """
    return quality.quality_filter(docs, fitted_quality(spark, docs, sf_dir))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not called toxic; fitted on the labelled ones that came this far."""
    return toxicity.toxicity_filter(docs, fitted_toxicity(spark, docs, sf_dir))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of least id, of equal ones any.

    Texts without words are near-duplicates of each other, NULL among them.
    """
    small_batches(spark)
    return simhash.simhash_dedup(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``PASSAGE_BYTES`` bytes or more that they share.

    No row goes; a text may become empty. NULL stays NULL, repeated rows are copies of each other.
    """
    small_batches(spark)
    return suffixes.suffix_dedup(docs, length=PASSAGE_BYTES)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence; empty texts have one piece."""
    small_batches(spark)
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
