"""Ranked lexical search by NRA: impact-sorted lists, read in order, with score intervals.

Documents are split into shards of bounded size. In a shard each term of the queries has a list of
the documents that hold it, the one with the greatest impact first. NRA ("no random access", Fagin,
Lotem and Naor, 2001) reads a query's lists from the top, a stretch of each at a time, and keeps for
each document it has met

- a lower score: the sum of the impacts read, and
- an upper score: that, and for each list where the document has not come up the impact at which
  reading has arrived, unless that lies below the least impact the document could have there (one
  occurrence, at the document's length): then it does not hold the term.

A document that has not come up at all scores no more than the sum of the impacts at which reading has
arrived. Reading goes on until no document outside the best k can reach the k-th best lower score and
the scores of all that can tie with it are settled, that is, lower equals upper. So ties and final
scores are exact. The k-th best score that a task knows already is kept for its next shard. Tasks
give their best k a query, which are merged.

Statistics (documents, terms, documents a term) cover the whole corpus; the lists are stored once, as
the query terms of each document, and read twice: for the statistics and for the search.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytrace.llm.common import column, small_batches, stored, utf8

#: Postings and documents after which a shard of documents is closed.
SHARD_POSTINGS, SHARD_DOCUMENTS = 1 << 20, 1 << 13
#: Query terms that are sent to the tasks at a time; more queries are searched in several passes.
PASS_TERMS = 1 << 18
#: First number of postings read from each list; doubled from step to step.
FIRST_READ = 64
#: Letters, digits and all bytes beyond ASCII make terms; only A to Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text, in order, with repeats."""
    return text.translate(_TERM_BYTES).split()


def term_weight(documents: int, holding: int) -> int:
    """The weight of a term that ``holding`` of all ``documents`` with terms hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with ``n`` terms: 10, and 90 times their length by the mean length."""
    return 10 + 90 * n * documents // total


def _impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _postings(vocabulary: dict[bytes, int]):
    """mapInArrow function from ``(doc_id, text)`` to ``doc_id, n, terms, tfs`` (query terms only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            data, offsets = data.tobytes(), offsets.tolist()
            lengths, ids, counts, ends = [], [], [], [0]
            for a, b in zip(offsets, offsets[1:], strict=False):
                words = terms(data[a:b])
                found = Counter(words)
                lengths.append(len(words))
                own = found.keys() & known
                ids.extend(map(vocabulary.__getitem__, own))
                counts.extend(map(found.__getitem__, own))
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


class Shard:
    """Impact-sorted lists of some documents, with the documents in the order of their ids."""

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights):
        self.m = m
        impact = _impacts(weights[term], tf, m[doc])
        order = np.argsort((term << 36) | ((1 << 36) - 1 - impact))  # an impact is below 2 ** 36
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.terms, self._first = np.unique(term, return_index=True)
        self._end = np.append(self._first[1:], len(term))
        self._weights = weights

    def lists(self, wanted: np.ndarray) -> list[tuple[int, int, int]]:
        """``(weight, from, to)`` of the lists of wanted terms that are not empty or worth nothing."""
        at = np.searchsorted(self.terms, wanted)
        found = at < len(self.terms)
        found[found] = self.terms[at[found]] == wanted[found]
        return [
            (int(w), int(a), int(b))
            for w, a, b in zip(
                self._weights[wanted[found]], self._first[at[found]], self._end[at[found]], strict=True
            )
            if w > 0
        ]

    def best(
        self, wanted: np.ndarray, k: int, known: int = 1, size: int = FIRST_READ
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """``(documents, scores, postings read)``: all documents that may be among the best k.

        Exact scores of every document that scores at least the k-th best, and at least ``known``.
        The first step reads ``size`` postings of each list, each later one twice as many.
        """
        lists = self.lists(wanted)
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        weight, at, end = (np.array(x) for x in zip(*lists, strict=True))
        begin = at.copy()
        low = np.zeros(len(self.m), np.int64)
        seen = np.zeros((len(lists), len(self.m)), bool)
        while True:
            for i in np.flatnonzero(at < end).tolist():
                stop = min(int(at[i]) + size, int(end[i]))
                docs = self.doc[at[i] : stop]
                low[docs] += self.impact[at[i] : stop]  # a list names a document once
                seen[i, docs] = True
                at[i] = stop
            size *= 2
            bar = known
            if len(low) >= k:
                bar = max(known, int(np.partition(low, len(low) - k)[len(low) - k]))
            # What is still to come on a list is at most the impact read last.
            arrived = np.where(at < end, self.impact[at - 1], 0)
            unread = int(arrived.sum())
            if unread >= bar:
                continue  # a document that has not come up may still be among the best
            docs = np.flatnonzero(low >= bar - unread)
            rest = np.where(seen[:, docs], 0, arrived[:, None])
            rest[rest < weight[:, None] * (1_000_000_000 // (1000 + 8 * self.m[docs]))] = 0
            high = low[docs] + rest.sum(0)
            docs, high = docs[high >= bar], high[high >= bar]
            if (high == low[docs]).all():
                return docs, low[docs], int((at - begin).sum())


def _search(
    queries: list[tuple[int, np.ndarray]],
    weights: np.ndarray,
    documents: int,
    total: int,
    k: int,
    shard_documents: int,
):
    """mapInArrow function from stored postings to ``query, doc_id, score``: the task's best k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bool, int]]] = {q: [] for q, _ in queries}
        bars = dict.fromkeys(best, 1)

        def shard(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts).combine_chunks()
            ids = rows.column(0).to_pylist()
            n = np.asarray(rows.column(1))
            lists = [rows.column(i).chunk(0) for i in (2, 3)]
            doc = np.repeat(np.arange(len(ids)), np.asarray(lists[0].value_lengths()))
            term, tf = (np.asarray(x.flatten()).astype(np.int64) for x in lists)
            own = Shard(length_factor(n, documents, total), doc, term, tf, weights)
            for query, wanted in queries:
                docs, scores, _ = own.best(wanted, k, bars[query])
                if not len(docs):
                    continue
                # Ties go to the smaller id, rows without an id come last.
                found = best[query] + [
                    (-s, ids[d] is None, ids[d] or 0)
                    for d, s in zip(docs.tolist(), scores.tolist(), strict=True)
                ]
                best[query] = sorted(found)[:k]
                if len(best[query]) == k:
                    bars[query] = -best[query][-1][0]

        waiting, postings, rows = [], 0, 0
        for batch in batches:
            sizes = np.asarray(batch.column(2).value_lengths(), np.int64)
            at = 0
            for i, size in enumerate(sizes.tolist()):
                postings, rows = postings + size, rows + 1
                if postings >= SHARD_POSTINGS or rows >= shard_documents:
                    waiting.append(batch.slice(at, i + 1 - at))
                    shard(waiting)
                    waiting, postings, rows, at = [], 0, 0, i + 1
            if at < len(batch):
                waiting.append(batch.slice(at))
        if waiting:
            shard(waiting)
        found = [(q, None if none else d, -s) for q, own in best.items() for s, none, d in own]
        for part in range(0, len(found), 1 << 16):
            columns = zip(*found[part : part + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"]
            )

    return run


def _passes(queries: list[tuple[int, list[bytes]]]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Queries in groups of ``PASS_TERMS`` terms, or a single larger one."""
    group, size = [], 0
    for query, own in queries:
        if group and size + len(own) > PASS_TERMS:
            yield group
            group, size = [], 0
        group.append((query, own))
        size += len(own)
    if group:
        yield group


def _one_pass(
    documents: DataFrame, group: list[tuple[int, list[bytes]]], k: int, shard_documents: int
) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in group for t in own}))}
    lists = stored(
        documents.mapInArrow(
            _postings(vocabulary), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
        ),
        "lexical-postings",
    ).filter("n > 0")
    corpus = lists.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    # A row for each query term of this pass, PASS_TERMS at most unless one query has more.
    holding = np.zeros(len(vocabulary), np.int64)
    for row in lists.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[row["t"]] = row["count"]
    weights = np.array([term_weight(corpus["documents"], int(df)) for df in holding], np.int64)
    wanted = [(q, np.array(sorted(vocabulary[t] for t in own), np.int64)) for q, own in group]
    run = _search(wanted, weights, corpus["documents"], corpus["total"] or 1, k, shard_documents)
    return lists.filter(F.size("terms") > 0).mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def search(
    documents: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    shard_documents: int = SHARD_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its k best documents, 1 the best.

    Only scores above 0 count, equal scores go to the smaller doc_id, rows without one come last; so
    an item may have fewer than k rows, or none if it has no terms. NULL texts have no terms. Whole
    texts of any length count. Each row of ``items`` is a query of its own, and each row of
    ``documents`` a document, repeated ones too. The items' texts are the query and are held by the
    driver, ``PASS_TERMS`` terms at a time; documents are not.
    """
    spark = documents.sparkSession
    small_batches(spark)
    id_type = column(documents, id_col)
    corpus = documents.select(id_type.cast("bigint").alias("doc_id"), column(documents, text_col).alias("text"))
    asked = items.select(column(items, item_col).alias("item_id"), column(items, item_text_col).alias("text"))
    rows = enumerate(asked.toLocalIterator())
    ids: list[tuple] = []

    def queries() -> Iterator[tuple[int, list[bytes]]]:
        for number, row in rows:
            ids.append((number, row["item_id"]))
            yield number, sorted(set(terms((row["text"] or "").encode())))

    found = None
    for group in _passes(queries()):
        own = stored(_one_pass(corpus, group, k, shard_documents), "lexical-found")
        found = own if found is None else found.unionByName(own)
    kind = asked.schema["item_id"].dataType.simpleString()
    names = spark.createDataFrame(ids, f"query bigint, item_id {kind}")
    if found is None:
        return names.filter("false").selectExpr(
            "item_id", "CAST(0 AS INT) AS rank", "query AS doc_id", "query AS score"
        )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
