"""The registered queries against SQL, and the pipeline against its stages one by one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from awkward import AWKWARD
from oracle import compare, connect
from skytrace.llm import simhash, suffixes
from skytrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None


def test_one_query_an_operator():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_repeats_of_the_registered_query(spark):
    from test_duplicates import _without_repeats

    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op3_suffix_array_dedup"](spark, SF).collect()}
    expected = _without_repeats([r["text"] for r in texts], 400)
    for row, (kept, spans, digest) in zip(texts, expected, strict=True):
        own = rows[row["doc_id"]]
        assert own["n_bytes"] == len((row["text"] or "").encode())
        assert (own["n_bytes"] - own["n_removed"], own["n_spans"]) == (kept, spans)
        assert own["kept_sha256"] == digest


def test_components_of_the_registered_query(spark):
    from test_duplicates import _fingerprint, _least_reachable

    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = {r["doc_id"]: _fingerprint(r["text"]) for r in texts}
    roots = _least_reachable(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()}


def test_stages_keep_the_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = docs
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns
        counts.append(kept.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4]
    prints = [simhash.fingerprint(r["text"]) for r in docs.collect()]
    assert counts[3] <= len(set(prints))
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    whole = corpus_pipeline.run(spark, SF)
    rows = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(last.select(*rows).collect()) == sorted(whole.select(*rows).collect())
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in kept.collect()}


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in ([], list(enumerate(AWKWARD)) + [(None, None), (3, "three")]):
        docs = spark.createDataFrame(
            [(i, t, None, None, None) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            assert stage(spark, docs, SF).count() <= len(rows)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert packed.select("doc_id").distinct().count() == len({i for i, _ in rows})
    assert suffixes.suffix_dedup(docs).count() == len(rows)
