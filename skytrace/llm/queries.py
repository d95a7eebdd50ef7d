"""The numbered queries: each operator over its whole table, with the digests their results carry."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import (
    bpe,
    grammar,
    html_text,
    lexical,
    packing,
    prefix_trie,
    quality,
    rules,
    simhash,
    suffixes,
    toxicity,
    unigram,
    vectors,
)
from skytrace.llm.common import fold, read, scratch, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def fitted_quality(spark: SparkSession, documents: DataFrame, sf_dir: str) -> quality.QualityModel:
    """The production classifier, fitted on labels whose id's crc32 modulo 3 is not 1."""
    labels = read(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 3) != 1)
    return quality.fit_quality(documents, labels)


def fitted_toxicity(
    spark: SparkSession, documents: DataFrame, sf_dir: str
) -> toxicity.ToxicityModel:
    """The production lexicon and curve, fitted on labels whose id's crc32 modulo 5 is not 0."""
    labels = read(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    return toxicity.fit_toxicity(documents, labels)


def _scored(documents: DataFrame, score, held_out) -> DataFrame:
    """A NULL id is in no fold, so such a row is not held out."""
    return documents.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score("text").alias("score")
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = fitted_quality(spark, documents, sf_dir)
    return _scored(documents, quality.quality_score(model), fold(F.col("doc_id"), 3) == 1)


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and ``text``: what stays, without bytes of characters cut apart."""
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    cut = suffixes.without_repeats(documents, kept="kept", n_spans="n_spans", as_text="kept_text")
    return cut.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).alias("n_removed"),
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        F.col("kept_text").alias("text"),
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    both = read(spark, sf_dir, "documents").select(
        "doc_id", bpe.round_trip(*vocabulary)("text").alias("both")
    )
    return both.select("doc_id", "both.*").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "pages")
        .select("page_id", "url", html_text.extract()("html").alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )


@query
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(read(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = fitted_toxicity(spark, documents, sf_dir)
    return _scored(documents, toxicity.toxicity_score(model), fold(F.col("doc_id"), 5) == 0)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = rules.ledger(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rules.verdict("base")).alias("base_failed"),
        rules.verdict("v2").alias("kept"),
        "failed",
    )


@query
def rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, stored once, and what each rule of each policy rejects, counted from its bits."""
    entries = stored(rules.ledger(read(spark, sf_dir, "documents"), keep=["doc_id"]), "rules-ledger")
    return reduce(
        DataFrame.unionByName,
        [
            rules.ablation(entries, policy).select(F.lit(policy).alias("policy"), "*")
            for policy in rules.POLICIES
        ],
    )


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = unigram.token_counts(public_tokenizers.path("piece_bpe_32k.model"))
    return (
        read(spark, sf_dir, "documents")
        .select("doc_id", counts("text").alias("c"))
        .select("doc_id", "c.n_tokens", "c.score")
    )


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-grammar")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    grammar.write(read(spark, sf_dir, "documents"), path, tokenizer, public_tokenizers.PATTERN)
    return grammar.documents_of(grammar.read_shards(spark, path))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefix_trie.turns_of(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_openings(turns, convs))


# Measurements of the quality rules, and a bit for each that fails.
_JUDGED = r"""base AS (
            SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   string_split(coalesce(text, ''), chr(10)) AS all_lines
            FROM documents
        ), places AS (
            SELECT row_no, i, list_slice(w, i, i + 7) AS win
            FROM (SELECT row_no, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) > 8)
        ), twice AS (
            SELECT row_no, i FROM places
            QUALIFY count(*) OVER (PARTITION BY row_no, win) > 1
        ), reach AS (
            SELECT row_no, least(8, coalesce(lead(i) OVER (PARTITION BY row_no ORDER BY i) - i, 8)) AS n
            FROM twice
        ), covered AS (
            SELECT row_no, sum(n) AS n FROM reach GROUP BY row_no
        ), measured AS (
            SELECT row_no, doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT)
                       AS n_symbols,
                   list_filter(all_lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS worded,
                   len(all_lines) AS n_lines
            FROM base
        ), counted AS (
            SELECT m.* EXCLUDE (worded, row_no),
                   CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
            FROM measured m LEFT JOIN covered c USING (row_no)
        ), judged AS (
            SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT)
                      + 4 * CAST(20 * n_symbols > word_chars AS BIGINT)
                      + 8 * CAST(2 * n_dup_lines > n_lines AS BIGINT)
                      + 16 * CAST(word_chars < 2 * n_words AS BIGINT)
                      + 32 * CAST(word_chars > 25 * n_words AS BIGINT) AS failed
            FROM counted
        )"""

ORACLES = {
    "op7_nearest_vectors": """
        WITH v AS (
            SELECT vec_id, row_number() OVER () AS row_no, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), ranked AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
                   row_number() OVER (PARTITION BY q.row_no
                       ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
            FROM v q JOIN v c ON q.row_no <> c.row_no AND len(q.e) = len(c.e)
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op9_quality_rules": f"""
        WITH {_JUDGED}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
        FROM judged
    """,
    "rules_ablation": f"""
        WITH {_JUDGED}, rules(rule, bit) AS (
            VALUES ('few_words', 1), ('repeated_windows', 2), ('many_symbols', 4),
                   ('repeated_lines', 8), ('short_words', 16), ('long_words', 32)
        ), policies(policy, mask) AS (VALUES ('base', 3), ('v1', 15), ('v2', 63))
        SELECT policy, rule, CAST(count(*) FILTER (failed & bit <> 0) AS BIGINT) AS n_failed,
               CAST(count(*) FILTER (failed & mask = bit) AS BIGINT) AS n_only
        FROM policies, rules, judged WHERE mask & bit <> 0
        GROUP BY policy, rule
    """,
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT row_no, doc_id, unnest(w) AS term, len(w) AS n
            FROM (
                SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
                FROM documents
            )
        ), asked AS (
            SELECT DISTINCT item_no, item_id, unnest(w) AS term
            FROM (
                SELECT row_number() OVER () AS item_no, item_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
                FROM benchmark
            )
        ), corpus AS (
            SELECT count(DISTINCT row_no) AS documents, count(*) AS total FROM words
        ), postings AS (
            SELECT row_no, doc_id, term, n, count(*) AS tf FROM words GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, corpus GROUP BY term, documents
        ), scored AS (
            SELECT item_no, item_id, row_no, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // total))))
                        AS BIGINT) AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus
            GROUP BY item_no, item_id, row_no, doc_id
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scored WHERE score > 0
        )
        WHERE rank <= 10
    """,
    "op13_conversation_trie": """
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
                   {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
                   xor(4294967295::UBIGINT, list_reduce(
                       list_prepend(4294967295::UBIGINT, list_transform(
                           string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), range(8)::UBIGINT[]),
                           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT)
                                        ELSE x >> 1 END))) % 9 AS h
            FROM turns GROUP BY conv_id
        ), plan AS (
            SELECT c.conv_id, c.base, CASE WHEN c.base = c.conv_id THEN 0 ELSE c.h END AS skip,
                   CASE WHEN c.base = c.conv_id THEN 0 ELSE least(c.h, coalesce(b.n, 0)) END AS lead_n
            FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
        ), rebuilt AS (
            SELECT conv_id, place - skip + lead_n AS place, said
            FROM turns JOIN plan USING (conv_id) WHERE place >= skip
            UNION ALL
            SELECT p.conv_id, t.place, t.said
            FROM plan p JOIN turns t ON t.conv_id = p.base AND t.place < p.lead_n
        ), whole AS (
            SELECT p.conv_id, coalesce(list(said ORDER BY place) FILTER (place IS NOT NULL), []) AS path
            FROM plan p LEFT JOIN rebuilt r USING (conv_id) GROUP BY p.conv_id
        ), prefixes AS (
            SELECT conv_id, d, path[1:d] AS path, d = len(path) AS ends
            FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM whole)
        ), nodes AS (
            SELECT path, d, min(conv_id) AS conv_id, count(*) AS n,
                   string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
            FROM prefixes GROUP BY path, d
        ), below AS (
            SELECT path[1:d - 1] AS path, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1
        ), counted AS (
            SELECT n.*, coalesce(b.children, 0) AS children,
                   CASE WHEN d = 0 THEN 0 ELSE (n.n - 1) * strlen(n.path[d].text) END AS own
            FROM nodes n LEFT JOIN below b USING (path)
        ), sums AS (
            SELECT path[1:a] AS path, count(*) FILTER (children = 0) AS leaves, sum(own) AS saved
            FROM (SELECT path, children, own, unnest(range(d + 1)) AS a FROM counted) GROUP BY 1
        )
        SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs,
               c.children AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
               sha256(coalesce(c.ids, '')) AS ends_sha256
        FROM counted c JOIN sums s USING (path)
        LEFT JOIN nodes p ON c.d > 0 AND p.path = c.path[1:c.d - 1] AND p.d = c.d - 1
    """,
}
