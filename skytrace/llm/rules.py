"""Quality rules as a ledger of failure bits, with built-in column functions only.

Every rule is evaluated once for each text. The ledger keeps the measurements and one bit a failed
rule; a policy is a mask over those bits, so that policies are compared, versioned and taken apart
without reading the texts again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import column

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, "[ \\t-\\r]+")).otherwise(F.array())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column, n_words: Column) -> Column:
    """Words that lie in a window found twice or more in the text.

    Windows are compared by hash. Only where some hash comes twice are they sorted with their
    places; the places that share a hash, in order, then each cover the words up to the next one.
    """

    def joined(reach: int) -> Callable[[Column], Column]:
        return lambda h: F.zip_with(
            h, F.slice(h, reach + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)
        )

    def windows(words: Column) -> Column:  # of 2, 4, 8 words; the last ones are not whole
        hashes = F.transform(words, lambda word: F.xxhash64(word))
        for reach in (1, 2, 4):
            hashes = _let(hashes, joined(reach))
        return F.slice(hashes, 1, n_words - (WINDOW - 1))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        shared = _let(
            placed,
            lambda p: F.transform(
                F.filter(
                    F.zip_with(
                        p,
                        F.zip_with(
                            F.concat(F.slice(p, 2, F.size(p)), F.array(F.lit(None))),
                            F.concat(F.array(F.lit(None)), F.slice(p, 1, F.size(p) - 1)),
                            lambda b, a: F.struct(b["h"].alias("b"), a["h"].alias("a")),
                        ),
                        lambda x, y: F.when((x["h"] == y["a"]) | (x["h"] == y["b"]), x["i"]),
                    ),
                    lambda i: i.isNotNull(),
                ),
                lambda i: i,
            ),
        )
        return _let(
            F.array_sort(shared),
            lambda at: F.aggregate(
                F.zip_with(
                    at,
                    F.slice(at, 2, F.size(at)),
                    lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
                ),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    repeats = _let(
        windows(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(n_words < WINDOW + 1, F.lit(0)).otherwise(repeats)


def measure(documents: DataFrame, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the measurements of each text; NULL counts as the empty text."""
    text = F.coalesce(column(documents, text_col), F.lit(""))
    base = documents.select(
        F.struct(*[column(documents, c) for c in keep]).alias("kept"), text.alias("text")
    )
    # A generator in between keeps the words from being split anew wherever they are used.
    split = base.select("kept", "text", F.explode(F.array(_words(F.col("text")))).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counted = split.select(
        "kept",
        "words",
        F.size("words").alias("n"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.char_length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        F.size(F.split("text", "\n")).alias("n_lines"),
    )
    whole = ("word_chars", "n_symbols", "n_dup_lines", "n_lines")
    return counted.select(
        "kept.*",
        F.col("n").cast("long").alias("n_words"),
        *[F.col(c).cast("long").alias(c) for c in whole],
        _repeated_words(F.col("words"), F.col("n")).cast("long").alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """A named test; true means that the text fails it."""

    name: str
    fails: str


#: Bit i of the ledger is rule i; rules are only ever appended, so that old ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "20 * n_symbols > word_chars"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
)
BASE = ("few_words", "repeated_windows")
#: Policies by version: the rules whose failure rejects a text.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}


def mask(names: tuple[str, ...]) -> int:
    known = [rule.name for rule in RULES]
    return sum(1 << known.index(name) for name in names)


def ledger(documents: DataFrame, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """A row for each row of ``documents``: ``keep``, the measurements and ``failed`` bits."""
    bits = [f"IF({rule.fails}, {1 << i}L, 0L)" for i, rule in enumerate(RULES)]
    return measure(documents, text_col=text_col, keep=keep).withColumn(
        "failed", F.expr(" | ".join(bits))
    )


def verdict(policy: str) -> Column:
    """Does a ledger row pass a policy?"""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """By rule of a policy: texts that fail it, and texts that only it rejects.

    The ledger is counted by its bits first, so at most ``2 ** len(RULES)`` rows go on.
    """
    own = mask(POLICIES[policy])
    counted = entries.groupBy(
        F.col("failed").bitwiseAND(F.lit(own).cast("long")).alias("failed")
    ).agg(F.count("*").alias("texts"))
    rules = [(r.name, 1 << i) for i, r in enumerate(RULES) if own >> i & 1]
    sides = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in rules])
    each = counted.withColumn("r", F.explode(sides))
    hit = F.col("failed").bitwiseAND(F.col("r.bit").cast("long")) != 0
    alone = F.col("failed") == F.col("r.bit")
    return each.groupBy("r.rule").agg(
        F.sum(F.when(hit, F.col("texts")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("texts")).otherwise(0)).alias("n_only"),
    )
