"""Toxicity by a learned lexicon, matched through Levenshtein automata.

The lexicon holds whole words and stems that mark toxic texts, with weights. It is a trie; each word
of a text is a Levenshtein automaton that walks the trie, so one walk finds all entries within the
edits an entry allows. A hit weighs less the more it is misspelled and, judged by the characters
around it, much less inside a quotation. A logistic curve turns the hits of a text into its score.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import column, fresh, labelled_sample, logistic

# What a hit keeps of its weight for each edit, in quotes, and when it is addressed.
PER_EDIT = 0.6
QUOTED = 0.25
ADDRESSED = 1.25
#: Characters on either side of a hit that tell quotation from abuse.
WINDOW = 48
QUOTES = re.compile("[\"“”„«»]")
REPORTING = re.compile(
    r"\b(said|says|quoted?|called|the word|the term|wrote|dit|écrit|mot|sagte|schrieb|wort|"
    r"dijo|escribió|palabra)\b"
)
ADDRESS = re.compile(r"\b(you|your|you're|tu|toi|vous|du|dich|ihr|tú|usted|eres)\b")
#: Characters may stand in for letters inside a word.
WORD = re.compile(r"\w(?:[\w*@$]*\w)?")
#: Words whose matches a task remembers before it starts anew.
REMEMBERED = 100_000


def edits_allowed(entry: str, stem: bool) -> int:
    """Short entries must be exact, since their neighbours are other words."""
    size = len(entry)
    return 0 if size < (7 if stem else 5) else 1 if size < 9 else 2


@dataclass(frozen=True)
class Lexicon:
    """Weights by entry; words that are known to be clean, though close to an entry."""

    words: dict[str, float]
    stems: dict[str, float]
    clean: frozenset[str] = frozenset()


class Matcher:
    """All entries' Levenshtein automata, run at once along the trie of the lexicon.

    A state is a set of (trie node, edits spent). States and their steps are kept as they turn up,
    so that a word costs a lookup a character until no entry can be reached any more.
    """

    def __init__(self, lexicon: Lexicon):
        self._clean = lexicon.clean
        self._children: list[dict[str, int]] = [{}]
        self._entries: list[list[tuple[float, int, bool]]] = [[]]
        self._most: list[int] = [0]  # the edits that some entry at or below a node allows
        for stem, entries in ((False, lexicon.words), (True, lexicon.stems)):
            for entry, weight in entries.items():
                allowed, node = edits_allowed(entry, stem), 0
                for char in entry:
                    self._most[node] = max(self._most[node], allowed)
                    if char not in self._children[node]:
                        self._children[node][char] = len(self._children)
                        self._children.append({})
                        self._entries.append([])
                        self._most.append(0)
                    node = self._children[node][char]
                self._most[node] = max(self._most[node], allowed)
                self._entries[node].append((weight, allowed, stem))
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, float] = {}
        self._steps: dict[tuple[int, str], int] = {}
        self._numbers: dict[frozenset, int] = {}
        self._states: list[frozenset] = []
        self._values: list[tuple[float, float]] = []  # of stems reached, of words that end here
        self._start = self._state({0: 0})

    def _state(self, spent: dict[int, int]) -> int:
        """The number of a state, after adding nodes reached when the entry has characters more."""
        todo = list(spent)
        while todo:
            node = todo.pop()
            edits = spent[node] + 1
            for child in self._children[node].values():
                if edits <= self._most[child] and edits < spent.get(child, edits + 1):
                    spent[child] = edits
                    todo.append(child)
        state = frozenset(spent.items())
        if state not in self._numbers:
            values = [0.0, 0.0]
            for node, edits in state:
                for weight, allowed, stem in self._entries[node]:
                    if edits <= allowed:
                        value = weight * PER_EDIT**edits
                        side = 0 if stem else 1
                        if value > abs(values[side]):
                            values[side] = -value if edits else value
            self._numbers[state] = len(self._states)
            self._states.append(state)
            self._values.append((values[0], values[1]))
        return self._numbers[state]

    def _step(self, state: int, char: str) -> int:
        spent: dict[int, int] = {}
        for node, edits in self._states[state]:
            reached = [(node, edits + 1)]  # the word has one more
            for other, child in self._children[node].items():
                reached.append((child, edits + (other != char)))
            for to, total in reached:
                if total <= self._most[to] and total < spent.get(to, total + 1):
                    spent[to] = total
        self._steps[state, char] = number = self._state(spent)
        return number

    def weight(self, word: str) -> float:
        """The largest weight of an entry that a word matches; below zero for a misspelled one."""
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= REMEMBERED or len(self._steps) >= REMEMBERED:
                self._forget()
            found = self._known[word] = self._walk(word)
        return found

    def _walk(self, word: str) -> float:
        state, steps, values = self._start, self._steps, self._values
        top = values[state][0]
        for char in word:
            following = steps.get((state, char))
            state = self._step(state, char) if following is None else following
            if not self._states[state]:
                break
            stem = values[state][0]
            if abs(stem) > abs(top):
                top = stem
        else:
            whole = values[state][1]
            if abs(whole) > abs(top):
                top = whole
        return 0.0 if top < 0 and word in self._clean else top

    def hits(self, text: str | None) -> list[tuple[float, bool]]:
        """``(weight in context, misspelled)`` of every hit in a whole text."""
        low = (text or "").lower()
        marked = {w for w in set(WORD.findall(low)) if self.weight(w)}
        if not marked:
            return []
        found = []
        for m in WORD.finditer(low):
            if m[0] in marked:
                weight = self.weight(m[0])
                found.append((abs(weight) * _context(low, m.start(), m.end()), weight < 0))
        return found


def _context(text: str, start: int, end: int) -> float:
    """How much a hit counts, from the window around it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    quoted = QUOTES.search(before) and QUOTES.search(after)
    if quoted and (len(QUOTES.findall(before)) % 2 or REPORTING.search(before)):
        return QUOTED
    return ADDRESSED if ADDRESS.search(before[-24:]) or ADDRESS.search(after[:24]) else 1.0


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon and calibration, both fitted on the bounded sample."""

    lexicon: Lexicon
    weights: tuple[float, ...] = ()
    prior: float = 0.0
    key: str = field(default="")

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        x = _features(texts, _matcher(self))
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


_MATCHERS: dict[str, Matcher] = {}


def _matcher(model: ToxicityModel) -> Matcher:
    if model.key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[model.key] = Matcher(model.lexicon)
    return _MATCHERS[model.key]


def _features(texts: list[str | None], matcher: Matcher) -> np.ndarray:
    x = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        hits = matcher.hits(text)
        if hits:
            exact = sum(w for w, misspelled in hits if not misspelled)
            near = sum(w for w, misspelled in hits if misspelled)
            x[i] = math.log1p(exact), math.log1p(near), max(w for w, _ in hits)
    return x


def _groups(texts: list[str]) -> list[int]:
    """A key by text that copies share: the least hash over its runs of four words."""
    keys = []
    for text in texts:
        words = text.lower().split()
        runs = {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
        keys.append(min(xxhash.xxh64_intdigest(r) for r in runs))
    return keys


def learn_lexicon(
    toxic: list[str], clean: list[str], *, lift: float = 25.0, support: float = 0.75
) -> Lexicon:
    """Words and stems that are ``lift`` times as frequent in toxic texts.

    Copies of a text count once. An entry must be in ``support * sqrt(n)`` of the n toxic texts,
    three at least, so that few texts don't make a lexicon of their chance words; a stem must start
    three words or more. Words that a stem covers stay entries too, as they allow more edits than it.
    """
    holders: list[dict[str, set[int]]] = []
    for texts in (toxic, clean):
        by_word: dict[str, set[int]] = defaultdict(set)
        for text, group in zip(texts, _groups(texts), strict=True):
            for word in set(WORD.findall(text.lower())):
                by_word[word].add(group)
        holders.append(by_word)
    in_toxic, in_clean = holders
    n_toxic, n_clean = (len(set().union(*h.values())) or 1 for h in holders)
    least = max(3.0, support * math.sqrt(n_toxic))

    def weight(hits: int, misses: int) -> float:
        ratio = (hits + 0.5) / (n_toxic + 1) / ((misses + 0.5) / (n_clean + 1))
        return math.log(ratio) if hits >= least and ratio >= lift else 0.0

    starts: dict[str, list[str]] = defaultdict(list)
    for word in in_toxic:
        for size in range(4, min(len(word), 9)):
            starts[word[:size]].append(word)
    holding = {
        prefix: len(set().union(*(in_toxic[w] for w in own)))
        for prefix, own in starts.items()
        if len(own) >= 3
    }
    impure = {w[:size] for w in in_clean for size in range(4, min(len(w) + 1, 9))}
    stems: dict[str, float] = {}
    for prefix in sorted(holding, key=len):
        if prefix in impure or any(prefix[:i] in stems for i in range(4, len(prefix))):
            continue
        value = weight(holding[prefix], 0)
        if not value or 2 * max(len(in_toxic[w]) for w in starts[prefix]) > holding[prefix]:
            continue  # rare, or one word and its neighbours
        longer = prefix
        while longer:  # as long as hardly any text is lost
            prefix, most = longer, 0.9 * holding[longer]
            letters = {w[len(prefix)] for w in starts[prefix] if len(w) > len(prefix)}
            longer = next((prefix + c for c in letters if holding.get(prefix + c, 0) >= most), "")
        stems[prefix] = value
    words = {
        word: value
        for word, groups in in_toxic.items()
        if len(word) >= 3
        and (value := weight(len(groups), len(in_clean.get(word, ()))))
    }
    near = Matcher(Lexicon(words, stems))
    return Lexicon(words, stems, frozenset(w for w in in_clean if near.weight(w) < 0))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_class: int = 2500,
    max_chars: int = 20_000,
) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled texts of each class, none over ``max_chars``.

    Classes are weighted by their share among all ``labels`` given. Without texts of both classes
    every score is the share of toxic labels, 0 without labels.
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
    prior = totals.get(1, 0) / sum(totals.values()) if totals else 0.0
    texts = {k: [t for t, y in sample if y == k and t] for k in (0, 1)}
    if min(map(len, texts.values())) < 4:
        return ToxicityModel(Lexicon({}, {}), prior=prior)
    lexicon = learn_lexicon(texts[1], texts[0])
    x = _features(texts[1] + texts[0], Matcher(lexicon))
    y = np.repeat([1.0, 0.0], [len(texts[1]), len(texts[0])])
    weight = np.where(y == 1, prior / len(texts[1]), (1 - prior) / len(texts[0])) * len(y)
    beta = logistic(x, y, weight, ridge=1e-4)
    shown = repr((sorted(lexicon.words.items()), sorted(lexicon.stems.items()), beta.tolist()))
    key = xxhash.xxh3_128_hexdigest(shown)
    return ToxicityModel(lexicon, tuple(map(float, beta)), prior, key)


def toxicity_score(model: ToxicityModel):
    """A column function: probability that a text is toxic. NULL counts as the empty text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts.to_pylist()), pa.float64())

    return score


def toxicity_filter(
    documents: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The rows whose score is below ``threshold``, with the columns of ``documents`` unchanged.

    Each row is judged by itself: repeated rows all stay or all go, NULL and empty texts are scored
    like any other, an empty table stays empty.
    """
    name = fresh(documents, "score")
    scored = documents.withColumn(name, toxicity_score(model)(column(documents, text_col)))
    return scored.filter(F.col(name) < threshold).drop(name)
