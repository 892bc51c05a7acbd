"""Toxicity by a lexicon whose misspellings count, and by the context of its terms.

The lexicon is learned from labelled documents: words and word beginnings that mark toxic
ones, chosen one by one so that each explains toxic documents the others do not. Terms go
into a trie, and trie and the terms' Levenshtein automata run side by side over the
different words of a block of texts at once, which says for each word which term it is
within how many edits.

A hit is judged in a window of words around it: hits close together strengthen each other,
quotation marks around it and reporting words near it mark a quotation and weaken it,
words that address the reader strengthen it. A logistic model of the summed window scores
turns them into a probability.

Null and empty texts have no hits. Without labelled rows of both classes the lexicon is
empty and every score is the prior. Repeated rows get equal scores.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ordermart.llm.common import Block, blocks, words
from ordermart.llm.samples import fold, labelled_sample

# Words that report speech, and words that address the reader.
REPORTING = (
    "called calls cited claimed quote quoted quotes quoting reported said saying says wrote "
    "citation cité dit écrit cita citado dijo escribió behauptete sagte schrieb zitat zitiert"
).split()
ADDRESSING = "you your youre u tu te toi vous votre du dich dir dein ihr euch usted tú".split()
QUOTES = "\"“”„«»‹›"

WINDOW = 8
QUOTED, REPORTED, ADDRESSED, NEAR, MISSPELLED = 0.3, 0.5, 1.25, 0.25, 0.6
BEGINNINGS = (4, 5, 6)
COVER = 3
# Toxic sample texts that a further term has to explain, and that have to hold it.
LEAST_GAIN, LEAST_HOLDERS = 2, 3
# Log ratio, less two standard errors, of a term beyond doubt.
SURE = 3.5
# Share of harmless texts with near misses of a term above which they are ordinary words.
ORDINARY = 0.001
THRESHOLD = 0.7
FEATURES = 3
# Words that run at once, and trie nodes in the states kept between them.
RUN_WORDS = 2048
KEPT_NODES = 1_000_000


@dataclass(frozen=True)
class Term:
    form: str
    beginning: bool  # any word that begins so is a hit
    strength: float  # 1 for terms that mark toxic texts without doubt
    edits: int = 0  # by which a word may miss the term


def usual_edits(form: str) -> int:
    """Edits to try, by length alone: whether the sample allows them is seen in harmless texts."""
    if len(form) < 4:
        return 0
    return 1 if len(form) < 9 else 2


NONE = (99, -1)


class Automaton:
    """Trie of the terms intersected with their Levenshtein automata, as far as words lead.

    A state is the set of trie nodes a word may have reached, each with the edits spent, and
    the best beginning met so far, by its edits. It absorbs once no fewer edits can come.
    State 0 is dead, 1 the start. A step is worked out when a word first takes it, so the
    terms may be many: the whole automaton is never made. Once the states hold more than
    ``KEPT_NODES`` nodes they are forgotten and made anew as words need them.
    """

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.budget = [0]
        for number, term in enumerate(terms):
            node, edits = 0, term.edits
            self.budget[0] = max(self.budget[0], edits)
            for letter in term.form:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.budget.append(0)
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], edits)
            self.ends[node].append(number)
        # Letters are classes; 0 are those of no term.
        self.letters = [None, *sorted({c for t in terms for c in t.form})]
        self.alphabet = {letter: k for k, letter in enumerate(self.letters) if k}
        self.classes = np.zeros(0x110000, dtype=np.uint8 if len(self.letters) < 256 else np.int32)
        for letter, number in self.alphabet.items():
            self.classes[ord(letter)] = number
        # Letters after which nothing is decided any more.
        self.depth = max((len(t.form) + t.edits for t in terms), default=0)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.others: dict[int, int] = {}
        self.nodes = 0
        # Accepted term or -1, edits, and whether the state absorbs.
        self.outcome = np.zeros((1024, 3), np.int32)
        # Steps by state and letter class, sorted, and where they lead.
        self.known, self.target = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self._number((frozenset(), NONE))
        self._number(self._state({0: 0}, NONE))

    def _accepted(self, nodes: frozenset, beginning: bool) -> tuple[int, int]:
        best = NONE
        for node, spent in nodes:
            for number in self.ends[node]:
                if self.terms[number].beginning == beginning and spent <= self.terms[number].edits:
                    best = min(best, (spent, number))
        return best

    def _state(self, reached: dict[int, int], opening: tuple[int, int]) -> tuple:
        # Nodes reached by letters the word leaves out, with the fewest edits of each.
        todo = list(reached.items())
        while todo:
            node, spent = todo.pop()
            for child in self.children[node].values():
                if spent + 1 <= self.budget[child] and reached.get(child, 99) > spent + 1:
                    reached[child] = spent + 1
                    todo.append((child, spent + 1))
        nodes = frozenset(reached.items())
        opening = min(opening, self._accepted(nodes, True))
        # Nodes that spent as much can only lead to whole words, which a beginning outweighs.
        return (frozenset(x for x in nodes if x[1] < opening[0]), opening)

    def _number(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            nodes, opening = state
            spent, term = opening if opening[1] >= 0 else self._accepted(nodes, False)
            if number == len(self.outcome):
                self.outcome = np.concatenate((self.outcome, np.zeros_like(self.outcome)))
            self.outcome[number] = term, spent if term >= 0 else 0, opening[1] >= 0 and not nodes
            self.states.append(state)
            self.nodes += len(nodes)
        return number

    def _follow(self, number: int, letter: str | None) -> int:
        nodes, opening = self.states[number]
        if letter is None or not any(letter in self.children[node] for node, _ in nodes):
            # A letter that leads on from no node is as any other.
            if number in self.others:
                return self.others[number]
            letter = None
        reached: dict[int, int] = {}
        for node, spent in nodes:
            if spent + 1 <= self.budget[node] and reached.get(node, 99) > spent + 1:
                reached[node] = spent + 1  # a letter too many
            for label, child in self.children[node].items():
                cost = spent + (label != letter)
                if cost <= self.budget[child] and reached.get(child, 99) > cost:
                    reached[child] = cost
        following = self._number(self._state(reached, opening))
        if letter is None:
            self.others[number] = following
        return following

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """States that follow on letter classes."""
        width = len(self.letters)
        taken = state.astype(np.int64) * width + letter
        at = np.searchsorted(self.known, taken)
        new = np.append(self.known, -1)[at] != taken
        if new.any():
            fresh = np.unique(taken[new])
            leads = [self._follow(int(k) // width, self.letters[int(k) % width]) for k in fresh]
            where = np.searchsorted(self.known, fresh)
            self.known, self.target = np.insert(self.known, where, fresh), np.insert(self.target, where, leads)
            at = np.searchsorted(self.known, taken)
        return self.target[at]


def run_words(
    automaton: Automaton, letters: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Term that every word is within the edits of, or -1, and its edits."""
    term, edits = np.full(len(start), -1, np.int32), np.zeros(len(start), np.int32)
    for low in range(0, len(start), RUN_WORDS):
        if automaton.nodes > KEPT_NODES:
            automaton.forget()
        alive = np.arange(low, min(low + RUN_WORDS, len(start)))
        state = np.ones(len(alive), dtype=np.int32)
        for place in range(automaton.depth + 2):
            stop = (start[alive] + place >= end[alive]) | (automaton.outcome[state, 2] > 0)
            term[alive[stop]], edits[alive[stop]] = automaton.outcome[state[stop], :2].T
            alive, state = alive[~stop], state[~stop]
            if not len(alive):
                break
            state = automaton.step(state, letters[start[alive] + place])
            alive, state = alive[state > 0], state[state > 0]
    return term, edits


@dataclass
class Lexicon:
    terms: list[Term]
    weights: np.ndarray
    bias: float


def found_terms(block: Block, automaton: Automaton) -> tuple:
    """Words of a block, its characters, their bounds, and every word's term and edits."""
    found = words(block)
    passed = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    text = found.lowered.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    start, end = passed[found.start], passed[found.end]
    # Each different word runs once.
    _, one, same = np.unique(found.hashes(), return_index=True, return_inverse=True)
    term, edits = run_words(automaton, automaton.classes[points], start[one], end[one])
    return found, passed, text, points, start, end, term[same], edits[same]


def window_scores(block: Block, automaton: Automaton) -> np.ndarray:
    """A row of ``FEATURES`` sums for every text of the block.

    Hits outside quotations, hits inside, and hits outside of the densest window.
    """
    out = np.zeros((len(block), FEATURES))
    if not automaton.terms:
        return out
    found, passed, text, points, start, end, term, edits = found_terms(block, automaton)
    hit = np.flatnonzero(term >= 0)
    if not len(hit):
        return out
    row = found.row[hit]
    value = np.array([t.strength for t in automaton.terms])[term[hit]] * MISSPELLED ** edits[hit]
    marks = np.flatnonzero(np.isin(points, [ord(c) for c in QUOTES]))
    breaks = np.flatnonzero(points == 10)
    row_start = passed[block.bounds[row]]
    # Inside quotation: an odd number of marks since the line began, and one more to close it.
    line = np.searchsorted(breaks, start[hit])
    begin = np.maximum(row_start, np.where(line > 0, breaks[line - 1], 0) if len(breaks) else 0)
    before = np.searchsorted(marks, start[hit]) - np.searchsorted(marks, begin)
    stop = np.minimum(passed[block.bounds[row + 1]], np.append(breaks, len(points))[line])
    after = np.searchsorted(marks, stop) - np.searchsorted(marks, end[hit])
    quoted = (before % 2 == 1) & (after > 0)
    value *= np.where(quoted, QUOTED, 1.0)
    for k, position in enumerate(hit):
        low = max(found.first[row[k]], position - WINDOW)
        high = min(found.first[row[k] + 1], position + WINDOW + 1)
        near = [text[start[w] : end[w]] for w in range(low, high)]
        if any(w in REPORTING_SET for w in near):
            value[k] *= REPORTED
        if any(w in ADDRESSING_SET for w in near):
            value[k] *= ADDRESSED
    total = np.concatenate(([0.0], np.cumsum(value)))
    high = np.minimum(np.searchsorted(hit, hit + WINDOW, side="right"), np.searchsorted(row, row, side="right"))
    low = np.maximum(np.searchsorted(hit, hit - WINDOW), np.searchsorted(row, row))
    close = total[high] - total[low] - value
    value = value * (1 + NEAR * np.minimum(close, 4))
    np.add.at(out, (row[~quoted], 0), value[~quoted])
    np.add.at(out, (row[quoted], 1), value[quoted])
    np.maximum.at(out, (row[~quoted], 2), value[~quoted])
    return out


REPORTING_SET, ADDRESSING_SET = frozenset(REPORTING), frozenset(ADDRESSING)


def _forms(text: str) -> set[tuple[str, bool]]:
    """Words and word beginnings of a text."""
    block = next(blocks(pa.array([text])), None)
    if block is None:
        return set()
    found = words(block)
    lowered = found.lowered.tobytes()
    different = {lowered[a:b].decode("utf-8", "replace") for a, b in zip(found.start, found.end) if b - a < 64}
    forms = {(w, False) for w in different}
    return forms | {(w[:n], True) for w in different for n in BEGINNINGS if len(w) > n}


def _count_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        positive, negative = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("positive").to_pylist()):
            (positive if label else negative).update(_forms(text))
        every = list(positive | negative)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([form for form, _ in every], pa.string()),
                pa.array([beginning for _, beginning in every], pa.bool_()),
                pa.array([positive[form] for form in every], pa.int64()),
                pa.array([negative[form] for form in every], pa.int64()),
            ],
            ["form", "beginning", "positive", "negative"],
        )


def _which_forms(wanted: dict[tuple[str, bool], int]):
    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(wanted[f] for f in _forms(text) & wanted.keys()) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["forms"])

    return which


def near_misses(block: Block, automaton: Automaton) -> Iterator[set[int]]:
    """For every text the terms that a word of it misses by some edits."""
    found, *_, term, edits = found_terms(block, automaton)
    hit = np.flatnonzero((term >= 0) & (edits > 0))
    cuts = np.searchsorted(found.row[hit], np.arange(len(block) + 1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield set(term[hit[a:b]].tolist())


def _near_misses(terms: list[Term]):
    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for batch in batches:
            missed = [t for block in blocks(batch.column("text")) for own in near_misses(block, automaton) for t in own]
            yield pa.RecordBatch.from_arrays([pa.array(missed, pa.int32())], ["term"])

    return misses


def choose_terms(forms: list[tuple[str, bool]], negative: np.ndarray, holders: list[np.ndarray], n: int) -> list[int]:
    """Greedy cover: forms that explain toxic texts, each up to ``COVER`` times, and few others.

    ``holders`` are the numbers of the toxic texts of each form. Of forms that explain
    about as much a whole word, and then a longer form, is taken; beginnings of a chosen
    form and forms that begin with it are not looked at again.
    """
    left = np.full(n, COVER)
    favour = [1 + 0.01 * len(form) + 0.03 * (not beginning) for form, beginning in forms]
    number = {form: k for k, form in enumerate(forms)}
    ordered = sorted(forms)
    usable = np.ones(len(forms), dtype=bool)
    chosen: list[int] = []
    # Gains only fall: a form whose gain is up to date and still the best is chosen, and one
    # that does not gain the least is never looked at again.
    heap = [(-(len(h) - 2 * negative[k]) * favour[k], k, 0) for k, h in enumerate(holders)]
    heapq.heapify(heap)
    while heap:
        _, top, seen = heapq.heappop(heap)
        if not usable[top]:
            continue
        if seen < len(chosen) or not chosen:
            gain = float((left[holders[top]] > 0).sum()) - 2 * negative[top]
            if gain < LEAST_GAIN:
                continue
            if seen < len(chosen):
                heapq.heappush(heap, (-gain * favour[top], top, len(chosen)))
                continue
        chosen.append(top)
        usable[top] = False
        left[holders[top]] -= left[holders[top]] > 0
        word, beginning = forms[top]
        for k in range(1, len(word) + 1):
            opening = number.get((word[:k], True))
            if opening is not None:
                usable[opening] = False
        if beginning:
            at = bisect_left(ordered, (word, False))
            while at < len(ordered) and ordered[at][0].startswith(word):
                usable[number[ordered[at]]] = False
                at += 1
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.01) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps; the bias is not penalized."""
    design = np.hstack([x, np.ones((len(x), 1))])
    theta = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], penalty * max(weight.sum(), 1.0) / 100)
    ridge[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + ridge * theta
        hessian = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + np.diag(ridge)
        move = np.linalg.solve(hessian, gradient)
        theta -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-8:
            break
    return theta[:-1], float(theta[-1])


def _features(terms: list[Term]):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for batch in batches:
            parts = [window_scores(block, automaton) for block in blocks(batch.column("text"))]
            rows = np.concatenate(parts) if parts else np.zeros((0, FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), batch.column("weight"), *[pa.array(rows[:, k]) for k in range(FEATURES)]],
                ["positive", "weight", *[f"f{k}" for k in range(FEATURES)]],
            )

    return features


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1) -> Lexicon:
    """Fit on a bounded sample of labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, fold(folds) != held_out)
    counted = sample.mapInArrow(_count_forms, "form string, beginning boolean, positive long, negative long")
    sizes = dict(sample.groupBy("positive").count().collect())
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    forms = counted.groupBy("form", "beginning").agg(F.sum("positive").alias("p"), F.sum("negative").alias("q"))
    # Surely likelier in toxic texts, by two standard errors of the log ratio: forms
    # of a bounded sample.
    ratio = F.log((F.col("p") + 0.5) / (n + 1)) - F.log((F.col("q") + 0.5) / (m + 1))
    error = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))
    forms = forms.withColumn("sure", ratio - 2 * error)
    likely = forms.where((F.col("p") >= LEAST_HOLDERS) & (F.col("sure") >= math.log(3)))
    likely = likely.orderBy(F.desc("p"), F.desc(F.length("form")), "form", "beginning").collect()
    named = [(row.form, row.beginning) for row in likely]
    wanted = {form: k for k, form in enumerate(named)}
    held = sample.where("positive = 1").mapInArrow(_which_forms(wanted), "forms array<int>").toPandas()["forms"]
    holders: list[list[int]] = [[] for _ in named]
    for text, found in enumerate(held):
        for form in found:
            holders[form].append(text)
    chosen = choose_terms(
        named, np.array([row.q * n / max(m, 1) for row in likely]), [np.array(h, dtype=np.int64) for h in holders], len(held)
    )
    strength = [min(1.0, likely[k].sure / SURE) for k in chosen]
    terms = [Term(*named[k], s, usual_edits(named[k][0])) for k, s in zip(chosen, strength)]
    # Where near misses of a term are ordinary words it gets fewer edits. A word counts for the
    # nearest term only, so the others are looked at again.
    while any(t.edits for t in terms):
        missed = sample.where("positive = 0").mapInArrow(_near_misses(terms), "term int")
        ordinary = {row.term for row in missed.groupBy("term").count().where(F.col("count") > ORDINARY * m).collect()}
        if not ordinary:
            break
        terms = [replace(t, edits=t.edits - 1) if k in ordinary else t for k, t in enumerate(terms)]
    table = sample.mapInArrow(
        _features(terms), "positive int, weight double, " + ", ".join(f"f{k} double" for k in range(FEATURES))
    ).toPandas()
    x = np.log1p(table[[f"f{k}" for k in range(FEATURES)]].to_numpy())
    if n and m:
        weights, bias = fit_logistic(x, table["positive"].to_numpy(float), table["weight"].to_numpy())
    else:
        weights, bias = np.zeros(FEATURES), (math.log((n + 1) / (m + 1)))
    return Lexicon(terms, weights, bias)


def toxicity_score(model: Lexicon, text: Column) -> Column:
    """Probability that a text is toxic, by its whole text."""
    made: list[Automaton] = []

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if not made:
            made.append(Automaton(model.terms))
        parts = [window_scores(block, made[0]) for block in blocks(column)]
        rows = np.log1p(np.concatenate(parts)) if parts else np.zeros((0, FEATURES))
        return pa.array(1 / (1 + np.exp(-np.clip(rows @ model.weights + model.bias, -30, 30))))

    return score(text)


def judge_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = learn(docs, labels)
    scored = docs.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (fold(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, with all their columns."""
    return docs.where(toxicity_score(learn(docs, labels), F.col("text")) < threshold)
