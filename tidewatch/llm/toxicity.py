"""Toxicity: a learned lexicon, misspellings by a Levenshtein automaton over its trie, context of each find."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import cut, remainder_of_id, table, text_batches

#: Labelled rows that lexicon and weights are fitted on: those with the smallest hash of the id.
SAMPLE = 20_000
#: A term occurs in so many toxic documents of the sample, and so many times as often as in others. All such terms are kept.
LEAST_DOCS, LEAST_RATIO = 3, 20.0
#: A word near finds tells quotation or abuse if it stands there in so many documents of one label, and so many times as often as in those of the other.
LEAST_CONTEXTS, CONTEXT_RATIO = 5, 4.0
#: Words on either side of a find that tell quotation from abuse.
CONTEXT = 5
WORD = re.compile(r"\w+")
QUOTES = re.compile(r"[\"“”„«»‘’]")
#: Words of reporting and of address in four languages. More are learned from the labelled rows.
REPORTING = frozenset("said says wrote called quote quoted word term sagte schrieb nannte wort dit écrit appelé mot dijo escribió llamó palabra".split())
ADDRESS = frozenset("you your youre u du dich dein ihr euch tu toi ton vous votre tú tu ti usted te".split())
FEATURES = ("exact", "one", "two", "quoted", "addressed", "dense")
KEPT_WORDS = 300_000


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class LexiconAutomaton:
    """Levenshtein automata of all terms, intersected with their trie and made deterministic as it is used.

    A state is a set of (node of the trie, edits so far); a word is accepted where a node ends a term that
    allows that many edits. States and arcs are kept in tables once they have been worked out.
    """

    def __init__(self, terms: list[str], most_arcs: int = 300_000):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.allowed: list[int] = [-1]
        self.terms, self.most_arcs = terms, most_arcs
        for i, term in enumerate(terms):
            node = 0
            limit = edits_allowed(term)
            self.allowed[0] = max(self.allowed[0], limit)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.allowed.append(-1)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], limit)
            self.term[node] = i
        self._clear()

    def _clear(self) -> None:
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.arcs: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a set of nodes, after terms' letters that a word may lack; -1 for the empty set."""
        waiting = list(nodes.items())
        while waiting:
            node, edits = waiting.pop()
            if nodes[node] < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and edits + 1 < nodes.get(child, 99):
                    nodes[child] = edits + 1
                    waiting.append((child, edits + 1))
        if not nodes:
            return -1
        key = tuple(sorted(nodes.items()))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.sets[state]:
            if edits + 1 <= self.allowed[node]:
                nodes[node] = min(nodes.get(node, 99), edits + 1)
            for letter, child in self.children[node].items():
                after = edits + (letter != c)
                if after <= self.allowed[child]:
                    nodes[child] = min(nodes.get(child, 99), after)
        return self._state(nodes)

    def look_up(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the closest term, of equals the first; None if no term is close enough."""
        if len(self.arcs) > self.most_arcs:
            self._clear()
        state = self.start
        for c in word:
            following = self.arcs.get((state, c))
            if following is None:
                following = self.arcs[state, c] = self._step(state, c)
            state = following
            if state < 0:
                return None
        found = [(e, self.term[n]) for n, e in self.sets[state] if self.term[n] >= 0 and e <= edits_allowed(self.terms[self.term[n]])]
        return min(found, default=None)


class Finder:
    def __init__(self, terms: list[str], innocent: frozenset[str], reporting: frozenset[str] = REPORTING, address: frozenset[str] = ADDRESS):
        self.automaton, self.innocent, self.reporting, self.address = LexiconAutomaton(terms), innocent, reporting, address
        self.known: dict[str, tuple[int, int] | None] = {}

    def _find(self, word: str) -> tuple[int, int] | None:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        found = None if word in self.innocent else self.automaton.look_up(word)
        self.known[word] = found
        return found

    def finds(self, words: list[str]) -> list[tuple[int, tuple[int, int]]]:
        known, find = self.known, self._find
        return [(i, f) for i, w in enumerate(words) if (f := known[w] if w in known else find(w))]

    def contexts(self, text: str) -> set[str]:
        """Words around the finds of a text that are no finds themselves."""
        words = WORD.findall(text.lower())
        finds = self.finds(words)
        near = {j for i, _ in finds for j in range(max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1))}
        return {words[j] for j in near.difference(i for i, _ in finds)}

    def features(self, text: str) -> list[float]:
        """FEATURES of a text: finds by edits, finds in quotation, finds near an address, finds among its words."""
        low = text.lower()
        words = WORD.findall(low)
        finds = self.finds(words)
        if not finds:
            return [0.0] * len(FEATURES)
        spans = [m.span() for m in WORD.finditer(low)]
        quoted = addressed = 0
        by_edits = [0, 0, 0]
        for i, (edits, _) in finds:
            first, last = max(0, i - CONTEXT), min(len(words) - 1, i + CONTEXT)
            near = words[first:i] + words[i + 1:last + 1]
            marks = bool(QUOTES.search(low, spans[first][0], spans[i][0])) and bool(QUOTES.search(low, spans[i][1], spans[last][1] + 1))
            quote = marks or not self.reporting.isdisjoint(words[first:i])
            quoted += quote
            addressed += not self.address.isdisjoint(near)
            by_edits[edits] += not quote
        return [*(float(np.log1p(n)) for n in (*by_edits, quoted, addressed)), float(np.log1p(1000 * len(finds) / len(words)))]


def _labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """id, text and toxic of at most `most` labelled ids, one row each: of rows that share an id that with the least text.

    The chosen ids are few enough to be sent to every task.
    """
    chosen = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return cut(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic"))


class Model:
    def __init__(self, terms: list[str], innocent: frozenset[str], weights: np.ndarray, reporting: frozenset[str] = REPORTING, address: frozenset[str] = ADDRESS):
        self.terms, self.innocent, self.weights, self.reporting, self.address = terms, innocent, weights, reporting, address

    def scores(self, features: np.ndarray) -> np.ndarray:
        odds = features @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _finders(model: Model):
    cached = []
    parts = model.terms, model.innocent, model.reporting, model.address

    def get() -> Finder:
        if not cached:
            cached.append(Finder(*parts))
        return cached[0]

    return get


def _word_counts(rows: DataFrame, words_of) -> DataFrame:
    """word, clean, toxic: in how many rows of each label a word is among words_of(text). The empty word counts rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            sums = {0: Counter(), 1: Counter()}
            for text, toxic in zip(texts, batch.column(1).to_pylist()):
                sums[toxic].update(words_of((text or b"").decode()) | {""})
            every = list(dict.fromkeys([*sums[0], *sums[1]]))
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *[pa.array([sums[k][w] for w in every], pa.int64()) for k in (0, 1)]], ["word", "clean", "toxic"])

    words = rows.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")).mapInArrow(count, "word string, clean long, toxic long")
    return words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _context_words(rows: DataFrame, model: Model) -> tuple[frozenset[str], frozenset[str]]:
    """Words near finds that go with clean documents (reporting) and with toxic ones (address)."""
    get = _finders(model)
    words = cut(_word_counts(rows, lambda text: get().contexts(text)))
    # Documents without a find have no context, so shares are among the contexts of each label.
    total = words.where("word <> ''").agg(F.sum("clean"), F.sum("toxic")).first()
    n_clean, n_toxic = (x or 0 for x in total)
    tilt = ((F.col("clean") + 0.5) / (n_clean + 1.0)) / ((F.col("toxic") + 0.5) / (n_toxic + 1.0))
    listed = words.where("word <> ''").select(
        "word", ((F.col("clean") >= LEAST_CONTEXTS) & (tilt >= CONTEXT_RATIO)).alias("reports"),
        ((F.col("toxic") >= LEAST_CONTEXTS) & (tilt <= 1 / CONTEXT_RATIO)).alias("addresses"),
    ).where("reports or addresses").collect()
    more = {side: {r.word for r in listed if r[side]} for side in ("reports", "addresses")}
    return REPORTING | more["reports"] - ADDRESS, ADDRESS | more["addresses"] - REPORTING


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon, context words and weights from a bounded sample of labelled rows. Without any, scores are the same for all texts.

    What comes to the driver is bounded by the sample: terms, words near finds and a row of features for each id.
    """
    rows = _labelled_sample(docs, labels, sample)
    words = cut(_word_counts(rows, lambda text: set(WORD.findall(text.lower()))))
    whole = words.where("word = ''").first()
    n_clean, n_toxic = (whole.clean, whole.toxic) if whole else (0, 0)
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1.0)) / ((F.col("clean") + 0.5) / (n_clean + 1.0))
    terms = [r.word for r in words.where((F.col("toxic") >= LEAST_DOCS) & (ratio >= LEAST_RATIO) & (F.col("word") != "")).orderBy(ratio.desc(), "word").collect()]
    # Words of clean documents that only look like terms; there are as many at most as near forms occur there.
    automaton = LexiconAutomaton(terms)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [w for w in batch.column(0).to_pylist() if (f := automaton.look_up(w)) and f[0] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], ["word"])

    innocent = frozenset(r.word for r in words.where("clean >= 2 and toxic < clean").select("word").mapInArrow(alike, "word string").collect()) if terms else frozenset()
    model = Model(terms, innocent, np.zeros(1 + len(FEATURES)))
    if terms:
        model.reporting, model.address = _context_words(rows, model)
    facts = featured(rows, model, ["doc_id", "toxic"]).collect()
    x = np.array([r.features for r in facts], float).reshape(len(facts), len(FEATURES))
    model.weights = _logistic(x, np.array([float(r.toxic > 0) for r in facts]))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def featured(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns `keep` (longs) and the features of each text."""
    get = _finders(model)
    rows = docs.select("text", *[F.col(c).cast("long").alias(c) for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = get()
        for batch, texts in text_batches(batches, "text"):
            found = [finder.features((t or b"").decode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))], [*keep, "features"])

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in keep) + ", features array<double>")


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted. A null text counts as empty; repeated rows and null ids keep one result
    each; whole texts of any length are searched; other columns are ignored; an empty table gives an empty one."""
    rows = featured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, ["doc_id"])
    odds = F.lit(float(model.weights[0]))
    for i, w in enumerate(model.weights[1:]):
        odds = odds + F.get("features", F.lit(i)) * float(w)
    rows = rows.select("doc_id", (1 / (1 + F.exp(-odds))).alias("score"))
    return rows.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = learned(docs.where(remainder_of_id("doc_id", 5) != 0), labels.where(remainder_of_id("doc_id", 5) != 0))
    return scored(docs, model).select("doc_id", (remainder_of_id("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
