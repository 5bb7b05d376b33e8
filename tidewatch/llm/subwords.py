"""Quality classifier: learned vectors of hashed word and character n-grams, averaged over a text, with a softmax on top."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import remainder_of_id, table, text_batches

#: Buckets of n-grams, length of their vectors, lengths of character n-grams in bytes.
BUCKETS, LENGTH, GRAMS = 1 << 18, 16, (3, 4, 5)
#: The fit takes so many labelled texts at most, none of more characters than that; scoring takes all texts whole.
MOST_ROWS, MOST_CHARACTERS = 3_000, 20_000
#: The fit makes so many steps, a text each, or as many as make so many rounds.
STEPS, ROUNDS, RATE = 12_000, 3, 1.0
#: Bytes that are taken at once. Longer texts are cut there behind white space; n-grams across a cut are not counted.
SLICE = 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x + np.uint64(kind)) * _MIX
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int32) & (BUCKETS - 1)


def grams(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text of each): the character n-grams, the words, the pairs of words and one end for each text.

    White space is one kind of character. A word equal to the one before it is written as a ditto mark in their pair, so
    that repetition has a vector of its own, whatever is repeated.
    """
    joined = np.frombuffer(b"".join([(t or b"") + b"\n" for t in texts]), np.uint8)
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    yield _bucket(np.zeros(len(texts), np.uint64), 1), np.arange(len(texts), dtype=np.int32)
    white = _WHITE[joined]
    codes = np.where(white, np.uint8(32), joined).astype(np.uint64)
    packed = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        packed = (packed[:-1] << np.uint64(8)) | codes[n - 1:]
        if n in GRAMS:
            inside = owner[:len(packed)] == owner[n - 1:]
            yield _bucket(packed[inside], 10 + n), owner[:len(packed)][inside]
    begins = np.flatnonzero(~white & np.concatenate(([True], white[:-1])))
    if not len(begins):
        return
    # A word's number: its letters mixed with their places, added up.
    spans = np.diff(np.append(begins, len(joined)))
    places = np.zeros(len(joined), np.uint64)
    places[begins[0]:] = np.arange(begins[0], len(joined)) - np.repeat(begins, spans)
    letters = (codes + (places << np.uint64(8)) + np.uint64(1)) * _MIX
    letters = (letters ^ (letters >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    letters[white] = 0
    words, of = np.add.reduceat(letters, begins), owner[begins]
    yield _bucket(words, 2), of
    near = of[1:] == of[:-1]
    pairs = np.where(words[1:] == words[:-1], np.uint64(3), words[:-1] * np.uint64(31) + words[1:])
    yield _bucket(pairs[near], 4), of[1:][near]


def pieces(text: bytes | None) -> list[bytes]:
    """The text in pieces of SLICE bytes at most, cut behind the last white space if there is any."""
    text, out = text or b"", []
    while len(text) > SLICE:
        white = np.flatnonzero(_WHITE[np.frombuffer(text[:SLICE], np.uint8)])
        end = int(white[-1]) + 1 if len(white) else SLICE
        out.append(text[:end])
        text = text[end:]
    return [*out, text]


@dataclass
class Classifier:
    """vectors: of the buckets; out: a row for each class."""

    vectors: np.ndarray
    out: np.ndarray

    def scores(self, texts: list[bytes | None], weights: np.ndarray) -> np.ndarray:
        """The probability of class 1. weights: what each bucket adds to the difference of the two classes."""
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        waiting, owners, size = [], [], 0

        def take() -> None:
            own = np.array(owners)
            for buckets, of in grams(waiting):
                np.add.at(total, own, np.bincount(of, weights[buckets], len(own)))
                np.add.at(number, own, np.bincount(of, minlength=len(own)))

        for at, text in enumerate(texts):
            for part in pieces(text):
                if waiting and size + len(part) > SLICE:
                    take()
                    waiting, owners, size = [], [], 0
                waiting.append(part)
                owners.append(at)
                size += len(part)
        if waiting:
            take()
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(number, 1), -500, 500)))

    @property
    def weights(self) -> np.ndarray:
        """The average of vectors times the difference of the output rows is the average of these products."""
        return (self.vectors @ (self.out[1] - self.out[0])).astype(np.float64)


def trained(texts: list[bytes | None], labels: list[int], rate: float = RATE, seed: int = 11) -> Classifier:
    """Stochastic gradient descent, a text a step, at a rate that falls to zero. Vectors begin as small noise."""
    noise = np.random.default_rng(seed)
    vectors = noise.uniform(-1 / LENGTH, 1 / LENGTH, (BUCKETS, LENGTH)).astype(np.float32)
    out = np.zeros((2, LENGTH), np.float32)
    parts = []
    for text in texts:
        buckets, times = np.unique(np.concatenate([b for b, _ in grams([text])]), return_counts=True)
        parts.append((buckets, (times / times.sum()).astype(np.float32)))
    for k in range(steps := max(STEPS, ROUNDS * len(texts)) if texts else 0):
        if k % len(texts) == 0:
            order = noise.permutation(len(texts))
        at = order[k % len(texts)]
        buckets, share = parts[at]
        own = vectors[buckets]
        hidden = share @ own
        chances = np.exp(out @ hidden)
        error = chances / chances.sum()
        error[labels[at]] -= 1
        error *= np.float32(rate * (1 - k / steps))
        vectors[buckets] = own - np.outer(share, error @ out)
        out -= np.outer(error, hidden)
    return Classifier(vectors, out)


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = MOST_ROWS) -> DataFrame:
    """text, label: of `most` labelled ids, by a hash of the id, one row each. Two labels of an id: the larger."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    short = docs.select("doc_id", "text").where(F.length("text") <= MOST_CHARACTERS)
    there = ids.join(short.select("doc_id"), "doc_id", "left_semi")
    chosen = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = short.join(chosen, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id")


def classified(docs: DataFrame, classifier: Classifier, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted (1 if score >= least). A null text counts as empty: its end alone decides.

    Repeated rows and null ids keep one result each; whole texts of any length are scored; other columns are ignored; an
    empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Classifier(np.empty(0), np.empty(0))
        for batch, texts in text_batches(batches, "text", 4 * SLICE):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(texts, sent.value))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


def learned(docs: DataFrame, labels: DataFrame, label: str, most: int = MOST_ROWS) -> Classifier:
    """Fitted in the driver on a bounded sample; without labelled rows every score is one half."""
    rows = sample(docs, labels, label, most).collect()
    return trained([r.text.encode() for r in rows], [r.label for r in rows])


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    classifier = learned(docs, labels.where(remainder_of_id("doc_id", 5) != 0), "quality")
    return classified(docs, classifier).select("doc_id", (remainder_of_id("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
