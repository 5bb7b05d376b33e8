"""Hidden Markov language model of words.

A hidden state emits a word class (a hash of the word's last letters, or the end of a text), a class emits a word
by its smoothed share in the training tokens of the class. So the states' tables are of fixed size, while word
counts are tables of any size. Baum-Welch counts are added up over all partitions; the scaled forward recursion
gives the exact likelihood of each text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import remainder_of_id, scratch, table, text_batches

STATES, CLASSES = 6, 1024
#: Baum-Welch has settled once a round over all training texts raises their log10 likelihood by less than this a token,
#: twice in a row: the first rounds from noise gain little.
SETTLED = 1e-4
#: Made-up emissions of every state, dealt by the classes' shares.
SMOOTHING = 50.0
#: Words that are sent to every task with their counts: those with at least this part of all tokens, so no more.
MOST_WORDS = 1 << 20
SLICE = 4 << 20
#: Tokens of a block, and blocks that are taken side by side.
BLOCK, GROUP = 256, 4096
END = ""  # no word is empty


def classes_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all tokens of the texts, one end for each text, and the number of tokens of each text."""
    joined = b"\n".join([b" ".join((t or b"").lower().split()) for t in texts]) + b"\n"
    codes = np.frombuffer(b"\x00\x00\x00" + joined, np.uint8)
    white = (codes[3:] == 32) | (codes[3:] == 10)
    ends = np.flatnonzero(white)
    line = codes[3:][ends] == 10
    length = np.diff(ends, prepend=-1) - 1
    last = [np.where(length > k, codes[3:][np.maximum(ends - 1 - k, 0)], 0).astype(np.int64) for k in range(3)]
    kind = 1 + ((last[0] * 31 + last[1]) * 37 + last[2]) % (CLASSES - 1)
    # A word and, at the end of a line, the end: two tokens, or the end alone for a text without words.
    worded = length > 0
    counts = worded.astype(np.int64) + line
    out = np.zeros(int(counts.sum()), np.int64)
    out[(np.cumsum(counts) - counts)[worded]] = kind[worded]
    sizes = np.diff(np.concatenate(([0], np.cumsum(counts)[line])))
    return out, sizes


class Pieces:
    """Texts cut into blocks of BLOCK tokens, the last one of a text shorter: where each begins, its length, its text."""

    def __init__(self, sizes: np.ndarray):
        number = -(-sizes // BLOCK)
        self.text = np.repeat(np.arange(len(sizes)), number)
        self.nth = np.arange(len(self.text)) - np.repeat(np.cumsum(number) - number, number)
        self.begins = np.repeat(np.cumsum(sizes) - sizes, number) + self.nth * BLOCK
        self.lengths = np.minimum(BLOCK, np.repeat(sizes, number) - self.nth * BLOCK)
        self.several = np.repeat(number, number) > 1

    def groups(self, chosen: np.ndarray) -> Iterator[np.ndarray]:
        """The chosen blocks, at most GROUP together, long ones first."""
        for at in range(0, len(chosen), GROUP):
            some = chosen[at:at + GROUP]
            yield some[np.argsort(-self.lengths[some], kind="stable")]


class Hmm:
    """Texts are taken in blocks side by side, so that arrays stay wide whatever the lengths of texts. A block's product of
    moves and emissions takes the forward variables over it and the backward ones back, so each block starts from the
    exact variables at its ends. Only the products are kept for a whole text."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit
        self.likelihoods: list[float] = []

    def _ends(self, kinds: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Of each block the forward variables before it (zero before the first) and the backward ones behind it, scaled."""
        k, emit = len(self.start), np.ascontiguousarray(self.emit.T)
        before, behind = np.zeros((len(pieces.text), k)), np.ones((len(pieces.text), k))
        long = np.flatnonzero(pieces.several)
        if not len(long):
            return before, behind
        products = np.empty((len(pieces.text) if len(long) else 0, k, k))
        for some in pieces.groups(long):
            begins, lengths = pieces.begins[some], pieces.lengths[some]
            product = np.empty((len(some), k, k))
            for t in range(int(lengths[0])):
                n = int(np.searchsorted(-lengths, -t, "left"))
                seen = emit[kinds[begins[:n] + t]][:, None, :]
                if t == 0:
                    # The first block of a text begins with the start, any other with a move.
                    product[:] = np.where((pieces.nth[some] == 0)[:, None, None], np.eye(k), self.move) * seen
                    continue
                product[:n] = (product[:n].reshape(-1, k) @ self.move).reshape(n, k, k) * seen
                if t % 8 == 0:
                    product[:n] /= product[:n].sum(axis=(1, 2), keepdims=True)
            products[some] = product
        last = np.append(pieces.nth[1:] == 0, True)
        for nth in range(1, int(pieces.nth.max()) + 1):
            here = long[pieces.nth[long] == nth]
            state = np.where((nth == 1), self.start, before[here - 1])
            state = np.einsum("bi,bij->bj", np.broadcast_to(state, (len(here), k)), products[here - 1])
            before[here] = state / state.sum(axis=1, keepdims=True)
        for nth in range(int(pieces.nth.max()) - 1, -1, -1):
            here = long[(pieces.nth[long] == nth) & ~last[long]]
            state = np.einsum("bij,bj->bi", products[here + 1], behind[here + 1])
            behind[here] = state / state.sum(axis=1, keepdims=True)
        return before, behind

    def _forward(self, kinds: np.ndarray, begins: np.ndarray, lengths: np.ndarray, prior: np.ndarray):
        """Step by step over blocks, long ones first: variables, scales, classes, and where each step's begin."""
        emit = np.ascontiguousarray(self.emit.T)
        alive = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")
        at = np.concatenate(([0], np.cumsum(alive)))
        states, scales, seen = np.empty((at[-1], len(self.start))), np.empty(at[-1]), np.empty(at[-1], np.int64)
        state = prior
        for t, n in enumerate(alive):
            kind = kinds[begins[:n] + t]
            state = (state if t == 0 else state[:n] @ self.move) * emit[kind]
            scale = state.sum(axis=1)
            state /= scale[:, None]
            here = slice(at[t], at[t + 1])
            states[here], scales[here], seen[here] = state, scale, kind
        return states, scales, seen, at

    def _priors(self, pieces: Pieces, some: np.ndarray, before: np.ndarray) -> np.ndarray:
        return np.where((pieces.nth[some] == 0)[:, None], self.start, before[some] @ self.move)

    def log10_likelihood(self, kinds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each text's classes: the sum over the logarithms of the scales of the forward variables."""
        pieces = Pieces(sizes)
        before, _ = self._ends(kinds, pieces)
        total = np.zeros(len(sizes))
        for some in pieces.groups(np.arange(len(pieces.text))):
            _, scales, _, at = self._forward(kinds, pieces.begins[some], pieces.lengths[some], self._priors(pieces, some, before))
            block = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
            np.add.at(total, pieces.text[some], np.bincount(block, np.log10(scales), len(some)))
        return total

    def counts(self, kinds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions."""
        return self.sums(kinds, sizes)[:3]

    def sums(self, kinds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same and the log10 likelihood of all texts: the forward and the backward recursion with the same scales."""
        k, pieces = len(self.start), Pieces(sizes)
        emit = np.ascontiguousarray(self.emit.T)
        before, behind = self._ends(kinds, pieces)
        starts, moves, emits, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((k, CLASSES)), np.zeros(1)
        for some in pieces.groups(np.arange(len(pieces.text))):
            states, scales, seen, at = self._forward(kinds, pieces.begins[some], pieces.lengths[some], self._priors(pieces, some, before))
            likelihood += np.log10(scales).sum()
            back = np.empty((0, k))
            for t in range(len(at) - 2, -1, -1):
                state = states[at[t]:at[t + 1]]
                n, m = len(state), len(back)
                here = np.empty((n, k))
                if m < n:  # blocks that end here
                    ended = behind[some[m:n]]
                    here[m:] = ended / np.einsum("bi,bi->b", ended, state[m:])[:, None]
                if m:
                    moves += state[:m].T @ back
                    here[:m] = back @ self.move.T
                state *= here
                if t:
                    back = here * (emit[seen[at[t]:at[t + 1]]] / scales[at[t]:at[t + 1]][:, None])
            # Moves into blocks from the blocks before them; what begins a text is a start.
            first = pieces.nth[some[:n]] == 0
            back = here * (emit[seen[:n]] / scales[:n][:, None])
            moves += before[some[:n]][~first].T @ back[~first]
            starts += states[:n][first].sum(axis=0)
            for i in range(k):
                emits[i] += np.bincount(seen, states[:, i], CLASSES)
        return starts, moves * self.move, emits, likelihood

    @staticmethod
    def of(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, shares: np.ndarray) -> Hmm:
        move, emit = moves + 1.0, emits + SMOOTHING * shares
        return Hmm((starts + 1.0) / (starts + 1.0).sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _beginning(kinds: np.ndarray, sizes: np.ndarray, shares: np.ndarray, rounds: int) -> Hmm:
    """States start as slight variations of the classes' shares; then so many rounds on the given texts."""
    noise = np.random.default_rng(11).uniform(0.5, 1.5, (STATES, CLASSES))
    stay = np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1))
    model = Hmm.of(np.ones(STATES), stay * 1000, 1000 * noise * shares, shares)
    for _ in range(rounds if len(sizes) else 0):
        model = Hmm.of(*model.counts(kinds, sizes), shares)
    return model


def sequences(texts: DataFrame) -> DataFrame:
    """kinds (classes, two bytes each) and sizes (tokens of each text, eight bytes each) of slices of texts, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in text_batches(batches, "text", SLICE):
            kinds, sizes = classes_of(part)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (kinds.astype("<u2").tobytes(), sizes.astype("<i8").tobytes())], ["kinds", "sizes"])

    spark, out = texts.sparkSession, scratch(texts.sparkSession, "classes")
    texts.select("text").mapInArrow(run, "kinds binary, sizes binary").write.parquet(out)
    return spark.read.parquet(out)


def baum_welch(texts: DataFrame, shares: np.ndarray, rounds: int | None = None) -> Hmm:
    """Trained on all texts in every round, until their likelihood settles or for so many rounds.

    Each task adds up its own counts; a fixed number of sums comes to the driver. The likelihoods before each round
    are kept in the model.
    """
    model = _beginning(np.empty(0, np.int64), np.empty(0, np.int64), shares, 0)
    likelihoods: list[float] = []
    rows = sequences(texts)
    while rounds is None or len(likelihoods) < rounds:
        sent = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES)), np.zeros(1)]
            for batch in batches:
                for kinds, sizes in zip(*batch.columns):
                    for whole, more in zip(sums, sent.value.sums(np.frombuffer(kinds.as_buffer(), "<u2"), np.frombuffer(sizes.as_buffer(), "<i8"))):
                        whole += more
            flat = np.concatenate([x.ravel() for x in sums])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int64)), pa.array(flat)], ["at", "x"])

        found = rows.select("kinds", "sizes").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(STATES * (1 + STATES + CLASSES) + 1)
        for r in found:
            flat[r["at"]] = r.x
        a, b = STATES, STATES + STATES * STATES
        model = Hmm.of(flat[:a], flat[a:b].reshape(STATES, STATES), flat[b:-1].reshape(STATES, CLASSES), shares)
        sent.unpersist()
        likelihoods.append(float(flat[-1]))
        if _settled(likelihoods, flat[b:-1].sum()):
            break
    model.likelihoods = likelihoods
    return model


def _settled(likelihoods: list[float], tokens: float) -> bool:
    gains = np.diff(likelihoods[-3:])
    return len(gains) == 2 and bool((gains <= SETTLED * tokens).all())


def word_counts(texts: DataFrame) -> DataFrame:
    """word, kind (its class), n: all tokens of the texts. Tasks count first; the end is the word END of class 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in text_batches(batches, "text", 2 * SLICE):
            sums = Counter()
            for t in part:
                sums.update((t or b"").lower().split())
            words = list(sums)
            kinds = classes_of(words)[0][::2] if words else np.empty(0, np.int64)  # each word as a text: its class, then an end
            yield pa.RecordBatch.from_arrays(
                [pa.array([*words, END.encode()], pa.binary()).cast(pa.string()), pa.array(np.append(kinds, 0)), pa.array([*sums.values(), len(part)], pa.int64())],
                ["word", "kind", "n"])

    return texts.select("text").mapInArrow(run, "word string, kind long, n long").groupBy("word", "kind").agg(F.sum("n").alias("n"))


class Model:
    """hmm; per class the tokens and distinct words; tokens, distinct words; counts of the words above a share; the table of all."""

    def __init__(self, hmm: Hmm, class_logs: np.ndarray, tokens: int, distinct: int, frequent: dict[bytes, int], counts: DataFrame):
        self.hmm, self.class_logs, self.tokens, self.distinct, self.frequent, self.counts = hmm, class_logs, tokens, distinct, frequent, counts


def learned(texts: DataFrame, most_words: int = MOST_WORDS, rounds: int | None = None) -> Model:
    """Word counts go to a table in the shared folder; frequent words, no more than `most_words`, to the driver."""
    spark = texts.sparkSession
    out = scratch(spark, "word-counts")
    word_counts(texts).write.parquet(out)
    counts = spark.read.parquet(out)
    tokens_of, words_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tokens_of[r.kind], words_of[r.kind] = r.n, r.v
    tokens, distinct = int(tokens_of.sum()), int(words_of.sum())
    least = max(1, -(-tokens // most_words))
    frequent = {r.word.encode(): r.n for r in counts.where(F.col("n") >= least).select("word", "n").collect()}
    shares = (tokens_of + 0.5) / (tokens_of + 0.5).sum()
    return Model(baum_welch(texts, shares, rounds), np.log10(tokens_of + 0.5 * (words_of + 1)), tokens, distinct, frequent, counts.where(F.col("n") < least))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Counts of frequent words are at hand in each task; the other words of a text, each once with its number,
    meet their counts in a join, and the sums come together by row. Of a hot word that is not sent around
    there are few by definition. A null text counts as empty: its end alone. Repeated rows and null ids keep
    one result each; whole texts of any length are scored; other columns are ignored; an empty table gives an
    empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.hmm, model.class_logs, {w: (n, float(np.log10(n + 0.5))) for w, n in model.frequent.items()}))
    names = ["row", "doc_id", "word", "times", "n_tokens", "n_known", "logs", "states"]
    schema = "row string, doc_id long, word string, times long, n_tokens long, n_known long, logs double, states double"
    kinds_ = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        at = 0
        for batch, texts in text_batches(batches, "text", SLICE):
            hmm, class_logs, frequent = sent.value
            kinds, sizes = classes_of(texts)
            states = hmm.log10_likelihood(kinds, sizes)
            ends = np.cumsum(sizes)
            less = np.add.reduceat(class_logs[kinds], ends - sizes) if len(sizes) else np.empty(0)
            out = []
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), texts)):
                row, at = f"{context.partitionId()}-{at}", at + 1
                known, logs = 0, 0.0
                for word, n in Counter([*(text or b"").lower().split(), b""]).items():
                    found = frequent.get(word)
                    if found:
                        known += n
                        logs += n * found[1]
                    else:
                        out.append((row, doc_id, word.decode(), n, 0, 0, 0.0, 0.0))
                # The sums so far, under a name that is no word's.
                out.append((row, doc_id, " " + row, 0, int(sizes[i]), known, logs, float(states[i] - less[i])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds_)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    met = rows.join(model.counts.select("word", "n"), "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = met.groupBy("row", "doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(n > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("logs") + F.col("times") * F.log10(n + 0.5)).alias("logs"), F.sum("states").alias("states"),
    )
    norm = float(np.log10(model.tokens + 0.5 * (model.distinct + 1)))
    return sums.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * norm).alias("base_score"), (F.col("logs") + F.col("states")).alias("score"),
    )


def op6_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learned(docs.where(remainder_of_id("doc_id", 5) != 1).select("text"))
    return scored(docs, model).select(
        "doc_id", (remainder_of_id("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
