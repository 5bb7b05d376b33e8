import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from tidewatch.llm import lm
from tidewatch.llm.shared import remainder_of_id


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.mark.parametrize("most_words", [3, 1 << 20])
def test_documents_against_plain_counts(documents, most_words):
    train = documents.where(remainder_of_id("doc_id", 5) != 1)
    model = lm.learned(train.select("text"), most_words)
    rows = documents.select("doc_id", "text").collect()
    counts = Counter(w for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in lm.scored(documents, model).collect()}
    assert len(got) == len(rows) and len(model.frequent) <= most_words
    kind = lambda w: int(lm.classes_of([w])[0][0])
    tokens_of, words_of = Counter(), Counter()
    for w, c in counts.items():
        tokens_of[kind(w)] += c
        words_of[kind(w)] += 1
    for r in rows:
        words, out = tokens(r.text), got[r.doc_id]
        assert (out.n_tokens, out.n_known, out.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(out.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel_tol=1e-9)
        if len(words) < 300:
            hmm, state, score = model.hmm, model.hmm.start, 0.0
            for t, w in enumerate(words):
                k = kind(w)
                state = (state if t == 0 else state @ hmm.move) * hmm.emit[:, k]
                score += math.log10(state.sum()) + math.log10((counts[w] + 0.5) / (tokens_of[k] + 0.5 * (words_of[k] + 1)))
                state = state / state.sum()
            assert math.isclose(out.score, score, rel_tol=1e-9)
    held = [out for i, out in got.items() if zlib.crc32(str(i).encode()) % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(8)
    hmm = lm.Hmm.of(rng.random(lm.STATES), rng.random((lm.STATES, lm.STATES)), rng.random((lm.STATES, lm.CLASSES)), np.full(lm.CLASSES, 1 / lm.CLASSES))
    kinds, sizes = np.array([5, 9, 9, 0, 7, 0, 0]), np.array([4, 2, 1])
    for got, (a, b) in zip(hmm.log10_likelihood(kinds, sizes), ((0, 4), (4, 6), (6, 7))):
        seq = kinds[a:b]
        total = sum(
            hmm.start[p[0]] * np.prod([hmm.move[x, y] for x, y in zip(p, p[1:])]) * np.prod([hmm.emit[s, k] for s, k in zip(p, seq)])
            for p in product(range(lm.STATES), repeat=len(seq)))
        assert math.isclose(got, math.log10(total), rel_tol=1e-9)
    starts, moves, emits = hmm.counts(kinds, sizes)
    assert math.isclose(starts.sum(), 3) and math.isclose(moves.sum(), 4) and math.isclose(emits.sum(), 7)
    assert np.allclose(emits.sum(axis=0)[[5, 9, 0, 7]], [1, 2, 3, 1])


def test_training_raises_the_likelihood(documents):
    texts = [r.text.encode() for r in documents.collect()]
    kinds, sizes = lm.classes_of(texts)
    shares = np.bincount(kinds, minlength=lm.CLASSES) / len(kinds)
    marks = [lm._beginning(kinds, sizes, shares, n).log10_likelihood(kinds, sizes).sum() for n in (0, 1, 4)]
    assert marks[0] < marks[1] < marks[2]


def test_edge_cases(frame):
    kinds, sizes = lm.classes_of([None, b"", b"A bc  def\tghij\n", b"a"])
    assert sizes.tolist() == [1, 1, 5, 2] and (kinds == 0).sum() == 4 and kinds[2] == kinds[7]
    docs = frame(None, "", "A a é", "word " * 30_000, "new", ids=[1, 1, None, 2, 3])
    model = lm.learned(docs.select("text"), 2)
    got = lm.scored(docs, model).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 2, 4, 30_001] and len(got) == 5
    assert lm.scored(frame(), model).collect() == []
    empty = lm.learned(frame().select("text"))
    assert [r.n_known for r in lm.scored(frame("a b"), empty).collect()] == [0]


def test_every_round_sees_all_texts(spark):
    """Many copies of one text and a few others: the rounds are those of plain Baum-Welch over all of them, until it settles."""
    texts = ["the same text again"] * 1200 + [f"one of{k} ing{k} other ed{k} words" for k in range(40)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    kinds, sizes = lm.classes_of([t.encode() for t in texts])
    shares = np.bincount(kinds, minlength=lm.CLASSES) / len(kinds)
    got = lm.baum_welch(frame, shares)
    marks = got.likelihoods
    plain = lm._beginning(kinds, sizes, shares, len(marks))
    assert np.allclose(got.move, plain.move) and np.allclose(got.emit, plain.emit)
    assert len(marks) > 3 and marks[-1] > marks[0] and marks[-1] - marks[-2] <= lm.SETTLED * len(kinds)
    assert math.isclose(marks[0], lm._beginning(kinds, sizes, shares, 0).log10_likelihood(kinds, sizes).sum(), rel_tol=1e-9)


def test_blocks_change_nothing(monkeypatch):
    """Counts and likelihoods of texts cut into blocks are those of whole texts."""
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 700, 3, 2000, 256, 257, 513, 1, 40])
    kinds = rng.integers(0, lm.CLASSES, sizes.sum())
    hmm = lm.Hmm.of(rng.random(lm.STATES) * 5, rng.random((lm.STATES, lm.STATES)) * 50, rng.random((lm.STATES, lm.CLASSES)) * 9, np.full(lm.CLASSES, 1 / lm.CLASSES))
    found = []
    for block, group in ((10_000, 4096), (256, 4096), (7, 13)):
        monkeypatch.setattr(lm, "BLOCK", block)
        monkeypatch.setattr(lm, "GROUP", group)
        found.append((*hmm.sums(kinds, sizes), hmm.log10_likelihood(kinds, sizes)))
    for other in found[1:]:
        assert all(np.allclose(a, b, rtol=1e-10, atol=1e-10) for a, b in zip(found[0], other))
    assert np.isclose(found[0][4].sum(), found[0][3][0])
