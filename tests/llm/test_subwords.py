"""The subword classifier: features and scores against plain loops, held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from tidewatch.llm import subwords
from tidewatch.llm.shared import table

FOLDER = "/root/testdata/sf0.01"
WHITE = b"\t\n\x0b\x0c\r "


def plain_grams(text):
    """Character n-grams (white space as a blank, with the line end behind the text), words, pairs, one end."""
    text = b"".join(b" " if c in WHITE else bytes((c,)) for c in (text or b"") + b"\n")
    words = text.split()
    pairs = ["same" if a == b else (a, b) for a, b in zip(words, words[1:])]
    return [text[i:i + n] for n in subwords.GRAMS for i in range(len(text) - n + 1)], words, pairs


@pytest.mark.parametrize("texts", [[b"one two two\tone", None, b"", b" \n ", b"a", "été été  x".encode()], [b"  lead", b"x y x y"], [None]])
def test_grams(texts):
    found = list(subwords.grams(texts))
    for at, text in enumerate(texts):
        mine = [b[of == at].tolist() for b, of in found]
        chars, words, pairs = plain_grams(text)
        assert len(mine[0]) == 1 and sum(len(m) for m in mine) == 1 + len(chars) + len(words) + len(pairs)
        if words:
            for numbers, things in ((sum(mine[1:1 + len(subwords.GRAMS)], []), chars), (mine[-2], words), (mine[-1], pairs)):
                assert len(set(zip(numbers, things))) == len(set(things)) == len(set(numbers))


def test_scores_are_averages(monkeypatch):
    """In pieces and slices of any size, against the softmax of the averaged vectors."""
    texts = [b"one two two three", b"", None, b"x" * 50, b"some more words here and there " * 8]
    model = subwords.trained(texts, [1, 0, 0, 1, 1])
    whole = model.scores(texts, model.weights)
    for text, score in zip(texts, whole):
        buckets = np.concatenate([b for b, _ in subwords.grams([text])])
        chances = np.exp(model.out @ model.vectors[buckets].mean(axis=0))
        assert score == pytest.approx(chances[1] / chances.sum(), rel=1e-4)
    monkeypatch.setattr(subwords, "SLICE", 64)
    assert all(b"".join(subwords.pieces(t)) == (t or b"") and max(map(len, subwords.pieces(t))) <= 64 for t in texts)
    assert model.scores(texts, model.weights)[:4] == pytest.approx(whole[:4], rel=1e-9)


def test_held_out(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    found = {r.doc_id: r for r in subwords.op11_quality_classifier(spark, FOLDER).collect()}
    assert len(found) == table(spark, FOLDER, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    tested = [(found[i].predicted, q) for i, q in labels.items() if i in found and found[i].held_out]
    bad = [p for p, q in tested if q == 0]
    assert len(bad) >= 8 and sum(bad) <= 1 and all(p for p, q in tested if q == 1)


def test_labels_of_the_fold_are_not_read(spark):
    docs, labels = table(spark, FOLDER, "documents").limit(60), table(spark, FOLDER, "labels")
    kept = labels.where("crc32(cast(string(doc_id) as binary)) % 5 <> 0")
    ids = {r.doc_id for r in labels.collect()} & {r.doc_id for r in docs.collect()}
    rows = subwords.sample(docs, kept, "quality").count()
    assert rows == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in ids)
    assert subwords.sample(docs, kept, "quality", 7).count() == 7


def test_odd_rows(spark, frame):
    docs = frame("good words", None, "", "good words", " \t", "x" * 3_000_000, ids=[1, 2, 3, None, 5, 5])
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (9, 1), (5, None), (5, 7)], "doc_id long, quality int")
    assert [tuple(r)[1:] for r in subwords.sample(docs, labels, "quality").collect()] in ([("good words", 1), ("", 0)], [("", 0), ("good words", 1)])
    found = subwords.classified(docs, subwords.learned(docs, labels, "quality"), id_col="doc_id").collect()
    assert len(found) == 6 and all(math.isfinite(r.score) for r in found)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].predicted == 1 and by[None][0].score == by[1][0].score and by[2][0].score == by[3][0].score < 0.3
    assert subwords.classified(frame(), subwords.learned(frame(), labels.limit(0), "quality")).collect() == []
    assert {r.score for r in subwords.classified(docs, subwords.learned(docs, labels.limit(0), "quality")).collect()} == {0.5}
