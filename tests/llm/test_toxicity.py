import random

from tidewatch.llm import toxicity as t
from tidewatch.llm.shared import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(7)
    terms = ["abc", "abcde", "abced", "aabbccdd", "eeeeeeeee", "cab", "deadbee"]
    automaton = t.LexiconAutomaton(terms, most_arcs=500)
    for _ in range(4000):
        word = "".join(rng.choice("abcde") for _ in range(rng.randint(0, 11)))
        near = [(d, i) for i, x in enumerate(terms) if (d := distance(word, x)) <= t.edits_allowed(x)]
        assert automaton.look_up(word) == min(near, default=None), word
    assert t.LexiconAutomaton([]).look_up("word") is None


def test_context():
    finder = t.Finder(["moron", "worthless"], frozenset({"morons"}))
    plain, quoted = finder.features("you moron you"), finder.features('he wrote "moron" there')
    assert plain[0] > 0 and plain[3] == 0 and plain[4] > 0 and quoted[0] == 0 and quoted[3] > 0
    assert finder.features("such mor0n")[1] > 0 and finder.features("wrthles")[2] > 0 and finder.features("morons moran x")[0] == 0
    assert finder.features("") == [0.0] * 6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = t.op8_toxicity(spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(toxic) / len(toxic) > 0.6 and sum(clean) / len(clean) < 0.03


def test_edge_cases(spark, frame):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (0, 1)], "doc_id long, toxic int")
    model = t.learned(frame("bad bad word", "good word", "other"), labels)
    got = t.scored(frame(None, "", "bad " * 50_000, "é", ids=[1, 1, None, 2]), model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert t.scored(frame(), model).collect() == []
    none = t.learned(frame("a"), labels.where("false"))
    assert [r.score for r in t.scored(frame("a", None), none).collect()] == [0.5, 0.5]


def test_no_term_is_left_out(spark, frame):
    """1,500 terms, some of two letters, that only toxic rows have: all are kept, however many rows share an id."""
    terms = [f"{a}{b}" for a in "qxz" for b in "vwyj"] + [f"vile{i:05d}q" for i in range(1_500)]
    toxic = [" ".join(terms[k::30]) + " you" for k in range(30)] * 3
    clean = [f"a calm text about number {i} and more" for i in range(900)]
    docs = frame(*toxic, *clean, *["a calm text about number 7 and more"] * 50, ids=[*range(len(toxic) + len(clean)), *[95] * 50])
    labels = spark.createDataFrame([(i, int(i < len(toxic))) for i in range(len(toxic) + len(clean))], "doc_id long, toxic int")
    model = t.learned(docs, labels)
    assert set(model.terms) >= set(terms)
    assert t._labelled_sample(docs, labels, 10_000).count() == len(toxic) + len(clean)
    got = {r.doc_id: r.predicted for r in t.scored(frame("qv you", "a calm text", terms[-1]), model).collect()}
    assert got[1] == 0 and got[2] == 1


def test_context_words_are_learned(spark, frame):
    """Words that stand near finds in clean rows only tell quotation, those in toxic rows only abuse."""
    abuse = [f"blarg moronix klee {i}" for i in range(40)]
    report = [f"tradoss wimmel moronix zenit {i}" for i in range(3)]
    docs = frame(*abuse, *report * 2, *[f"plain text {i}" for i in range(400)])
    labels = spark.createDataFrame([(i, int(i < len(abuse))) for i in range(len(abuse) + 406)], "doc_id long, toxic int")
    model = t.learned(docs, labels)
    assert "moronix" in model.terms
    assert {"tradoss", "wimmel"} <= model.reporting - t.REPORTING and "klee" not in model.reporting


def test_features_against_plain_counts(spark, documents):
    """Features of whole texts, by edit distances of all words to all terms."""
    import numpy as np

    model = t.Model(["moron", "worthless", "vorbei"], frozenset({"morons"}), np.zeros(7))
    rows = documents.where("length(text) < 600").limit(60).collect()
    texts = [r.text + extra for r, extra in zip(rows, ['"a moron" he said', " you wrthles thing", " morons vorbai", ""] * 15)]
    for text in texts:
        words = t.WORD.findall(text.lower())
        near = [min(((d, i) for i, x in enumerate(model.terms) if (d := distance(w, x)) <= t.edits_allowed(x)), default=None) if w != "morons" else None for w in words]
        assert t.Finder(model.terms, model.innocent).finds(words) == [(i, f) for i, f in enumerate(near) if f]
