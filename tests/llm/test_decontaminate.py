import re
from collections import Counter

import numpy as np

from tidewatch.llm import decontaminate as d
from tidewatch.llm.shared import table

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(text, size=5):
    words = words_of(text)
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def plain(docs, items, least=0.8):
    """Every window of every item's size, compared outright."""
    out = set()
    for doc_id, text in docs:
        for item_id, item_text in items:
            size = min(5, max(1, len(words_of(item_text))))
            doc, item = grams(text, size), grams(item_text, size)
            if not item or not doc:
                continue
            n, want, best = min(len(item), len(doc)), Counter(item), (0.0, None)
            for start in range(len(doc) - n + 1):
                shared = sum((Counter(doc[start:start + n]) & want).values())
                similar = shared / (n + len(item) - shared)
                if similar > best[0]:
                    best = similar, start
            if best[0] >= least - 1e-12:
                out.add((doc_id, item_id, round(best[0], 9), best[1]))
    return out


def check(docs, benchmark):
    got = d.matches(docs, benchmark).collect()
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert {(r.doc_id, r.item_id, round(r.similarity, 9), r.first_shingle) for r in got} == expected
    return got


def test_documents_against_brute_force(spark, documents):
    benchmark = table(spark, SMALL, "benchmark")
    short = documents.where("length(text) < 3000")
    assert check(short, benchmark)


def test_changed_passages(spark, frame):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choice(words, n)) for n in (12, 40, 60, 60, 3, 5)]
    texts = [None, "", "w1", items[4], "x " + items[4], " ".join(items) + " tail"]
    for item in items[:4] * 12:
        w = item.split()
        for _ in range(rng.integers(1, 4)):
            k = rng.integers(0, len(w))
            w[k:k + 1] = [[], ["new"], ["new", "words"]][rng.integers(0, 3)]
        texts.append(" ".join(rng.choice(words, 30)) + " " + ", ".join(w).upper() + " " + " ".join(rng.choice(words, 30)))
    docs = frame(*texts, items[1] * 1, "w " * 50_000 + items[2], ids=[*range(len(texts) - 1), None, 7, 8])
    benchmark = spark.createDataFrame([*enumerate(items), (9, None), (10, ""), (1, items[1])], "item_id long, text string")
    assert len(check(docs, benchmark)) > 10


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(6)
    prints = rng.integers(0, 2**63, 500).astype(np.uint64)
    for radius, blocks in ((20, 4), (7, 8), (3, 4)):
        index = d.HammingIndex(prints, radius, blocks)
        for _ in range(40):
            one = prints[rng.integers(0, 500)] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, radius).astype(np.uint64))
            near = np.flatnonzero(np.bitwise_count(prints ^ one) <= radius).tolist()
            assert index.within(np.array([one])) == [(0, p) for p in near]


def test_blocks_and_empty_tables(spark, documents, frame):
    benchmark = table(spark, SMALL, "benchmark")
    whole = {(r.doc_id, r.item_id) for r in d.matches(documents, benchmark).collect()}
    parts = {(r.doc_id, r.item_id) for r in d.matches(documents, benchmark, block_bytes=3000).collect()}
    assert whole == parts and whole
    assert d.matches(frame(), benchmark).collect() == [] and d.matches(documents, benchmark.where("false")).collect() == []
    left = d.clean(documents, benchmark)
    assert left.columns == documents.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in documents.collect()} - {a for a, _ in whole}


def test_short_items_and_letter_case(spark, frame):
    """Items of fewer than five words inside texts, upper case beyond ASCII, curly quotes and dashes."""
    items = ["école nationale supérieure", "ja", "das große Übungsbuch der Straße “links” neben dem Ärztehaus – sagt man dort", "x y z w", ""]
    texts = [
        "Die ÉCOLE Nationale—SUPÉRIEURE hier", "Ja, ja", "janein", "vor DAS GROSSE Übungsbuch", "nichts x y z v", "x  y\nz, W!", None, "",
        "Hier: DAS GROßE ÜBUNGSBUCH DER STRAßE links NEBEN dem ÄRZTEHAUS, sagt MAN dort … und Ende",
    ]
    benchmark = spark.createDataFrame([*enumerate(items), (7, None), (8, "JA")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.first_shingle) for r in check(frame(*texts), benchmark)}
    assert got == {(0, 0, 1), (1, 1, 0), (1, 8, 0), (5, 3, 0), (8, 2, 1)}


def test_recall_of_the_radius(capsys):
    """Windows at a similarity of 0.8 to 0.85 against their items: those that the radius lets through."""
    rng = np.random.default_rng(9)
    near = total = 0
    while total < 3000:
        n = int(rng.integers(40, 120))
        words = rng.integers(0, 10**9, n).tolist()
        changed = list(words)
        for k in rng.integers(0, n, max(1, n // 45)):
            changed[k] = int(rng.integers(0, 10**9))
        one, two = (d.hashed(" ".join(map(str, w)).encode()) for w in (words, changed))
        shared = len(np.intersect1d(one, two))
        if 0.8 <= shared / (2 * len(one) - shared) < 0.85:
            prints = [d._packed(d._signs(x).sum(axis=0, keepdims=True))[0] for x in (one, two)]
            total += 1
            near += int(np.bitwise_count(prints[0] ^ prints[1])) <= d.RADIUS
    with capsys.disabled():
        print(f"within the radius: {near} of {total}")
    assert near >= 0.995 * total
