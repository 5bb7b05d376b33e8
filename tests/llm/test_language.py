import zlib
from collections import Counter

import numpy as np

from tidewatch.llm import language
from tidewatch.llm.shared import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = language.op2_language(spark, folder).join(table(spark, folder, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r.lang == r.lang_pred for r in rows if r.held_out and r.lang is not None and len(r.text) > 40]
    assert len(held) > 200 and sum(held) / len(held) > 0.97


def test_filter_holds_all_and_little_else():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**62, 6000).astype(np.uint64)
    model = language.GramFilter(["a", "b"], [keys[:2000], keys[1000:3000]])
    found = model.languages_of(keys)
    assert (found[:2000] & 1).all() and (found[1000:3000] >> np.uint64(1) & np.uint64(1)).all()
    for i, start in ((0, 2000), (1, 3000)):
        rate = np.mean(found[start:] >> np.uint64(i) & np.uint64(1)) if i else np.mean(found[start:] & np.uint64(1))
        assert abs(rate - model.false[i]) < 0.02


def test_counts_against_plain_sets():
    texts = ["Hello, wörld!", "", "ab", "Zz zz\x00q", "1234"]
    keys, owner = language.grams_of([t.encode() for t in texts])
    for i, t in enumerate(texts):
        clean = "".join(c if c.isalpha() else " " for c in t.lower() + " ")
        plain = [(" " + clean)[k:k + 3] for k, c in enumerate(clean) if c.isalpha()]
        got = ["".join(chr(int(key) >> s & 0x1FFFFF) for s in (42, 21, 0)) for key in keys[owner == i]]
        assert got == plain


def test_edge_cases(spark, frame):
    model = language.GramFilter(["de", "en"], [language.grams_of([b" der die das und"])[0], language.grams_of([b" the and of was"])[0]])
    docs = frame(None, "", "123 !?", "the and", "die und das", "the " * 60_000, "漢字", ids=[1, 1, None, 2, 3, 4, 5])
    got = {(r.doc_id, r.n_grams): r.lang_pred for r in language.predicted(docs, model).collect()}
    assert got[1, 0] == got[None, 0] == "und" and got[2, 6] == "en" and got[3, 9] == "de" and got[4, 180_000] == "en"
    empty = language.learned(frame().where("false"))
    assert [r.lang_pred for r in language.predicted(frame("some text"), empty).collect()] == ["und"]
    assert language.predicted(frame(), model).collect() == []


def plain_prediction(model_grams, text):
    """The language that has most of a text's n-grams by plain sets; None where two have equally many."""
    keys = language.grams_of([text.encode()])[0].tolist()
    counts = sorted(((sum(k in grams for k in keys), lang) for lang, grams in model_grams.items()), reverse=True)
    return counts[0][1] if len(counts) < 2 or counts[0][0] > counts[1][0] else None


def plain_model(rows):
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(language.grams_of([text.encode()])[0].tolist())
    share = {lang: {k: n / sum(c.values()) for k, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for one in share.values():
        for k, x in one.items():
            best[k] = max(best[k], x)
    return {lang: {k for k, x in one.items() if x >= language.LEAST_PART * best[k]} for lang, one in share.items()}


def test_predictions_against_plain_sets(documents):
    """The filter put together by the tasks has the n-grams of plain counting, and predicts as plain sets do."""
    docs = documents.where("length(text) < 4000")
    rows = docs.collect()
    plain = plain_model([(r.lang, r.text) for r in rows if r.lang is not None and r.text is not None])
    model = language.learned(docs)
    assert model.languages == sorted(plain)
    built = language.GramFilter(sorted(plain), [np.array(sorted(plain[x]), np.int64).view(np.uint64) for x in sorted(plain)])
    assert (built.masks == model.masks).all()
    got = {r.doc_id: r.lang_pred for r in language.predicted(docs, model).collect()}
    expected = {r.doc_id: plain_prediction(plain, r.text) for r in rows if r.text and any(map(str.isalpha, r.text))}
    clear = [i for i, lang in expected.items() if lang]
    assert len(clear) > 100 and sum(got[i] == expected[i] for i in clear) >= 0.99 * len(clear)


def test_more_than_64_languages(spark, frame):
    """150 languages, each with words of its own, and a filter that the bytes make full."""
    words = {i: [f"{chr(0x4e00 + i)}{chr(0x5e00 + k)}{chr(0x4e00 + i)}" for k in range(20)] for i in range(150)}
    docs = spark.createDataFrame([(i, " ".join(words[i]), f"l{i:03d}") for i in words], "doc_id long, text string, lang string")
    texts = frame(*[" ".join(words[i][:10]) for i in words])
    for most_bytes in (language.MOST_BYTES, 1 << 17):
        model = language.learned(docs, most_bytes=most_bytes)
        assert len(model.languages) == 150 and model.masks.nbytes <= most_bytes and model.masks.shape[0] == 3
        assert [r.lang_pred for r in language.predicted(texts, model).orderBy("doc_id").collect()] == [f"l{i:03d}" for i in words]


def test_rare_ngrams_count(spark, frame):
    """An n-gram that one in two million has still tells the language."""
    docs = spark.createDataFrame([(0, "ba" * 1_100_000 + " xyz", "one"), (1, "ba" * 500, "two")], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.predicted(frame("xyz"), language.learned(docs)).collect()] == ["one"]
