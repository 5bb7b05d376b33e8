import math
import re
import string

from tidewatch.llm import quality
from tidewatch.llm.shared import table


def plain(text):
    text = text or ""
    spans = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(spans) - 7):
        seen.setdefault(tuple(spans[i:i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(spans)
    return {
        "n_words": n, "word_chars": sum(map(len, spans)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def check(docs):
    texts = sorted(map(repr, ((r.doc_id, *plain(r.text).values()) for r in docs.collect())))
    rows = quality.judged(docs).collect()
    assert texts == sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    return rows


def test_documents_against_brute_force(documents):
    rows = check(documents)
    assert 0 < sum(r.kept for r in rows) < len(rows)


def plain_votes(text):
    """The votes of one text, rule by rule: 1 good, -1 bad, 0 abstains."""
    text, facts = text or "", plain(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(words), facts["word_chars"]
    among = lambda some: sum(c in some for c in text)
    of_words, of_chars = (lambda x: x / max(n, 1)), (lambda x: x / max(chars, 1))
    judge = lambda share, bad, good: -1 if share > bad else 1 if share <= good else 0
    variety = 1 - of_words(len(set(words))) * max(1.0, math.log10(n) - 1) if n >= 30 else None
    return (
        judge(of_words(facts["n_symbols"]), 0.3, 0.02),
        judge(of_chars(among(string.punctuation + string.digits)), 0.1, 0.05),
        judge(of_chars(among(string.ascii_uppercase)), 0.4, 0.1),
        judge(of_words(facts["n_repeat_words"]), 0.25, 0.02),
        judge(of_words(sum(a == b for a, b in zip(words, words[1:]))), 0.2, 0.02),
        0 if len(lines) < 3 else judge(facts["n_dup_lines"] / len(lines), 0.4, 0.0),
        0 if variety is None else judge(variety, 0.65, 0.5),
        -1 if n < 10 else 0,
        -1 if of_chars(among(string.digits)) > 0.3 else 0,
        -1 if n >= 10 and not 2.2 <= of_words(chars) <= 14 else 0,
    )


def plain_posteriors(cast):
    """Expectation-maximisation document by document, each with its own belief, from the same start."""
    kinds, options, rules = (1, -1), (1, 0, -1), range(len(cast[0]))
    rate = {(r, kind, v): quality.PRIOR_RATES[kind][v] for r in rules for kind in kinds for v in options}
    good, made_up = quality.PRIOR_GOOD, max(1.0, quality.PRIOR_WEIGHT * len(cast))

    def belief(votes):
        odds = math.log(good / (1 - good))
        for r, v in enumerate(votes):
            gain = math.log(rate[r, 1, v] / rate[r, -1, v])
            odds += 0 if v == 0 else max(gain, 0) if v == 1 else min(gain, -math.log(quality.LEAST_RATIO))
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        sure = [belief(votes) for votes in cast]
        mass = {1: made_up * quality.PRIOR_GOOD + sum(sure), -1: made_up * (1 - quality.PRIOR_GOOD) + sum(1 - p for p in sure)}
        start = {1: made_up * quality.PRIOR_GOOD, -1: made_up * (1 - quality.PRIOR_GOOD)}
        rate = {
            (r, kind, v): (start[kind] * quality.PRIOR_RATES[kind][v] + sum(p if kind == 1 else 1 - p for p, votes in zip(sure, cast) if votes[r] == v)) / mass[kind]
            for r in rules for kind in kinds for v in options
        }
        good = mass[1] / (mass[1] + mass[-1])
    return [belief(votes) for votes in cast]


def test_verdicts_against_brute_force(documents):
    """Votes, estimated rates, posteriors and what is kept, all from plain loops over the documents."""
    rows = documents.collect()
    cast = [plain_votes(r.text) for r in rows]
    assert all({votes[rule] for votes in cast} - {0} for rule in range(len(quality.RULES) - 2))
    want = sorted(zip((r.doc_id for r in rows), plain_posteriors(cast), (plain(r.text)["base_failed"] for r in rows)))
    got = sorted((r.doc_id, r.posterior, r.kept) for r in quality.judged(documents).collect())
    assert len(got) == len(want)
    for (one, p, kept), (other, q, failed) in zip(got, want):
        assert one == other and abs(p - q) < 1e-9 and kept == (not failed and q >= 0.5)


def test_edge_cases(frame):
    phrase = "a b c d e f g h i j "
    check(frame(
        None, "", "\n\n \t", "one", phrase * 3, phrase + "x " + phrase, "same " * 5000, "l\nl\n l\nm\nm\n", "é ü | # \x0b\f\r x y",
        "w1 w2 w3 w4 w5 w6 w7 w8", "a b c d e f g h i b c d e f g h i", ids=[1, 1, None, 2, 3, 4, 5, 6, 7, 8, 9],
    ))
    assert quality.judged(frame()).collect() == [] and quality.keep_good(frame()).collect() == []


def test_agrees_with_labels(spark):
    """Held-out labels: junk goes, clean documents stay."""
    folder = "/root/testdata/sf0.01"
    rows = quality.judged(table(spark, folder, "documents")).join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) / len(clean) > 0.97
    assert sum(junk) / len(junk) < 0.25


def test_keep_good_is_judged(documents):
    kept = {r.doc_id for r in quality.judged(documents).collect() if r.kept}
    out = quality.keep_good(documents)
    assert out.columns == documents.columns and {r.doc_id for r in out.collect()} == kept


def test_main_path_has_no_python(documents):
    plan = quality.keep_good(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
