"""Quality rules that vote or abstain, weighed by expectation-maximisation. DataFrame functions only.

A null text counts as empty. Any length of text is taken whole. Repeated rows and null ids keep one result
each; ties (posterior equal to the limit) are kept; an empty table gives an empty result; other columns,
whatever their names, are ignored by `judged` and passed on by `keep_good`.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import cut, let, scratch, table

WHITE = " \t\n\x0b\f\r"
PUNCTUATION, DIGITS = string.punctuation, string.digits
WINDOW = 8
GOOD, BAD, ABSTAIN = 1, -1, 0
#: Rounds of expectation-maximisation; it settles far earlier.
ROUNDS = 50
#: Where the estimate starts and what it is pulled to, with made-up documents of PRIOR_WEIGHT times the real ones.
#: Junk passes most rules and fails one or two: passing is weak evidence, failing is strong.
PRIOR_GOOD, PRIOR_WEIGHT = 0.8, 0.05
PRIOR_RATES = {GOOD: {GOOD: 0.9, ABSTAIN: 0.08, BAD: 0.02}, BAD: {GOOD: 0.5, ABSTAIN: 0.2, BAD: 0.3}}
#: A rule is better than chance: its bad votes are so many times as frequent among bad documents, or more.
LEAST_RATIO = 3.0


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that lie in 8-word windows found twice or more, the first one included.

    Windows are told apart by the 64-bit hash of their words' hashes; within one text two windows that differ
    are confused about once in 2^64 pairs. Sorted with their places, equal windows stand together; the
    places of repeated windows, sorted again, cover min(8, distance to the next) words each.
    """

    def covered(places: Column) -> Column:
        # The list moved by one place is one shorter; the last place has no next one and covers a whole window.
        steps = F.zip_with(F.slice(places, 2, F.size(places)), places, lambda b, a: F.when(b.isNull(), WINDOW).otherwise(F.least(b - a, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda x, y: x + y)

    def places(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def beside(s: Column, x: Column, k: Column) -> Column:
            equal = [F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False)) for at in (k - 1, k + 1)]
            return equal[0] | equal[1]

        kept = let(ranked, lambda s: F.filter(s, lambda x, k: beside(s, x, k)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def of(windows: Column) -> Column:
        # Most texts repeat no window and need no sorting.
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(places(windows), covered))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(hashes, windows), of)).otherwise(0).cast("long")


def counted(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and the counts of each text, as `c_...`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, text.alias("c_text"))
    # One pass over the words for all that needs them.
    facts = let(
        words_of(F.col("c_text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i + 1), F.lit(False)))).cast("long").alias("n_adjacent"),
        ),
    )
    lines = let(
        F.filter(F.split("c_text", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0),
        lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("n")),
    )
    rows = rows.select(*keep, "c_text", facts.alias("c_facts"), lines.alias("c_lines"))
    length = lambda x: F.length(x).cast("long")
    return rows.select(
        *keep, F.col("c_facts.n_words").alias("c_words"), F.col("c_facts.n_repeat_words").alias("c_repeat_words"),
        F.col("c_facts.n_distinct").alias("c_distinct"), F.col("c_facts.n_adjacent").alias("c_adjacent"),
        F.col("c_lines.dup").alias("c_dup_lines"), F.col("c_lines.n").alias("c_lines_n"),
        length(F.translate("c_text", WHITE, "")).alias("c_word_chars"),
        (length("c_text") - length(F.translate("c_text", "#*$%&|<>", ""))).alias("c_symbols"),
        (length("c_text") - length(F.translate("c_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("c_capitals"),
        (length("c_text") - length(F.translate("c_text", DIGITS, ""))).alias("c_digits"),
        (length("c_text") - length(F.translate("c_text", PUNCTUATION + DIGITS, ""))).alias("c_no_letters"),
    )


def _above(share: Column, bad: float, good: float) -> Column:
    """Too much of it is bad, little of it good, between them no vote."""
    return F.when(share > bad, BAD).when(share <= good, GOOD).otherwise(ABSTAIN)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


#: Each rule votes GOOD or BAD or abstains; the last three only know what is bad.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: _above(_share("c_symbols", "c_words"), 0.3, 0.02),
    "no_letters": lambda: _above(_share("c_no_letters", "c_word_chars"), 0.1, 0.05),
    "capitals": lambda: _above(_share("c_capitals", "c_word_chars"), 0.4, 0.1),
    "repeats": lambda: _above(_share("c_repeat_words", "c_words"), 0.25, 0.02),
    "adjacent": lambda: _above(_share("c_adjacent", "c_words"), 0.2, 0.02),
    "lines": lambda: F.when(F.col("c_lines_n") < 3, ABSTAIN).otherwise(_above(_share("c_dup_lines", "c_lines_n"), 0.4, 0.0)),
    # Long texts repeat their words more: the limit falls with the number of digits of the length.
    "variety": lambda: F.when(F.col("c_words") < 30, ABSTAIN).otherwise(
        _above(1 - _share("c_distinct", "c_words") * F.greatest(F.lit(1.0), F.log10(F.col("c_words")) - 1), 0.65, 0.5)
    ),
    "length": lambda: F.when(F.col("c_words") < 10, BAD).otherwise(ABSTAIN),
    "digits": lambda: F.when(_share("c_digits", "c_word_chars") > 0.3, BAD).otherwise(ABSTAIN),
    "word_length": lambda: F.when((F.col("c_words") >= 10) & ~_share("c_word_chars", "c_words").between(2.2, 14), BAD).otherwise(ABSTAIN),
}


def votes() -> list[Column]:
    return [rule().cast("int").alias(f"v_{name}") for name, rule in RULES.items()]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation over vote patterns with their counts.

    The model: a document is good or bad; given that, each rule votes GOOD, BAD or abstains on its own, with
    rates of its own for either kind.
    """
    rules = range(len(RULES))
    model = {"good": PRIOR_GOOD, "rates": [{kind: dict(PRIOR_RATES[kind]) for kind in (GOOD, BAD)} for _ in rules]}
    made_up = max(1.0, PRIOR_WEIGHT * sum(n for _, n in patterns))
    for _ in range(rounds):
        mass = {GOOD: made_up * PRIOR_GOOD, BAD: made_up * (1 - PRIOR_GOOD)}
        seen = [{kind: {v: mass[kind] * x for v, x in PRIOR_RATES[kind].items()} for kind in (GOOD, BAD)} for _ in rules]
        for pattern, n in patterns:
            p = posterior(pattern, model)
            for kind, part in ((GOOD, n * p), (BAD, n * (1 - p))):
                mass[kind] += part
                for rule, vote in enumerate(pattern):
                    seen[rule][kind][vote] += part
        for rule in rules:
            for kind in (GOOD, BAD):
                model["rates"][rule][kind] = {v: x / mass[kind] for v, x in seen[rule][kind].items()}
        model["good"] = mass[GOOD] / (mass[GOOD] + mass[BAD])
    return model


def weight(model: dict, rule: int, vote: int) -> float:
    """What a vote adds to the log odds of good. Abstaining adds nothing: it is no evidence."""
    if vote == ABSTAIN:
        return 0.0
    good, bad = (max(model["rates"][rule][kind][vote], 1e-9) for kind in (GOOD, BAD))
    odds = math.log(good / bad)
    return min(odds, -math.log(LEAST_RATIO)) if vote == BAD else max(odds, 0.0)


def posterior(pattern: tuple[int, ...], model: dict) -> float:
    odds = math.log(model["good"]) - math.log(max(1 - model["good"], 1e-9)) + sum(weight(model, k, v) for k, v in enumerate(pattern))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def learned(votes_cast: DataFrame) -> dict:
    """The model of a table of votes. At most 3^rules patterns reach the driver, however many rows there are."""
    names = [f"v_{name}" for name in RULES]
    found = votes_cast.groupBy(*names).count().collect()
    return estimate([(tuple(r[n] for n in names), r["count"]) for r in found])


def posterior_column(model: dict) -> Column:
    odds = F.lit(math.log(model["good"]) - math.log(max(1 - model["good"], 1e-9)))
    for k, name in enumerate(RULES):
        odds = odds + F.when(F.col(f"v_{name}") == GOOD, weight(model, k, GOOD)).when(F.col(f"v_{name}") == BAD, weight(model, k, BAD)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _failed() -> Column:
    return (F.col("c_words") < 20) | (100 * F.col("c_repeat_words") > 30 * F.col("c_words"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, the posterior probability of good quality, and kept."""
    facts = counted(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ["doc_id"])
    facts = cut(facts.select("*", *votes()))
    good = posterior_column(learned(facts))
    return facts.select(
        "doc_id", F.col("c_words").alias("n_words"), F.col("c_word_chars").alias("word_chars"), F.col("c_symbols").alias("n_symbols"),
        F.col("c_dup_lines").alias("n_dup_lines"), F.col("c_repeat_words").alias("n_repeat_words"),
        _failed().alias("base_failed"), (~_failed() & (good >= least)).alias("kept"), good.alias("posterior"),
    )


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, with their columns. Texts are counted once; the rows wait with their votes in the
    shared folder until the rules' rates are learned from all votes."""
    columns = docs.columns
    facts = counted(docs.select(F.struct(*columns).alias("row"), "text"), ["row"]).select("row", _failed().alias("failed"), *votes())
    spark, out = docs.sparkSession, scratch(docs.sparkSession, "votes")
    facts.write.parquet(out)
    facts = spark.read.parquet(out)
    return facts.where(~F.col("failed") & (posterior_column(learned(facts)) >= least)).select("row.*")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents"))
