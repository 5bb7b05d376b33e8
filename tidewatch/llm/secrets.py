"""Secrets in texts: fixed patterns, and high-entropy strings by sliding windows. DataFrame functions only.

A null text counts as empty. Texts of any length are searched whole. Repeated rows and null ids keep one
result each; spans that start together are ordered by kind as in KINDS, then by end; an empty table gives an
empty result; other columns are ignored by `found_secrets` and passed on by `redacted`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import let, table

#: Fixed values of the base patterns. Runs of hex digits of 16 or more are whole runs, as are access keys.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
LEAST_ASSIGN = 12
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
#: Character class: pattern of a candidate, least entropy in bits a character of some window.
CLASSES = {
    "entropy_hex": (r"(?<![0-9a-fA-F])[0-9a-fA-F]{20,}", 3.0),
    "entropy_base64": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 3.7),
}
#: Candidates of these forms are no secrets: words, numbers, UUIDs, dates with more behind, paths of words, dummies.
ALLOWED = (
    r"^[A-Za-z+/_=-]*$", r"^[0-9+/_=-]*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"^/?([A-Za-z_-]+/)+[A-Za-z_-]*[0-9]{0,4}$", r"(?i:example|sample|placeholder|changeme|dummy)",
)
MASK = "[SECRET]"
#: Matches that one fold goes over.
BLOCK = 64
_SPAN = "struct<s:int,k:int,e:int,r:int>"


def _cut_in_blocks(values: Column) -> Column:
    """The entries of an array in arrays of BLOCK each; one empty block for an empty array."""
    last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, BLOCK))


def _before(values: Column, join, levels: int = 2) -> Column:
    """For each of the whole numbers in `values` all before it, joined from 0 on.

    A fold copies what it carries at every step, so one that appends to its result takes quadratic time. Here
    folds run over BLOCK entries; what comes before a block follows in the same way from what blocks join to.
    """
    if not levels:
        def step(state: Column, x: Column) -> Column:
            return F.struct(join(state["at"], x).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, start, step, lambda state: state["out"])

    def shifted(blocks: Column) -> Column:
        wholes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), join))
        inner = F.transform(blocks, lambda block: _before(block, join, 0))
        return F.flatten(F.zip_with(inner, let(wholes, lambda w: _before(w, join, levels - 1)), lambda block, at: F.transform(block, lambda x: join(at, x))))

    return let(_cut_in_blocks(values), shifted)


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Leftmost matches that do not overlap: structs of start s and end e (code points), match m, group g.

    What lies between the matches and the matches themselves, put one after the other, give the places.
    """
    def places(both: Column) -> Column:
        lengths = F.transform(both, lambda x: F.length(x["between"]) + F.length(x["m"]))
        ends = let(lengths, lambda n: F.zip_with(_before(n, lambda a, b: a + b), n, lambda at, one: at + one))
        return F.zip_with(both, ends, lambda x, end: F.struct(
            (end - F.length(x["m"])).alias("s"), end.alias("e"), x["m"].alias("m"), x["g"].alias("g")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    both = F.arrays_zip(F.split(text, pattern, -1).alias("between"), found.alias("m"), groups.alias("g"))
    # There is one piece more than matches.
    return F.when(text.rlike(pattern), let(F.filter(both, lambda x: x["m"].isNotNull()), places)).otherwise(
        F.array().cast("array<struct<s:int,e:int,m:string,g:string>>")
    )


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda x: F.struct(
        x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e"), (x["e"] - F.length(x["g"])).alias("r")))


def _times_log(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n)).otherwise(0.0)


def _dense_region(candidate: Column, least: float) -> Column:
    """From the first to the last window of WINDOW characters with the entropy `least`: struct lo, hi (hi -1: none).

    The entropy of a window is log2(W) - sum(c log2 c) / W over its characters' counts c. Moving on by one
    character changes the counts of the one that leaves and the one that enters, and so two terms of the sum.
    """
    def region(chars: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            def moved(before: Column) -> Column:
                gone = F.when(i >= WINDOW, F.get(chars, i - WINDOW))
                here = F.get(chars, i)
                count = lambda one: F.size(F.filter(before, lambda x: x == one))
                leaving = F.when(i >= WINDOW, count(gone)).otherwise(0)
                entering = count(here) - F.when(gone == here, 1).otherwise(0)
                return state["sum"] + _times_log(leaving - 1) - _times_log(leaving) + _times_log(entering + 1) - _times_log(entering)

            def judged(total: Column) -> Column:
                high = (i >= WINDOW - 1) & (F.log2(F.lit(float(WINDOW))) - total / WINDOW >= least)
                return F.struct(
                    total.alias("sum"),
                    F.when(high & (state["hi"] < 0), i - (WINDOW - 1)).otherwise(state["lo"]).alias("lo"),
                    F.when(high, i + 1).otherwise(state["hi"]).alias("hi"),
                )

            before = F.slice(chars, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW)))
            return let(let(before, moved), judged)

        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step)

    return let(F.split(candidate, ""), region)


def _entropy_spans(text: Column, kind: str) -> Column:
    pattern, least = CLASSES[kind]
    allowed = lambda m: F.exists(F.array(*[m.rlike(p) for p in ALLOWED]), lambda hit: hit)
    candidates = F.filter(_matches(text, pattern), lambda x: ~allowed(x["m"]))
    regions = F.transform(candidates, lambda x: F.struct(x["s"].alias("s"), _dense_region(x["m"], least).alias("d")))
    return F.transform(
        F.filter(regions, lambda x: x["d"]["hi"] >= 0),
        lambda x: F.struct(
            (x["s"] + x["d"]["lo"]).alias("s"), F.lit(KINDS.index(kind)).alias("k"), (x["s"] + x["d"]["hi"]).alias("e"),
            (x["s"] + x["d"]["lo"]).alias("r"),
        ),
    )


def spans_of(text: Column) -> Column:
    """All spans of a text in order: structs of start s, kind k (place in KINDS), end e, start r of the secret itself."""
    assign = F.filter(_matches(text, ASSIGN, 2), lambda x: F.length(x["g"]) >= LEAST_ASSIGN)
    every = [_spans(assign, "assign"), _spans(_matches(text, ACCESS), "access"), _spans(_matches(text, HEX), "hex")]
    every += [_entropy_spans(text, kind) for kind in CLASSES]
    return F.sort_array(F.concat(*[x.cast(f"array<{_SPAN}>") for x in every]))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def found_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, all spans as kind:start:end."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = let(text, spans_of)
    count = lambda kind: F.size(F.filter("found", lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    rows = docs.select(F.col(id_col).alias("doc_id"), spans.alias("found"))
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.filter("found", lambda x: x["k"] < 3)), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """The text with MASK in place of each secret; secrets that touch or overlap share one.

    A place in a text is found by going there from its start, so pieces are taken from the part of their block.
    """
    def pieces(block: Column) -> Column:
        first, last = F.get(block, F.lit(0))["at"], F.array_max(F.transform(block, lambda x: x["r"]))
        part = F.substring(text, first + 1, F.greatest(last - first, F.lit(0)))
        return let(F.struct(first.alias("first"), part.alias("part")), lambda own: F.array_join(F.transform(block, lambda x: F.when(
            x["r"] >= x["at"], F.concat(F.substring(own["part"], x["at"] - own["first"] + 1, x["r"] - x["at"]), F.lit(MASK))).otherwise("")), ""))

    def whole(secrets: Column) -> Column:
        ends = F.transform(secrets, lambda x: x["e"])
        placed = F.zip_with(secrets, let(ends, lambda e: _before(e, lambda a, b: F.greatest(a, b))), lambda x, at: F.struct(x["r"].alias("r"), at.alias("at")))
        masked = F.transform(let(placed, _cut_in_blocks), pieces)
        return F.concat(F.array_join(masked, ""), F.substring(text, F.array_max(ends) + 1, F.length(text)))

    by_secret = F.sort_array(F.transform(spans, lambda x: F.struct(x["r"].alias("r"), x["e"].alias("e"))))
    return F.when(F.size(spans) > 0, let(by_secret, whole)).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every secret masked in `text`, and `n_chars`, where it exists, counted anew. No row is lost; a null text stays null."""
    text = let(F.col("text"), lambda t: let(spans_of(F.coalesce(t, F.lit(""))), lambda spans: _masked(t, spans)))
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return found_secrets(table(spark, folder, "documents"))
