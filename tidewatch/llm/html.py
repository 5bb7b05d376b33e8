"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of the same host.

A page is a row of tags and text slots. What repeats side by side becomes a repeated group; the distinct rows of a host are
aligned one after the other, and what only some of them have becomes an optional group. Where pages that differ hold the
same text in a slot, the text is part of the wrapper and no main text. The other slots hold what varies; of those the tags
and names around them tell what stands aside. On a host with too few pages, on a page that its wrapper does not fit, and for
the h1 of an article, which near copies may share, tags and names decide alone.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import scratch, table, text_batches

#: Distinct pages that must hold the same text in a slot, all that have the slot, to make it part of the wrapper.
LEAST_PAGES = 3
#: Wrappers of so many bytes together are sent to every task; more of them meet their pages in a join.
MOST_SENT = 16 << 20
#: Parts in which the rows of a host are aligned before the parts are.
PARTS = 32
#: Longest group that is looked for side by side, in tags and slots.
LONGEST_GROUP = 24
SLOT = "#"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^\"'<>]++|\"[^\"]{0,65536}\"|'[^']{0,65536}')*+)>|[^<]++|<", re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i img kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are no main text, and words in classes and ids that tell the same: some in any company, some only with
#: their like and with words that say nothing.
ASIDE = frozenset("nav footer aside form head title button select option dialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies disqus footer masthead menu modal "
    "nav navbar navigation newsletter popup promo promoted related replies respond sidebar sponsor sponsored subscribe".split()
)
ASIDE_ALONE = frozenset("banner header notice notices share sharing skip social toolbar widget".split())
IDLE_WORDS = frozenset("area bar block body bottom box button buttons container content div inner item left link links list main outer page panel right section site top wrap wrapper".split())
MAIN = frozenset(("article", "main"))
#: An element of this name ends an open one of the same name.
SELF_ENDING = frozenset("p li dt dd tr td th option".split())
LISTS = ("ul", "ol", "table", "dl", "select")


def parsed(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value): 'text' with the raw text, 'open' with the shape (name, classes, id, role), 'close', 'void'. No scripts, styles, comments."""
    for m in _TOKEN.finditer(page):
        name = m[3]
        if name:
            name = name.lower()
            if m[2]:
                yield "close", name, ""
            else:
                marks = sorted({w for x in _NAMED.finditer(m[4]) for w in re.split(r"[^a-z]+", (x[2] or x[3] or x[4] or "").lower()) if w}) if "=" in m[4] else []
                yield "void" if name in VOID or m[4].endswith("/") else "open", name, " ".join([name, *marks])
        elif not m[0].startswith(("<!", "<?")) and not m[1]:
            yield "text", "", m[0]


class Reading:
    """A page read once, forward only. Places are numbered paths of open elements, without plain inline ones."""

    def __init__(self, page: str):
        #: (kind, name, place, value) in order; for each place its key, and whether it lies inside a main element or aside.
        self.tokens: list[tuple[str, str, int, str]] = []
        self.keys, self.inside, self.aside, self.names = [0], [False], [False], [""]
        known: dict[tuple[int, str], int] = {}
        open_names: list[str] = []
        places: list[int] = []
        at_of: dict[str, list[int]] = defaultdict(list)

        def close(at: int) -> None:
            while len(open_names) > at:
                at_of[open_names.pop()].pop()
                places.pop()

        for kind, name, value in parsed(page):
            if kind == "open":
                if name in SELF_ENDING and at_of[name]:
                    at = at_of[name][-1]
                    if all(not at_of[x] or at_of[x][-1] < at for x in LISTS):
                        close(at)
                place = places[-1] if places else 0
                if value not in INLINE:
                    above, place = place, known.get((place, value), -1)
                    if place < 0:
                        place = known[above, value] = len(self.keys)
                        self.keys.append(xxhash.xxh64_intdigest(value, self.keys[above]))
                        self.names.append(name)
                        inside = self.inside[above]
                        self.aside.append(self.aside[above] or stands_aside(value, inside))
                        self.inside.append(inside or is_main(value))
                at_of[name].append(len(open_names))
                open_names.append(name)
                places.append(place)
            elif kind == "close" and at_of[name]:
                close(at_of[name][-1])
            self.tokens.append((kind, name, places[-1] if places else 0, value))

    def has_main(self) -> bool:
        return any(self.inside[place] for kind, _, place, value in self.tokens if kind == "text" and value.strip())

    def slots(self) -> dict[int, int]:
        """For each place with text that could be main text its key and a digest of all its texts."""
        texts = defaultdict(xxhash.xxh64)
        for kind, _, place, value in self.tokens:
            if kind == "text" and value.strip() and not self.aside[place] and self.names[place] != "h1":
                texts[place].update(" ".join(value.split()) + "\n")
        return {self.keys[place]: digest.intdigest() for place, digest in texts.items()}


def stands_aside(shape: str, inside: bool) -> bool:
    """By an element's own name, classes, id and role."""
    name, *marks = shape.split(" ")
    if name in ASIDE or (name == "header" and not inside):
        return True
    if name == "body" or not marks:
        return False
    alone = not ASIDE_ALONE.isdisjoint(marks) and all(m in ASIDE_ALONE or m in IDLE_WORDS for m in marks)
    return alone or not ASIDE_WORDS.isdisjoint(marks)


def is_main(shape: str) -> bool:
    name, *marks = shape.split(" ")
    return name in MAIN or (name == "div" and "main" in marks and "article" in marks)


def sequence(reading: Reading) -> list:
    """Symbols of a page: tags, and SLOT for text that is not blank."""
    out: list = []
    for kind, name, _, value in reading.tokens:
        if kind == "text":
            if value.strip() and (not out or out[-1] != SLOT):
                out.append(SLOT)
        elif name not in INLINE:
            out.append("/" + name if kind == "close" else value)
    return out


def grouped(symbols: list) -> list:
    """Groups that stand side by side twice or more become one repeated group ('+', ...), short groups first."""
    for period in range(1, LONGEST_GROUP + 1):
        out, i = [], 0
        while i < len(symbols):
            group = symbols[i:i + period]
            n = 1
            while len(group) == period and symbols[i + n * period:i + (n + 1) * period] == group:
                n += 1
            if n > 1 and not (period == 1 and group[0] == SLOT):
                out.append(("+", *group) if not (period == 1 and group[0][0] == "+") else group[0])
                i += n * period
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


def _folded(symbols: list, groups: list[tuple]) -> list:
    """Single occurrences of the other page's groups, written as those groups."""
    for group in sorted(set(groups), key=len, reverse=True):
        body, out, i = list(group[1:]), [], 0
        while i < len(symbols):
            if symbols[i:i + len(body)] == body:
                out.append(group)
                i += len(body)
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


def aligned(wrapper: list, page: list) -> list:
    """The wrapper that fits both: mismatches become optional groups ('?', ...)."""
    if wrapper == page:
        return wrapper
    page = _folded(page, [x for x in wrapper if isinstance(x, tuple)])
    wrapper = _folded(wrapper, [x for x in page if isinstance(x, tuple) and x[0] == "+"])
    out: list = []

    def optional(part: list) -> None:
        plain: list = []
        for x in [*part, None]:
            if isinstance(x, tuple) and x[0] == "?" or x is None:
                if plain:
                    out.append(("?", *plain))
                plain = []
                if x is not None:
                    out.append(x)
            else:
                plain.append(x)

    for tag, a, b, c, d in SequenceMatcher(None, wrapper, page, autojunk=False).get_opcodes():
        if tag == "equal":
            out += wrapper[a:b]
        else:
            optional(wrapper[a:b])
            optional(page[c:d])
    return out


def _thawed(x):
    return tuple(x) if isinstance(x, list) else x


def expression(page: str) -> str:
    return json.dumps(grouped(sequence(Reading(page))), ensure_ascii=False)


def aligned_all(expressions: Iterator[str]) -> str:
    """One expression that fits all, as JSON; one after the other, so that only two are held at a time."""
    out: list | None = None
    for said in expressions:
        page = [_thawed(x) for x in json.loads(said)]
        out = page if out is None else aligned(out, page)
    return json.dumps(out or [], ensure_ascii=False)


class Wrapper:
    """The expression of a host, and the keys of the places whose text is part of it."""

    def __init__(self, said: str, fixed: frozenset[int] = frozenset()):
        self.symbols: dict[str, str] = {}
        # Groups keep what they have taken, so matching takes time in proportion to the page.
        self.expression = re.compile("".join(map(self._pattern, json.loads(said))))
        self.fixed = fixed

    def _pattern(self, x) -> str:
        if isinstance(x, list):
            return "(?:" + "".join(map(self._pattern, x[1:])) + ")" + x[0] + "+"
        return self.symbols.setdefault(x, chr(0xF0000 + len(self.symbols)))

    def fits(self, reading: Reading) -> bool:
        return bool(self.expression.fullmatch("".join([self.symbols.get(x, "\0") for x in sequence(reading)])))


@lru_cache(maxsize=4096)
def _wrapper(said: str, fixed: tuple[int, ...]) -> Wrapper:
    return Wrapper(said, frozenset(fixed))


def main_text(page: str, wrapper: Wrapper | None = None) -> str:
    """Blocks of main text in page order, joined by line ends."""
    reading = Reading(page)
    fixed = wrapper.fixed if wrapper and wrapper.fixed and wrapper.fits(reading) else frozenset()
    # By page: a host may have templates with an article and others without.
    has_main = reading.has_main()
    wanted = [not aside and (inside or not has_main) and key not in fixed for key, inside, aside in zip(reading.keys, reading.inside, reading.aside)]
    blocks: list[str] = []
    pieces: list[str] = []

    def end() -> None:
        text = " ".join(references.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            blocks.append(text)

    for kind, name, place, value in reading.tokens:
        if kind == "text":
            if wanted[place]:
                pieces.append(value)
        elif name in ("br", "hr"):
            pieces.append(" ")
        elif name not in INLINE:
            end()
    end()
    return "\n".join(blocks)


def host_of(url_col: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper, fixed (keys of places): of the hosts with a place whose text is the same on LEAST_PAGES distinct pages
    or more and on all that have it.

    Every page counts. A task sends on each page's expression, and the keys and digests of its slots, never its html;
    equal expressions of a host are aligned once, in parts of the host first, each part one after the other.
    """
    rows = pages.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "html"):
            said, pages_, slots = [], [], []
            for text in texts:
                reading = Reading(text.decode())
                said.append(json.dumps(grouped(sequence(reading)), ensure_ascii=False))
                pages_.append(_signed(xxhash.xxh64_intdigest(text)))
                slots.append([{"key": _signed(k), "digest": _signed(d)} for k, d in reading.slots().items()])
            kinds = pa.list_(pa.struct([("key", pa.int64()), ("digest", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said), pa.array(pages_), pa.array(slots, kinds)], ["host", "said", "page", "slots"])

    spark, out = pages.sparkSession, scratch(pages.sparkSession, "expressions")
    rows.mapInArrow(read, "host string, said string, page long, slots array<struct<key: bigint, digest: bigint>>").write.parquet(out)
    seen = spark.read.parquet(out)
    slots = seen.select("host", "page", F.explode("slots").alias("slot")).select("host", "page", "slot.*")
    fixed = slots.groupBy("host", "key").agg(
        F.count_distinct("page").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high")
    ).where((F.col("n") >= LEAST_PAGES) & (F.col("low") == F.col("high")))
    fixed = fixed.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("fixed"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of host and part."""
        now, said = None, ""
        for batch in batches:
            for host, part, following in zip(*[c.to_pylist() for c in batch.columns]):
                if (host, part) == now:
                    said = aligned_all(iter((said, following)))
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([said])], ["host", "said"])
                now, said = (host, part), following
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([said])], ["host", "said"])

    rows = seen.select("host", "said").distinct().join(fixed.select("host"), "host", "left_semi")
    for part in (F.pmod(F.xxhash64("said"), F.lit(PARTS)).cast("int"), F.lit(0)):
        rows = rows.select("host", part.alias("part"), "said").repartition("host", "part").sortWithinPartitions("host", "part", "said")
        rows = rows.mapInArrow(align, "host string, said string")
    return rows.join(fixed, "host").select("host", F.col("said").alias("wrapper"), "fixed")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars. A null html counts as empty and gives an empty text; a url that is null
    or has no host shares a wrapper with its like; broken markup is read as far as it goes; repeated rows and null
    ids keep one result each; whole pages of any length are read; other columns are ignored; an empty table gives
    an empty one."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"), F.col(html_col).alias("html"))
    spark, out = pages.sparkSession, scratch(pages.sparkSession, "wrappers")
    wrappers(pages, url_col, html_col).write.parquet(out)
    found = spark.read.parquet(out)
    size = found.agg(F.sum(F.length("wrapper") + 8 * F.size("fixed")).alias("size")).first()["size"] or 0
    met = rows.join(F.broadcast(found) if size <= MOST_SENT else found, "host", "left").select("page_id", "url", "html", "wrapper", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "html"):
            said, keys = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found = [main_text((t or b"").decode(), _wrapper(w, tuple(k % (1 << 64) for k in f)) if w else None) for t, w, f in zip(texts, said, keys)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return met.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))
