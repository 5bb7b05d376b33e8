"""Documents that hold benchmark items: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are those of letters and digits in lower case, of any script; shingles are five words. Similarity is the
weighted Jaccard of two multisets of shingles: the sum of the smaller counts over the sum of the larger ones. An
item of fewer words than a shingle is one shingle of its own length, sought among those of that length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import cut, table, text_batches

SIZE, LEAST = 5, 0.8
BITS, BLOCKS = 64, 4
#: Differing bits up to which windows are verified. At similarity 0.8 a bit differs with probability
#: arccos(0.889) / pi = 0.15: 9.7 of 64 on average, 20 or fewer in all but one of some thousand cases.
RADIUS = 20
#: Bytes of benchmark text that are sent to the tasks at once; larger benchmarks are taken block by block.
BLOCK_BYTES = 16 << 20
_WORD = re.compile(rb"[0-9a-z]+")
_ANY_WORD = re.compile(r"[^\W_]+")
_PRIME, _MIX1, _MIX2 = np.uint64(0x100000001B3), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(33))) * _MIX2
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the base of the rolling hash and of its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            m = max(n + 1, 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(m, b, np.uint64))), dtype=np.uint64) for b in (int(_PRIME), _inverse(int(_PRIME)))
            )


_powers = Powers()


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits in lower case."""
    text = text or b""
    return _WORD.findall(text.lower()) if text.isascii() else [w.encode() for w in _ANY_WORD.findall(text.decode().lower())]


def hashed(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """64-bit hashes of all shingles of a text in order; fewer words than size: of the whole sequence; no word: none.

    One polynomial hash over the bytes gives those of all shingles by differences.
    """
    return _hashed(words_of(text), size)


def _hashed(words: list[bytes], size: int) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    _powers.reach(len(joined))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(joined * _powers.up[:len(joined)])))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    first, last = starts[:n], ends[min(size, len(words)) - 1:]
    return _mixed((sums[last] - sums[first]) * _powers.down[first])


def _signs(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return 2 * bits.astype(np.int32) - 1


def _packed(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


class HammingIndex:
    """All stored fingerprints within a radius of a given one, by tables of their blocks.

    With m blocks, one block of any fingerprint within radius r differs in r // m bits or fewer. Each table
    has the values of its block in order, with the stored fingerprints that have them.
    """

    def __init__(self, prints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius, self.width = prints, radius, BITS // blocks
        self.near = radius // blocks
        masks = [sum(1 << b for b in some) for k in range(self.near + 1) for some in combinations(range(self.width), k)]
        self.masks = np.array(masks, np.uint64)
        self.tables: list[tuple[np.ndarray, list[np.ndarray]]] = []
        for block in range(blocks):
            values, inverse = np.unique(self._block(prints, block), return_inverse=True)
            self.tables.append((values, [np.flatnonzero(inverse == i) for i in range(len(values))]))

    def _block(self, prints: np.ndarray, block: int) -> np.ndarray:
        return prints >> np.uint64(block * self.width) & np.uint64((1 << self.width) - 1)

    def within(self, prints: np.ndarray) -> list[tuple[int, int]]:
        """Pairs (place in prints, place in the stored ones) within the radius, in order."""
        found = set()
        for block, (values, places) in enumerate(self.tables):
            if not len(values):
                continue
            own = self._block(prints, block)
            # The shorter way round: look up all values nearby, or compare with all that are stored.
            if len(self.masks) < len(values):
                sought = own[:, None] ^ self.masks[None, :]
                at = np.minimum(np.searchsorted(values, sought), len(values) - 1)
                rows, columns = np.nonzero(values[at] == sought)
                hits = zip(rows.tolist(), at[rows, columns].tolist())
            else:
                hits = zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(own[:, None] ^ values[None, :]) <= self.near)))
            for i, v in hits:
                near = places[v][np.bitwise_count(self.prints[places[v]] ^ prints[i]) <= self.radius]
                found.update((i, p) for p in near.tolist())
        return sorted(found)


class Items:
    """Benchmark items made ready for search."""

    def __init__(self, ids: list[int | None], texts: list[bytes | None], size: int = SIZE, least: float = LEAST, radius: int = RADIUS):
        self.size, self.least = size, least
        words = [words_of(t) for t in texts]
        hashes = [_hashed(w, size) for w in words]
        #: Items shorter than a shingle come behind the others, by their length and their one shingle.
        short = [i for i, w in enumerate(words) if 0 < len(w) < size]
        used = [i for i, w in enumerate(words) if len(w) >= size]
        self.ids = [ids[i] for i in [*used, *short]]
        self.short: dict[int, dict[int, list[int]]] = {}
        for place, i in enumerate(short, len(used)):
            self.short.setdefault(len(words[i]), {}).setdefault(int(hashes[i][0]), []).append(place)
        self.hashes = [hashes[i] for i in used]
        self.counts = [Counter(h.tolist()) for h in self.hashes]
        prints = [_packed(_signs(h).sum(axis=0, keepdims=True))[0] for h in self.hashes]
        self.lengths = np.array([len(h) for h in self.hashes], np.int64)
        # A window is as long as its item: one index for each length.
        self.of_length = {int(n): np.flatnonzero(self.lengths == n) for n in np.unique(self.lengths)}
        self.indexes = {n: HammingIndex(np.array(prints, np.uint64)[at], radius) for n, at in self.of_length.items()}
        self.shingles = np.unique(np.concatenate(self.hashes)) if used else np.empty(0, np.uint64)
        # A bit for the low end of each hash rules most shingles of documents out without a search.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.shingles & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found_in(self, text: bytes | None) -> list[tuple[int, float, int]]:
        """(item's place, similarity, first shingle) of the most similar window of each item found; of equals the first.

        Windows of every item's size at every place are meant. Those in which fewer shingles than `least` of the
        smallest possible union occur in any item cannot be similar to one, so they get no fingerprint.
        """
        words = words_of(text)
        return [*self._long_in(_hashed(words, self.size)), *self._short_in(words)]

    def _short_in(self, words: list[bytes]) -> list[tuple[int, float, int]]:
        """Items shorter than a shingle, at the first place where their words follow each other."""
        found = []
        for length, sought in sorted(self.short.items()):
            if len(words) >= length:
                own = _hashed(words, length)
                spots = np.flatnonzero(np.isin(own, np.fromiter(sought, np.uint64, len(sought))))
                values, first = np.unique(own[spots], return_index=True)
                found += [(i, 1.0, int(spots[at])) for v, at in zip(values.tolist(), first) for i in sought[v]]
        return found

    def _long_in(self, doc: np.ndarray) -> list[tuple[int, float, int]]:
        hit = self.seen[(doc & np.uint64((1 << 20) - 1)).astype(np.int64)] if len(doc) else np.empty(0, bool)
        spots = np.flatnonzero(hit)
        if not spots.size:
            return []
        spots = spots[self.shingles[np.minimum(np.searchsorted(self.shingles, doc[spots]), len(self.shingles) - 1)] == doc[spots]]
        if not spots.size:
            return []
        known = np.zeros(len(doc) + 1, np.int64)
        known[spots + 1] = 1
        known = np.cumsum(known)
        best: dict[int, tuple[float, int]] = {}
        for length in np.unique(self.lengths):
            n = int(min(length, len(doc)))
            # Shared counts are at least least / (1 + least) of both sizes together.
            needed = int(np.ceil(self.least * (n + length) / (1 + self.least) - 1e-9))
            starts = np.flatnonzero(known[n:] - known[:len(known) - n] >= needed)
            for part in np.array_split(starts, len(starts) // 1024 + 1):
                if part.size:
                    self._windows(doc, part, n, int(length), best)
        return [(i, s, at) for i, (s, at) in sorted(best.items())]

    def _windows(self, doc: np.ndarray, starts: np.ndarray, n: int, length: int, best: dict) -> None:
        low = int(starts[0])
        sums = np.concatenate((np.zeros((1, BITS), np.int32), np.cumsum(_signs(doc[low:int(starts[-1]) + n]), axis=0, dtype=np.int32)))
        prints = _packed(sums[starts - low + n] - sums[starts - low])
        last, window = -1, Counter()
        for k, place in self.indexes[length].within(prints):
            start, i = int(starts[k]), int(self.of_length[length][place])
            if start != last:
                last, window = start, Counter(doc[start:start + n].tolist())
            item = self.counts[i]
            shared = sum(min(c, item[h]) for h, c in window.items() if h in item)
            similar = shared / (n + length - shared)
            if similar >= self.least - 1e-12 and similar > best.get(i, (0.0, 0))[0]:
                best[i] = similar, start


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of about `most` bytes, fetched one after the other."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect() if n > 1 else rows.collect()
        yield [r.item for r in part], [r.text.encode() for r in part]


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = SIZE, least: float = LEAST, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, similarity, first_shingle: the most similar window of each item in each document.

    Texts and items that are null or have no word match nothing; items shorter than a shingle match where their
    words follow each other in a text, first_shingle being their first word's place; repeated documents and items each give their rows; null ids are passed on; whole texts of
    any length are searched; other columns are ignored; empty tables give an empty result. Every document goes
    through one task without a shuffle, once for each block of the benchmark.
    """
    schema = "doc_id long, item_id long, similarity double, first_shingle long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for ids, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(*sent.value, size, least, radius)
            for batch, texts in text_batches(batches, "text"):
                out = [(d, items.ids[i], s, at) for d, t in zip(batch.column(0).to_pylist(), texts) for i, s, at in items.found_in(t)]
                columns = list(zip(*out)) or [(), (), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "similarity", "first_shingle"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no benchmark item was found, with their columns. Rows with a null id stay."""
    hit = cut(matches(docs, benchmark).select("doc_id").where("doc_id is not null").distinct())
    return docs.join(hit, "doc_id", "left_anti").select(docs.columns)


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
