"""Encoding and decoding by a tokenization automaton made of a tokenizer's merges.

The automaton reads tokens: its states are the last token read, and it has an arc from x to y if y may follow
x. It starts with the single symbols, all of which may follow each other. Each merge (u, v) -> w adds a gadget:
w is entered from where u could be entered, is left to where v could be left, and the arc from u to v goes.
Exactly the sequences that merging in order would give remain, and each word has exactly one.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import table, text_batches

VOCABULARY = "word_bpe_49k.json"
#: Pieces of text whose ids, and arcs that, a task keeps; then it starts anew.
KEPT_PIECES, KEPT_ARCS = 400_000, 400_000
#: Bytes of text that a task takes at once.
SLICE = 4 << 20
_NEVER = 1 << 60


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: itself, or the next free one from 256 on."""
    own = [b for first, last in ((33, 126), (161, 172), (174, 255)) for b in range(first, last + 1)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Automaton:
    """Arcs are worked out from the gadgets when first used and then read from a table."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        n = max(vocab.values()) + 1
        self.label: list[str] = [""] * n
        for token, i in vocab.items():
            self.label[i] = token
        self.left, self.right, self.born = [-1] * n, [-1] * n, [-1] * n
        self.gone: dict[tuple[int, int], int] = {}
        made = {u + v for u, v in merges}
        #: What a token spells; a symbol that ends a word carries a mark.
        self.spelling: dict[int, str] = {}
        for token, i in vocab.items():
            if token not in made:
                self.spelling[i] = token[:-len(suffix)] + "\0" if suffix and token.endswith(suffix) and len(token) > len(suffix) else token
        for rank, (u, v) in enumerate(merges):
            self._gadget(rank, vocab[u], vocab[v], vocab[u + v])
        self.token = {s: i for i, s in self.spelling.items()}
        #: The spellings as a trie: symbol to (node below, token that ends here or -1).
        self.trie: dict = {}
        for spelled, i in self.token.items():
            node = self.trie
            for c in spelled[:-1]:
                node = node.setdefault(c, [{}, -1])[0]
            node.setdefault(spelled[-1], [{}, -1])[1] = i
        self.arcs: dict[tuple[int, int], bool] = {}

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if self.born[w] >= 0:
            raise ValueError("a token with two merges")
        self.left[w], self.right[w], self.born[w] = u, v, rank
        self.gone[u, v] = rank
        self.spelling[w] = self.spelling[u] + self.spelling[v]

    def arc(self, x: int, y: int) -> bool:
        """Whether y may follow x: back through the gadgets, each of which copied the arcs of that time."""
        known = self.arcs.get((x, y))
        if known is not None:
            return known
        a, b, before, out = x, y, _NEVER, True
        while True:
            if self.gone.get((a, b), _NEVER) < before:
                out = False
                break
            age_a, age_b = self.born[a], self.born[b]
            if age_a < 0 and age_b < 0:
                break
            if age_b > age_a:
                if a == self.left[b] == self.right[b]:  # a, aa reads as aa, a
                    out = False
                    break
                b, before = self.left[b], age_b
            elif age_a > age_b:
                a, before = self.right[a], age_a
            else:
                a, b, before = self.right[a], self.left[b], age_a
        if len(self.arcs) > KEPT_ARCS:
            self.arcs.clear()
        self.arcs[x, y] = out
        return out

    def read(self, symbols: str) -> list[int]:
        """The one path whose arcs spell the symbols. Every beginning has one too, told by its last token."""
        whole = self.token.get(symbols)
        if whole is not None and self.born[whole] >= 0 and self._is_path(whole):
            return [whole]
        n = len(symbols)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        arc = self.arc
        for begin in range(n):
            if begin and last[begin] < 0:
                continue
            node, end, before = self.trie, begin, last[begin]
            while node and end < n:
                found = node.get(symbols[end])
                if found is None:
                    break
                node, token = found
                end += 1
                if token >= 0 and last[end] < 0 and (not begin or arc(before, token)):
                    last[end], start[end] = token, begin
        out, end = [], n
        while end > 0:
            out.append(last[end])
            end = start[end]
        return out[::-1]

    def _is_path(self, token: int) -> bool:
        """A token is reached by its own spelling if its parts could stand together until they were merged."""
        u, v, rank = self.left[token], self.right[token], self.born[token]
        return rank < 0 or (self._before(u, v, rank) and self._is_path(u) and self._is_path(v))

    def _before(self, a: int, b: int, rank: int) -> bool:
        kept, self.gone[a, b] = self.gone[a, b], _NEVER
        known = self.arcs.pop((a, b), None)
        out = self.arc(a, b)
        self.gone[a, b] = kept
        self.arcs.pop((a, b), None)
        if known is not None:
            self.arcs[a, b] = known
        return out


class WordTokenizer:
    """Ids and decoded text as the tokenizer file says, for files with word ends and byte-level symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(next(p["pattern"]["Regex"] for p in said["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.symbols = _byte_symbols()
        #: Ids and labels of pieces between white space and of the words that pieces are split into.
        self.pieces: dict[str, tuple[bytes, str]] = {}

    def _kept(self, piece: str, out: tuple[bytes, str]) -> tuple[bytes, str]:
        if len(self.pieces) >= KEPT_PIECES:
            self.pieces.clear()
        self.pieces[piece] = out
        return out

    def _word(self, word: str) -> tuple[bytes, str]:
        ids = self.automaton.read("".join([self.symbols[b] for b in word.encode()]) + "\0")
        return self._kept(word, (struct.pack(f"<{len(ids)}I", *ids), " ".join([self.automaton.label[i] for i in ids])))

    def _piece(self, piece: str) -> tuple[bytes, str]:
        words = self.words.findall(piece)
        if len(words) == 1 and words[0] == piece:
            return self._word(piece)
        parts = [self.pieces.get(w) or self._word(w) for w in words]
        return self._kept(piece, (b"".join([i for i, _ in parts]), " ".join([d for _, d in parts])))

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and what they decode to."""
        ids, labels = [], []
        for part in self.special_split.split(text) if "<|" in text else (text,):
            if part in self.special:
                ids.append(struct.pack("<I", self.special[part]))
                labels.append(part)
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # Letter by letter: a capital sigma has one small form whatever follows.
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            for piece in part.split() if not regex.search("[\x1c-\x1f]", part) else regex.split(r"(?V1)[\s--[\x1c-\x1f]]+", part):
                found = self.pieces.get(piece)
                if found is None:
                    found = self._piece(piece)
                if found[0]:
                    ids.append(found[0])
                    labels.append(found[1])
        return b"".join(ids), " ".join(labels)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs; between them a space, as the file names no decoder."""
        names = {i: s for s, i in self.special.items()}
        return " ".join(names.get(i) or self.automaton.label[i] for (i,) in struct.iter_unpack("<I", ids))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process."""
    return WordTokenizer(path)


def encoded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = True, with_decoded: bool = True
) -> DataFrame:
    """Per row: doc_id, n_tokens, digests of ids and decoded text, and on wish ids (list) and decoded (text).

    A null text counts as empty: no ids and an empty decoded text. Repeated rows and null ids keep one result
    each; whole texts of any length are encoded; other columns are ignored; an empty table gives an empty one.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch, texts in text_batches(batches, "text", SLICE):
            ids, sizes, digests, decoded_digests, decoded = [], [], [], [], []
            for text in texts:
                packed, labels = tokenizer.encode((text or b"").decode())
                sizes.append(len(packed) // 4)
                digests.append(hashlib.sha256(packed).hexdigest())
                decoded_digests.append(hashlib.sha256(labels.encode()).hexdigest())
                if with_ids:
                    ids.append(packed)
                if with_decoded:
                    decoded.append(labels)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                flat = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(ids))])
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), flat))
                names.append("ids")
            if with_decoded:
                columns.append(pa.array(decoded, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_decoded
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), with_ids=False, with_decoded=False)
