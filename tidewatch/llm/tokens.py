"""Token ids in Parquet files: list columns, bounded row groups and pages, offsets for selective reads.

Format: files in ascending order of their ids, rows in ascending order of the id. Columns: doc_id, offset
(tokens of the same file before it), n_tokens, tokens. Ids and offsets are delta encoded, tokens dictionary
encoded; pages are small and indexed, so that a few documents or the metadata alone can be read.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import scratch, table, text_batches

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Bytes of text that a task encodes at once.
SLICE = 4 << 20
#: Pieces of text whose ids a task keeps; then only those of its last texts stay.
KEPT_PIECES = 400_000
FORMAT = {
    "parquet.writer.version": "v2", "parquet.block.size": str(64 << 20), "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "true", "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#offset": "false", "compression": "zstd",
}
SCHEMA = "doc_id long, offset long, n_tokens long, tokens array<int>"
#: Kinds of bytes: beyond ASCII, letters, digits, space, other white space, apostrophe, all else, and END.
BEYOND, LETTER, DIGIT, SPACE, WHITE, APOSTROPHE, MARK, ENDS = range(8)
#: Bytes that UTF-8 does not have: behind each text, and before the number of a text that is asked for whole.
END, WHOLE = b"\xff", b"\xfe"
#: Words that are asked for in one row.
ROW = 200
#: Pieces of more bytes are not kept for the next texts.
LONGEST = 100


def _kinds() -> np.ndarray:
    kinds = np.full(256, MARK, np.uint8)
    kinds[128:] = BEYOND
    kinds[END[0]] = ENDS
    for kind, of in ((LETTER, string.ascii_letters), (DIGIT, string.digits), (SPACE, " "), (WHITE, "\t\n\v\f\r"), (APOSTROPHE, "'")):
        kinds[list(of.encode())] = kind
    return kinds


#: Whether the pattern parts between two kinds: no or not known, yes, or one of these questions about the neighbours.
NO, YES, LAST_WHITE, WHITE_BEYOND, BEYOND_MARK, MARK_BEYOND = range(6)


def _parts() -> np.ndarray:
    parts = np.zeros((8, 8), np.uint8)
    parts[[LETTER, DIGIT, MARK, APOSTROPHE], SPACE] = parts[[LETTER, DIGIT, MARK, APOSTROPHE], WHITE] = YES
    parts[LETTER, [DIGIT, MARK, APOSTROPHE]] = parts[DIGIT, [LETTER, MARK, APOSTROPHE]] = YES
    parts[MARK, [LETTER, DIGIT]] = parts[APOSTROPHE, DIGIT] = parts[WHITE, [LETTER, DIGIT, MARK, APOSTROPHE]] = YES
    parts[np.ix_([SPACE, WHITE, BEYOND], [SPACE, WHITE])] = LAST_WHITE
    parts[WHITE, BEYOND], parts[BEYOND, [MARK, APOSTROPHE]], parts[MARK, BEYOND] = WHITE_BEYOND, BEYOND_MARK, MARK_BEYOND
    parts[ENDS, :] = parts[:, ENDS] = YES
    return parts.ravel()


KINDS, PARTS = _kinds(), _parts()


def _letters(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether two bytes are a letter of U+00C0 to U+024F or U+0400 to U+047F."""
    latin = (first >= 0xC4) & (first <= 0xC9) | (first == 0xC3) & (second != 0x97) & (second != 0xB7)
    return latin | (first == 0xD0) | (first == 0xD1)


def _dark(first: np.ndarray) -> np.ndarray:
    """Whether the character that begins with this byte is known not to be white space."""
    return ~np.isin(KINDS[first], [SPACE, WHITE, ENDS]) & ~np.isin(first, [0xC2, 0xE1, 0xE2, 0xE3])


def piece_starts(data: bytes) -> np.ndarray:
    """Where the vocabulary's pattern begins a word, whatever else there is; data ends with END.

    It parts between letters, digits and marks, but for letters behind an apostrophe; before white space; in a row
    of white space before its last character, unless the text ends there; and behind one that is no space. Characters
    beyond ASCII that may be of either kind stay with their neighbours, so a piece may have several words.
    """
    of = np.frombuffer(END + data + END, np.uint8)
    kinds = KINDS[of]
    parts = PARTS[kinds[:-1] << 3 | kinds[1:]][:-1]
    starts = parts == YES

    def answer(question: int, reply) -> None:
        at = np.flatnonzero(parts == question)  # between of[at] and of[at + 1]
        starts[at] = reply(at)

    answer(LAST_WHITE, lambda at: _dark(of[at + 2]) | (kinds[at] == BEYOND) & ~(np.isin(of[at - 1], [0xC2, 0x9A, 0x80, 0x81])))
    answer(WHITE_BEYOND, lambda at: _dark(of[at + 1]))
    answer(BEYOND_MARK, lambda at: _letters(of[at - 1], of[at]))
    answer(MARK_BEYOND, lambda at: _letters(of[at + 1], of[at + 2]))
    return np.flatnonzero(starts)


class Pieces:
    """Ids of texts from the library, which is asked once for each piece that recurs. Texts with special tokens go
    to the library whole, and so does everything if the vocabulary has another pattern than the usual one of bytes.
    What is known lies in arrays: pieces, how many ids each has, and the ids in a row."""

    #: Pieces that are one row of dark characters, with or without a space before.
    WORD = "^ ?[^\\pZ\\x00-\\x20\\x7f\\x{85}]+$"

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        parts, usual = json.loads(self.library.to_str()), {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.usual = parts["normalizer"] is None and usual.items() <= (parts["pre_tokenizer"] or {}).items()
        vocabulary = self.library.get_vocab()
        self.line_end = vocabulary.get("\u010a", -1)
        self.first = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space or a line end
        self.first[[i for t, i in vocabulary.items() if t.startswith(("\u0120", "\u010a"))]] = True
        self.numbers = count()
        self.known = pa.array([END], pa.large_binary())
        self.lengths, self.ids = np.array([1]), np.array([end_id], np.int32)

    def _ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids in a row."""
        lists = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(map(len, lists), np.int64, len(lists)), np.fromiter(chain.from_iterable(lists), np.int32)

    def _learn(self, new: pa.Array) -> None:
        """Words are asked for in rows: a word that has no space before gets a line end there, and the first id of
        each tells where it begins, for no other id in a row has a space or a line end."""
        new = new.cast(pa.large_string())
        is_word = pc.match_substring_regex(new, self.WORD)
        words, rest = new.filter(is_word), new.filter(pc.invert(is_word))
        if len(words):
            line_end, none = (pa.scalar(t, pa.large_string()) for t in ("\n", ""))
            spaced = pc.if_else(pc.starts_with(words, " "), words, pc.binary_join_element_wise(line_end, words, none))
            rows = pa.ListArray.from_arrays(pa.array([*range(0, len(words), ROW), len(words)], pa.int32()), spaced)
            _, ids = self._ask(pc.binary_join(rows, none).to_pylist())
            firsts = np.append(np.flatnonzero(self.first[ids]), len(ids))
            if len(firsts) == len(words) + 1:
                added = ids == self.line_end
                self._add(words, np.diff(firsts) - added[firsts[:-1]], ids[~added])
            else:  # a vocabulary that joins or lacks some of them
                self._add(words, *self._ask(words.to_pylist()))
        if len(rest):
            self._add(rest, *self._ask(rest.to_pylist()))

    def _add(self, pieces_: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, pieces_.cast(pa.large_binary())])
        self.lengths, self.ids = np.concatenate((self.lengths, lengths)), np.concatenate((self.ids, ids))

    def _keep(self, stay: np.ndarray) -> None:
        self.ids = self.ids[np.repeat(stay, self.lengths)]
        self.known, self.lengths = self.known.filter(pa.array(stay)), self.lengths[stay]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, the end id behind each, and the number of ids of each text."""
        aside = [i for i, t in enumerate(texts) if not self.usual or any(s in t for s in self.special)]
        if aside:
            numbers = [WHOLE + b"%d" % next(self.numbers) for _ in aside]
            self._add(pa.array(numbers, pa.large_binary()), *self._ask([texts[i].decode() for i in aside]))
            named = dict(zip(aside, numbers))
            texts = [named.get(i, t) for i, t in enumerate(texts)]
        data = END.join(texts) + END
        if data.count(END) != len(texts) or data.count(WHOLE) != len(aside):
            raise ValueError("a text is not UTF-8")
        starts = piece_starts(data)
        bounds = pa.py_buffer(np.append(starts, len(data)))
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        rows = pc.index_in(found.dictionary, self.known)
        if rows.null_count:
            new, before = found.dictionary.filter(rows.is_null()), len(self.known)
            self._learn(new)
            learned = pc.add(pc.index_in(new, self.known.slice(before)), pa.scalar(before, pa.int32()))
            rows = pc.replace_with_mask(rows, rows.is_null(), learned)
        rows = np.asarray(rows)
        of = rows[np.asarray(found.indices)]  # the row of each piece
        sizes = self.lengths[of]
        sums = np.cumsum(sizes)
        firsts = (np.cumsum(self.lengths) - self.lengths)[of]
        ids = self.ids[np.repeat(firsts - (sums - sizes), sizes) + np.arange(sums[-1])]
        counts = np.diff(sums[of == 0], prepend=0)
        stay = np.asarray(pc.binary_length(self.known)) <= LONGEST
        if aside:
            stay &= ~np.asarray(pc.starts_with(self.known, WHOLE), bool)
        if len(self.known) > KEPT_PIECES:  # what occurs often is in these texts too
            stay &= np.isin(np.arange(len(stay)), rows)
        if not stay.all():
            self._keep(stay)
        return ids, counts


@lru_cache(maxsize=2)
def pieces(path: str, end_id: int) -> Pieces:
    """One for each worker process."""
    return Pieces(path, end_id)


def write_tokens(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID) -> None:
    """Encodes and writes every text. A null text counts as empty and has the end id only; null ids come first;
    rows with the same id are ordered by their text; whole texts of any length are encoded; an empty table
    gives files without rows. The texts are sorted by range of ids, so no task holds more than its share."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch, texts in text_batches(batches, "text", SLICE):
            ids, sizes = pieces(path, end_id).encode([t or b"" for t in texts])
            offsets = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(offsets), pa.array(sizes), lists], ["doc_id", "offset", "n_tokens", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.options(**FORMAT).parquet(out)


def _file_number(name: Column) -> Column:
    return F.regexp_extract(name, r"part-(\d+)", 1).cast("long")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The files' rows with the number of their file; choose columns and ids on the result to read only those."""
    return spark.read.schema(SCHEMA).parquet(folder).select("*", _file_number(F.col("_metadata.file_name")).alias("file"))


def with_start(rows: DataFrame, folder: str) -> DataFrame:
    """Adds `start`, the tokens of all documents before; rows must hold offset and file. One number for each file is summed up."""
    totals = read_tokens(rows.sparkSession, folder).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "file").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, file, offset, n_tokens and ids_crc32 of rows read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends, values = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4")
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            sizes = np.diff(ends).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes), pa.array(sums, pa.int64())],
                ["doc_id", "file", "offset", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "file", "offset", "tokens").mapInArrow(run, "doc_id long, file long, offset long, n_tokens long, ids_crc32 long")


def op3_tokens(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), out)
    return with_start(digests(read_tokens(spark, out)), out).select("doc_id", "start", "n_tokens", "ids_crc32")
