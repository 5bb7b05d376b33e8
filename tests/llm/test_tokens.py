import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm import tokens
from tidewatch.llm.shared import scratch

LIBRARY = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))


def check(spark, docs):
    out = scratch(spark, "tokens")
    tokens.write_tokens(docs, out)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    start, expected = 0, []
    for r in rows:
        ids = [*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 2]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = tokens.with_start(tokens.digests(tokens.read_tokens(spark, out)), out).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == [(s, i, n, c) for i, s, n, c in expected]
    return out


def test_documents_against_the_library(spark, documents):
    out = check(spark, documents)
    some = tokens.read_tokens(spark, out).where("doc_id = 17").select(F.size("tokens").alias("n"), "n_tokens").collect()
    assert [r.n for r in some] == [r.n_tokens for r in some] and len(some) == 1
    files = spark.read.parquet(out).inputFiles()
    column = pq.ParquetFile(files[0].removeprefix("file:")).metadata.row_group(0).column(0)
    assert column.has_column_index and column.has_offset_index and "DELTA_BINARY_PACKED" in column.encodings


def test_edge_cases(spark, frame):
    texts = [None, "", " a  b   c \n\n d", " lead", "trail ", "x<|endoftext|>y", "tab\t x\n y \n z", "é \U0001f600  ", "word " * 4000, "it's we'll 12 !!"]
    check(spark, frame(*texts, "again", ids=[5, 4, 3, 2, 1, 0, None, 9, 8, 7, 5]))
    out = scratch(spark, "tokens")
    tokens.write_tokens(frame(), out)
    assert tokens.with_start(tokens.digests(tokens.read_tokens(spark, out)), out).collect() == []


def encoded(pieces, texts):
    ids, counts = pieces.encode([t.encode() for t in texts])
    assert len(counts) == len(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def expected(library, texts):
    return [[*e.ids, 2] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pieces_of_odd_texts(monkeypatch):
    """Every kind of character beside every other, few pieces kept."""
    monkeypatch.setattr(tokens, "KEPT_PIECES", 500)
    pieces = tokens.Pieces(public_tokenizers.path(tokens.VOCABULARY), 2)
    white = [" ", " ", "\t", "\n", "\n", "\r", "\v", "\f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000"]
    marks = ["'", "'", "'s", "'ll", "'re", ".", ",", "!", "-", "\0", "\x01", "\x1c", "\x1f", "\x7f", "\xab", "\xd7", "\xf7", "\u2014", "\u200b", "\U0001f600"]
    words = ["a", "s", "ll", "The", "7", "12", "\xe0", "\xe9", "\xdf", "\xaa", "\xb2", "\u0109", "\u02b0", "\u03b1", "\u0434", "\u0482", "\u0483", "\u4e2d", "\u0663", "\u0301"]
    dealt = random.Random(3)
    for _ in range(6):
        texts = ["".join(dealt.choices([*white, *marks, *words, "<|endoftext|>"], k=dealt.randint(0, 12))) for _ in range(1500)]
        texts += [a + b + c for a in white + marks + words for b in white for c in dealt.sample(white + marks + words, 9)]
        texts += ["x" * 150 + " " + "y" * 101, "<|endoftext|>", "z" * 150]
        assert encoded(pieces, texts) == expected(LIBRARY, texts)
        assert len(pieces.lengths) == len(pieces.known) and pieces.lengths.sum() == len(pieces.ids)
        assert max(map(len, pieces.known.to_pylist())) <= tokens.LONGEST


def test_what_recurs_is_asked_for_once():
    """Also in texts with white space in a row, tabs, digits in words: the library gets each piece once, not each text."""
    pieces, asked = tokens.Pieces(public_tokenizers.path(tokens.VOCABULARY), 2), []
    library = pieces.library

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

        def encode_batch(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch(texts, **options)

    pieces.library = Counted()
    dealt = random.Random(4)
    words = ["".join(dealt.choices("abcdefghij\xe9", k=6)) for _ in range(100)]
    for gap in ("  ", "\n\n", " \n", "\t", "7 ", ", '", "\r\n"):
        texts = ["".join(dealt.choice(words) + dealt.choice([" ", gap]) for _ in range(200)) for _ in range(50)]
        asked.clear()
        assert encoded(pieces, texts) == expected(library, texts)
        assert sum(map(len, asked)) < sum(map(len, texts)) / 10


def test_texts_that_are_not_utf8_are_refused():
    pieces = tokens.Pieces(public_tokenizers.path(tokens.VOCABULARY), 2)
    for bad in (b"a\xff", b"\xfe0", b"\xc3 x", b"a \xe9"):
        with pytest.raises(ValueError):
            pieces.encode([b"x", bad])
        assert pieces.encode([b"x"])[1].tolist() == [2]


def test_vocabulary_with_another_pattern():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["", "It's  12 o'clock\n\nand Foo", " a", "a ", "caf\xe9 \u4e2d"]
    assert encoded(tokens.Pieces(path, 2), texts) == expected(Tokenizer.from_file(path), texts)
