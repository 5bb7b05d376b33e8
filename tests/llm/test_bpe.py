import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return ids, decoded


def check(docs):
    got = bpe.encoded(docs).collect()
    rows = docs.collect()
    expected = sorted(repr((r.doc_id, *plain(r.text))) for r in rows)
    assert expected == sorted(repr((r.doc_id, r.ids, r.decoded)) for r in got)
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest() and r.n_tokens == len(r.ids)


def test_documents_against_the_library(documents):
    check(documents)


def test_edge_cases(frame):
    check(frame(
        None, "", " \n\t ", "I'll don't WE'RE it's", "aaaa aaaaaaa aaaaaaaaaaaaa", "<|endoftext|>x<|startoftext|> <|endoftext|", "ΑΣ ΣΑΣ İ ǅ é é",
        "12345 a1b2!!?? ...", "日本語 \U0001f600\U0001f601  x\xa0y\x1cz", "x" * 3000, "</w> a</w>", "\x00\x01 a\x00", ids=[1, 1, None, *range(9)],
    ))
    assert bpe.encoded(frame()).collect() == []


def test_random_words():
    coder, rng = bpe.word_tokenizer(PATH), random.Random(3)
    for alphabet in ("ab", "aei nrt", "abcdefghijklmnopqrstuvwxyz", "äöüßéabc -'", "inthe rans"):
        for _ in range(400):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
            ids = LIBRARY.encode(text, add_special_tokens=False).ids
            packed, decoded = coder.encode(text)
            assert np.frombuffer(packed, "<u4").tolist() == ids, text
            assert coder.decode(packed) == decoded == LIBRARY.decode(ids, skip_special_tokens=False)


def test_two_merges_of_one_token_are_refused():
    with pytest.raises(ValueError):
        bpe.Automaton({"a": 0, "b": 1, "ab": 2, "aba": 3, "ba": 4}, [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")], "")
