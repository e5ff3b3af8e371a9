import random
import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpuloom.llm import bpe, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BYTE_LIBRARY, WORD_LIBRARY = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
COUNTER = token_counts.UnitLengths(BYTES, 1 << 12, 500, 16)
UNITS = bpe.Units(bpe.ForcedBoundaryBpe(WORDS), 500, 16)
TEXTS = st.text(st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85 　abcABCΣσéİ́'1٣<|>.!日😀") | st.characters(exclude_categories=["Cs"]), max_size=40)
SPECIAL = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|endoftext", "don't I'LL 's", "a" * 3000, "  x "]


def digests(text):
    ids = WORD_LIBRARY.encode(text, add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(WORD_LIBRARY.decode(ids, skip_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_lengths_are_the_librarys(text):
    assert COUNTER.lengths([text]) == [len(BYTE_LIBRARY.encode(text, add_special_tokens=False).ids)]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_are_the_librarys(text):
    assert bpe.digests(UNITS, text) == digests(text)
    assert UNITS.bpe.encode(text) == WORD_LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", SPECIAL)
def test_special_strings_and_long_words(text):
    assert COUNTER.lengths([text]) == [len(BYTE_LIBRARY.encode(text, add_special_tokens=False).ids)]
    assert bpe.digests(UNITS, text) == digests(text)


def test_cuts_never_part_what_a_token_joins():
    cutter = UNITS.bpe
    for token in list(cutter.vocab)[::37]:
        body = token.removesuffix(cutter.end)
        assert cutter.cut(body) == [body] if body else True


def test_batches_hold_about_the_same_bytes():
    parts = list(token_counts.by_bytes(["aa", None, "b" * 10, "c", "dd"], 4))
    assert parts == [["aa", None], ["b" * 10], ["c", "dd"]]
    assert list(token_counts.by_bytes([], 4)) == []


def test_counts_over_a_table(documents, no_documents):
    got = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(documents, BYTES).collect()}
    for row in documents.collect():
        text = row.text or ""
        r = got[row.doc_id, len(text.encode())]
        assert r.n_tokens == len(BYTE_LIBRARY.encode(text, add_special_tokens=False).ids)
        assert r.over_limit == (r.n_tokens > 1024)
    assert token_counts.count_tokens(documents, BYTES).count() == documents.count()
    assert token_counts.count_tokens(no_documents, BYTES).collect() == []


def test_digests_over_a_table(documents, no_documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in bpe.encode_digests(documents, WORDS).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(texts[r.doc_id] or "")
    assert bpe.encode_digests(no_documents, WORDS).collect() == []


def test_encode_then_decode(documents):
    ids = bpe.encode_texts(documents, WORDS)
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in bpe.decode_ids(ids, WORDS).collect():
        assert r.text == WORD_LIBRARY.decode(WORD_LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, skip_special_tokens=False)


def test_long_texts_in_pieces_count_the_same():
    rnd = random.Random(5)
    parts = ["a", "word", "é", "日本", " ", "  ", "\n", "\t", " ", "　", ".", "'s", "12"]
    whole = token_counts.UnitLengths(public_tokenizers.path("byte_bpe_50k.json"), 1 << 20, 1000, 64)
    small = token_counts.UnitLengths(public_tokenizers.path("byte_bpe_50k.json"), 16, 1000, 64)
    for _ in range(300):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 200)))
        assert "".join(token_counts.pieces_of(text, 16)) == text
        n = len(whole.tokenizer.encode(text, add_special_tokens=False).ids)
        assert small.lengths([text]) == whole.lengths([text]) == [n]
    assert [sum(token_counts.n_bytes(t or "") for t in p) for p in token_counts.by_bytes(["ab", "日本", "x" * 9, None], 6)] == [2, 6, 9, 0]
