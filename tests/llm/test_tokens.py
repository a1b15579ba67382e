"""Packing and byte-pair encoding against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from plain import TEXTS, sha
from tokenizers import Tokenizer
from given import documents, edges, empty  # noqa: F401

from aerometry.llm import bpe_automaton, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

PARTS = [
    *"abcdeHTiş'\n\t.,!s(E中́ \x1c\x85 \xa0٢²Ⅷ0123#<|>", "<|endoftext|>", "<|startoftext|>",
    "the, ", "word. ", "á", "'S", "don't, ", "aaaa", "   ", "İ.", "Σ", "\U0001f600", "한국",
]


def drawn(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    found = {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}
    for tokenizer in found.values():
        tokenizer.no_truncation()
        tokenizer.no_padding()
    return found


def test_texts_together_have_the_tokens_of_each(library):
    """Plain texts and others in one batch, with white space at their ends."""
    texts = [" a  b ", "", "\n", "x\x85y", "x\xa0y", "Füße, ÉTÉ.", "a\x1cb", "<|x|>", "日本 go", *drawn(50, seed=7)]
    found = packing.word_tokens(WORDS).encode_all(pa.array(texts * 2, pa.large_string())[3:])
    for text, tokens in zip((texts * 2)[3:], found, strict=True):
        ids = library[WORDS].encode(text, add_special_tokens=False).ids
        assert tokens == np.array(ids, dtype="<u4").tobytes(), text


def test_words_have_the_librarys_tokens(library):
    own = packing.word_tokens(WORDS)
    for text in drawn(4000):
        expected = library[WORDS].encode(text, add_special_tokens=False).ids
        assert own.encode(text) == np.array(expected, dtype="<u4").tobytes(), text


def test_automaton_encodes_and_decodes_like_the_library(library):
    own = bpe_automaton.codec(BYTES)
    for text in drawn(4000, seed=4):
        ids = library[BYTES].encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library[BYTES].decode(ids, skip_special_tokens=False)


def test_small_memo_and_table_change_nothing(monkeypatch):
    texts = drawn(300, seed=5)
    whole = [bpe_automaton.codec(BYTES).encode(text) for text in texts]
    monkeypatch.setattr(bpe_automaton, "MEMO_LIMIT", 7)
    monkeypatch.setattr(bpe_automaton, "TABLE_LIMIT", 50)
    fresh = bpe_automaton.ByteLevelCodec(BYTES)
    assert [fresh.encode(text) for text in texts] == whole


def test_a_full_memory_changes_nothing(monkeypatch):
    """A memory of few words changes no tokens."""
    texts = drawn(300, seed=6)
    whole = [packing.word_tokens(WORDS).encode(text) for text in texts]
    monkeypatch.setattr(packing, "MEMO_LIMIT", 40)
    fresh, made = packing.WordTokens(WORDS), []
    letters = fresh._letters
    monkeypatch.setattr(fresh, "_letters", lambda word: made.append(word) or letters(word))
    for text, expected in zip(texts, whole, strict=True):
        assert fresh.encode(text) == expected
        assert len(fresh.memo.before) <= 40 + 2 * len(packing.WORD.findall(text)) + 160
    assert len(made) > 20


def test_generations_keep_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_LIMIT", 3)
    made = []
    memo = packing.Memo(lambda word: made.append(word) or word.encode())
    for number in range(30):
        assert memo["common"] == b"common" and memo[f"w{number}"] == b"w%d" % number
        memo = memo.following()
        assert len(memo) + len(memo.before) <= 8
    assert made.count("common") == 1 and len(made) == 31


def test_merge_gadget_by_hand():
    labels = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4}
    merges = [(b"a", b"a"), (b"a", b"b"), (b"a", b"ab")]
    encoder = bpe_automaton.WordEncoder(bpe_automaton.MergeAutomaton(labels, merges))
    # Pairs merge from the left, the earlier rule first; "aab" never arises.
    assert encoder.encode(b"aaab") == (2, 3)
    assert encoder.encode(b"aab") == (2, 1)
    assert encoder.encode(b"abab") == (3, 3)


def test_bpe_table(edges, empty, library):
    assert bpe_automaton.encode_documents(empty, BYTES).count() == 0
    expected = []
    for doc_id, text in TEXTS:
        ids = library[BYTES].encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    found = bpe_automaton.encode_documents(edges, BYTES).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def check_packed(rows, expected):
    """Every token in one piece, windows within capacity, offsets without gaps."""
    windows = {}
    for row in rows:
        windows.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    pieces = sorted(
        ((r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows), key=repr
    )
    wanted = []
    for doc_id, ids in expected:
        data = np.array(ids, dtype="<u4").tobytes()
        for start, length in packing.cuts(len(ids)):
            crc = zlib.crc32(data[4 * start : 4 * (start + length)])
            wanted.append((doc_id, len(ids), start, length, crc))
    assert pieces == sorted(wanted, key=repr)
    return 1 - sum(r.length for r in rows) / (packing.CAPACITY * len(windows))


def test_packing_table(documents, empty, library):
    assert packing.pack_documents(empty, WORDS).count() == 0
    rng = random.Random(9)
    texts = [(100 + i, " ".join(rng.choices(PARTS, k=rng.randint(1, 3000)))) for i in range(150)]
    texts = [*TEXTS, *texts]
    encode = lambda t: library[WORDS].encode(t or "", add_special_tokens=False).ids
    expected = [(i, [*encode(t), packing.END_TOKEN]) for i, t in texts]
    rows = packing.pack_documents(documents(texts), WORDS).collect()
    assert check_packed(rows, expected) < 0.02


def test_equal_rows_spread_over_cells(documents, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 200)
    texts = [(None, "")] * 2000 + [(7, "the same words")] * 1000 + [(i, "a b") for i in range(100, 200)]
    rows = packing.pack_documents(documents(texts), WORDS).collect()
    assert len(rows) == len(texts)
    assert sum(r.doc_id is None for r in rows) == 2000 and sum(r.doc_id == 7 for r in rows) == 1000
    cells = np.unique([r.sequence_id >> 32 for r in rows], return_counts=True)[1]
    # 16 cells of 194 pieces on the average; one of all equal rows would hold 2,000.
    assert len(cells) == 16 and cells.max() < 300


@pytest.mark.parametrize("tokens", [1, 511, 512, 4095, 4096, 4097, 9000])
def test_cuts_cover_a_document(tokens):
    at = 0
    for start, length in packing.cuts(tokens):
        assert start == at and 0 < length <= packing.CAPACITY
        at += length
    assert at == tokens


def test_window_count_rises_where_capacity_is_exceeded():
    sizes = np.array([3000, 3000, 3000])
    window = packing.partition(sizes)
    assert len(set(window.tolist())) == 3
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 512, 2000)
    loads = np.bincount(packing.partition(sizes), weights=sizes)
    assert loads.max() <= packing.CAPACITY and loads.max() - loads.min() < 64
