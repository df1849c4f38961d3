"""Token counts and BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textquarry.llm import bpe_trie, byte_bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "don't", "é", "日", "本", "²", "1", "٣", "_", "-", "<|endoftext|>", "<|end", " ", " ", "\x1c", "!", "ab" * 40, "x" * 700, "=", "́", "the ", "\U0001f600"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize(("chunk", "overlap"), [(token_counts.CHUNK, token_counts.OVERLAP), (60, 8), (40, 2)])
def test_counts(library, chunk, overlap):
    counter = token_counts.ChunkCounter(*token_counts.encoder(PATH), chunk, overlap)
    some = [*texts(150, 1), "word " * 5000, "a" * 9000, " " * 9000, "日本" * 4000]
    for t in some:
        assert counter.count(t)[0] == len(library.encode(t, add_special_tokens=False).ids)
    assert counter.count("a" * 9000)[2] > 0


@given(st.text(max_size=200))
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids if text else []
    trie = bpe_trie.encoder(PATH)
    assert np.frombuffer(trie.encode_all([text])[0], "<u4").tolist() == want
    assert token_counts.ChunkCounter(*token_counts.encoder(PATH), 50, 6).count(text)[0] == len(want)


def test_trie(library):
    trie = bpe_trie.TrieEncoder(byte_bpe.load(PATH))
    some = [*texts(200, 2), "a" * 3000, "=" * 300 + "-" * 300, *("ab" * 20 + "c" * n for n in range(20, 30)), "é" * 33, "x" * 70 + "y", "x" * 70 + "z", "q" * 1_000_000]
    for t, code in zip(some, trie.encode_all(some), strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(code, "<u4").tolist() == ids
        assert trie.decode(code) == library.decode(ids, skip_special_tokens=False) == t


def test_decoding_of_broken_ids(library):
    trie = bpe_trie.encoder(PATH)
    ids = library.encode("日本é", add_special_tokens=False).ids
    for cut in (ids[1:], ids[:-1], ids[::2]):
        assert trie.decode(np.array(cut, "<u4").tobytes()) == library.decode(cut, skip_special_tokens=False)


def test_operators_on_edge_cases(edge, edge_rows, library):
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t in edge_rows}
    key = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(edge, PATH, limit=5).collect()), key=key)
    assert got == sorted(((i, len((t or "").encode()), len(ids[t]), len(ids[t]) > 5) for i, t in edge_rows), key=key)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = sorted((tuple(r)[:4] for r in bpe_trie.round_trip(edge, PATH).collect()), key=key)
    assert got == sorted(((i, len(ids[t]), sha(np.array(ids[t], "<u4").tobytes()), sha((t or "").encode())) for i, t in edge_rows), key=key)
    assert token_counts.token_counts(edge.where("false"), PATH).count() == bpe_trie.round_trip(edge.where("false"), PATH).count() == 0
    assert {len(r["ids"]) for r in bpe_trie.encode(edge.where("doc_id = 4"), PATH).collect()} == {6}
