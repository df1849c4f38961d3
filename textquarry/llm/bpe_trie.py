"""BPE encoding by a traversal of the words' trie that shares prefixes.

The encoding of a prefix is fixed by its last token: the one token t that
ends there, encodes to itself, and may stand after the last token of what
precedes it, that is, when encoding both together gives just these two. The
distinct words, sorted, are the trie in depth-first order; a stack holds the
last token and the encoding of each prefix of the word at hand, so that a
prefix shared by many words is worked out once.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from textquarry.llm import byte_bpe
from textquarry.llm.runtime import keyed_text, map_texts

#: Distinct words whose encodings a worker keeps.
KEPT_WORDS = 500_000
#: Prefixes of up to so many bytes have their whole encoding on the stack; from longer ones it is read back over their
#: last tokens, and words that long aren't kept. No result depends on it.
SPELLED = 64

#: The pre-tokens of byte-level BPE, for any text.
ANY = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts without the characters in ODD, on which the classes of Python's faster module agree.
LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
ODD = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


#: Of the automaton that finds which tokens end at a byte: (next states, (length, id) of those tokens, longest first, what was read).
State = tuple[dict[int, "State"], list[tuple[int, int]], bytes]


def words_of(text: str) -> list[str]:
    return (ANY if ODD.search(text) else LATIN).findall(text)


class TrieEncoder:
    """Encodes and decodes whole texts; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, bpe: byte_bpe.ByteBpe):
        self.bpe = bpe
        self.packed = [i.to_bytes(4, "little") for i in range(bpe.size)]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(bpe.special, key=len, reverse=True))) + ")") if bpe.special else None
        self.known: dict[str, bytes] = {}
        self.may_follow: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        #: All beginnings of tokens, and the states below them that have been visited.
        self.begins = {b[:n] for b in bpe.ids for n in range(1, len(b) + 1)}
        self.root: State = ({}, [], b"")
        self.states: dict[bytes, State] = {b"": self.root}

    def step(self, state: State, byte: int) -> State:
        """The state after one more byte: the longest beginning of a token that ends there, and the tokens that do."""
        seen = state[2] + bytes((byte,))
        while seen and seen not in self.begins:
            seen = seen[1:]
        found = self.states.get(seen)
        if found is None:
            ids = self.bpe.ids
            found = self.states[seen] = ({}, [(n, ids[seen[-n:]]) for n in range(len(seen), 0, -1) if seen[-n:] in ids], seen)
        state[0][byte] = found
        return found

    def spine(self, token: int, side: int, top: int) -> list[tuple[int, int, int]]:
        """What stands at one end of a token while it is merged: (part, rank that made it, rank that uses it up)."""
        out, until = [], top
        while True:
            parts = self.bpe.parts.get(token)
            made = self.bpe.merges[parts][0] if parts else -1
            out.append((token, made, until))
            if not parts:
                return out
            token, until = parts[side], made

    def clash(self, left: int, right: int, top: int) -> bool:
        """Whether merging left and right together would merge across their border before rank ``top``.

        Of equal ranks the leftmost goes first: the left token's own merge
        precedes one across the border, which precedes the right token's.
        """
        rights = self.spine(right, 0, top)
        for x, x_from, x_to in self.spine(left, 1, top):
            for y, y_from, y_to in rights:
                m = self.bpe.merges.get((x, y))
                if m and x_from < m[0] < x_to and y_from < m[0] <= y_to and m[0] < top:
                    return True
        return False

    def is_whole(self, token: int) -> bool:
        """Whether the token's bytes encode to just this token."""
        got = self.whole.get(token)
        if got is None:
            parts = self.bpe.parts.get(token)
            got = not parts or self.is_whole(parts[0]) and self.is_whole(parts[1]) and not self.clash(*parts, self.bpe.merges[parts][0])
            self.whole[token] = got
        return got

    def follows(self, left: int, right: int) -> bool:
        key = left << 32 | right
        got = self.may_follow.get(key)
        if got is None:
            if len(self.may_follow) > 1_000_000:
                self.may_follow.clear()
            got = self.may_follow[key] = self.is_whole(right) and not self.clash(left, right, 1 << 62)
        return got

    def last_token(self, state: State, end: int, last: list[int]) -> tuple[int, int]:
        """(length, id) of the token that the encoding of the first ``end`` bytes ends with, given those of the shorter prefixes."""
        known = self.may_follow.get
        for n, token in state[1]:
            if n == end:
                if self.is_whole(token):
                    return n, token
            elif (ok := known(last[end - n] << 32 | token)) or ok is None and self.follows(last[end - n], token):
                return n, token
        raise ValueError("the vocabulary lacks single bytes")

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Encodes distinct words in the order of a depth-first walk over their trie; returns what isn't kept."""
        last, codes, states, before = [-1], [b""], [self.root], b""
        packed, lengths, known, last_token = self.packed, self.bpe.bytes, self.known, self.last_token
        passing: dict[str, bytes] = {}
        for word, text in sorted((w.encode(), w) for w in words):
            same = 0
            for a, b in zip(word, before, strict=False):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], codes[same + 1 :], states[same + 1 :]
            state = states[-1]
            for end in range(same + 1, len(word) + 1):
                byte = word[end - 1]
                state = state[0].get(byte) or self.step(state, byte)
                n, token = last_token(state, end, last)
                last.append(token)
                states.append(state)
                if end <= SPELLED:
                    codes.append(codes[end - n] + packed[token])
            if len(word) <= SPELLED:
                known[text] = codes[-1]
            else:
                tail, end = [], len(word)
                while end > SPELLED:
                    tail.append(packed[last[end]])
                    end -= len(lengths[last[end]])
                passing[text] = codes[end] + b"".join(reversed(tail))
            before = word
        return passing

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        split = [[(words_of(x), x) if i % 2 == 0 else ([], x) for i, x in enumerate(self.special.split(t) if self.special else [t])] for t in texts]
        fresh = {w for parts in split for words, _ in parts for w in words}
        if len(self.known) + len(fresh) > KEPT_WORDS:
            self.known.clear()
        passing = self.learn(fresh - self.known.keys())
        known, out = self.known, []
        for parts in split:
            code = []
            for i, (words, x) in enumerate(parts):
                if i % 2:
                    code.append(self.packed[self.bpe.special[x]])
                else:
                    code += [known[w] if w in known else passing[w] for w in words]
            out.append(b"".join(code))
        return out

    def decode(self, code: bytes) -> str:
        return b"".join(map(self.bpe.bytes.__getitem__, np.frombuffer(code, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(byte_bpe.load(path))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) of every row; null and empty texts have none. No shuffle."""

    def make():
        trie = encoder(tokenizer)

        def work(ids: list, texts: list) -> dict:
            return {"doc_id": ids, "ids": [np.frombuffer(c, "<u4").astype("i4") for c in trie.encode_all([t or "" for t in texts])]}

        return work

    return map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, same (the decoded text is the text) of every row.

    Encodes and decodes in one pass. Null is as the empty text; special
    tokens in a text are encoded as such; repeated rows give repeated
    results; other columns are ignored. No shuffle.
    """

    def make():
        trie = encoder(tokenizer)

        def work(ids: list, texts: list) -> dict:
            texts = [t or "" for t in texts]
            codes = trie.encode_all(texts)
            back = [trie.decode(c) for c in codes]
            return {
                "doc_id": ids, "n_tokens": [len(c) // 4 for c in codes], "ids_sha256": [hashlib.sha256(c).hexdigest() for c in codes],
                "decoded_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in back], "same": [a == b for a, b in zip(texts, back, strict=True)],
            }

        return work

    return map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, same boolean")
