"""Token counts by overlap resynchronisation.

A long text is encoded in overlapping chunks. Two neighbours are spliced at a
position that is a token boundary of both and that is proven to be stable:

* the left chunk's tokens up to there are right, as its start is proven and
  its cut end is further away than the encoder ever looks ahead;
* the characters around it end a pre-token whatever precedes them, so what
  follows is encoded alike from there on, and the right chunk has a boundary
  there.

Where the overlap has no such position (one endless word, say), it is
widened, doubling until it has one or the text ends. Counts are those of
encoding the text in one piece; memory is bounded by the chunk wherever
texts have any boundary at all.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from textquarry.llm import bpe_trie, byte_bpe
from textquarry.llm.runtime import keyed_text, map_texts

#: Characters of a chunk and of the first overlap.
CHUNK, OVERLAP = 4096, 192
#: Longer chunks, which only texts of one endless pre-token need, are encoded by the trie: the library's matcher has a stack that they exceed.
MATCHED = 1 << 16
#: The encoder decides about a pre-token by at most two characters after it (contractions, the last blank of a run).
LOOKAHEAD = 3
#: Ends a pre-token whatever precedes: a non-blank before a blank, a letter or digit before another kind.
STABLE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


@lru_cache(maxsize=2)
def encoder(path: str):
    """(encode to an array of ids, byte length of each id, longest special token) for one vocabulary file."""
    import public_tokenizers
    import tiktoken

    bpe = byte_bpe.load(path)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ids, special_tokens=bpe.special)
    lengths = np.fromiter(map(len, bpe.bytes), np.int64, bpe.size)

    def encode(text: str) -> np.ndarray:
        if len(text) <= MATCHED:
            return enc.encode_to_numpy(text, allowed_special="all")
        return np.frombuffer(bpe_trie.encoder(path).encode_all([text])[0], "<u4")

    return encode, lengths, max(map(len, bpe.special), default=0)


class ChunkCounter:
    """Counts tokens of whole texts, chunk by chunk."""

    def __init__(self, encode: Callable[[str], np.ndarray], lengths: np.ndarray, special: int, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.encode, self.lengths, self.margin = encode, lengths, special + LOOKAHEAD
        self.chunk, self.overlap = max(chunk, 2 * (overlap + self.margin)), overlap

    def ends(self, text: str) -> np.ndarray:
        """Byte offsets at which the tokens of a chunk end."""
        return np.cumsum(self.lengths[self.encode(text)])

    def splice(self, text: str, a0: int, a_ends: np.ndarray, a1: int, b0: int, b_ends: np.ndarray, done: int) -> tuple[int, int, int] | None:
        """(position, tokens of the left chunk up to it, of the right one before it), or None."""
        seam = text[b0:a1]
        before = len(text[a0:b0].encode())
        used = at = 0
        for m in STABLE.finditer(seam):
            p = m.start()
            if b0 + p > a1 - self.margin:
                break
            at, used = at + len(seam[used:p].encode()), p
            if b0 + p <= done:
                continue
            i, j = np.searchsorted(a_ends, before + at), np.searchsorted(b_ends, at)
            if i < len(a_ends) and a_ends[i] == before + at and (at == 0 or j < len(b_ends) and b_ends[j] == at):
                return b0 + p, int(i) + 1, int(j) + 1 if at else 0
        return None

    def count(self, text: str) -> tuple[int, int, int]:
        """(tokens, chunks encoded, overlaps widened)."""
        n, total, chunks, widened = len(text), 0, 1, 0
        a0, a1 = 0, min(n, self.chunk)
        a_ends, done, skipped = self.ends(text[a0:a1]), 0, 0
        overlap = self.overlap
        while a1 < n:
            b0 = a1 - overlap
            if b0 <= done:  # the overlap has reached what is proven: a longer chunk from there
                a0, a1 = done, min(n, a1 + overlap)
                a_ends, skipped, chunks, overlap = self.ends(text[a0:a1]), 0, chunks + 1, 2 * overlap
                continue
            b1 = min(n, b0 + max(self.chunk, 2 * overlap))
            b_ends = self.ends(text[b0:b1])
            chunks += 1
            found = self.splice(text, a0, a_ends, a1, b0, b_ends, done)
            if found is None:
                widened, overlap = widened + 1, 2 * overlap
                continue
            done, upto, of_b = found
            total += upto - skipped
            a0, a1, a_ends, skipped, overlap = b0, b1, b_ends, of_b, self.overlap
        return total + len(a_ends) - skipped, chunks, widened


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), n_chunks, n_widened of every row.

    Null and empty texts have no bytes and no tokens. Special tokens that
    occur in a text count as such, as is the library's default. Repeated rows
    give repeated results; other columns of the input are ignored. Rows are
    handled where they are read: no shuffle.
    """

    def make():
        counter = ChunkCounter(*encoder(tokenizer), chunk, overlap)

        def work(ids: list, texts: list) -> dict:
            found = [counter.count(t or "") for t in texts]
            return {"doc_id": ids, "n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": [x[0] for x in found], "over_limit": [x[0] > limit for x in found], "n_chunks": [x[1] for x in found], "n_widened": [x[2] for x in found]}

        return work

    return map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, n_chunks bigint, n_widened bigint")
