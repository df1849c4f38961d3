"""A byte-level BPE vocabulary as read from a tokenizer file in JSON."""

from __future__ import annotations

import json
from functools import lru_cache


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE files: printable Latin-1 stays, other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Token bytes, ids, merges and special tokens of one file.

    Raises ValueError for files that are not plain byte-level BPE (normalizer,
    prefix space, special tokens that swallow blanks), whose results this
    package could not reproduce.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that depend on what surrounds them")
        back = byte_alphabet()
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids: dict[bytes, int] = {bytes(map(back.__getitem__, s)): i for s, i in model["vocab"].items() if s not in self.special}
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * self.size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        #: (left, right) -> (rank, merged), merged -> (left, right)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = (self.ids[bytes(map(back.__getitem__, x))] for x in (a, b))
            made = self.ids[self.bytes[left] + self.bytes[right]]
            self.merges[left, right] = rank, made
            self.parts.setdefault(made, (left, right))


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """Once for each worker process."""
    return ByteBpe(path)
