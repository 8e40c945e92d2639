"""Ids of a public byte-level BPE vocabulary.

The vocabulary comes from its ``tokenizers`` JSON file; encoding runs in the
faster ``tiktoken`` core on the same ranks. Both give the same ids (tested),
special strings in a text included.
"""

from __future__ import annotations

import json

import numpy as np

#: Fixed value: the splitting pattern of byte-level BPE vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """Printable character of each byte: itself where it is printable, else
    the next free one from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairEncoder:
    """Encoder of the vocabulary in ``path`` (the file must be at the same
    path on every worker); one instance a Python worker."""

    _made: dict[str, "BytePairEncoder"] = {}

    def __init__(self, path: str) -> None:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: bytes(alphabet[c] for c in p)
                       for p, i in spec["model"]["vocab"].items() if p not in special}
        #: Bytes of every id, the special ones included.
        self.bytes_of = self.pieces | {i: p.encode() for p, i in special.items()}
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, p in self.bytes_of.items():
            self.lengths[i] = len(p)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merged = [spec["model"]["vocab"][a + b] for a, b in merges]
        if merged != sorted(merged):
            raise ValueError("the merges of the vocabulary are not in the order of their ids")
        self.size = max([*self.pieces, *special.values()]) + 1
        self.special = set(special)
        self._core = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens=special,
                                       mergeable_ranks={b: i for i, b in self.pieces.items()})

    @classmethod
    def of(cls, path: str) -> "BytePairEncoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        return self._core.encode_to_numpy(text, allowed_special=self.special)
