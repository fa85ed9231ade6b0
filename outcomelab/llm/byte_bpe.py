"""Byte-level BPE ids of whole texts, shared by token counts and packing.

The ids are those that the ``tokenizers`` library gives for the vocabulary
file with ``add_special_tokens=False``: nothing is added, and the file's added
tokens get their own ids where they stand in a text (``encode``).  ``ids`` takes
them as ordinary text.  Tests compare both with the library over random
Unicode.  ``tiktoken`` does the merging, over the ranks of the same file, in a
third of that library's time.
"""

from __future__ import annotations

import json
import re

import numpy as np

# Fixed value: the pattern that splits a text before the merges.  The
# possessive runs spare retries; they change no match.
SPLIT = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")


def _ranks(vocabulary: str) -> dict[bytes, int]:
    """Token bytes -> id.  Byte-level files spell each byte as a printable
    character: printable Latin-1 stands for itself, the rest follow from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    byte_of = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}
    data = json.loads(vocabulary)
    special = {t["content"] for t in data["added_tokens"]}
    return {bytes(byte_of[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in special}


class ByteBpe:
    """Ids of texts; one per Python worker."""

    def __init__(self, vocabulary: str):
        import tiktoken
        added = json.loads(vocabulary)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their surroundings are not supported")
        self.added = {t["content"]: t["id"] for t in added}
        # the leftmost, of these the longest, as the library finds them
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if longest else None
        self.lib = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=_ranks(vocabulary), special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """The library's ids: text between added tokens is encoded part by part."""
        if not any(t in text for t in self.added):
            return self.ids(text)
        parts = self.split(text)  # at odd places the added tokens
        return np.concatenate([np.array([self.added[p]], "<u4") if i % 2 else self.ids(p) for i, p in enumerate(parts)])

    def ids(self, text: str) -> np.ndarray:
        """Ids with added tokens taken as ordinary text."""
        return np.array(self.lib.encode_ordinary(text), dtype="<u4")


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
