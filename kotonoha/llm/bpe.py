"""Byte-level merges of public tokenizer files, run by tiktoken's merge loop.

A `tokenizers` file lists its vocabulary in the order of its merges, which is what
tiktoken calls ranks; its merge loop then gives the same ids several times as
fast. Tests compare both on every code point and on whole texts.
"""

from __future__ import annotations

import json

import numpy as np

# Fixed value: the split of byte-level tokenizers without a pattern of their own.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def symbol_bytes() -> dict[str, int]:
    """The printable symbol of each byte in a byte-level vocabulary, to the byte.

    Visible Latin-1 characters stand for themselves, the other bytes in order
    for the code points from 256.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeFile:
    """Vocabulary of a `tokenizers` file in bytes, and what the file says about its text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        model = self.spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        merged = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"])
        ids = [model["vocab"][token] for token in merged]
        if ids != sorted(ids):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        self.vocab = {t: i for t, i in model["vocab"].items() if t not in self.added}

    def ranks(self, word_end: bytes = b"") -> dict[bytes, int]:
        """Token bytes to id; the mark of a word's end becomes ``word_end``."""
        byte_of = symbol_bytes()
        found = {}
        for token, i in self.vocab.items():
            tail = b""
            if self.suffix and token.endswith(self.suffix):
                token, tail = token[: -len(self.suffix)], word_end
            found[bytes(byte_of[c] for c in token) + tail] = i
        if len(found) != len(self.vocab):
            raise ValueError("two tokens have the same bytes")
        return found


def merge_loop(ranks: dict[bytes, int], split: str, specials: dict[str, int] | None = None):
    import tiktoken

    return tiktoken.Encoding("file", pat_str=split, mergeable_ranks=ranks, special_tokens=specials or {})


class ByteLevelBpe:
    """Ids of whole texts through a plain byte-level file (no normaliser, the usual split).

    With ``specials`` the strings of special tokens are those tokens, as in
    `tokenizers` by default; without, they are text like any other.
    """

    def __init__(self, path: str, specials: bool = True):
        file = BpeFile(path)
        split = file.spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True)
        if file.spec["normalizer"] or file.suffix or not plain or split.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        self.token_bytes = {i: b for b, i in file.ranks().items()}
        self._loop = merge_loop(file.ranks(), BYTE_LEVEL_SPLIT, file.added if specials else {})
        self._allowed = set(file.added) if specials else set()

    def encode(self, text: str) -> np.ndarray:
        return self._loop.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=())
