"""Whole-text ids of a byte-level BPE tokenizer, one cached word at a time.

The tokenizer splits a text by a pattern before it merges bytes, and no part of the
split reaches over a single space that follows or precedes a visible character.  A text
is therefore cut at its spaces, and every distinct word with its space is split and
merged once per worker.  Texts with white space of another kind around a space are
split by the pattern as a whole.

Added tokens of the vocabulary file, special ones too, are found in a text before
anything else, as the library does it; what stands between them is encoded by itself.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import regex
from tokenizers import Tokenizer

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 700_000


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class _Words(dict):
    """Ids of words with the space before them, made on demand.

    None stands for a word that has to be seen in its text.
    """

    def __init__(self, split: Callable[[str], bytes]) -> None:
        self._split = split

    def __missing__(self, word: str) -> bytes | None:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = None if not word or word[0].isspace() else self._split(" " + word)
        self[word] = found
        return found


class ByteBpe:
    """Encoder of one vocabulary file; bounded memory, equal to the library's own ids."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        before = settings.get("pre_tokenizer") or {}
        if (
            before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or not before.get("use_regex", True)
            or settings.get("normalizer")
            or settings["model"]["type"] != "BPE"
        ):
            raise ValueError(f"{path} is not a byte-level BPE tokenizer without a normalizer")
        self._model = Tokenizer.from_file(path).model
        self._parts = regex.compile(PATTERN)
        self._characters = _byte_characters()
        self._words = _Words(self._split)
        self._added = self._added_tokens(settings.get("added_tokens") or [], path)
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")

    @staticmethod
    def _added_tokens(added: list[dict], path: str) -> dict[str, bytes]:
        for token in added:
            if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
                raise ValueError(f"{path}: {token['content']} takes part of the text around it")
        return {token["content"]: int(token["id"]).to_bytes(4, "little") for token in added}

    def _merged(self, part: str) -> list[int]:
        mapped = "".join([self._characters[b] for b in part.encode("utf-8", "surrogatepass")])
        return [token.id for token in self._model.tokenize(mapped)]

    def _split(self, text: str) -> bytes:
        ids = [i for part in self._parts.findall(text) for i in self._merged(part)]
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def packed(self, text: str | None) -> bytes:
        """The ids of the whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(token in text for token in self._added):
            return b"".join(self._added.get(part) or self._plain(part) for part in self._cut.split(text) if part)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        first, *words = text.split(" ")
        try:
            return self._split(first) + b"".join(map(self._words.__getitem__, words))
        except TypeError:  # a word that has to be seen in its text
            return self._split(text)

    def count(self, text: str | None) -> int:
        return len(self.packed(text)) // 4


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """The encoder of a vocabulary file, kept for the life of a Python worker."""
    return ByteBpe(path)
