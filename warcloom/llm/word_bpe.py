"""Ids of a lower-casing, word-wise BPE tokenizer file, cached by word.

The tokenizer normalises (composition, white space, lower case), splits into
words and merges inside each word only. A text made of common Latin characters
is split here by the same rule and each distinct word is merged once by the
library's model; any other text, and one that may hold a special token, goes to
the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

# Letters, digits and white space among U+0000 to U+017F.
_LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\t\n\v\f\r \u0085 "
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+")
#: Anything outside these is left to the library; so are special tokens, which start with "<|",
#: and capital I with a dot, which lower-cases to two characters.
_OTHER = re.compile("[^\u0000-\u001b -įı-ſ]|<\\|")
MAX_WORDS = 200_000


class WordBpe(dict):
    """Word -> its ids as little-endian 32-bit bytes. Emptied when it holds ``MAX_WORDS``."""

    _open: dict[str, WordBpe] = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        # The printable stand-ins of bytes, as the byte-level step writes them.
        kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
        shifted = iter(range(256, 512))
        self.letters = [chr(b) if b in kept else chr(next(shifted)) for b in range(256)]

    @classmethod
    def shared(cls, path: str) -> WordBpe:
        """One per worker process, so the cache outlives a task."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_WORDS:
            self.clear()
        letters = self.letters
        pieces = self.model.tokenize("".join([letters[b] for b in word.encode()]))
        ids = b"".join([p.id.to_bytes(4, "little") for p in pieces])
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text):
            return self._library(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.__getitem__, _WORD.findall(text.lower())))
