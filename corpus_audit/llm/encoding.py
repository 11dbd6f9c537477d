"""Ids of whole texts by the tokenizers library, with each white-space word encoded once per task."""

from __future__ import annotations

import os
import re
import string
import unicodedata
from array import array
from codecs import charmap_decode

MAX_WORDS = 500_000
_PUNCTUATION = string.punctuation.encode()
#: letters of U+00C0 to U+017F beside ASCII ones: stable under NFC, one character in lower case (so not U+0130)
_latin = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+").fullmatch


class _Words(dict):
    """Word -> its ids as little-endian 32-bit bytes; a word seen for the first time is encoded on the spot."""

    def __init__(self, tokenizer, limit: int):
        from tokenizers import pre_tokenizers

        super().__init__()
        self.tokenizer, self.model, self.limit = tokenizer, tokenizer.model, limit
        self.bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the byte-level character of each byte that those letters have in UTF-8
        self.alphabet = list(map(chr, range(128))) + ["\ufffe"] * 128
        for letter in map(chr, range(0xC0, 0x180)):
            for byte, c in zip(letter.encode(), self.bytelevel.pre_tokenize_str(letter)[0][0]):
                self.alphabet[byte] = c
        self.alphabet = "".join(self.alphabet)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids = self._ids(word)
        return ids

    def _ids(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters alone: one pre-token, to which normalisation only does the lower case
            low = word.lower()
            return self._pieces(word.decode()) if low == word else self[low]
        if b"<|" not in word:  # where no special token ends in the punctuation
            core = word.rstrip(_PUNCTUATION)
            if len(core) not in (0, len(word)) and self._closed(core):
                return self[core] + self[word[len(core) :]]
        text = word.decode()
        if _latin(text):
            low = text.lower()
            return self._pieces(charmap_decode(word, "strict", self.alphabet)[0]) if low == text else self[low.encode()]
        if text.isalpha() and unicodedata.is_normalized("NFC", text):
            text = self.tokenizer.normalizer.normalize_str(text)
            if text.isalpha():  # still one pre-token
                return self._pieces(self.bytelevel.pre_tokenize_str(text)[0][0])
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _pieces(self, token: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(token)]).tobytes()

    def _closed(self, core: bytes) -> bool:
        """Does it end in a letter or digit, so that the punctuation behind it is a pre-token of its own?"""
        if core[-1:].isalnum() or _latin(core.decode()):
            return True
        last = self.tokenizer.normalizer.normalize_str(core.decode())[-1:]
        return last.isalpha() or last.isdecimal()


class WordEncoder:
    """``encode(texts)``: for each UTF-8 text the ids that ``Tokenizer.encode`` gives for the whole text, as bytes.

    For a tokenizer that drops white space before it splits into pre-tokens (the ``word_bpe`` file), the ids of a
    text are those of its words one after the other, so a word is encoded once and then looked up.  The table of
    words is cleared at ``limit`` entries: memory is bounded, results do not depend on it.
    """

    def __init__(self, path: str, limit: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.words = _Words(Tokenizer.from_file(path), limit)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        get, out = self.words.__getitem__, []
        for text in texts:
            if b"<|" not in text and text.isascii():
                text = text.lower()
            out.append(b"".join(map(get, text.split())))
        return out
