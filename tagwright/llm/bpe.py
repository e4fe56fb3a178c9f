"""Byte-pair encoding: words of a text, and the ids of words under a public tokenizer."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from pathlib import Path

from tokenizers import Tokenizer

HELD_WORDS = 1_000_000  # words whose ids a Python worker keeps at a time
WORDS_AT_ONCE = 4096
# The characters that the pattern of the tokenizers counts as white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LATIN = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
# A run of Latin letters that no other letter or digit follows, any run without white space, white space.
UNIT = re.compile(rf" ?[{LATIN}]++(?![^\W_])| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def tokenizer_file(path: str) -> str:
    """The tokenizer as text, to be sent to the workers; a vocabulary has a fixed size."""
    return Path(path).read_text(encoding="utf-8")


@lru_cache(maxsize=4)
def _loaded(spec: str) -> "WordTable":
    return WordTable(spec)


def word_table(spec: str) -> "WordTable":
    """The tokenizer of a worker; it stays for the worker's next tasks."""
    return _loaded(spec)


class WordTable:
    """Ids of words as little-endian 32-bit numbers.

    The pattern of the tokenizer never matches across the ends of these words, so a text has the ids of its
    words one after the other. Strings of added tokens are found first, as the tokenizer does.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.names = added
        self.ids = HeldIds()

    def words(self, text: str) -> list[str]:
        """The parts of a text that are encoded by themselves, in order; joined they are the text."""
        if self.added is None or not any(name in text for name in self.names):
            return UNIT.findall(text)
        found = []
        for part in self.added.split(text):
            found += [part] if part in self.names else UNIT.findall(part)
        return found

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Few are encoded at a time, as what the library gives takes far more room than the ids."""
        found = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(words[at : at + WORDS_AT_ONCE], add_special_tokens=False)
            found += [array("I", one.ids).tobytes() for one in encoded]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts; each word that the worker does not hold is encoded once."""
        if len(self.ids) > HELD_WORDS:
            self.ids.clear()
        parts = [list(map(self.ids.__getitem__, self.words(text))) for text in texts]
        for word, ids in zip(self.ids.new, self.encode_words(list(self.ids.new))):
            self.ids.new[word].extend(ids)
            self.ids[word] = ids
        self.ids.new.clear()
        return list(map(b"".join, parts))


class HeldIds(dict):
    """Ids of words; a new word gets a place that is filled when all words at hand are encoded."""

    def __init__(self):
        super().__init__()
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        return self.new.setdefault(word, bytearray())
