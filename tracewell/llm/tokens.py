"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Texts are cut at white space, which the vocabulary drops: no rule of its normaliser, pre-tokenizer or
merges reaches across it, so a text's ids are those of its words in a row. Texts in which that does not
hold plainly (special tokens, control separators) are encoded whole.
"""

from __future__ import annotations

import array
import os
import re
from functools import lru_cache

#: Words of a generation; a worker remembers two.
WORDS_KEPT = 400_000
#: Texts with these are not lower-cased here: combining marks and letters whose case mapping depends on them.
NOT_PLAIN = re.compile("[İ̀-\U0010ffff]")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain(text: str) -> bool:
    return text.isascii() or not NOT_PLAIN.search(text)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def split_at_spaces(text: str) -> list[str] | None:
    """Words between Unicode white space; None where str.split would also drop the separators 1C to 1F, which are symbols here."""
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return None
    return text.split()


class Remembered(dict):
    """What compute() said of a key, for keys of this generation and the one before: frequent ones stay, memory is bounded."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def __missing__(self, key: str):  # noqa: ANN204
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def age(self) -> None:
        """Begin a generation if this one is full."""
        if len(self) > WORDS_KEPT:
            self.older = self.copy()
            self.clear()


class WordIds(Remembered):
    """From a word to the bytes of its ids as unsigned little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.tails = {c: self.whole(c) for c in ".,"}

    def whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def compute(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in self.tails and word[:-1].isalpha() and plain(word):
            return self[word[:-1]] + self.tails[word[-1]]
        if word.isalpha() and word.islower() and plain(word):  # its own normal form and one piece
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            return array.array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return self.whole(word)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = None if "<|" in text else split_at_spaces(text.lower() if plain(text) else text)
        if words is None:
            return self.whole(text)
        self.age()
        return b"".join(map(self.__getitem__, words))


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
