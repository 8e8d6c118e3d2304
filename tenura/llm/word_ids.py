"""Token ids of whole texts: the tokenizers library once per distinct word, joined per text."""

from __future__ import annotations

import os
import re

import numpy as np

from tenura.llm.common import keeps, starts_task

#: Words of these characters (printable, up to Latin Extended-A, without the dotted capital I) are not changed by
#: composition and are split and lower-cased here; any other word goes through the library whole.
PLAIN = re.compile("[!-~¡-¬®-įı-ſ]+")
LETTERS, NUMBERS = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼-¾"
#: How the tokenizer splits a lower-cased word of those characters.
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from 256 on in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordEncoder:
    """Encodes texts with a word-wise vocabulary (white space dropped before merging).

    The ids of a word do not depend on its neighbours, nor those of a part on the rest of its word, so each distinct
    word is put together once, each distinct part goes through the library once, and both are kept as bytes. At `most`
    kept words or parts the store is emptied, which bounds memory and changes no result.
    """

    def __init__(self, path: str, most: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.kept, self.parts, self.letters = most, {"": b""}, {}, byte_letters()

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = np.array([token.id for token in self.tokenizer.model.tokenize(spelled)], dtype="<u4").tobytes()
        self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if "<|" in word or not PLAIN.fullmatch(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        known = self.parts
        return b"".join([known.get(part) or self._part(part) for part in PARTS.findall(word.lower())])

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        kept = self.kept
        try:
            return b"".join(map(kept.__getitem__, words))
        except KeyError:
            pass
        if len(kept) > self.most:
            kept.clear()
            kept[""] = b""
        if len(self.parts) > self.most:
            self.parts.clear()
        for word in set(words).difference(kept):
            kept[word] = self._word(word)
        return b"".join(map(kept.__getitem__, words))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    starts_task("words")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    keeps("words", _ENCODERS.clear)
    return _ENCODERS[path]
