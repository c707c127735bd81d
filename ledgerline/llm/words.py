"""Splitting texts into the pre-tokens of a byte-level tokenizer, and a bounded memory of words per worker."""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import public_tokenizers
import regex
from tokenizers import Tokenizer


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


#: The split of byte-level tokenizers (a fixed value).
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_HIGH = re.compile("[԰-\U0010ffff]")


@functools.cache
def _unsettled() -> re.Pattern:
    """Letters and digits that only some Unicode versions know: the libraries here needn't agree on them."""
    letter = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and letter.match(c)]
    return re.compile("[" + "".join(map(re.escape, new)) + "]") if new else re.compile(r"(?!)")


@functools.cache
def library(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Splitter:
    """Cuts a text at special strings and into pre-tokens; a special string comes out as one piece."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            self.model = json.load(f)
        self.special = {t["content"]: t["id"] for t in self.model["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        if self._cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[str] = []
        for piece in self._cut.split(text):
            out += [piece] if piece in self.special else self._plain(piece)
        return out

    def _plain(self, text: str) -> list[str]:
        if _HIGH.search(text) and _unsettled().search(text):
            pieces = library(self.path).pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in pieces]
        return PATTERN.findall(text)


class WordMemory(dict):
    """word -> what ``make`` gives for it. Long words aren't kept, and a full memory starts anew."""

    def __init__(self, make: Callable, limit: int = 500_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= self.longest:
            self.keep(word, value)
        return value

    def keep(self, word: str, value) -> None:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value


class _Stretches(WordMemory):
    """What stands between two blanks -> the joined values of its pre-tokens, the first with the blank before it."""

    def __init__(self, of: TextMap, limit: int):
        super().__init__(of.known.make, limit)
        self.of = of

    def __missing__(self, stretch: str):
        if stretch.isalpha():
            return self._word(stretch)
        of, word = self.of, stretch[:-1]
        if stretch[-1:] in _STOPS and word.isalpha():
            value, most = self[word] + of.known[stretch[-1]], 7
        else:
            pieces = of.split.words(" " + stretch)
            value, most = of.join([self[w[1:]] if w[0] == " " and w[1:].isalpha() else of.known[w] for w in pieces]), 12
        if len(stretch) <= most and "\n" not in stretch:  # longer ones seldom come again
            self.keep(stretch, value)
        return value

    def _word(self, letters: str):
        value = self.make(" " + letters)
        if len(letters) <= self.longest:
            self.keep(letters, value)
        return value


_STOPS = frozenset(".,;:!?")

#: A blank that white space or the end follows: only there can a run of white space cross a blank.
_RUN = re.compile(r" (?:\s|\Z)")


class TextMap:
    """Joins what ``make`` gives for the pre-tokens of a text.

    Without runs of blanks a text can be cut at each blank, which then starts a
    pre-token; the words between are looked up without the splitting pattern.
    """

    def __init__(self, split: Splitter, make: Callable, join: Callable[[Iterable], object], limit: int = 500_000):
        self.split, self.join = split, join
        self.known = WordMemory(make, limit // 4)
        self.stretches = _Stretches(self, limit)

    def whole(self, text: str):
        return self.join(map(self.known.__getitem__, self.split.words(text)))

    def __call__(self, text: str):
        if _RUN.search(text) or any(s in text for s in self.split.special):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.join(itertools.chain((self.whole(first),), map(self.stretches.__getitem__, rest)))
