"""Splitting of texts into the words of a word-end tokenizer, equal to the public tokenizer library's own."""

from __future__ import annotations

import re
import unicodedata

from tokenizers import Tokenizer

#: Code points that the quick path handles: nothing composes with them and their lower case stays among them.
_PLAIN = "".join(re.escape(chr(c)) for c in range(0x250) if max(map(ord, chr(c).lower())) < 0x250)
_PLAIN += "\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\U0001f300-\U0001f5ff\U0001f600-\U0001f64f"
_SPACES = "\t-\r \x85\xa0"
OTHER = re.compile(f"[^{_PLAIN}]")
BEYOND_LATIN = re.compile("[^\x00-\xff]")


def _word(below: int) -> re.Pattern:
    """The tokenizer's pattern over code points below a bound; its branches begin with different characters."""
    kind = {k: "".join(re.escape(chr(c)) for c in range(below) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    return re.compile(f"[{kind['L']}]+|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACES}{kind['L']}{kind['N']}]+|[{kind['N']}]")


WORD, LATIN_WORD = _word(0x250), _word(0x100)


def byte_letters() -> dict[int, str]:
    """The visible letter of each byte: itself where printable in Latin-1, else the next free one from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {b: chr(b) for b in seen}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return out


class Splitter:
    """Words of a text: special strings apart, then the tokenizer's normaliser and pattern.

    Texts of common letters take a quick path with the same rules; all others go through the
    library's normaliser and pre-tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._byte = {c: b for b, c in byte_letters().items()}

    def parts(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at odd places."""
        return self._cut.split(text) if self._cut and "<" in text else [text]

    def words(self, part: str) -> list[str]:
        if OTHER.search(part) is None:
            low = part.lower()
            return (LATIN_WORD if BEYOND_LATIN.search(low) is None else WORD).findall(low)
        t = self.tokenizer
        pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(part))
        return [bytes(map(self._byte.__getitem__, p)).decode() for p, _ in pieces]


class Memo(dict):
    """Results by key up to a bounded number, then afresh; long texts are not kept."""

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if isinstance(key, int) or len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value
