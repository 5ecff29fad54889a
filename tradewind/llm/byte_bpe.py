"""Byte-level BPE through the tokenizers library, word by word.

A text is cut at single spaces between two characters that aren't white space.  The pre-tokenizer never
reaches over such a space (it begins the next pre-token), so the parts are tokenised independently and
frequent ones once per worker.  Texts that hold a special token's string are given to the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import regex

from tradewind.llm.common import keep_for

REMEMBERED = 400_000  # words kept per worker; the first that come, so the frequent ones are among them
LONGEST_REMEMBERED = 64
GROUP_CHARACTERS = 500_000  # of texts whose new words are tokenised together
WORDS_AT_ONCE = 300
SPACE = "\u0120"  # how byte-level vocabularies write a space
_CUT = re.compile(r"(?<=\S) (?=\S)")
# The pre-tokenizer's pattern (a fixed value), with white space spelled out.
_WS = r"\t-\r \x85\xa0  -     　"
_PRE_TOKENS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Words:
    """Cuts texts and tokenises their parts."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # tokens whose first byte is a space
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items() if t.startswith(SPACE)]] = True
        # a mark after a letter, with white space or nothing behind it, is a pre-token of its own
        self.mark_ids = {m: np.array(self.tokenise([m])[0], "<u4").tobytes() for m in ".,"}
        self.ids_of: dict[str, bytes] = {}
        self.pieces_of: dict[str, tuple[str, ...]] = {}

    def is_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def tokenise(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def tokenise_words(self, words: list[str]) -> list[bytes]:
        """Ids of each plain word with a space before it.  All go to the library as one text: a token that begins
        with a space begins a word, as plain words hold no space and have no white space at their ends."""
        joined = " " + " ".join(words)
        if not self.is_special(joined):
            ids = np.array(self.tokenise([joined])[0], "<u4")
            at = np.flatnonzero(self.opens[ids]).tolist()
            if len(at) == len(words) and at[0] == 0:
                raw = ids.tobytes()
                return [raw[4 * a : 4 * b] for a, b in zip(at, [*at[1:], len(ids)])]
        return [np.array(ids, "<u4").tobytes() for ids in self.tokenise([" " + w for w in words])]

    @staticmethod
    def _odd(word: str) -> bool:
        return not word or word[0].isspace() or word[-1].isspace()

    def cut(self, text: str, known: dict) -> tuple[str, list[str], list[str], set[str]]:
        """First part, the plain words after it (each follows one space), a last part with white space at its
        end if there is one, and the plain words that aren't in `known`."""
        words = text.split(" ")
        first = words[0]
        rest = words[1:]
        new = set(rest).difference(known)
        last: list[str] = []
        if self._odd(first) or any(map(self._odd, new)):
            words = _CUT.split(text)
            first, rest = words[0], words[1:]
            if rest and self._odd(rest[-1]):
                last = [" " + rest.pop()]
            new = set(rest).difference(known)
        return first, rest, last, new

    def _cut(self, text: str, odd: bool = False) -> tuple[str, list[str | bytes], list[str], list[int]]:
        """Like `cut`, with the ids of the plain words, and where a word isn't known: it stands there itself instead of its ids."""
        words = _CUT.split(text) if odd else text.split(" ")
        first = words[0]
        rest = words[1:]
        last = [" " + rest.pop()] if odd and rest and self._odd(rest[-1]) else []
        middle = list(map(self.ids_of.get, rest))
        new, i = [], -1
        for _ in range(middle.count(None)):
            i = middle.index(None, i + 1)
            new.append(i)
            middle[i] = rest[i]
        if not odd and (self._odd(first) or any([self._odd(rest[i]) for i in new])):
            return self._cut(text, odd=True)
        return first, middle, last, new

    def ids(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return self._group([text])[0]

    def ids_of_texts(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text; the new words of a group of texts go to the library together."""
        out, group, held = [], [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= GROUP_CHARACTERS:
                out += self._group(group)
                group, held = [], 0
        return out + self._group(group) if group else out

    def _group(self, texts: list[str]) -> list[bytes]:
        known = self.ids_of
        cuts = [None if not t or self.is_special(t) else self._cut(t) for t in texts]
        once = self._learn({c[1][i] for c in cuts if c for i in c[3]})
        edges = iter(self.tokenise([part for c in cuts if c for part in (c[0], *c[2])]))
        packed = lambda ids: np.array(ids, "<u4").tobytes()
        out = []
        for text, cut in zip(texts, cuts):
            if not cut:
                out.append(packed(self.tokenise([text])[0]) if text else b"")
                continue
            _, middle, last, new = cut
            first = packed(next(edges))
            for i in new:
                word = middle[i]
                middle[i] = once[word] if word in once else known[word]
            out.append(b"".join((first, *middle, *(packed(next(edges)) for _ in last))))
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Tokenises new plain words and remembers them while there is room; gives those it can't remember."""
        known, once = self.ids_of, {}

        def keep(word: str, ids: bytes) -> None:
            if len(known) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
                known[word] = ids
            else:
                once[word] = ids

        marked = {w for w in new if w[-1] in self.mark_ids and w[-2:-1].isalpha() and w[-2] < "\u0250"}
        wanted = list((new - marked).union(w[:-1] for w in marked).difference(known))
        for i in range(0, len(wanted), WORDS_AT_ONCE):
            some = wanted[i : i + WORDS_AT_ONCE]
            for w, ids in zip(some, self.tokenise_words(some)):
                keep(w, ids)
        for w in marked:
            stem = w[:-1]
            keep(w, (known[stem] if stem in known else once[stem]) + self.mark_ids[w[-1]])
        return once

    def pieces(self, part: str) -> tuple[str, ...]:
        """Pre-tokens of one part."""
        if max(part) < "\u0250":
            return tuple(_PRE_TOKENS.findall(part))
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
        return tuple(part[s:e] for _, (s, e) in found)

    def pieces_of_word(self, word: str) -> tuple[str, ...]:
        """Pre-tokens of a word with its space."""
        found = self.pieces_of.get(word)
        if found is None:
            found = self.pieces(" " + word)
            if len(self.pieces_of) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
                self.pieces_of[word] = found
        return found

    def split_special(self, text: str) -> list[str]:
        """The text cut around special tokens; they are parts of their own."""
        if not self.is_special(text):
            return [text]
        return [p for p in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if p]


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def words(path: str) -> Words:
    """One per worker process and vocabulary, so that what it remembers serves later tasks too."""
    keep_for("byte_bpe", _words.cache_clear)
    return _words(path)
