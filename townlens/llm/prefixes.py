"""Tokens of every prefix of one long piece, exactly and in time that grows with its length.

The tokenizer encodes each word (a run of letters, a number, a run of signs) alone by merges, and marks the end of a word,
so the tokens of a prefix are not a prefix of the tokens. But tokens stand in an encoding if and only if each two neighbours
are the encoding of their own text: before a merge over a border, both sides do what they do alone. So the last token of
each prefix of a word, without the mark, is the one that fits the last token of the prefix before it, and the last token
with the mark is found in the same way, one step each. Whether two tokens fit is asked of the library's own merges."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers.models import BPE

from townlens.llm.vocab import MEMO, tokenizer

END = "</w>"
#: Hangul parts that join with the character before them.
JOINS = re.compile("[ᅠ-ᇿힰ-퟿]")


@lru_cache(4)
def prefixes(name: str) -> Prefixes:
    return Prefixes(name)


def stands_alone(ch: str) -> bool:
    """Whether no normal form joins or moves a character with what stands before it."""
    return ch < "̀" or not (unicodedata.category(ch) in ("Mn", "Mc", "Me", "Cn") or JOINS.match(ch))


class Prefixes:
    def __init__(self, name: str) -> None:
        self.library = tokenizer(name)
        model = json.loads(self.library.to_str())["model"]
        self.vocab, self.fits = model["vocab"], {}
        self.plain = BPE(self.vocab, [tuple(m) for m in model["merges"]])  # the same merges, no mark at the end
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        special = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    def count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False))

    def fit(self, before: str, token: str) -> bool:
        key = (before, token)
        if key not in self.fits:
            if len(self.fits) > MEMO:
                self.fits.clear()
            model = self.library.model if token.endswith(END) else self.plain
            found = [t.value for t in model.tokenize(before + token.removesuffix(END))]
            self.fits[key] = found == ([before, token] if before else [token])
        return self.fits[key]

    def word(self, signs: str, ends: list[int]) -> list[int]:
        """Tokens of the word's prefixes that end at the given places of its byte signs."""
        last, count, out, asked = [""], [0], [], set(ends)
        for i in range(1, len(signs) + 1):
            found = marked = None
            for j in range(max(0, i - self.longest), i):
                t = signs[j:i]
                if found is None and t in self.vocab and self.fit(last[j], t):
                    found = j
                if marked is None and i in asked and t + END in self.vocab and self.fit(last[j], t + END):
                    marked = j
            last.append(signs[found:i])
            count.append(count[found] + 1)
            if i in asked:
                out.append(count[marked] + 1)
        return out

    def counts(self, piece: str) -> np.ndarray:
        """Tokens of piece[:k] for each k from 0 on."""
        out, at = np.zeros(len(piece) + 1, dtype=np.int64), 0
        for m in self.special.finditer(piece):
            tail = self.between(piece, at, m.start(), out)
            for k in range(m.start() + 1, m.end()):  # a part of a special string is text, behind the word that it may belong to
                out[k] = out[tail] + self.count(piece[tail:k])
            out[m.end()] = out[m.start()] + 1
            at = m.end()
        self.between(piece, at, len(piece), out)
        return out

    def between(self, piece: str, start: int, stop: int, out: np.ndarray) -> int:
        """Fills the counts of a part without special strings; where a word begins that what follows cannot change."""
        if start == stop:
            return start
        cuts = [k for k in range(start, stop) if k == start or stands_alone(piece[k])] + [stop]
        normal = {}
        for a, b in zip(cuts, cuts[1:]):
            c = piece[a:b]
            if c not in normal:
                normal[c] = self.library.normalizer.normalize_str(c)
        parts = [normal[piece[a:b]] for a, b in zip(cuts, cuts[1:])]
        text, place = "".join(parts), np.cumsum([0, *map(len, parts)])
        here = np.zeros(len(text) + 1, dtype=np.int64)
        total, done, begins = int(out[start]), 0, [0]
        here[0] = total
        for signs, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text):
            here[done + 1 : a + 1] = total
            begins.append(a)
            if text[a] == "'" and any(ch.isalpha() for ch in text[a:b]):  # an ending like 're, of which a part is no ending
                here[a + 1 : b + 1] = [total + self.count(text[a:j]) for j in range(a + 1, b + 1)]
            else:
                here[a + 1 : b + 1] = total + np.array(self.word(signs, np.cumsum([len(ch.encode()) for ch in text[a:b]]).tolist()))
            total, done = int(here[b]), b
        here[done + 1 :] = total
        out[np.array(cuts)] = here[place]
        known = dict(zip(place.tolist(), cuts))
        firm = [known[a] for a in begins if a in known and "'" not in text[max(0, a - 2) : a]]
        tail = 0
        for a, b in zip(cuts, cuts[1:]):
            while tail + 1 < len(firm) and firm[tail + 1] <= a:
                tail += 1
            for k in range(a + 1, b):  # inside a character of several code points
                out[k] = out[firm[tail]] + self.count(piece[firm[tail] : k])
        return firm[-1]
