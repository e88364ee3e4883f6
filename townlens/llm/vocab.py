"""Public tokenizer files. Tokenizers are opened once a Python worker; word results are kept in a bounded memo."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Entries after which a worker's memo starts anew: bounds its memory, changes no result.
MEMO = 1_000_000
#: Characters on which every Unicode version agrees; texts of these only are split here, others by the library.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ɏ‐-‟…]*+")
#: The byte-level split of texts of these characters: contractions, letters, numbers, signs, white space.
_LETTER, _NUMBER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
WORDS = re.compile(rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")


def path_of(name: str) -> str:
    """A file name of the public set, or a path as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(4)
def tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path_of(name))


@lru_cache(4)
def byte_ids(name: str, memo: int = MEMO) -> ByteIds:
    """One for each worker, so that its memo serves all tasks of the worker."""
    return ByteIds(name, limit=memo)


def slices(values: list[str], size: int):
    for at in range(0, len(values), size):
        yield values[at : at + size]


class ByteIds:
    """Ids of whole texts by a byte-level vocabulary, as little-endian unsigned 32-bit integers.

    The library splits a text into words and encodes each alone, so a word's ids are asked for once and then joined.
    New words are given to the library in rows: where each starts with a space it splits the row into these words."""

    ROW = 2000

    def __init__(self, name: str, special: tuple[str, ...] = ("<|endoftext|>",), limit: int = MEMO) -> None:
        self.library, self.special, self.memo, self.limit = tokenizer(name), special, {}, limit

    def plain(self, text: str) -> bool:
        return not any(s in text for s in self.special) and PLAIN.fullmatch(text) is not None

    def learn(self, words: list[str]) -> None:
        spaced, rest = [], []
        for w in words:
            (spaced if w[0] == " " and w[1:].isalpha() else rest).append(w)
        for some in slices(spaced, self.ROW):
            e = self.library.encode("".join(some), add_special_tokens=False)
            ids, word = np.array(e.ids, dtype="<u4"), np.array(e.word_ids)
            cuts = np.searchsorted(word, np.arange(len(some) + 1)).tolist()
            raw = ids.tobytes()
            self.memo.update(zip(some, [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]))
        for some in slices(rest, 20_000):
            for w, e in zip(some, self.library.encode_batch(some, add_special_tokens=False)):
                self.memo[w] = np.array(e.ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [WORDS.findall(t) if self.plain(t) else None for t in texts]
        known = self.memo.get
        parts = [w if w is None else list(map(known, w)) for w in split]
        holes, fresh = [], set()
        for w, p in zip(split, parts):
            if p is not None and None in p:
                at = [i for i, x in enumerate(p) if x is None]
                holes.append((w, p, at))
                fresh.update([w[i] for i in at])
        if len(self.memo) + len(fresh) > self.limit:
            self.memo.clear()
        self.learn(list(fresh))
        get = self.memo.__getitem__
        for w, p, at in holes:
            for i in at:
                p[i] = get(w[i])
        return [b"".join(p) if p is not None else np.array(self.library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t, p in zip(texts, parts)]
