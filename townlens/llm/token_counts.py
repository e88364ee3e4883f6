"""Exact token counts by prefix dynamic programming.

P[i] is the number of tokens of the first i characters. A word-based tokenizer never joins characters across white space,
so within a piece (a run without white space) that starts at s, P[i] = P[s] + count(piece[: i - s]), and P stays as it is
over white space. What is stored is the change from each P[i] to the next, which depends on the piece alone: the changes
of each distinct piece are computed once a worker, by counting all its prefixes with the tokenizers library, and a text's
table is theirs joined. From the table, and from nothing else, follow the tokens of any prefix, of any range between two
pieces, and the longest prefix within a budget: no text is split or encoded again. Of pieces of more than LONG characters
that table knows the end alone, as counting their prefixes one by one costs the square of their length; a text with such
a piece has a second table, `inner`, with the count of every prefix (see prefixes), and budgets are held against that one.

Defined cases: null is empty; empty has no tokens and an empty table; special strings inside a text count as the library
counts them by default; texts of any length are processed whole; repeated rows and rows without an id each have their own
row; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from townlens.llm.common import narrow, only_memo, written
from townlens.llm.prefixes import prefixes
from townlens.llm.vocab import MEMO, slices, tokenizer

#: Unicode white space. Python's own split() also breaks at \x1c to \x1f, which tokenizers treat as text.
SPACE = "\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[^{SPACE}]+")
ODD = re.compile("[\x1c-\x1f]")


#: A change of P is stored in two bytes.
CHANGE = np.dtype("<i2")
#: Counting every prefix of a piece costs the square of its length: in the first table a longer piece without white space is
#: known at its end alone. Its other places are marked by UNKNOWN, to which a part of the piece's count may be added.
LONG, UNKNOWN = 200, 20_000
#: Counts of prefixes after which a worker's memo of them starts anew: bounds its memory, changes no result.
HEADS = 1_000_000
#: A word and the signs behind it: the tokenizer drops case, splits there and encodes both sides alone, so that prefixes of
#: the one add to prefixes of the other. Letters on which every Unicode version agrees; an apostrophe may begin an ending.
PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


@lru_cache(4)
def prefix_counter(name: str) -> PrefixCounter:
    """One for each worker, so that its memo serves all tasks of the worker."""
    return PrefixCounter(name)


class PrefixCounter:
    """The tables of texts; memo: the changes of each piece, parts: those of the words and signs that pieces consist of,
    heads: counts of prefixes."""

    def __init__(self, name: str = "word_bpe_49k.json") -> None:
        self.name, self.library, self.memo, self.parts, self.heads = name, tokenizer(name), {}, {}, {}

    def pieces(self, text: str) -> list[str]:
        return PIECE.findall(text) if ODD.search(text) else text.split()

    def _count(self, words: list[str]) -> None:
        for some in slices(words, 2000):
            self.heads.update(zip(some, map(len, self.library.encode_batch_fast(some, add_special_tokens=False))))

    def _learn_parts(self, parts: list[str]) -> None:
        """Count all prefixes of each part, and keep the changes from one to the next."""
        for some in slices(sorted(parts), 4000):  # neighbours share their prefixes
            if len(self.heads) > HEADS:
                self.heads.clear()
            usual = [p for p in some if len(p) <= LONG]
            every = [p[:j] for p in usual for j in range(1, len(p) + 1)]
            long = [p for p in some if len(p) > LONG]
            self._count(list({h for h in (*every, *long) if h not in self.heads}))
            counts = np.fromiter(map(self.heads.__getitem__, every), dtype=np.int64, count=len(every))
            change = np.diff(counts, prepend=0)
            starts = np.cumsum([0, *map(len, usual)])
            change[starts[:-1]] = counts[starts[:-1]]
            raw, cuts = change.astype(CHANGE).tobytes(), (2 * starts).tolist()
            self.parts.update(zip(usual, (raw[x:y] for x, y in zip(cuts, cuts[1:]))))
            for p in long:
                most = UNKNOWN // 2
                full, rest = divmod(self.heads[p], most)
                row = np.full(len(p), UNKNOWN)
                row[:full] += most
                row[-1] = rest
                self.parts[p] = row.astype(CHANGE).tobytes()

    def learn(self, pieces: set[str]) -> None:
        fresh = [p for p in pieces if p not in self.memo]
        if len(self.memo) + len(fresh) > MEMO or len(self.parts) > MEMO:
            self.memo.clear()
            self.parts.clear()
            fresh = list(pieces)
        split = {}
        for p in fresh:
            m = PLAIN.fullmatch(p) if len(p) <= LONG else None
            split[p] = (m[1].lower(), m[2]) if m else (p, "")
        parts = {x for pair in split.values() for x in pair if x}
        self._learn_parts([x for x in parts if x not in self.parts])
        known = self.parts
        known[""] = b""
        for p, (word, signs) in split.items():
            self.memo[p] = known[word] + known[signs]

    def inside(self, piece: str) -> bytes:
        """The change of P at each character of a piece of any length."""
        if len(piece) <= LONG:
            return self.memo[piece]
        return np.diff(prefixes(self.name).counts(piece)).astype(CHANGE).tobytes()

    def inner(self, text: str, pieces: list[str]) -> bytes | None:
        """The table with the places inside long pieces; none where a text has no such piece."""
        if max(map(len, pieces), default=0) <= LONG:
            return None
        return self.table(text, pieces, {p: self.inside(p) for p in set(pieces)}.__getitem__)

    def table(self, text: str, pieces: list[str], changes: Callable[[str], bytes] | None = None) -> bytes:
        """The change of P at each character; the pieces of the text must have been learnt."""
        changes = changes or self.memo.__getitem__
        if len(text) == sum(map(len, pieces)) + len(pieces) - 1:  # one character of white space between pieces, none at the ends
            return b"\0\0".join(map(changes, pieces))
        out, at = [], 0
        for m in PIECE.finditer(text):
            out += [bytes(2 * (m.start() - at)), changes(m[0])]
            at = m.end()
        return b"".join([*out, bytes(2 * (len(text) - at))])


def counts_of(table: bytes) -> np.ndarray:
    """P at every prefix, from the empty one on; in the first table -1 inside a piece of more than LONG characters."""
    change = np.frombuffer(table, CHANGE)
    out = np.zeros(len(change) + 1, dtype=np.int64)
    if len(change) and change.max() >= UNKNOWN:
        inside = change >= UNKNOWN
        np.cumsum(np.where(inside, change - UNKNOWN, change), dtype=np.int64, out=out[1:])
        out[1:][inside] = -1
    else:
        np.cumsum(change, dtype=np.int64, out=out[1:])
    return out


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that has at most budget tokens."""
    return int(np.nonzero((counts <= budget) & (counts >= 0))[0][-1])


def prefix_tables(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, changes, inner): the size of each text in UTF-8, and its tables, two bytes a code point; inner is null
    where no piece is longer than LONG and changes holds all."""
    source = narrow(docs, id_col, text)

    def run(batches):
        only_memo("pieces", prefix_counter.cache_clear)
        dp = prefix_counter(tokenizer_name)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                texts = some.column("text").to_pylist()
                split = [dp.pieces(t) for t in texts]
                dp.learn(set().union(*split))
                size = [len(t.encode("utf-8", "replace")) for t in texts]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(size, pa.int64()), pa.array(list(map(dp.table, texts, split)), pa.binary()), pa.array(list(map(dp.inner, texts, split)), pa.binary())], ["doc_id", "n_bytes", "changes", "inner"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes long, changes binary, inner binary")


def answers(tables: DataFrame, limit: int, chars: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars, prefix_tokens, first_tokens) from stored tables: fit_chars code points
    are the longest prefix of at most limit tokens, first_tokens the tokens of the first chars code points (of all, if fewer or
    None); prefix_tokens is the same from the first table alone, null inside a piece of more than LONG."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                found = [counts_of(t) for t in some.column("changes").to_pylist()]
                total = np.array([c[-1] for c in found], dtype=np.int64)
                every = [c if t is None else counts_of(t) for c, t in zip(found, some.column("inner").to_pylist())]
                fit = [len(c) - 1 if c[-1] <= limit else longest_within(c, limit) for c in every]
                head = lambda c: int(c[-1] if chars is None else c[min(chars, len(c) - 1)])
                known = [None if n < 0 else n for n in map(head, found)]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("n_bytes"), pa.array(total), pa.array(total > limit), pa.array(fit, pa.int64()), pa.array(known, pa.int64()), pa.array(list(map(head, every)), pa.int64())], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "prefix_tokens", "first_tokens"])

    return tables.mapInArrow(run, f"doc_id {tables.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, prefix_tokens long, first_tokens long")


def token_counts(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) of each row, from the tables, which are stored first."""
    tables = written(prefix_tables(docs, tokenizer_name, id_col, text), "prefix-tables")
    return answers(tables, limit).drop("prefix_tokens", "first_tokens")
