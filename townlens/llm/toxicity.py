"""Toxicity scores behind a noisy-channel deobfuscation.

Three steps. (1) A character 4-gram model is counted over all words of all documents; its alphabet has 28 symbols, so
the counts that reach the driver are at most 28^4 whatever the input. (2) Written tokens that may hide a word (digits or
signs among letters, letters spaced out, letters repeated) become lattices: each character may stand for the letters it
is used for, be dropped as filler, or repeat the letter before it, at a price. A Viterbi pass, exact for the model's
three letters of context, finds the cheapest reading. (3) A noisy-or classifier over words scores the restored text.

The classifier is fitted on a bounded sample of labelled rows (max_train, by hash of the id). A word's evidence is the
smaller of the labelled documents and the distinct neighbour pairs it occurs in, so copies of one document do not make
its words look telling; words need a likelihood ratio above G2_MIN and a precision of one half.

The score of a text is that of its restored text, restore(text, bits, lexicon). Every token that hides something, and every
run of spaced-out letters, is decoded whole, however long, and once a worker; a token that cannot be read as any word of
the lexicon, by a look that admits every reading the lattice has, adds nothing to the score and is not decoded.

Defined cases: null and empty texts have the score of a document without a telling word; labels that are null are not
used; repeated labels of one id count once (the highest); no usable label at all gives every document the same score;
repeated rows and rows without an id are scored each; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import narrow, only_memo, written

#: Symbols of the language model: 0 is the word boundary, 1 to 26 are a to z, 27 is any other letter.
SYMBOLS, ORDER = 28, 4
ACCENTS = {"à": "a", "á": "a", "â": "a", "ã": "a", "ä": "a", "å": "a", "ç": "c", "è": "e", "é": "e", "ê": "e", "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i", "ñ": "n", "ò": "o", "ó": "o", "ô": "o", "õ": "o", "ö": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "ý": "y", "ÿ": "y"}
#: What a sign or digit may stand for; a single * may stand for any letter, a run of them is filler.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "#": "h", "€": "e", "£": "l", "¡": "i", "v": "u", "*": "abcdefghijklmnopqrstuvwxyz"}
FOLD = str.maketrans(ACCENTS)
#: Channel prices in bits.
LEET_COST, WILD_COST, DROP_COST, REPEAT_COST, DOUBLE_COST, SPLIT_COST, PART_COST = 1.0, 3.0, 1.5, 0.5, 3.0, 4.0, 1.6
G2_MIN, LEAST_EVIDENCE = 24.0, 4
MAX_TRAIN = 20_000
#: Characters whose 4-grams are counted at a time: bounds memory, changes no result.
CHUNK = 1 << 20
#: Distinct tokens after which a worker's memo starts anew: bounds its memory, changes no result.
MEMO = 250_000


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point below 0x250; the last entry is for all others."""
    out = np.zeros(0x251, dtype=np.int64)
    for cp in range(0x250):
        c = chr(cp).lower()[0]
        c = ACCENTS.get(c, c)
        out[cp] = ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0
    out[0x250] = 27
    return out


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of the 4-grams of symbols; runs of boundaries count as one. Symbols are taken CHUNK at a time, with the three
    before them, so that memory does not grow with the length of the texts."""
    whole = "\n".join(["", *texts, ""])
    out, before = np.zeros(SYMBOLS**ORDER, dtype=np.int64), np.zeros(2, dtype=np.int64)
    for at in range(0, len(whole), CHUNK):
        cps = np.frombuffer(whole[at : at + CHUNK].encode("utf-32-le", "replace"), dtype=np.uint32)
        s = symbol_table()[np.minimum(cps, 0x250)]
        last = before[-1] if at else 1  # the first boundary counts
        s = np.concatenate([before, s[(s != 0) | (np.concatenate([[last], s[:-1]]) != 0)]])
        codes = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
        out += np.bincount(codes, minlength=SYMBOLS**ORDER)
        before = s[-3:]
    return out


def char_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> np.ndarray:
    """4-gram counts of all texts, at most 28^4 numbers."""

    def run(batches):
        total = np.zeros(SYMBOLS**ORDER, dtype=np.int64)
        for b in batches:
            column = b.column("text")
            for at in range(0, b.num_rows, 500):
                total += gram_counts(column.slice(at, 500).to_pylist())
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    found = narrow(docs, id_col, text).select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**ORDER, dtype=np.float64)
    out[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return out


def char_model(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Bits of each symbol after each three, orders interpolated; shape (28, 28, 28, 28)."""
    c4 = counts.reshape((SYMBOLS,) * ORDER)
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        c = c4.sum(axis=axes) if axes else c4
        lower = (c + weight * lower) / (c.sum(axis=-1, keepdims=True) + weight)
    return -np.log2(lower).astype(np.float32)


#: What parts words when written between them; other signs may, at a higher price.
PARTS = "/\\,;:&=~_…-.?’'\"“”«»"


def viterbi(token: str, bits: np.ndarray) -> str:
    """The cheapest reading of a token: letters (those written keep their accents), and a space where spaced letters or
    signs part words. A tab stands for a gap of more than one space."""
    written_as = token.lower()
    token = written_as.translate(FOLD)
    states: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
    end = len(token)
    earlier = before = ""  # the last two characters that are no gaps
    for i, c in enumerate(token):
        moves: list[tuple[int, float, str]] = []  # symbol written (-1: none), price, letter
        if "a" <= c <= "z":
            moves.append((ord(c) - 96, 0.0, written_as[i]))
            moves += [(ord(x) - 96, LEET_COST + 1, x) for x in LEET.get(c, "")]
            if before == c:
                run = earlier == c or (i + 1 < end and token[i + 1] == c)
                moves.append((-1, REPEAT_COST if run else DOUBLE_COST, ""))
        elif c == " ":
            moves += [(-1, 0.0, ""), (0, SPLIT_COST, " ")]
        elif c == "\t":
            moves += [(-1, 1.0, ""), (0, 0.5, " ")]
        elif c.isalpha():
            moves.append((27, 0.0, c))
        else:
            if c == "*":
                if "*" not in (token[i - 1 : i], token[i + 1 : i + 2]):
                    moves += [(ord(x) - 96, WILD_COST, x) for x in LEET[c]]
            else:
                moves += [(ord(x) - 96, LEET_COST, x) for x in LEET.get(c, "")]
            moves += [(-1, REPEAT_COST if before == c else DROP_COST, ""), (0, PART_COST if c in PARTS else SPLIT_COST, " ")]
        after: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
        for (x, y, z), (cost, out) in states.items():
            for s, price, letter in moves:
                if s < 0:
                    key, total = (x, y, z), cost + price
                else:
                    key, total = (y, z, s), cost + price + float(bits[x, y, z, s])
                if key not in after or total < after[key][0]:
                    after[key] = (total, (out, letter) if letter else out)
        states = after
        if c not in " \t":
            earlier, before = before, c
    _, _, back = min((cost + (float(bits[x, y, z, 0]) if z else 0.0), (x, y, z), out) for (x, y, z), (cost, out) in states.items())
    letters = []
    while back:
        back, letter = back
        letters.append(letter)
    return "".join(reversed(letters))


LETTERS = re.compile(r"[^\W\d_]+")
#: Letters spaced out, with signs at both ends.
SPACED = re.compile(r"(?<!\S)[^\w\s]*\S(?:\s+\S){2,}[^\w\s]*(?!\S)")
GAP = re.compile(r"\s+")
RUN = re.compile(r"(.)\1+", re.S)
#: Signs that stand for no letter: at the ends of a token they are always dropped, which is the cheapest there.
_FILLER = r"[^\w\s" + re.escape("".join(LEET)) + r"]|_|(?<=\*)\*|\*(?=\*)"
ENDS = re.compile(rf"^(?:{_FILLER})+|(?:{_FILLER})+$")
#: Classes of letters that one sign may stand for, for a first look at what a token can be read as at all.
CLASS = {"l": "i", "g": "b", "v": "u"}
LOOK = {x: CLASS.get(x, x) for x in "abcdefghijklmnopqrstuvwxyz"} | {sign: CLASS.get(x[0], x[0]).upper() for sign, x in LEET.items() if not sign.isalpha()} | {"*": "?"}
#: Tokens whose first look is longer are decoded without it, for the look may then cost more.
LOOK_LENGTH = 200


def gaps(run: str) -> str:
    return GAP.sub(lambda m: " " if len(m[0]) == 1 else "\t", run)


def plain(token: str, words) -> str | None:
    """The core of a lower-case token that hides nothing: a known word, or letters of which no two neighbours are alike."""
    core = ENDS.sub("", token)
    if core in words or (core.isalpha() and RUN.search(core.translate(FOLD)) is None):
        return core
    return None


def restore(text: str, bits: np.ndarray, words=()) -> str:
    """The lower-case text with every token and spaced run replaced by its cheapest reading; words: known ones, which
    are left as they are."""
    low, out, at = text.lower(), [], 0
    read = lambda m: core if (core := plain(m[0], words)) is not None else viterbi(m[0], bits)
    for run in SPACED.finditer(low):
        out += [re.sub(r"\S+", read, low[at : run.start()]), viterbi(gaps(run[0]), bits)]
        at = run.end()
    return "".join([*out, re.sub(r"\S+", read, low[at:])])


#: Spellers of this worker by the scoring run, so that a memo serves all tasks of the worker.
SPELLERS: dict[str, Speller] = {}


def speller(run: str, lexicon: list[str], bits: np.ndarray) -> Speller:
    only_memo("toxicity", SPELLERS.clear)
    if run not in SPELLERS:
        SPELLERS.clear()
        SPELLERS[run] = Speller(lexicon, bits)
    return SPELLERS[run]


class Speller:
    """Which words of a lexicon a text holds once it is restored. Tokens are decoded whole, each once; those whose
    letters and signs cannot spell any word of the lexicon need no decoding, for no reading of them counts."""

    def __init__(self, lexicon: list[str], bits: np.ndarray) -> None:
        self.words = {w: i for i, w in enumerate(lexicon)}
        self.bits, self.memo = bits, {}
        bare = sorted({self.look(w) for w in self.words})
        spell = ["".join(rf"(?:{c}|{c.upper()}|\?)[{c}A-Z?]*" if "a" <= c <= "z" else re.escape(c) for c in w) for w in bare]
        self.maybe = re.compile("|".join(spell) or r"(?!)")

    @staticmethod
    def look(token: str) -> str:
        """Classes of the letters, upper case where a sign may stand for one; equal neighbours are one."""
        token = token.translate(FOLD)
        return RUN.sub(r"\1", "".join([LOOK.get(c, c if c.isalpha() else "") for c in token]))

    def hits(self, token: str) -> tuple[int, ...]:
        """Numbers of the lexicon's words in the reading of a lower-case token or spaced run."""
        if (core := plain(token, self.words)) is not None:
            return (self.words[core],) if core in self.words else ()
        look = self.look(token)
        if len(look) <= LOOK_LENGTH and not self.maybe.search(look):
            return ()
        return tuple(sorted({self.words[w] for w in LETTERS.findall(viterbi(token, self.bits)) if w in self.words}))

    def text_hits(self, text: str) -> set[int]:
        low = text.lower()
        runs = {gaps(m[0]) for m in SPACED.finditer(low)}
        tokens = set((SPACED.sub(" ", low) if runs else low).split()) | runs
        if len(self.memo) > MEMO:
            self.memo = {}
        out: set[int] = set()
        for t in tokens:
            got = self.memo.get(t)
            if got is None:
                got = self.memo[t] = self.hits(t)
            if got:
                out.update(got)
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", label: str = "toxic", text: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most max_train labelled documents that are not held out, by hash of the id."""
    usable = labels.filter(labels[label].isNotNull() & labels[id_col].isNotNull() & ~held_out(labels[id_col]))
    chosen = usable.groupBy(usable[id_col].alias("doc_id")).agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    return narrow(docs, id_col, text).join(F.broadcast(chosen), "doc_id")  # bounded by max_train


def g2(t: float, c: float, n_t: int, n_c: int) -> float:
    """Likelihood ratio of a word that t of n_t and c of n_c documents hold."""
    rows = n_t + n_c
    cells = ((t, n_t, t + c), (c, n_c, t + c), (n_t - t, n_t, rows - t - c), (n_c - c, n_c, rows - t - c))
    return 2 * sum(a * math.log(a * rows / (n * m)) for a, n, m in cells if a > 0)


def g2_column(t: Column, c: Column, n_t: int, n_c: int) -> Column:
    """g2() of two columns."""
    rows = n_t + n_c
    cells = ((t, n_t, t + c), (c, n_c, t + c), (n_t - t, n_t, rows - t - c), (n_c - c, n_c, rows - t - c))
    return 2 * sum((F.when(a > 0, a * F.log(a * F.lit(float(rows)) / (m * F.lit(float(n))))).otherwise(0.0) for a, n, m in cells), F.lit(0.0))


def learn(sample: DataFrame) -> dict:
    """The lexicon with a probability for each word, and the rate of the label among documents without any of them."""
    sample = written(sample, "toxicity-train")

    def frequencies(batches):
        counts = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                counts[min(1, max(0, label))].update({w for w in LETTERS.findall(text.lower()) if len(w) > 1})
        names = list(counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][w] for w in names], pa.int64()), pa.array([0] * len(names), pa.int64())], ["word", "t", "c"])
        names = list(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([0] * len(names), pa.int64()), pa.array([counts[0][w] for w in names], pa.int64())], ["word", "t", "c"])

    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_t, n_c = sizes.get(1, 0), sizes.get(0, 0)
    if not n_t or not n_c:
        return {"lexicon": [], "p": [], "base": (n_t + 0.5) / (n_t + n_c + 1)}
    words = sample.mapInArrow(frequencies, "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    telling = words.filter((F.col("t") >= LEAST_EVIDENCE) & (F.col("t") > F.col("c")) & (F.col("t") * n_c > 3 * F.col("c") * n_t))
    rows = telling.filter(g2_column(F.col("t"), F.col("c"), n_t, n_c) >= G2_MIN).collect()  # words of at most max_train texts
    candidates = {r["word"]: r for r in rows}

    def contexts(batches):
        for b in batches:
            out: set[tuple[str, int, str]] = set()
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                tokens = LETTERS.findall(text.lower())
                out.update((w, label, f"{tokens[i - 1] if i else ''} {tokens[i + 1] if i + 1 < len(tokens) else ''}") for i, w in enumerate(tokens) if w in candidates)
            names, marks, pairs = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(marks, pa.int32()), pa.array(pairs, pa.string())], ["word", "label", "pair"])

    seen = sample.mapInArrow(contexts, "word string, label int, pair string").distinct().groupBy("word", "label").agg(F.count("*").alias("n")).collect()
    around = {(r["word"], r["label"]): r["n"] for r in seen}
    found = []
    for w, r in candidates.items():
        t, c = min(r["t"], around.get((w, 1), 0)), r["c"]
        if t >= LEAST_EVIDENCE and g2(t, c, n_t, n_c) >= G2_MIN and (p := (t + 0.5) / (t + c + 1)) >= 0.5:
            found.append((g2(t, c, n_t, n_c), w, p))
    lexicon = sorted(w for _, w, _ in found)
    known = set(lexicon)

    def without(batches):
        for b in batches:
            labels = [x for t, x in zip(b.column("text").to_pylist(), b.column("label").to_pylist()) if known.isdisjoint(LETTERS.findall(t.lower()))]
            yield pa.RecordBatch.from_arrays([pa.array([sum(labels)], pa.int64()), pa.array([len(labels)], pa.int64())], ["t", "n"])

    rest = sample.mapInArrow(without, "t long, n long").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    precision = {w: p for _, w, p in found}
    return {"lexicon": lexicon, "p": [precision[w] for w in lexicon], "base": ((rest["t"] or 0) + 0.5) / ((rest["n"] or 0) + 1)}


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, words): words are the telling words found in the restored text."""
    counts = char_counts(docs, id_col, text)
    model = learn(training_sample(docs, labels, max_train, id_col, text=text))
    context = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, char_model(counts), model))
    source = narrow(docs, id_col, text)

    def run(batches):
        name, bits, model = context.value
        reader = speller(name, model["lexicon"], bits)
        for b in batches:
            column = b.column("text")
            scores, words = [], []
            for at in range(0, b.num_rows, 500):
                for t in column.slice(at, 500).to_pylist():
                    hits = reader.text_hits(t)
                    clean = 1.0 - model["base"]
                    for k in sorted(hits):
                        clean *= 1.0 - model["p"][k]
                    scores.append(1.0 - clean)
                    words.append([model["lexicon"][k] for k in sorted(hits)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), pa.array(words, pa.list_(pa.string()))], ["doc_id", "score", "words"])

    scored = source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double, words array<string>")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "words")


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose text scores under the threshold, in one pass: each row is judged where it lies."""
    counts = char_counts(docs, id_col, text)
    model = learn(training_sample(docs, labels, max_train, id_col, text=text))
    context = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, char_model(counts), model))
    telling = [p for p in model["p"]]

    def run(batches):
        name, bits, model = context.value
        reader = speller(name, model["lexicon"], bits)
        for b in batches:
            keep = []
            for at in range(0, b.num_rows, 500):
                for t in b.column(text).slice(at, 500).to_pylist():
                    clean = 1.0 - model["base"]
                    for k in reader.text_hits(t or ""):
                        clean *= 1.0 - telling[k]
                    keep.append(1.0 - clean < threshold)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
