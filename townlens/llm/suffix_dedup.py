"""Exact removal of repeated bytes: every byte covered by a string of `width` bytes that also starts in a document with a
smaller id goes. Strings are judged on the input, overlaps count, and no match crosses documents.

How it is spread. Each window of `width` bytes names a key: the least hash of the GRAM-byte strings inside it. Equal windows
name equal keys, so windows meet by key, and neighbouring windows of one key travel as one piece of text.

1. The texts are written once, in blocks of about BLOCK bytes that Spark deals by hash; later passes read them where they are.
2. Each block sends its distinct keys; a key that only one document has decides nothing and goes no further.
3. Each block sends its distinct pieces of the keys that are left, each with its least document.
4. Where pieces of one key differ, a suffix array of them brings equal windows together (`suffix_array`: suffixes are grouped
   by their Lyndon prefixes in descending order, then each group's order is emitted); the least document of a run of equal
   windows is the one that keeps them. The string that gave the key is one symbol there, as every window of the key has it.
5. The verdicts go back to the blocks, which cut the bytes.

Blocks send each distinct thing once, so no copy, line or passage makes a key hot by its copies. A key with more than HOT
pieces (a common line before ever different words) is cut into its windows, which are dealt by all their bytes.

Null texts are empty. Null ids come after all others and are not smaller than one another; rows that share an id are one
document, so none of them is smaller than the other. Texts of less than `width` bytes, and an empty table, lose nothing. Very
long texts are read in slices, with windows over the cuts. Further columns are ignored, whatever their names."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import forget, narrow, remove, shared_dir, written

WIDTH = 50
#: Bytes of the strings whose least hash is a window's key: shorter ones meet by chance, longer ones make more pieces.
GRAM = 24
#: Bytes of text that one group of a pass reads, and groups to a file.
BLOCK, PER_FILE = 1 << 21, 4
#: Windows hashed at a time, windows of one piece at most, symbols of one suffix array (a key is never parted).
SLICE, RUN, BATCH = 1 << 18, 32, 60_000
#: Pieces of one key beyond which its windows are dealt one by one.
HOT = 4096
#: Bits of a key that pass 1 leaves out, which only asks who else may have it: keys alike in the rest send pieces in vain,
#: which then meet under their whole keys. 40 bits are left, in half the bytes.
UNTOLD = np.uint64(24)
LAST = np.iinfo(np.int64).max


def suffix_array(t: list[int]) -> list[int]:
    """Starts of all suffixes of t in ascending order; t ends with its only smallest-possible suffix, a least symbol.

    Phase 1 keeps groups of suffixes that share a Lyndon prefix and goes through them in descending order. Each member
    points at the nearest start on its left that lies in a smaller group (`left`); what is pointed at has a longer Lyndon
    prefix than the rest of its group, by as many copies as members point at it, and so moves to a group of its own just
    above. Phase 2 goes through the order as it grows: the starts that lead to a placed suffix along `left` are the next of
    their groups. No names are given to substrings, and nothing is sorted but places within a group."""
    n = len(t)
    first: dict[int, set[int]] = {}
    for i, c in enumerate(t):
        if c in first:
            first[c].add(i)
        else:
            first[c] = {i}
    symbols = sorted(first)
    members = [first[c] for c in symbols]
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    group = [0] * n
    for g, some in enumerate(members):
        for i in some:
            group[i] = g
    left, done, at = [-1] * n, bytearray(n), len(symbols) - 1

    def part(g: int, moved: set[int]) -> None:
        """Moves starts of group g to a new group right above it."""
        h, over = len(members), above[g]
        members.append(moved)
        for j in moved:
            group[j] = h
        above[g] = below[over] = h
        above.append(over)
        below.append(g)

    while at >= 0:
        some = members[at]
        for i in some:
            done[i] = 1
        if len(some) == 1:
            (i,) = some
            j = i - 1
            while j >= 0 and done[j]:
                j = left[j]
            left[i] = j
            if j >= 0 and len(members[group[j]]) > 1:
                members[group[j]].remove(j)
                part(group[j], {j})
        else:
            copies: dict[int, int] = {}
            for i in sorted(some):
                j = i - 1
                while j >= 0 and done[j]:
                    j = left[j]
                left[i] = j
                if j >= 0:
                    copies[j] = copies.get(j, 0) + 1
            by_copies: dict[int, list[int]] = {}
            for j, k in copies.items():
                by_copies.setdefault(k, []).append(j)
            for k in sorted(by_copies, reverse=True):
                parted: dict[int, set[int]] = {}
                for j in by_copies[k]:
                    parted.setdefault(group[j], set()).add(j)
                for g, moved in parted.items():
                    if len(moved) < len(members[g]):
                        members[g] -= moved
                        part(g, moved)
        at = below[at]

    free, g, placed = [0] * len(members), group[n - 1], 0
    while below[g] >= 0:
        g = below[g]
    while g >= 0:
        free[g] = placed
        placed += len(members[g])
        g = above[g]
    order, known = [0] * n, bytearray(n)
    order[0], known[n - 1] = n - 1, 1
    free[group[n - 1]] += 1
    for k in range(n):
        j = order[k] - 1
        while j >= 0 and not known[j]:
            g = group[j]
            order[free[g]] = j
            free[g] += 1
            known[j] = 1
            j = left[j]
    return order


def grown(x: np.ndarray, size: int, join) -> np.ndarray:
    """join() over each `size` neighbours, from spans that double."""
    span = 1
    while span * 2 <= size:
        x = join(x[:-span], x[span:])
        span *= 2
    return join(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each string of `gram` bytes."""

    def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        y = a * np.uint64(0xBF58476D1CE4E5B9) + b
        y ^= y >> np.uint64(31)
        return y

    x = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = grown(x, gram, mixed) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def spread(hashes: np.ndarray) -> np.ndarray:
    """Keys of hashes: the least of several are small, so they are spread again."""
    x = hashes * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pieces(raw: np.ndarray, ends: np.ndarray, width: int, gram: int = GRAM, step: int = SLICE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and key of each run of windows with one key; ends: where each document ends in raw."""
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low in range(0, max(len(raw) - width + 1, 0), step):
        keys = grown(gram_hashes(raw[low : low + step + width - 1], gram), width - gram + 1, np.minimum)
        n = len(keys)
        inside, cut = np.zeros(n + 1, np.int8), np.zeros(n, bool)
        a, z = np.clip(starts - low, 0, n), np.clip(np.maximum(ends - width + 1, starts) - low, 0, n)
        np.add.at(inside, a, 1)
        np.add.at(inside, z, -1)
        inside = np.cumsum(inside[:-1]) > 0
        cut[0] = True
        cut[1:] = keys[1:] != keys[:-1]
        cut[a[a < n]] = True
        cut[z[z < n]] = True
        at = np.flatnonzero(cut)
        length = np.diff(np.append(at, n))
        long = length > RUN
        if long.any():
            parts = np.where(long, -(-length // RUN), 1)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            length = np.minimum(np.repeat(length, parts) - nth * RUN, RUN)
            at = np.repeat(at, parts) + nth * RUN
        keep = inside[at]
        at, length = at[keep], length[keep]
        found.append((at + low, length, spread(keys[at])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """The documents of one block in the order of their ids, their bytes in one array, and their pieces."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = rows["doc_id"]
        self.order = np.array([LAST if x is None else x for x in self.ids.to_pylist()], np.int64)
        texts = [x.encode() for x in rows["text"].to_pylist()]
        self.ends = np.cumsum([len(x) for x in texts]).astype(np.int64) if texts else np.zeros(0, np.int64)
        self.data = b"".join(texts)
        self.raw = np.frombuffer(self.data, np.uint8)

    def pieces(self, width: int, step: int):
        at, length, key = pieces(self.raw, self.ends, width, step=step)
        return at, length, key, self.order[np.searchsorted(self.ends, at, "right")]


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which shuffle files compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def gaps(keys: np.ndarray) -> bytes:
    """Ascending keys as the gaps between them."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def ungaps(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, np.uint64), dtype=np.uint64)


def reduced(by: np.ndarray, values: np.ndarray, how) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of by in ascending order, how() of the values of each, and how many there are."""
    order = np.argsort(by, kind="stable")
    keys, at, n = np.unique(by[order], return_index=True, return_counts=True)
    return keys, how.reduceat(values[order], at) if len(at) else values[:0], n


def dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which entries go to which bucket."""
    to = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    found, at = np.unique(to[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, at[1:]))


SENT = "bucket long, block long, a binary, b binary, c binary, d binary, e binary"


def sent(rows: list[tuple]) -> pa.Table:
    """Rows of SENT."""
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
    names = ["bucket", "block", "a", "b", "c", "d", "e"]
    full = [(*r, *[None] * (7 - len(r))) for r in rows]
    return pa.table({n: pa.array([r[i] for r in full], k) for i, (n, k) in enumerate(zip(names, kinds))})


def keys_of_block(width: int, buckets: int, step: int):
    """Pass 1: each key of the block once, with the number of its pieces; odd where it has several documents here."""

    def run(rows: pa.Table) -> pa.Table:
        number = rows["block"][0].as_py()
        _, _, key, doc = Block(rows).pieces(width, step)
        key = key >> UNTOLD
        keys, least, n = reduced(key, doc, np.minimum)
        _, most, _ = reduced(key, doc, np.maximum)
        n = (2 * n + (least < most)).astype(np.uint32)
        out = []
        for bucket, which in dealt(keys, buckets):
            which = np.sort(which)
            out.append((bucket, number, gaps(keys[which]), planes(n[which])))
        return sent(out)

    return run


def keys_of_several(hot_from: int):
    """Pass 1, by bucket: to each block its keys that several documents have; those with very many pieces apart."""

    def run(rows: pa.Table) -> pa.Table:
        blocks = rows["block"].to_pylist()
        keys = [ungaps(x) for x in rows["a"].to_pylist()]
        counts = [unplanes(x, np.uint32).astype(np.int64) for x in rows["b"].to_pylist()]
        every, total, blocks_of = reduced(np.concatenate(keys), np.concatenate(counts) >> 1, np.add)
        _, several, _ = reduced(np.concatenate(keys), np.concatenate(counts) & 1, np.maximum)
        wanted = (blocks_of > 1) | (several > 0)
        hot = wanted & (total > hot_from)
        out = []
        for block, own in zip(blocks, keys):
            at = np.searchsorted(every, own)
            if wanted[at].any():
                out.append((0, block, gaps(own[wanted[at] & ~hot[at]]), gaps(own[hot[at]])))
        return sent(out)

    return run


def held(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are among ascending ones."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys


def pieces_of_block(width: int, buckets: int, step: int):
    """Pass 2: each distinct piece of the wanted keys to the bucket of its key, with its least document; and, under a bucket
    below 0 that is its alone, the block's own notes: where each piece starts, its windows, which piece stands for it, whether a smaller document here
    has the same."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        if not texts.num_rows or not wanted.num_rows:
            return sent([])
        number, block = texts["block"][0].as_py(), Block(texts)
        plain = np.sort(np.concatenate([ungaps(x) for x in wanted["a"].to_pylist()]))
        hot = np.sort(np.concatenate([ungaps(x) for x in wanted["b"].to_pylist()]))
        at, length, key, doc = block.pieces(width, step)
        is_hot = held(key >> UNTOLD, hot)
        keep = is_hot | held(key >> UNTOLD, plain)
        at, length, key, doc, is_hot = (x[keep] for x in (at, length, key, doc, is_hot))
        parts = np.where(is_hot, length, 1)  # a hot key's pieces are cut into their windows
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at, key, doc = np.repeat(at, parts) + nth, np.repeat(key, parts), np.repeat(doc, parts)
        length, is_hot = np.where(np.repeat(is_hot, parts), 1, np.repeat(length, parts)), np.repeat(is_hot, parts)
        data, known = block.data, {}
        stands = np.fromiter((known.setdefault(data[a:z], i) for i, (a, z) in enumerate(zip(at.tolist(), (at + length + width - 1).tolist()))), np.int64, len(at))
        first = np.flatnonzero(stands == np.arange(len(at)))
        texts_of = list(known)
        for i in np.flatnonzero(is_hot[first]).tolist():
            key[first[i]] = xxhash.xxh3_64_intdigest(texts_of[i])
        pack = zstandard.ZstdCompressor(level=3)  # pieces overlap little, but share words: half of what shuffle files make of them
        out = [(-1 - number, number, planes(at), planes(length.astype(np.uint8)), planes(stands.astype(np.uint32)), planes((doc > doc[stands]).astype(np.uint8)))]
        for bucket, which in dealt(key[first], buckets):
            i = first[which]
            out.append((bucket, number, planes(key[i]), planes(doc[i]), planes(i.astype(np.uint32)), planes(length[i].astype(np.uint8)), pack.compress(b"".join([texts_of[k] for k in which.tolist()]))))
        return sent(out)

    return run


def shortened(texts: list[bytes], keys: np.ndarray, width: int) -> list[int]:
    """Where in each text the one string is whose hash is the text's key, for keys all of whose texts have it once; else -1.
    Windows of such a key all hold that string, so one symbol may stand for it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes)
    hashes = spread(gram_hashes(data, GRAM))
    at = np.arange(len(hashes))
    of = np.searchsorted(ends, at, "right")
    hit = (hashes == keys[of]) & (at + GRAM <= ends[of])
    times = np.bincount(of[hit], minlength=len(texts))
    place = np.full(len(texts), -1)
    place[of[hit]] = at[hit] - (ends - sizes)[of[hit]]
    _, group = np.unique(keys, return_inverse=True)
    odd = np.bincount(group, weights=times != 1) > 0
    return np.where(odd[group], -1, place).tolist()


def shared_windows(texts: list[bytes], keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal windows of texts of one key, from the suffix array of all texts: text, window in it, group. Windows
    that no other window equals are left out."""
    symbols: list[int] = []
    places, numbers = shortened(texts, keys, width), np.unique(keys, return_inverse=True)[1].tolist()
    for x, place, number in zip(texts, places, numbers):
        if place >= 0:
            symbols += [c + 1 for c in x[:place]]
            symbols.append(257 + number)
            symbols += [c + 1 for c in x[place + GRAM :]]
        else:
            symbols += [c + 1 for c in x]
        symbols.append(0)
    short = np.array(places) >= 0
    sizes = np.array([len(x) for x in texts]) - short * (GRAM - 1)
    widths = width - short * (GRAM - 1)
    base = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    flat = np.array(symbols, np.int32)
    order = np.array(suffix_array(symbols), np.int64)
    text = np.searchsorted(base, order, "right") - 1
    window = order - base[text]
    keep = window <= (sizes - widths)[text]
    order, text, window = order[keep], text[keep], window[keep]
    same = np.zeros(len(order), bool)
    for kind, size in ((True, width - GRAM + 1), (False, width)):
        own = np.flatnonzero(short[text] == kind)  # windows of either kind differ: only one holds such a symbol
        if len(own):
            view = np.lib.stride_tricks.sliding_window_view(flat, size)
            for low in range(1, len(own), 1 << 16):
                some = own[low - 1 : low + (1 << 16)]
                got = view[order[some]]
                same[some[1:]] = (got[1:] == got[:-1]).all(axis=1) & (np.diff(some) == 1)
    group = np.cumsum(~same)
    keep = same.copy()
    keep[:-1] |= same[1:]
    return text[keep], window[keep], group[keep]


def verdicts(width: int, batch: int):
    """Pass 3, by bucket: to each block, of its pieces those with windows that start in a smaller document, as bits, as bucket
    -2; notes of blocks go by as bucket -1, so that the pieces are in shuffle files alone and in no table besides."""

    def run(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() < 0:
            return sent([(-1, *(r[c] for c in ("block", "a", "b", "c", "d"))) for r in rows.to_pylist()])
        rows = rows.sort_by("block")
        known: dict[bytes, int] = {}
        unpack = zstandard.ZstdDecompressor()
        text, key, doc, length, place, owner = [], [], [], [], [], []
        for block, k, d, i, n, t in zip(*(rows[c].to_pylist() for c in ("block", "a", "b", "c", "d", "e"))):
            k, d, i, n = unplanes(k, np.uint64), unplanes(d, np.int64), unplanes(i, np.uint32), unplanes(n, np.uint8).astype(np.int64)
            t, z = unpack.decompress(t), np.cumsum(n + width - 1)
            text.append(np.fromiter((known.setdefault(t[a:e], len(known)) for a, e in zip((z - n - width + 1).tolist(), z.tolist())), np.int64, len(n)))
            key.append(k), doc.append(d), length.append(n), place.append(i), owner.append(np.full(len(n), block))
        text, key, doc, length, place, owner = (np.concatenate(x) for x in (text, key, doc, length, place, owner))
        all_texts = list(known)
        _, at = np.unique(text, return_index=True)
        _, least, _ = reduced(text, doc, np.minimum)
        bits = np.zeros(len(at), np.uint32)  # for the least document of each distinct piece
        for some in differing(all_texts, key[at], width, batch):
            some = np.array(some)
            t, w, g = shared_windows([all_texts[i] for i in some.tolist()], key[at][some], width)
            t = some[t]
            _, low, sizes = reduced(g, least[t], np.minimum)
            goes = np.repeat(low, sizes) < least[t]
            np.bitwise_or.at(bits, t[goes], np.uint32(1) << w[goes].astype(np.uint32))
        full = (np.uint64(1) << length.astype(np.uint64)) - np.uint64(1)
        bits = np.where(doc > least[text], full.astype(np.uint32), bits[text])
        told = np.flatnonzero(bits)  # rows came by block, so owners ascend
        blocks, at = np.unique(owner[told], return_index=True)
        return sent([(-2, b, planes(place[which]), planes(bits[which])) for b, which in zip(blocks.tolist(), np.split(told, at[1:]))])

    return run


def differing(texts: list[bytes], key: np.ndarray, width: int, batch: int) -> Iterator[list[int]]:
    """The pieces that need sorting, in lists that hold keys whole: those that may share a window with a different piece of
    their key, that is, share the key of a longer string with it. Every shared window is in one list."""
    order = np.argsort(key, kind="stable")
    keys, at, n = np.unique(key[order], return_index=True, return_counts=True)
    several = order[np.repeat(n > 1, n)]
    if not len(several):
        return
    ends = np.cumsum([len(texts[i]) for i in several.tolist()]).astype(np.int64)
    start, _, finer = pieces(np.frombuffer(b"".join([texts[i] for i in several.tolist()]), np.uint8), ends, width, (width + GRAM) // 2)
    of = several[np.searchsorted(ends, start, "right")]
    finer = finer ^ key[of]
    _, low, _ = reduced(finer, of, np.minimum)
    _, high, _ = reduced(finer, of, np.maximum)
    found = np.unique(finer)
    shared = (low < high)[np.searchsorted(found, finer)]
    wanted = np.unique(of[shared])
    wanted = wanted[np.argsort(key[wanted], kind="stable")]
    some, size, last = [], 0, None
    for i, k in zip(wanted.tolist(), key[wanted].tolist()):
        if size > batch and k != last:
            yield some
            some, size = [], 0
        some.append(i)
        size += len(texts[i]) + 1
        last = k
    if some:
        yield some


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary, kept binary"


def cut_blocks(width: int, keep_text: bool):
    """Pass 4: the texts of a block without what the verdicts take."""

    def run(texts: pa.Table, notes: pa.Table) -> pa.Table:
        block = Block(texts)
        cover = np.zeros(len(block.raw) + 1, np.int32)
        own = notes.filter(pa.compute.equal(notes["bucket"], -1))
        if own.num_rows:
            at, length, stands, later = (unplanes(own[c][0].as_py(), k) for c, k in zip("abcd", (np.int64, np.uint8, np.uint32, np.uint8)))
            bits = np.zeros(len(at), np.uint32)
            said = notes.filter(pa.compute.equal(notes["bucket"], -2))
            for place, mask in zip(said["a"].to_pylist(), said["b"].to_pylist()):
                bits[unplanes(place, np.uint32)] = unplanes(mask, np.uint32)
            full = ((np.uint64(1) << length.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            bits = np.where(later > 0, full, bits[stands])
            for w in range(RUN):
                gone = at[(bits >> np.uint32(w)) & np.uint32(1) > 0] + w
                np.add.at(cover, gone, 1)
                np.add.at(cover, gone + width, -1)
        gone = np.cumsum(cover[:-1]) > 0
        out, low = [], 0
        for high in block.ends.tolist():
            data, mark = block.raw[low:high], gone[low:high]
            kept = data[~mark].tobytes()
            edge = np.flatnonzero(np.diff(mark.astype(np.int8), prepend=0, append=0))
            out.append((len(data), int(mark.sum()), len(edge) // 2, hashlib.sha256(kept).hexdigest(), edge.astype("<i8").tobytes(), kept if keep_text else None))
            low = high
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")
        return pa.table({"doc_id": block.ids} | {c: pa.array([r[i] for r in out], k) for i, (c, k) in enumerate(zip(names, kinds))})

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, keep_text: bool = True, block: int = BLOCK, hot: int = HOT, batch: int = BATCH, step: int = SLICE) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the bytes that
    stay, spans (start and end of each run in bytes, little-endian 64-bit pairs) and, with keep_text, those bytes.

    width is at least GRAM + 2. block, hot, batch and step bound the memory of a task; no result depends on them. Written
    tables go to spark.checkpoint.dir."""
    if width < GRAM + 2:
        raise ValueError(f"width is at least {GRAM + 2}")
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, -(-size // block))
    files, buckets = max(1, -(-blocks // PER_FILE)), max(1, blocks // 2)
    name, path = f"townlens_{uuid.uuid4().hex}", f"{shared_dir(spark)}/townlens/blocks-{uuid.uuid4().hex}"
    rows = rows.withColumn("block", F.expr(f"pmod(xxhash64(doc_id, text), {blocks})"))
    rows.repartition(files, "block").write.option("path", path).option("compression", "zstd").bucketBy(files, "block").saveAsTable(name)
    try:
        by_block = spark.table(name).groupBy("block")
        keys = by_block.applyInArrow(keys_of_block(width, buckets, step), SENT)
        wanted = keys.groupBy("bucket").applyInArrow(keys_of_several(hot), SENT)
        found = by_block.cogroup(wanted.groupBy("block")).applyInArrow(pieces_of_block(width, buckets, step), SENT)
        notes = written(found.groupBy("bucket").applyInArrow(verdicts(width, batch), SENT), "verdicts")
        out = written(by_block.cogroup(notes.groupBy("block")).applyInArrow(cut_blocks(width, keep_text), KEPT), "kept")
        forget(notes)
        remove(spark, path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out
