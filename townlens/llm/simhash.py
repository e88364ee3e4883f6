"""SimHash near-duplicates with Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in at most two bits
have, for some cyclic neighbour pair of segments (a, b), no error in a and at most one in b: of the three segments one
has no error, and the case table (2 errors in one segment, or 1 + 1) is covered by the ordered pairs (0,1), (1,2), (2,0).
Segment a is used as it is; segment b, padded to 23 bits, is decoded with the perfect binary Golay code [23, 12, 7].
The nearest codeword of x lies within 3 of x, so it lies within 4 of any y that differs from x in one bit: joining the
nearest codeword of one side with all codewords within 4 of the other (1 to 6 of them) misses no such pair. Each
fingerprint so gets 3 keys of one kind and 3 to 18 of the other, of 34 selective bits each.

Equal fingerprints are one node before any join, a candidate pair leaves the join only if it is a link, and a node
has at most 64 + 2016 links, so what is emitted grows in proportion to the input however large a group is.

Beside the fingerprints there is a stage by shingle similarity (similar_groups): documents whose sets of word shingles
have a Jaccard similarity of at least `similarity` are linked. Candidates are documents that share one of BANDS keys of
ROWS minhashes each (a pair at 0.8 is missed with a chance of 3 in 100,000), and each link is verified on the sets
themselves. Equal sets are one node. Each document is first held against the least of its bucket; a bucket whose
documents are then of one group needs no further pair. Documents of the other buckets are compared where their rarest
shingles meet, first with the least changed of them, then with all of other groups that can be similar, which misses none: neither a large group of near copies nor a passage that many documents
share makes a square of pairs.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; fewer than three words make
one shingle; repeated rows are copies; a null doc_id keeps its row and never becomes a component_id unless alone; columns of
other names, whatever they are, are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import forget, narrow, only_memo, written

#: The generator polynomial of the binary Golay code, and the bits of each segment (first bit, width).
GOLAY = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (1, 2), (2, 0))
SEED, SHINGLE, MAX_BITS = 42, 3, 2
#: Rows of one fingerprint above which it is no key of a shuffle, and the bytes of such fingerprints that are broadcast.
HEAVY, HEAVY_BYTES = 50_000, 16 << 20
#: Minhash keys of the similarity stage: BANDS keys of ROWS minhashes.
BANDS, ROWS = 26, 5


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit majority of the XXH64 hashes of all word shingles, repeats included."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    h = np.array([xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams], dtype=np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""

    def run(batches):
        only_memo("none", lambda: None)
        for b in batches:
            fps = np.array([fingerprint(t) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    source = narrow(docs, id_col, text)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


@lru_cache(1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each 12-bit data word, and for each syndrome the error patterns of weight up to 4 (0 fills up:
    a pattern given twice makes no new key)."""

    def rest(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    single = [rest(1 << i) for i in range(23)]
    errors: list[list[int]] = [[] for _ in range(2048)]

    def grow(start: int, weight: int, pattern: int, syndrome: int) -> None:
        errors[syndrome].append(pattern)
        if weight < 4:
            for i in range(start, 23):
                grow(i + 1, weight + 1, pattern | 1 << i, syndrome ^ single[i])

    grow(0, 0, 0, 0)
    table = np.zeros((2048, 6), dtype=np.int64)
    for s, found in enumerate(errors):
        found.sort(key=lambda e: (e.bit_count(), e))
        table[s] = (found + [found[0]] * 6)[:6]
        assert len(found) <= 6 and found[0].bit_count() <= 3
    return np.array([rest(d << 11) for d in range(4096)], dtype=np.int64), table


def codewords(x: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within 4 of each 23-bit value; the nearest comes first and fills up the rest."""
    remainder, errors = golay_tables()
    return (x[:, None] ^ errors[remainder[x >> 11] ^ (x & 2047)]) >> 11


def fuzzy_keys(fps: np.ndarray, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of the fingerprints: one key for each segment pair, or all within reach."""
    part = [((fps.view(np.uint64) >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    rows, keys = [], []
    for kind, (a, b) in enumerate(PAIRS):
        index = codewords(part[b])
        index = index[:, :1] if nearest else index
        fresh = np.ones(index.shape, dtype=bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :1]
        key = (np.int64(kind) << 40) | (part[a][:, None] << 12) | index
        rows.append(np.nonzero(fresh)[0])
        keys.append(key[fresh])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(nodes: DataFrame, nearest: bool) -> DataFrame:
    def run(batches):
        for b in batches:
            fps, ids = b.column("fp").to_numpy(zero_copy_only=False), b.column("node")
            rows, keys = fuzzy_keys(fps, nearest)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows]), ids.take(pa.array(rows))], ["key", "fp", "node"])

    return nodes.select("fp", "node").mapInArrow(run, f"key long, fp long, node {nodes.schema['node'].dataType.simpleString()}")


def links(nodes: DataFrame) -> DataFrame:
    """(u, v): every pair of nodes (fp, node) whose fingerprints differ in one or two bits, once."""
    x = _keyed(nodes, True).select("key", F.col("fp").alias("xfp"), F.col("node").alias("u"))
    y = _keyed(nodes, False).select("key", F.col("fp").alias("yfp"), F.col("node").alias("v"))
    near = (F.col("xfp") < F.col("yfp")) & (F.bit_count(F.col("xfp").bitwiseXOR(F.col("yfp"))) <= MAX_BITS)
    return x.hint("merge").join(y, (x["key"] == y["key"]) & near).groupBy("u", "v").agg(F.lit(1).alias("n")).select("u", "v")


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of an edge list (u, v) reaches.

    Each round takes the smallest label among the neighbours, then follows the label one step (pointer jumping), so
    rounds grow with the logarithm of a chain's length. State is a written table; the driver sees one count a round."""
    both = written(edges.select("u", "v").union(edges.select("v", "u")), f"{tag}-edges")
    state = written(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("component"), F.lit(True).alias("moved")), tag)
    while state.filter("moved").limit(1).count():
        heard = both.join(state.select(F.col("node").alias("v"), "component"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("low"))
        step = state.join(heard, "node").select("node", F.col("component").alias("was"), F.least("component", "low").alias("to"))
        jump = state.select(F.col("node").alias("to"), F.col("component").alias("beyond"))
        after = step.join(jump, "to").select("node", F.least("to", "beyond").alias("component"), (F.least("to", "beyond") < F.col("was")).alias("moved"))
        old, state = state, written(after, tag)
        forget(old)
    forget(both)
    return state.select("node", "component")


def by_key(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Rows with the class of their key, null where there is none; classes: one row a key, with n, its number of rows. Keys
    of very many rows, of which there are few, meet these where they lie: no key of the join is hot."""
    classes = written(classes, "classes")
    heavy = classes.filter(F.col("n") > HEAVY).drop("n")
    if heavy.count() * 24 > HEAVY_BYTES:
        return rows.join(classes.drop("n"), key, "left")
    few = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(classes.filter(F.col("n") <= HEAVY).drop("n"), key, "left")
    return rows.join(F.broadcast(heavy), key).unionByName(few)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of docs."""
    prints = written(fingerprints(docs, id_col, text), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "nodes")
    found = written(links(nodes.filter("node is not null")), "links")
    groups = components(found)
    classes = nodes.join(groups, "node", "left").select("fp", "n", F.coalesce("component", "node").alias("component_id"))
    named = by_key(prints, classes, "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@lru_cache(4)
def _factors(n: int) -> np.ndarray:
    """Odd 64-bit factors, the same in every worker."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) | 1 for i in range(n)], dtype=np.uint64)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles; fewer words than that make one shingle."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype=np.uint64)
    size = min(shingle, len(words))
    n, out = len(h) - size + 1, np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def band_keys(grams: np.ndarray) -> np.ndarray:
    """One key for each band of minhashes."""
    factors, low = _factors(BANDS * ROWS)[:, None], None
    for at in range(0, len(grams), 1024):
        part = grams[at : at + 1024] * factors
        part = (part ^ (part >> np.uint64(32))).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    if low is None:
        return np.zeros(0, dtype=np.int64)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(low.reshape(BANDS, ROWS))], dtype=np.uint64).view(np.int64)


def _sets(docs: DataFrame, shingle: int, keys: bool) -> DataFrame:
    """(doc_id, same, found): a hash of the shingle set, with its band keys or the set itself."""

    def run(batches):
        only_memo("none", lambda: None)
        for b in batches:
            column = b.column("text")
            for at in range(0, b.num_rows, 500):
                same, found = [], []
                for t in column.slice(at, 500).to_pylist():
                    grams = shingle_set(t, shingle)
                    same.append(xxhash.xxh64_intdigest(grams.tobytes(), SEED))
                    found.append(band_keys(grams) if keys else grams.view(np.int64))
                same = np.array(same, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, 500), pa.array(same), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "same", "found"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, same long, found array<long>")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of set hashes whose sets are similar enough; only the texts of candidates are read into sets."""
    asked = pairs.select(F.col("u").alias("same")).union(pairs.select(F.col("v").alias("same"))).distinct()
    ids = nodes.join(asked, "same", "left_semi").select(F.col("node").alias("doc_id")).distinct()
    sets = written(_sets(docs.join(ids, "doc_id", "left_semi"), shingle, False).dropDuplicates(["same"]), "sets")
    one = sets.select(F.col("same").alias("u"), F.col("found").alias("a"))
    two = sets.select(F.col("same").alias("v"), F.col("found").alias("b"))
    both = pairs.hint("merge").join(one, "u").hint("merge").join(two, "v")
    met = F.size(F.array_intersect("a", "b"))
    out = written(both.filter(met >= F.lit(similarity) * (F.size("a") + F.size("b") - met)).select("u", "v"), "similar")
    forget(sets)
    return out


def _prefixes(mixed: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(same, gram, n, left): the first shingles of each of the sets of mixed (same), rare ones first, and how many of its n
    are left from there on; written. Similar sets share one of their first n - similarity * n + 1 shingles."""
    ids = nodes.join(mixed.select("same"), "same", "left_semi").select(F.col("node").alias("doc_id")).distinct()
    one = written(_sets(docs.join(ids, "doc_id", "left_semi"), shingle, False).dropDuplicates(["same"]).select("same", F.explode("found").alias("gram")), "grams")
    often = one.groupBy("gram").agg(F.count("*").alias("often"))
    order = F.sort_array(F.collect_list(F.struct("often", "gram"))).alias("order")  # the shingles of one text
    sets = one.join(often, "gram").groupBy("same").agg(order, F.count("*").alias("n"))
    first = F.slice("order", F.lit(1), (F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).cast("int"))
    return written(sets.select("same", "n", F.posexplode(first).alias("at", "x")).filter("x.often > 1").select("same", "x.gram", "n", (F.col("n") - F.col("at")).alias("left")), "prefixes")


def _prefix_pairs(tokens: DataFrame, component: DataFrame, similarity: float, star: bool) -> DataFrame:
    """(u, v): pairs of different components that can be similar, as where they first meet enough is left of both:
    documents that share what many share, and differ else, meet late. star: each with the one document of a shingle alone
    that has most left of it, which is the least changed of a group of near copies."""
    named = tokens.join(component, "same", "left").withColumn("component", F.coalesce("component", "same"))
    split = named.groupBy("gram").agg((F.min("component") < F.max("component")).alias("split"), F.max_by("same", F.struct(F.col("left") / F.col("n"), "same")).alias("head")).filter("split").select("gram", "head")
    named = written(named.join(split, "gram"), "named")
    x = (named.filter("same = head") if star else named).select("gram", F.col("same").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"), F.col("left").alias("lu"))
    y = named.select(F.col("gram").alias("gram_"), F.col("same").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"), F.col("left").alias("lv"))
    sizes = F.least("nu", "nv") >= similarity * F.greatest("nu", "nv") - 1e-9
    left = F.least("lu", "lv") >= similarity / (1 + similarity) * (F.col("nu") + F.col("nv")) - 1e-9
    can = (F.col("gram") == F.col("gram_")) & (F.col("cu") != F.col("cv")) & sizes & left & (F.lit(True) if star else F.col("u") < F.col("v"))
    return written(x.hint("merge").join(y, can).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, component_id), one row for each row of docs: groups by Jaccard similarity of the word shingles."""
    source = narrow(docs, id_col, text)
    sets = written(_sets(source, shingle, True), "shingles")
    nodes = written(sets.groupBy("same").agg(F.min("doc_id").alias("node"), F.any_value("found").alias("keys"), F.count("*").alias("n")).filter("node is not null"), "nodes")
    keyed = written(nodes.select("same", F.explode("keys").alias("key")), "keys")
    least = keyed.groupBy("key").agg(F.min("same").alias("u"), F.count("*").alias("n")).filter("n > 1").select("key", "u")
    first = written(keyed.join(least, "key").filter("same <> u").select("u", F.col("same").alias("v")).distinct(), "pairs")
    near = _verified(first, nodes, source, shingle, similarity)

    grouped = keyed.join(components(near).select(F.col("node").alias("same"), "component"), "same", "left").withColumn("component", F.coalesce("component", "same"))
    split = grouped.groupBy("key").agg((F.min("component") < F.max("component")).alias("split")).filter("split").select("key")
    mixed = written(grouped.join(split, "key", "left_semi").select("same", "component").distinct(), "mixed")
    tokens = _prefixes(mixed, nodes, source, shingle, similarity)
    for star in (True, False):
        found = components(near).select(F.col("node").alias("same"), "component")
        near = near.unionByName(_verified(_prefix_pairs(tokens, found, similarity, star), nodes, source, shingle, similarity))

    classes = nodes.join(components(near).select(F.col("node").alias("same"), "component"), "same", "left").select("same", "node", "n", F.coalesce("component", "same").alias("component"))
    named = classes.groupBy("component").agg(F.min("node").alias("component_id"))
    return by_key(sets.select("doc_id", "same"), classes.join(named, "component").select("same", "n", "component_id"), "same").select("doc_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """The rows of docs without near-duplicates: of each group the document with the smallest id stays, once. Rows
    that share an id are copies of one document; rows without an id cannot be grouped and stay. With a similarity the
    groups are those of similar_groups, else those of the fingerprints."""
    groups = near_duplicates(docs, id_col, text) if similarity is None else similar_groups(docs, shingle, similarity, id_col, text)
    kept = written(groups.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct(), "kept")
    named = docs.filter(docs[id_col].isNotNull())
    return named.join(kept, named[id_col] == kept["_kept"], "left_semi").dropDuplicates([id_col]).unionByName(docs.filter(docs[id_col].isNull()))
